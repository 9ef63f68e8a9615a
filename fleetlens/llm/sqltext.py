"""Pieces of DuckDB SQL that several checking statements share."""

from __future__ import annotations


def crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII string expression, bit by bit; null for null."""
    shift = "lambda a, b: case when a % 2 = 1 then xor(a // 2, 3988292384) else a // 2 end"
    step = f"lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], {shift})"
    codes = f"list_transform(string_split({text}, ''), lambda d: cast(ascii(d) as bigint))"
    return f"xor(list_reduce(list_prepend(cast(4294967295 as bigint), {codes}), {step}), cast(4294967295 as bigint))"
