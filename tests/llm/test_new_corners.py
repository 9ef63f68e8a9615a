"""Periodic runs, quality rules and manifests: brute force, nulls, empty and long texts, ties, repeated rows."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import merkle, periodic, rules
from tests.llm.test_corners import LONG, SCHEMA, TEXTS, words

SPACES = " \t\n\x0b\f\r"


def own_words(text: str | None) -> list[str]:
    for c in SPACES:
        text = (text or "").replace(c, " ")
    return [w for w in text.split(" ") if w]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i % 5 == 0 else "en", None, None, 7, "k", 1, 2, 3, "s", 4, "h", [1], 5) for i, t in TEXTS.items()]
    rows += [rows[0], (None, "without an id\nbut two lines", "fr", None, None, 7, "k", 1, 2, 3, "s", 4, "h", [1], 5)]
    rows += [(1, "Another TEXT of id one", "en", "s", 22, 7, "k", 1, 2, 3, "s", 4, "h", [1], 5)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# --- periodic runs ------------------------------------------------------------------


def brute_runs(w: list[str]) -> list[tuple[int, int, int]]:
    found, n = [], len(w)
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            j = i
            while j < n and w[j] == w[j - q]:
                j += 1
            start, length = i - q, j - i + q
            smaller = any(all(w[k] == w[k - d] for k in range(start + d, start + length)) for d in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                found.append((start, length, q))
            i = max(j, i + 1)
    return sorted(found)


def repetitive(seed: int) -> str:
    """Powers of random words, some within others, between random ones."""
    r = np.random.default_rng(seed)
    out: list[str] = []
    for _ in range(int(r.integers(1, 8))):
        base = [str(x) for x in r.integers(0, int(r.integers(1, 5)), int(r.integers(1, 14)))]
        if r.integers(0, 3) == 0:
            base = base * int(r.integers(2, 6)) + [str(r.integers(0, 4))]
        times = int(r.integers(1, 8))
        out += (base * times)[: len(base) * times - int(r.integers(0, len(base)))]
    return " ".join(out)


def test_periodic_runs(spark):
    texts = {i: repetitive(i) for i in range(60)}
    texts |= {1000: "a " * 3000, 1001: "a b " * 150 + "c", 1002: "x x x x x x", 1003: "x x x x x", 1004: LONG, 1005: f"{words(40, 1)} " * 9}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    rows = {r.id: r for r in periodic.find_runs(df).collect()}
    assert sum(len(r.runs) for r in rows.values()) > 60
    for i, text in texts.items():
        w = own_words(text)
        expected = brute_runs(w) if len(w) < 5000 and i != 1000 else ([(0, 3000, 1)] if i == 1000 else [])
        assert [tuple(x) for x in rows[i].runs] == expected, i
        gone = {k for s, n, q in expected for k in range(s + q, s + n)}
        assert rows[i].collapsed == " ".join(x for k, x in enumerate(w) if k not in gone) and rows[i].n_words == len(w)


def test_periodic_corners(docs, none):
    rows = periodic.find_runs(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r.id: r for r in rows}
    assert all(not by_id[i].runs and by_id[i].collapsed == "" and by_id[i].n_words == 0 for i in (3, 4, 5))
    assert [tuple(x) for x in by_id[12].runs] == [(0, 120, 1)] and by_id[12].collapsed == "x"
    told = {r.doc_id: r for r in periodic.digest(periodic.find_runs(docs)).collect()}
    assert told[3].n_runs == 0 and told[3].start is None and told[3].runs_sha256 == hashlib.sha256(b"").hexdigest()
    assert told[12].runs_sha256 == hashlib.sha256(b"0,120,1\n").hexdigest() and told[12].exponent_milli == 120_000
    assert not periodic.find_runs(none).collect() and not periodic.digest(periodic.find_runs(periodic.with_repeated_tail(none))).collect()
    with pytest.raises(ValueError):
        periodic.find_runs(docs, settings=periodic.Settings(min_periods=3))


def test_repeated_tail(spark):
    texts = {i: words(1 + i % 40, i) for i in range(300)} | {300: None, 301: ""}
    df = spark.createDataFrame([*texts.items(), (None, "a b")], "doc_id long, text string")
    for r in periodic.with_repeated_tail(df).collect():
        h = zlib.crc32(str(r.doc_id).encode()) if r.doc_id is not None else 1
        w = own_words(texts.get(r.doc_id, "a b"))
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        assert own_words(r.text) == w


# --- quality rules ------------------------------------------------------------------


def brute_measures(text: str | None) -> dict[str, int]:
    w, text = own_words(text), text or ""
    lines = [x for x in text.split("\n") if own_words(x)]
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    inside = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    bare = [x.lower().strip(rules.MARKS) for x in w]
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in rules.SYMBOLS for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(inside), "n_lines": len(lines),
        "n_stop_words": sum(x in rules.STOP_WORDS for x in bare), "n_letter_words": sum(any(c.isalpha() for c in x) for x in w),
        "n_marked_lines": sum(x.lstrip(SPACES)[0] in "-*•" or x.rstrip(SPACES).endswith("...") for x in lines),
    }


def test_quality_rules(spark, docs, none):
    odd = {20: "- a\n* b\n• c\nd ...\n - a\n- a", 21: "a b c a b c a b c d", 22: "a a a a", 23: "a a a", 24: "# $ & <x> | 100%", 25: "Über, THE la; 漢字 🙂 a\x00b",
           26: " ".join(["the and of"] * 30), 27: words(60, 3), 28: "the " + words(60, 4), 29: "x\r\ny\r\nx\x0b\nx", 30: "a b  c"}
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame(list(odd.items()), "doc_id long, text string"))
    rows = rules.judge(more).collect()
    given = {(r.doc_id, r.text) for r in more.collect()}
    assert len(rows) == more.count()
    for i, text in given:
        if text == LONG:
            continue
        expected = brute_measures(text)
        assert any({m: r[m] for m in rules.MEASURES} == expected and r.id == i for r in rows), (i, expected)
    by_id = {r.id: r for r in rows}
    assert by_id[3].base_failed and by_id[3].failed == ["few_words", ] and not by_id[3].kept
    assert by_id[26].base_failed and "repeated_windows" in by_id[26].failed
    assert by_id[28].kept and not by_id[28].failed and by_id[27].failed == ["no_stop_words"] and not by_id[27].base_failed
    assert not rules.judge(none).collect()


def test_rules_are_one_projection_without_functions_of_the_user(docs):
    plan = rules.digest(rules.judge(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("Project", 1)[0] and "Python" not in plan and "Arrow" not in plan


def test_thresholds_are_inclusive(spark):
    df = spark.createDataFrame([(1, " ".join(str(i) for i in range(50))), (2, " ".join(str(i) for i in range(49)))], "doc_id long, text string")
    only = (rules.Rule("letters", "n_letter_words", "n_words", most=0), rules.Rule("none", "n_lines", "n_dup_lines", least=1))
    found = {r.id: r for r in rules.judge(df, rules=only).collect()}
    assert found[1].kept and not found[1].base_failed and found[2].base_failed and found[2].failed == ["few_words"]


# --- manifests ----------------------------------------------------------------------


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def brute_tree(digests: list[str], width: int) -> list[list[str]]:
    levels = [digests]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([sha("".join(now[i : i + width])) for i in range(0, len(now), width)])
    return levels


def climb(levels: list[list[str]], at: int, folded: str, width: int) -> tuple[str, str]:
    proof = ""
    for now in levels[:-1]:
        run = now[at - at % width : at - at % width + width]
        proof += "".join(run[: at % width] + run[at % width + 1 :])
        folded = sha("".join(run[: at % width] + [folded] + run[at % width + 1 :]))
        at //= width
    return proof, folded


def brute_manifest(rows: list[tuple], width: int) -> list[tuple]:
    def leaf(r):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))

    def lower(t):
        return t.translate(str.maketrans(merkle.UPPER, merkle.UPPER.lower())) if t else t

    groups: dict = {}
    for r in rows:  # doc_id, source, lang, n_chars, text
        hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
        groups.setdefault(r[2], []).append((r[0] is None, r[0] or 0, leaf(r), leaf((*r[:4], lower(r[4]))) if hit else leaf(r), r[0]))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [brute_tree([x[2] for x in sorted(groups[g])], width) for g in order]
    top, out = brute_tree([t[-1][0] for t in trees], width), []
    for k, g in enumerate(order):
        for at, (*_, own, claimed, doc_id) in enumerate(sorted(groups[g])):
            proof, folded = climb(trees[k], at, claimed, width)
            more, folded = climb(top, k, folded, width)
            out.append((doc_id, own, trees[k][-1][0], top[-1][0], sha(proof + more), folded, folded == top[-1][0]))
    return out


@pytest.mark.parametrize("width, nodes", [(8, 30_000), (3, 10)])
def test_manifest(spark, docs, none, width, nodes):
    settings = merkle.Settings(fanout=width, broadcast_nodes=nodes)

    def checked(df):
        return sorted(map(tuple, merkle.digest(merkle.check_documents(df, settings)).collect()), key=str)

    def told(df):
        return sorted(brute_manifest([tuple(r[c] for c in merkle.FIELDS) for r in df.collect()], width), key=str)

    many = [(i, f"Text {i % 17}" if i % 9 else None, ("a", "b", "é", None, "z")[i % 5 if i % 2 else 0], "s" if i % 3 else None, i) for i in range(150)]
    many += [(500 + i, "T", f"g{i}", None, None) for i in range(11)] + [many[3]] * 4
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    many = spark.createDataFrame(many, schema).repartition(4)
    if width == 8:
        assert not checked(none)
    for df in [many] if width < 8 else [docs, docs.where("lang = 'fr'").withColumn("lang", F.lit(None).cast("string"))]:
        assert checked(df) == told(df)
