"""Naive Bayes counted gram by gram in plain Python, next to the operator."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import pytest

from fleetlens.llm import language
from fleetlens.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
MASK = (1 << 64) - 1


def buckets(text: str | None, settings: language.Settings) -> list[int]:
    """The bucket of each run of one to three characters that ends at each place, spaces around the text."""
    lead = settings.longest - 1
    padded = " " * lead + (text or "").lower() + " "
    codes = [ord(c) if c.isalpha() else 32 for c in padded]
    out = []
    for n in range(1, settings.longest + 1):
        for i in range(len(codes)):
            code = 0
            for k in range(n):
                # the operator joins a column of texts; before a text's own spaces there is a space again
                code = (code * 0x100000001B3 + (codes[i - k] if i >= k else 32)) & MASK
            out.append((((code + n) & MASK) * 0x9E3779B97F4A7C15 & MASK) >> 40 & (settings.buckets - 1))
    return out


def test_predictions_equal_naive_counting(spark):
    settings = language.Settings()
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    fold = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 4 for r in rows}
    counts: dict[str, Counter] = {}
    documents: Counter = Counter()
    for r in rows:
        if fold[r.doc_id] != 2 and r.lang is not None and r.text is not None:
            counts.setdefault(r.lang, Counter()).update(buckets(r.text, settings))
            documents[r.lang] += 1
    totals = {k: sum(c.values()) + settings.smoothing * settings.buckets for k, c in counts.items()}
    found = {r.doc_id: r for r in QUERIES["op5_language_id"](spark, FOLDER).collect()}
    for r in sorted(rows, key=lambda r: len(r.text or ""))[:150]:
        own = Counter(buckets(r.text, settings))
        scores = {
            k: math.log(documents[k] / sum(documents.values()))
            + sum(times * math.log((c[b] + settings.smoothing) / totals[k]) for b, times in own.items()) for k, c in counts.items()
        }
        best = max(scores.values())
        shares = {k: math.exp(s - best) for k, s in scores.items()}
        posterior = {k: s / sum(shares.values()) for k, s in shares.items()}
        if any(c.isalpha() for c in r.text or ""):
            assert found[r.doc_id].score == pytest.approx(max(posterior.values()), abs=2e-3)
            assert posterior[found[r.doc_id].lang_pred] == pytest.approx(max(posterior.values()), abs=2e-3)
        else:
            assert found[r.doc_id].lang_pred == "und" and found[r.doc_id].score == 0
        assert found[r.doc_id].held_out == (fold[r.doc_id] == 2)
