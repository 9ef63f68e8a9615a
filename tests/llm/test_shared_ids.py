"""Different texts that share an id, or have none."""

from __future__ import annotations

import corpus_pipeline
from fleetlens.llm import lines, minhash, suffixes
from tests.llm.test_corners import words


def test_line_dedup_of_texts_that_share_an_id(spark):
    common = [words(5, 2000 + i) for i in range(30)]
    texts = [(i, "\n".join([words(4, 3000 + k), *common, words(4, 3100 + k)])) for k, i in enumerate((None, None, 5, 5, 6))]
    texts.append(texts[4])  # a repeated row
    rows = lines.dedup_lines(spark.createDataFrame(texts, "doc_id long, text string").repartition(3)).collect()
    removed = sorted((r.id is None, r.id or 0, r.n_removed) for r in rows)
    # every text but one, of id 5, loses what the chunks of the common lines hold
    most = max(r.n_removed for r in rows)
    assert most >= 15 and [x for x in removed if x[2] == 0] == [(False, 5, 0)]
    assert len(rows) == 6 and all(x[2] == most for x in removed if x[2])


def test_repeated_passages_of_texts_that_share_an_id(spark):
    w, u, v = words(80, 61), words(80, 62), words(90, 63)
    rows = [(5, w), (5, u), (7, f"x {w} y"), (8, v), (9, v), (8, f"{u} z"), (5, w)]
    found = suffixes.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    # id 5 twice: its text w in 7, its text u in 8; the copies of v as a whole
    assert sorted(map(tuple, found)) == [(5, 0, 80), (5, 0, 80), (7, 1, 81), (8, 0, 80), (8, 0, 90), (9, 0, 90)]
    alone = suffixes.repeated_passages(spark.createDataFrame(rows[:3], "doc_id long, text string")).collect()
    assert sorted(map(tuple, alone)) == [(5, 0, 80), (7, 1, 81)]


def test_a_very_common_gram(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "HOT_SHARE", 10**6)
    passage = words(55, 70)
    texts = [(i, f"{words(20, 5000 + i)} a{i} {passage} b{i} {words(20, 7000 + i)}") for i in range(1200)]
    found = suffixes.repeated_passages(spark.createDataFrame(texts, "doc_id long, text string").repartition(4)).collect()
    assert sorted(map(tuple, found)) == [(i, 21, 76) for i in range(1200)]


def test_near_dedup_stage_keeps_different_texts_of_an_id(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    a, b = words(60, 81), words(60, 82)
    rows = [(1, a, "en", "s2", 1), (1, a, "en", "s1", 1), (1, b, "en", "s", 1), (2, words(50, 83), None, None, None), (None, a, "en", "s", 1)]
    kept = corpus_pipeline.distinct_documents(spark, spark.createDataFrame(rows, schema).repartition(3), "").collect()
    assert sorted((r.doc_id or 0, r.text, r.source) for r in kept) == sorted([(1, a, "s1"), (1, b, "s"), (2, rows[3][1], None), (0, a, "s")])


def test_near_duplicates_of_texts_that_share_an_id(spark):
    """Rows of one id are one node: what one of its texts is linked with, all are."""
    a, b, c = (words(60, 90 + k) for k in range(3))
    near = " ".join(c.split()[:58] + ["other", "end"])
    rows = [(5, a), (5, b), (3, b), (9, c), (5, ""), (8, near), (8, a), (11, words(60, 99)), (12, None), (None, a)]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert len(found) == len(rows)
    assert {(r.id, r.component_id, r.kept) for r in found} == {
        (5, 3, False), (3, 3, True), (8, 3, False), (9, 3, False), (11, 11, True), (12, 12, True), (None, None, True)
    }
