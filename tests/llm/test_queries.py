"""The registered queries against their SQL, and against brute force where there is none."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

import corpus_pipeline
from fleetlens.llm import language, lines, minhash, packing
from fleetlens.llm.queries import QUERIES, SQL
from tests.llm import brute
from tests.parity import connect, differences

FOLDER = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_sql(spark, name):
    rows, problems = differences(spark, FOLDER, QUERIES[name], SQL[name], connect(FOLDER))
    assert rows and not problems


def test_near_duplicates(spark, documents):
    expected = brute.components({i: r.text for i, r in documents.items()}, 2)
    found = {r.doc_id: r for r in QUERIES["op3_minhash"](spark, FOLDER).collect()}
    assert {i: r.component_id for i, r in found.items()} == expected
    assert all(r.kept == (i == expected[i]) for i, r in found.items())


def test_language_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{LARGER}/documents.parquet").collect()}
    rows = QUERIES["op5_language_id"](spark, LARGER).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.98


def test_quality_held_out(spark):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    rows = QUERIES["op8_quality"](spark, LARGER).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    good = [r.score for r in held if truth[r.doc_id]]
    bad = [r.score for r in held if not truth[r.doc_id]]
    wins = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert wins > 0.95 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.9


def test_packing_keeps_every_token(spark, documents):
    rows = QUERIES["op7_packing"](spark, FOLDER).collect()
    used = {}
    for r in rows:
        used[r.doc_id] = used.get(r.doc_id, 0) + r.length
        used.setdefault(("total", r.doc_id), r.doc_tokens)
    assert set(documents) == {k for k in used if not isinstance(k, tuple)}
    assert all(used[i] == used[("total", i)] for i in documents)


def test_shards_are_even(spark):
    rows = QUERIES["op9_sharding"](spark, LARGER).collect()
    sizes = np.zeros(24)
    for r in rows:
        sizes[r.shard] += r.size
    assert sizes.max() - sizes.min() <= 2 * max(r.size for r in rows)


def test_pipeline_stage_by_stage(spark, documents):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "line_dedup", "minhash_near_dedup", "decontamination", "packing"]
    texts = {i: r.text for i, r in documents.items()}

    def applied(k, table):
        path = corpus_pipeline.fresh_path(spark, "test-stage")
        corpus_pipeline.STAGES[k][1](spark, table, FOLDER).write.parquet(path)
        out = spark.read.parquet(path)
        if k < 4:
            assert out.dtypes == docs.dtypes
        return out

    known = applied(0, docs)
    scored = {r.source["doc_id"]: r for r in language.identify(docs).collect()}
    kept = {i for i, r in scored.items() if r.lang_pred != "und" and r.score >= corpus_pipeline.LEAST_SCORE}
    assert {r.doc_id for r in known.collect()} == kept

    expected = {i: t for i, t in brute.dedup_lines({i: texts[i] for i in kept}).items() if t or not texts[i]}
    unique = applied(1, known)
    assert {r.doc_id: r.text for r in unique.collect()} == expected
    assert all(r.n_chars == len(r.text) for r in unique.collect())

    roots = brute.components(expected, 5)
    distinct = applied(2, unique)
    assert sorted(r.doc_id for r in distinct.collect()) == sorted(set(roots.values()))

    items = {r.item_id: r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()}
    clean = {i for i in set(roots.values()) if not brute.hits(expected[i], items)[1]}
    clear = applied(3, distinct)
    assert {r.doc_id for r in clear.collect()} == clean

    pieces = applied(4, clear).collect()
    assert {r.doc_id for r in pieces} == clean
    assert sum(r.length for r in pieces) == sum({r.doc_id: r.doc_tokens for r in pieces}.values())
    assert {r.doc_id for r in corpus_pipeline.run(spark, FOLDER).collect()} == clean


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert not stage(spark, docs, FOLDER).collect()


def test_stages_with_nulls_and_repeated_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, "the quick brown fox jumps over it\nand on", "en", None, None), (1, "the quick brown fox jumps over it\nand on", "en", None, None),
            (None, "sans nom\net sans fin", None, None, None), (2, None, "en", "s", 0), (3, "", None, None, 0)]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = spark.createDataFrame(stage(spark, docs, FOLDER).collect(), schema)
    assert sorted(r.doc_id or 0 for r in docs.collect()) in ([0, 1], [1])


def test_every_setting_is_a_parameter():
    assert lines.dedup_lines.__defaults__ and minhash.Settings(words=2).hashes == 240 and packing.Settings().window == 4096
