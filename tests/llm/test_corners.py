"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing column names."""

from __future__ import annotations

import gzip
import hashlib
import io
import zipfile
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import decontamination, language, lines, minhash, packing, quality, sharding, suffixes, vectors, warc
from fleetlens.llm.common import Words, components
from fleetlens.llm.queries import TOKENIZER
from tests.llm import brute

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, id long, key string, chunks int, block long, "
    "bucket int, score string, size int, shard string, lines array<int>, gone int"
)


def words(n: int, seed: int) -> str:
    r = np.random.default_rng(seed)
    return " ".join("".join(chr(97 + c) for c in r.integers(0, 26, 4)) for _ in range(n))


PASSAGE = words(70, 99)
LONG = "\n".join(words(40, 1000 + i) for i in range(500))  # 20,000 words
TEXTS = {
    1: "Alpha beta gamma\ndelta line two\nthird line here\nfourth line there",
    2: "Alpha beta gamma\ndelta line two\nthird line here\nfourth line there",
    3: None,
    4: "",
    5: " \n\t ",
    6: "word",
    7: LONG,
    8: f"{words(30, 1)} {PASSAGE} {words(30, 2)}",
    9: f"{words(35, 3)} {PASSAGE.upper()} {words(20, 4)}",
    10: "1234 5678 ,.;",
    11: "élan Über ÉLAN naïve",
    12: "x " * 120,
}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i % 5 == 0 else "en", None, None, 7, "k", 1, 2, 3, "s", 4, "h", [1], 5) for i, t in TEXTS.items()]
    rows.append(rows[0])  # a repeated row
    rows.append((None, "without an id\nbut two lines", "fr", None, None, 7, "k", 1, 2, 3, "s", 4, "h", [1], 5))
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_words_agree_with_split():
    texts = [None, "", "  a  bB\tc\n", "é ü", "x" * 3000 + " y", LONG]
    found = Words(pa.array(texts))
    for i, text in enumerate(texts):
        part = range(found.first[i], found.first[i + 1])
        own = [found.data[found.starts[k] : found.ends[k]].tobytes() for k in part]
        assert own == brute.split_words(text)
    long_words = Words(pa.array(["aaaaaaaaaaaab aaaaaaaaaaaac baaaaaaaaaaaa"]))
    assert len(set(long_words.hashes.tolist())) == 3


def test_components(spark):
    pairs = [(i, i + 1) for i in range(10, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long"), "t").collect()}
    assert {found[i] for i in range(11, 41)} == {10} and {found[i] for i in range(101, 140)} == {100} and 7 not in found
    assert not components(spark.createDataFrame([], "a long, b long"), "t").collect()


def test_line_dedup(docs, none):
    found = {r.id: r for r in lines.dedup_lines(docs).collect() if r.id}
    expected = brute.dedup_lines({i: t for i, t in TEXTS.items() if t is not None})
    assert {i: r.text for i, r in found.items() if r.text is not None} == expected
    assert found[3].text is None and found[3].n_lines == 0 and found[4].n_lines == 1
    assert found[1].text == TEXTS[1] and found[2].n_removed > 0
    assert lines.dedup_lines(docs).count() == docs.count() and not lines.dedup_lines(none).collect()


def test_line_runs(spark, docs, none):
    """Every repeated run of two or more lines goes, wherever it lies; runs of equal lines leave two."""
    r = np.random.default_rng(8)
    runs = [[words(6, 700 + 10 * i + k) for k in range(2 + i % 5)] for i in range(12)]
    texts = {i: t for i, t in TEXTS.items() if t is not None}
    for i in range(60):
        own = [words(5, 5000 + 20 * i + k) for k in range(8)]
        at = int(r.integers(0, 9))
        texts[100 + i] = "\n".join(own[:at] + runs[int(r.integers(0, 12))] + own[at:])
    texts |= {300: "\n".join(["same"] * 9), 301: "a\n" + "\n".join(["same"] * 3) + "\nb", 302: "same\nb", 303: "x\nx\nx", 304: "\n\n\n\n", 305: "x\nx"}
    more = spark.createDataFrame([(i, t) for i, t in texts.items() if i not in TEXTS], "doc_id long, text string")
    found = {x.id: x for x in lines.dedup_runs(docs.select("doc_id", "text").unionByName(more)).collect() if x.id}
    lost = brute.repeated_runs(texts)
    assert sum(len(n) for i, n in lost.items() if 100 <= i < 160) > 100
    for i, text in texts.items():
        own = text.split("\n")
        assert found[i].text == "\n".join(t for k, t in enumerate(own) if k not in lost[i]), i
        assert (found[i].n_lines, found[i].n_removed) == (len(own), len(lost[i]))
    assert found[300].text == "same\nsame" and found[301].text == "a\nb" and found[302].text == ""
    assert found[303].text == "x\nx" and found[305].text == "" and found[3].text is None and found[3].n_lines == 0
    assert lines.dedup_runs(docs).count() == docs.count() and not lines.dedup_runs(none).collect()


def test_decontamination(spark, docs, none):
    items = [(1, words(12, 50)), (2, "only four words here"), (3, None), (4, "..."), (None, "alpha beta"), (2, "only four words here"), (5, "ÉLAN naïve")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    planted = spark.createDataFrame(
        [(20, f"a {words(12, 50)[5:]} b. Only, FOUR words... here!"), (21, "only four words"), (22, "élan naïve"), (23, "Élan naïve")], "doc_id long, text string"
    )
    own = {i: t for i, t in items if i and t}
    for table in (docs, planted):
        for block in (4_000_000, 40):
            found = decontamination.decontaminate(table, bench, block_bytes=block).collect()
            assert len(found) == table.count()
            for r in found:
                hit, which = brute.hits(r.source["text"], own)
                assert {w for s in r.spans for w in range(s.begin, s.end)} == hit and set(r.items) == which
                assert r.n_words == len(brute.benchmark_words(r.source["text"]))
    assert not decontamination.decontaminate(none, bench).collect()
    assert {r.n_words for r in decontamination.decontaminate(planted, bench.limit(0)).collect()} and not decontamination.decontaminate(none, bench.limit(0)).collect()


def test_decontamination_of_a_later_call(spark, monkeypatch):
    """Workers that served one call do not search for its items in the next, whatever address its table had."""
    monkeypatch.setattr(decontamination, "id", lambda _: 7, raising=False)
    docs = spark.createDataFrame([(1, words(12, 51)), (2, words(12, 52))], "doc_id long, text string").coalesce(1)
    for k in (1, 2):
        bench = spark.createDataFrame([(k, words(12, 50 + k))], "item_id long, text string")
        found = {r.source["doc_id"]: r["items"] for r in decontamination.decontaminate(docs, bench).collect()}
        assert found == {k: [k], 3 - k: []}


@pytest.mark.parametrize("n", [2, 5])
def test_minhash(docs, none, n):
    found = minhash.near_duplicates(docs, settings=minhash.Settings(words=n))
    rows = found.collect()
    assert len(rows) == docs.count()
    expected = brute.components(TEXTS, n)
    assert all(r.component_id == expected[r.id] for r in rows if r.id)
    other = [r for r in rows if r.id is None]
    assert other[0].component_id is None and other[0].kept
    assert not minhash.near_duplicates(none).collect()


def test_minhash_links_all_of_a_family(spark):
    """Copies with edits, each like its base and not like every other, beside near misses."""
    r = np.random.default_rng(5)
    base = words(120, 7).split()
    texts = {}
    for i in range(80):
        own = list(base)
        for at in r.choice(120, 9 if i % 4 else 14, replace=False):
            own[at] = words(1, 100 + i)
        texts[i] = " ".join(own)
    texts |= {200 + i: words(100, 300 + i) for i in range(20)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = minhash.near_duplicates(df, settings=minhash.Settings(words=2)).collect()
    expected = brute.components(texts, 2)
    assert {r.id: r.component_id for r in rows} == expected


def test_bayes_bound_keeps_pairs_at_the_threshold():
    settings = minhash.Settings()
    fewest = minhash.least_matches(settings)
    assert (np.diff(fewest) > 0).all() and 0 < fewest[0] < settings.batch and fewest[-1] < 0.8 * settings.hashes


def test_repeated_passages(docs, none):
    settings = suffixes.Settings(min_words=50)
    found: dict[int, set[int]] = {}
    for r in suffixes.repeated_passages(docs, settings=settings).collect():
        found.setdefault(r.id, set()).update(range(r.begin, r.end))
    assert found == brute.repeated_words(TEXTS, 50)
    assert {8, 9, 12} <= set(found)
    assert not suffixes.repeated_passages(none).collect()


def test_repeated_passages_with_few_suffixes(spark):
    """One suffix in a partition is its first and its last one, and no repeat of itself."""
    texts = {i: f"{words(60, 800 + i)} {words(19, 600 + i % 6)} {words(60, 900 + i)}" for i in range(12)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        rows = suffixes.repeated_passages(df, settings=suffixes.Settings(min_words=20)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert not brute.repeated_words(texts, 20) and not rows


def test_repeated_passages_of_near_copies(spark):
    """Families of near copies: the best partner of a suffix is next to it in neither order."""
    r = np.random.default_rng(11)
    texts: dict[int, str | None] = {}
    for family in range(3):
        base = words(300, 40 + family).split()
        for i in range(150):
            own = list(base)
            for at in r.choice(300, 9, replace=False):
                own[at] = words(1, 10_000 + 1000 * family + int(r.integers(0, 900)))
            texts[1000 * family + i] = " ".join(own)
    rows = list(texts.items())
    df = spark.createDataFrame(rows + rows[:20], "doc_id long, text string").repartition(4)
    found: dict[int, set[int]] = {}
    for x in suffixes.repeated_passages(df).collect():
        found.setdefault(x.id, set()).update(range(x.begin, x.end))
    assert found == brute.repeated_words(texts, 50)


def test_language(docs, none):
    rows = language.identify(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r.source["doc_id"]: r for r in rows}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (3, 4, 5, 10))
    assert by_id[7].lang_pred == "en" and all(0 <= r.score <= 1 for r in rows) and not by_id[None].held_out
    assert not language.identify(none).collect()
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(unlabelled).collect()} == {"und"}


def test_vectors(spark):
    r = np.random.default_rng(3)
    rows = [(i, r.normal(size=16).tolist(), 1) for i in range(300)]
    rows += [(400 + i, rows[7][1], 1) for i in range(30)]  # ties
    rows += [(500, None, 1), (501, [0.0] * 16, 1), (502, [float("nan")] * 16, 1), (503, [None] + [1.0] * 15, 1),
             (504, [float("inf")] * 16, 1), (505, [], 1), (None, [1.0] * 16, 1), (520, [1.0, 2.0], 1), (521, [2.0, 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, code int")
    settings = vectors.Settings(k=5, block=100, query_block=4, chunk=32)
    found = vectors.nearest(df, F.col("id") % 20 == 0, settings=settings).collect()
    good = {i: np.float32(v).astype(float) for i, v, _ in rows if i is not None and v and i not in range(500, 506)}
    for q in [i for i in good if i % 20 == 0]:
        scored = sorted((-float(sum(a * b for a, b in zip(good[q], v))), i) for i, v in good.items() if i != q and len(v) == len(good[q]))[:5]
        own = sorted((x.rank, x.vec_id, x.score) for x in found if x.query_id == q)
        assert [o[1] for o in own] == [i for _, i in scored] and [o[0] for o in own] == list(range(1, len(scored) + 1))
        assert [o[2] for o in own] == [-s for s, _ in scored]
    assert not vectors.nearest(df.limit(0), F.col("id") % 20 == 0).collect()


def test_packing(docs, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(TOKENIZER)
    odd = [(30, "Don't <|endoftext|> stop it　ΣΑΣ İstanbul ͅx é \x1c\x00 12a3 …!!"), (31, "ﬁn ŉ Ａ １２ 漢字 🙂 ñ")]
    table = docs.select("doc_id", "text").distinct().unionByName(docs.sparkSession.createDataFrame(odd, "doc_id long, text string"))
    rows = packing.pack(table, path, settings=packing.Settings(window=64, shard_tokens=3000)).collect()
    whole = Tokenizer.from_file(path)
    texts = {r.doc_id: r.text for r in table.collect()}
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(pieces) == set(texts)
    for i, text in texts.items():
        ids = whole.encode(text or "", add_special_tokens=False).ids + [2]
        own = sorted(pieces[i], key=lambda r: r.start)
        joined = np.frombuffer(b"".join(r.ids for r in own), dtype="<u4").tolist()
        assert joined == ids and [r.start for r in own] == np.cumsum([0] + [r.length for r in own[:-1]]).tolist()
        assert {r.doc_tokens for r in own} == {len(ids)}
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        total = sum(r.length for r in own)
        assert [r.offset for r in own] == np.cumsum([0] + [r.length for r in own[:-1]]).tolist()
        assert total <= 64 and total & (total - 1) == 0
    assert not packing.pack(none, path).collect()


def test_packing_puts_like_documents_together():
    kinds = [np.arange(100 * k, 100 * k + 60, dtype=np.uint16) for k in range(8)]
    documents = [np.random.default_rng(i).permutation(kinds[i % 8])[:32] for i in range(64)]
    packer = packing.Packer(0, packing.Settings(window=256))
    packer.shard(list(range(64)), documents)
    packer.finish()
    together: dict[int, set[int]] = {}
    for doc, _, _, _, sequence, _ in packer.take():
        together.setdefault(sequence, set()).add(doc % 8)
    assert all(len(kinds) == 1 for kinds in together.values())


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (7, 1), (8, 0), (9, None), (None, 1), (77, 1)], "doc_id long, quality int")
    rows = quality.score_quality(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert not quality.score_quality(none, labels).collect()
    assert {r.score for r in quality.score_quality(docs, labels.limit(0)).collect()} == {0.5}


def test_isotonic():
    x, y = quality.isotonic(np.arange(5.0), np.array([0.0, 3.0, 1.0, 2.0, 4.0]), np.array([4.0, 4.0, 4.0, 4.0, 4.0]))
    assert (np.diff(y) > 0).all() and y[0] == 0 and y[-1] == 1 and len(y) == 3


@pytest.mark.parametrize("shards", [3, 24])
def test_sharding(docs, none, shards):
    rows = sharding.shard_documents(docs, shards=shards, bits=3).collect()
    assert len(rows) == docs.count()

    def key(r):
        digest = lambda t, n: int(hashlib.md5(t.encode()).hexdigest()[:n], 16)
        return digest(r.source["text"] or "", 8) << 28 | digest("" if r.id is None else str(r.id), 7)

    total = sum(r.size for r in rows)
    below = {k: sum(r.size for r in rows if key(r) < k) for k in {key(r) for r in rows}}
    assert all(r.shard == shards * below[key(r)] // total for r in rows)
    assert all(r.size == len((r.source["text"] or "").encode()) + 8 for r in rows)
    for s in {r.shard for r in rows}:
        own = sorted((r.slot, key(r)) for r in rows if r.shard == s)
        assert [o[0] for o in own] == list(range(len(own))) and [o[1] for o in own] == sorted(o[1] for o in own)
    assert not sharding.shard_documents(none).collect()


def test_warc(spark, tmp_path):
    big = "<p>" + "é" * 200
    rows = [(5, "http://a/\n x", big, 1), (3, "http://b", big, 1), (9, None, big, 1), (None, "n", big, 1), (1, "u", "short", 1),
            (2, "u", "short", 1), (4, "u", None, 1), (6, "u", "", 1), (3, "http://b", big, 1), (8, "u", "z" * 100, 1), (7, "u", LONG, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int").repartition(2)
    packages = warc.write_archives(pages, f"file://{tmp_path}/packages", package_bytes=300)
    found = warc.read_records(packages).collect()
    assert len(found) == len(rows) and packages.count() > 2
    for r in found:
        text = {i: h for i, _, h, _ in rows}[r.page_id] or ""
        revisit = text == big and r.page_id != 3
        assert r.record_type == ("revisit" if revisit else "response") and r.refers_to == (3 if revisit else None)
        assert r.payload_bytes == len(text.encode()) and r.payload_digest == hashlib.sha256(text.encode()).hexdigest()
        assert (r.payload is None) == revisit and (revisit or bytes(r.payload) == text.encode())
    for path in (r.path for r in packages.collect()):
        assert zipfile.ZipFile(path.removeprefix("file://")).testzip() is None
    assert not warc.read_records(warc.write_archives(pages.limit(0))).collect()


def test_zip_directory_forms():
    """ZIP64 fields and end records, and a package without an index."""
    out = io.BytesIO()
    member = gzip.compress(b"one") + gzip.compress(b"two" * 1000)
    with zipfile.ZipFile(out, "w") as package:
        with package.open("archive/a.warc.gz", "w", force_zip64=True) as f:
            f.write(member)
        package.writestr("packed.txt", "x" * 500, compress_type=zipfile.ZIP_DEFLATED)
    data = out.getvalue()
    entries = warc.directory(io.BytesIO(data), len(data))
    assert [e["name"] for e in entries] == ["archive/a.warc.gz", "packed.txt"]
    at = warc.data_place(io.BytesIO(data), entries[0])
    assert data[at : at + len(member)] == member
    with pytest.raises(ValueError):
        warc.data_place(io.BytesIO(data), entries[1])
    spans = list(warc._members_of(io.BytesIO(data), at, len(member)))
    assert [zlib.decompress(data[a : a + n], 31) for a, n in spans] == [b"one", b"two" * 1000]

    # the same directory behind a ZIP64 end record
    import struct

    end = data.rfind(b"PK\x05\x06")
    count, length, place = struct.unpack("<HII", data[end + 10 : end + 20])
    wide = struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, count, count, length, place)
    locator = struct.pack("<4sIQI", b"PK\x06\x07", 0, end, 1)
    short = struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    big = data[:end] + wide + locator + short
    assert warc.directory(io.BytesIO(big), len(big)) == entries
    with pytest.raises(ValueError):
        warc.directory(io.BytesIO(b"no archive"), 10)
