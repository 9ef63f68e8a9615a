"""Lexical retrieval packing: fixed windows of tokens filled with documents on like subjects.

Each task packs its own partition in shards of about `shard_tokens` tokens: an inverted index with
BM25 weights is built over the shard's documents; the document at the head of a window is its
seed, and the unused documents that score best against the seed's `query_terms` weightiest terms
follow until the window is full. A document that does not fit is cut; its rest heads the next
window. The window left open at the end of a shard goes on with the next shard, and the last one
of a partition is divided into sequences whose lengths are powers of two, so nothing is padded.

No shuffle takes place and nothing of the corpus leaves its task; sequence ids carry the
partition's number. Rows are sorted by id and text inside the partition, so that a repeated task
packs alike. A null or empty text is the end token alone.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import ASCII_SPACE, Words, slices

WINDOW = 4096
END = 2


@dataclass(frozen=True)
class Settings:
    """k1, b: BM25; query_terms: terms of a seed that are searched for."""

    window: int = WINDOW
    end: int = END
    shard_tokens: int = 1_500_000
    query_terms: int = 48
    k1: float = 1.2
    b: float = 0.75


#: Fixed by the tokenizer file: how its pre-tokenizer divides lower-cased text.
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def _byte_names() -> list[str]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from 256."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    names, extra = [], 0
    for b in range(256):
        names.append(chr(b) if b in printable else chr(256 + extra))
        extra += b not in printable
    return names


#: Words that the short way may take: printable ASCII and precomposed Latin letters with a plain lower case.
_PLAIN = regex.compile("[!-~\u00c0-\u012f\u0131-\u0148\u014a-\u017f]+")


class Tokens:
    """Token ids of whole texts. White space separates tokens, so words are tokenized once each.

    Plain words are divided as the tokenizer's pre-tokenizer does and go straight to its merge
    model; anything unusual goes through the whole tokenizer. Two generations of at most `most`
    words, and as many pieces of words, are remembered.
    """

    def __init__(self, path: str, most: int = 250_000):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.names = _byte_names()
        self.most, self.young, self.old, self.pieces = most, {}, {}, {}

    def _piece(self, piece: str) -> bytes:
        name = piece if piece.isascii() else "".join([self.names[b] for b in piece.encode()])
        found = array("H", [t.id for t in self.model.tokenize(name)]).tobytes()
        if len(self.pieces) >= self.most:
            self.pieces.clear()
        self.pieces[piece] = found
        return found

    def _fresh(self, word: bytes) -> bytes:
        found = self.old.get(word)
        if found is None:
            text = word.decode("utf-8", "replace")
            if "<|" in text or not _PLAIN.fullmatch(text):
                return array("H", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
            known = self.pieces.get
            found = b"".join([known(p) or self._piece(p) for p in _PIECES.findall(text.lower())])
        return found

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text, without an end token."""
        words = Words(texts, ASCII_SPACE, lower=False)
        _, first, which = np.unique(words.hashes, return_index=True, return_inverse=True)
        data = words.data.tobytes()
        kinds = [data[s:e] for s, e in zip(words.starts[first].tolist(), words.ends[first].tolist())]
        if len(self.young) >= self.most:
            self.young, self.old = {}, self.young
        coded = list(map(self.young.get, kinds))
        for i, found in enumerate(coded):
            if found is None:
                coded[i] = self.young[kinds[i]] = self._fresh(kinds[i])
        flat = np.frombuffer(b"".join(coded), dtype=np.uint16)
        sizes = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded)) // 2
        begin = np.cumsum(sizes) - sizes
        lengths = sizes[which]
        until = np.concatenate([[0], np.cumsum(lengths)])
        ids = flat[np.arange(until[-1]) + np.repeat(begin[which] - until[:-1], lengths)]
        return [ids[until[a] : until[b]] for a, b in zip(words.first[:-1], words.first[1:])]


class Index:
    """BM25 over the documents of a shard; terms are token ids."""

    def __init__(self, documents: list[np.ndarray], settings: Settings):
        n = len(documents)
        lengths = np.array([len(d) for d in documents])
        terms = np.concatenate(documents).astype(np.int64)
        postings, times = np.unique(terms * n + np.repeat(np.arange(n), lengths), return_counts=True)
        self.n, self.settings = n, settings
        self.term, self.doc = postings // n, postings % n
        self.first = np.searchsorted(self.term, np.arange(np.iinfo(np.uint16).max + 2))
        df = np.diff(self.first)
        self.idf = np.log1p((n - df + 0.5) / (df + 0.5))
        norm = settings.k1 * (1 - settings.b + settings.b * lengths / max(lengths.mean(), 1))
        self.weight = self.idf[self.term] * times * (settings.k1 + 1) / (times + norm[self.doc])
        # the terms of each document, weightiest first
        self.by_doc = np.lexsort((self.term, -self.weight, self.doc))
        self.doc_first = np.searchsorted(self.doc[self.by_doc], np.arange(n + 1))

    def neighbours(self, seed: int) -> np.ndarray:
        """All documents, best first; ties by number."""
        own = self.by_doc[self.doc_first[seed] : self.doc_first[seed + 1]][: self.settings.query_terms]
        query = self.term[own]
        begin, size = self.first[query], self.first[query + 1] - self.first[query]
        until = np.cumsum(size)
        at = np.arange(until[-1] if len(until) else 0) + np.repeat(begin - (until - size), size)
        scores = np.bincount(self.doc[at], weights=self.weight[at], minlength=self.n)
        return np.argsort(-scores, kind="stable")


class Packer:
    """Pieces (document, start, ids, tokens of the document, sequence, offset) of one partition."""

    def __init__(self, first_sequence: int, settings: Settings):
        self.settings, self.sequence = settings, first_sequence
        self.window: list[tuple] = []  # pieces of the open window
        self.filled = 0
        self.done: list[tuple] = []

    def _close(self) -> None:
        self.done += self.window
        self.window, self.filled, self.sequence = [], 0, self.sequence + 1

    def _place(self, doc: int | None, ids: np.ndarray) -> bool:
        """Puts a whole document down; does it head the window that is open then?"""
        at, heads = 0, False
        while at < len(ids):
            heads = self.filled == 0
            piece = ids[at : at + self.settings.window - self.filled]
            self.window.append((doc, at, piece, len(ids), self.sequence, self.filled))
            self.filled += len(piece)
            at += len(piece)
            if self.filled == self.settings.window:
                self._close()
                heads = False
        return heads

    def shard(self, names: list[int | None], documents: list[np.ndarray]) -> None:
        index = Index(documents, self.settings)
        unused = np.ones(len(documents), dtype=bool)
        seed, order, at, lowest = None, None, 0, 0
        for _ in range(len(documents)):
            if seed is None:
                while not unused[lowest]:
                    lowest += 1
                doc = lowest
            else:
                if order is None:
                    order, at = index.neighbours(seed), 0
                while not unused[order[at]]:
                    at += 1
                doc = int(order[at])
            unused[doc] = False
            before = self.sequence
            heads = self._place(names[doc], documents[doc])
            if heads or self.filled == 0:
                seed, order = (doc if heads else None), None
            elif seed is None:
                seed = doc
            elif self.sequence != before:
                seed, order = doc, None

    def finish(self) -> None:
        """Divides the open window into sequences of 2048, 1024, ... tokens."""
        pieces, left = self.window, self.filled
        self.window, self.filled = [], 0
        while left:
            size = 1 << left.bit_length() - 1
            left -= size
            offset = 0
            while offset < size:
                doc, start, ids, total, _, _ = pieces[0]
                part = ids[: size - offset]
                self.done.append((doc, start, part, total, self.sequence, offset))
                offset += len(part)
                pieces = pieces[1:] if len(part) == len(ids) else [(doc, start + len(part), ids[len(part) :], total, 0, 0), *pieces[1:]]
            self.sequence += 1

    def take(self) -> list[tuple]:
        done, self.done = self.done, []
        return done


_TOKENS: dict[str, Tokens] = {}

_SCHEMA = "id long, start long, ids binary, length long, doc_tokens long, sequence_id long, offset long"
_NAMES = ["id", "start", "ids", "length", "doc_tokens", "sequence_id", "offset"]


def _rows(pieces: list[tuple]) -> pa.RecordBatch:
    doc, start, ids, total, sequence, offset = zip(*pieces)
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, pa.int64()), pa.array(start, pa.int64()),
         pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary()), pa.array([len(i) for i in ids], pa.int64()),
         pa.array(total, pa.int64()), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names=_NAMES,
    )


def pack(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """One row per piece: id, start, ids (little-endian 32 bits), length, doc_tokens, sequence_id, offset.

    `tokenizer` is the file's path on the executors.
    """
    base = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text")).sortWithinPartitions("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _TOKENS:
            _TOKENS[tokenizer] = Tokens(tokenizer)
        tokens = _TOKENS[tokenizer]
        packer = Packer(TaskContext.get().partitionId() << 33, settings)
        names, documents, size = [], [], 0
        end = np.array([settings.end], dtype=np.uint16)

        def full() -> Iterator[pa.RecordBatch]:
            packer.shard(names, documents)
            done = packer.take()
            for at in range(0, len(done), 2000):
                yield _rows(done[at : at + 2000])

        for batch in batches:
            for part, texts in slices(batch, batch.column("text"), 4_000_000):
                names += part.column("id").to_pylist()
                new = [np.concatenate([ids, end]) for ids in tokens.encode(texts)]
                documents += new
                size += sum(map(len, new))
                if size >= settings.shard_tokens:
                    yield from full()
                    names, documents, size = [], [], 0
        if documents:
            yield from full()
        packer.finish()
        done = packer.take()
        if done:
            yield _rows(done)

    return base.mapInArrow(run, _SCHEMA)


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
