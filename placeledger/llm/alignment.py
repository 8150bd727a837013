"""Alignment of two tokenizers' tokens over the bytes they share.

A token is a range of a text's bytes, so a tokenisation is a sparse matrix of tokens by bytes.
A·Bᵀ, row by row, gives for each token of one tokenizer the tokens of the other it shares
bytes with, and how many. Where two tokens in a row share no partner, both tokenizers end at
one byte: there a group ends. The matrices of tokens by groups, multiplied in the same way, link
all tokens of a group with each other.

How many documents of a corpus have a pair of ids linked is counted in two exchanges: tasks read
texts by the batch and hand on each pair of a batch once, with its number of documents; the sums
come back to the batch by place, where documents keep places instead of pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from placeledger.llm.common import records, text_slices, written
from placeledger.llm.tokens import ChunkIds, ids_of
from placeledger.operators.joins import lookup

BYTE_LEVEL = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
# Products, and bytes of text, that are held at once.
PRODUCTS = 1 << 20
# Bytes of text whose pairs of ids are counted together before they leave the task.
BATCH_BYTES = 4 << 20


def cuts(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of items whose sizes add up to `most` at most, or of one item."""
    ends, lo = np.cumsum(sizes), 0
    while lo < len(sizes):
        done = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield lo, hi
        lo = hi


@dataclass
class Csr:
    """A sparse matrix of numbers by rows: those of row r lie at indptr[r] to indptr[r + 1]."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    width: int

    @classmethod
    def runs(cls, lengths: np.ndarray) -> Csr:
        """Row r has ones in the next lengths[r] columns: the bytes of each token."""
        ends = np.cumsum(lengths)
        width = int(ends[-1]) if len(ends) else 0
        return cls(np.concatenate([[0], ends]), np.arange(width), np.ones(width, dtype=np.int64), width)

    @classmethod
    def members(cls, column: np.ndarray, width: int) -> Csr:
        """Row r has a one in column[r]: the group of each token."""
        return cls(np.arange(len(column) + 1), column, np.ones(len(column), dtype=np.int64), width)

    def transposed(self) -> Csr:
        rows = np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))
        order = np.argsort(self.indices, kind="stable")
        counts = np.bincount(self.indices, minlength=self.width)
        return Csr(np.concatenate([[0], np.cumsum(counts)]), rows[order], self.data[order], len(self.indptr) - 1)

    def times(self, other: Csr, most: int = PRODUCTS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Entries (row, column, value) of the product, in order, some rows at a time: a row is the
        sum of the other's rows that it names, each times its number (Gustavson)."""
        many = np.diff(other.indptr)[self.indices]
        done = np.concatenate([[0], np.cumsum(many)])
        for lo, hi in cuts(done[self.indptr[1:]] - done[self.indptr[:-1]], most):
            a, b = self.indptr[lo], self.indptr[hi]
            own, count = self.indices[a:b], many[a:b]
            rows = np.repeat(np.arange(lo, hi), np.diff(self.indptr[lo:hi + 1]))
            at = np.repeat(other.indptr[own] - np.cumsum(count) + count, count) + np.arange(count.sum())
            key = np.repeat(rows, count) * other.width + other.indices[at]
            values = np.repeat(self.data[a:b], count) * other.data[at]
            entries, where = np.unique(key, return_inverse=True)
            total = np.bincount(where, weights=values, minlength=len(entries)).astype(np.int64)
            yield entries // max(other.width, 1), entries % max(other.width, 1), total


def overlaps(left: np.ndarray, right: np.ndarray, most: int = PRODUCTS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(left token, right token, shared bytes) of two tokenisations of the same bytes, by the
    tokens' lengths; the matrices are made for a window of bytes at a time."""
    ends, others = np.cumsum(left), np.cumsum(right)
    for lo, hi in cuts(left, most):
        start, end = int(ends[lo] - left[lo]), int(ends[hi - 1])
        first = int(np.searchsorted(others, start, side="right"))
        last = int(np.searchsorted(others, end, side="left")) + 1
        # Tokens that reach out of the window have only their bytes inside it here.
        inside = np.minimum(others[first:last], end) - np.maximum(others[first:last] - right[first:last], start)
        for i, j, shared in Csr.runs(left[lo:hi]).times(Csr.runs(inside).transposed(), most):
            yield i + lo, j + first, shared


def groups(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of both sides, from 0: a new one where a token shares no partner
    with the one before it. Tokens have a byte at least."""
    first, last = np.zeros(len(left), dtype=np.int64), np.zeros(len(left), dtype=np.int64)
    of_right = np.zeros(len(right), dtype=np.int64)
    found = list(overlaps(left, right))
    for i, j, _ in found:
        first[i[::-1]], last[i] = j[::-1], j
    own = np.concatenate([[0], np.cumsum(first[1:] != last[:-1])]) if len(left) else last
    for i, j, _ in found:
        of_right[j] = own[i]
    return own, of_right


def shared_links(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All (left token, right token) of one group, by the tokens' groups."""
    width = int(left[-1]) + 1 if len(left) else 0
    for i, j, _ in Csr.members(left, width).times(Csr.members(right, width).transposed()):
        yield i, j


class ByteLevel:
    """Ids by a byte-level vocabulary, of a text behind a space."""

    def __init__(self, name: str):
        tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        tokenizer.encode_special_tokens = True
        self.known = ChunkIds(tokenizer)
        # Printable bytes stand for themselves, the others for the letters from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
        names = {i: t for t, i in tokenizer.get_vocab().items()}
        # A token that no byte spells is never made from a text.
        self.bytes = [bytes(byte.get(c, 0) for c in names.get(i, "")) for i in range(max(names) + 1)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(ids_of(" " + t, self.known), dtype="<u4").astype(np.int64) for t in texts]


class Pieces:
    """Ids by a vocabulary of pieces, which puts the space before the text itself."""

    def __init__(self, name: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            own = bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()
            self.bytes.append(own)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, dtype=np.int64) for ids in self.model.encode(texts, num_threads=1)]


@cache
def sides(left: str, right: str) -> tuple[ByteLevel, Pieces, np.ndarray, np.ndarray, list[str]]:
    """Both vocabularies, the lengths of their tokens, and the texts of ids in a list of groups:
    left ids before a comma, before a bar, right ids before a comma, before a semicolon."""
    a, b = ByteLevel(left), Pieces(right)
    lengths = [np.array([len(t) for t in side.bytes], dtype=np.int64) for side in (a, b)]
    texts = [f"{i}{sign}" for side, signs in ((a, ",|"), (b, ",;")) for sign in signs for i in range(len(side.bytes))]
    return a, b, *lengths, texts


@dataclass
class Aligned:
    """The texts of a slice: per document its numbers and its list of groups, and for each of its
    pairs of ids (left id * right ids + right id) how often it is linked."""

    numbers: list[tuple[int, int, int, int, str]]
    doc: np.ndarray
    pair: np.ndarray
    times: np.ndarray


def encoded(texts: list[str | None], left: str, right: str) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Ids of both sides; none where the text is null or empty, or the bytes of a side's tokens
    are not the text's behind a space."""
    a, b, *_ = sides(left, right)
    none = np.zeros(0, dtype=np.int64)
    out = [none] * len(texts), [none] * len(texts)
    some = [k for k, t in enumerate(texts) if t]
    own = [texts[k] for k in some]
    for k, text, i, j in zip(some, own, a.encode(own), b.encode(own)):
        wanted = b" " + text.encode()
        if all(b"".join(map(side.bytes.__getitem__, ids.tolist())) == wanted for side, ids in ((a, i), (b, j))):
            out[0][k], out[1][k] = i, j
    return out


def align(texts: list[str | None], left: str = BYTE_LEVEL, right: str = PIECES) -> Aligned:
    """Align texts. They lie one behind the other: a document's end is an end for both sides, so
    no group and no link crosses it."""
    a, b, length_a, length_b, names = sides(left, right)
    ids_a, ids_b = encoded(texts, left, right)
    flat_a, flat_b = (np.concatenate([*ids, np.zeros(0, dtype=np.int64)]) for ids in (ids_a, ids_b))
    doc_a, doc_b = (np.repeat(np.arange(len(texts)), [len(i) for i in ids]) for ids in (ids_a, ids_b))
    group_a, group_b = groups(length_a[flat_a], length_b[flat_b])
    many = int(group_a[-1]) + 1 if len(group_a) else 0
    in_a, in_b = np.bincount(group_a, minlength=many), np.bincount(group_b, minlength=many)
    # A list of groups has a group's left ids, then its right ones.
    before_a, before_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
    listed = np.zeros(len(flat_a) + len(flat_b), dtype=np.int64)
    last_a, last_b = (np.append(g[1:] != g[:-1], np.ones(min(len(g), 1), dtype=bool)) for g in (group_a, group_b))
    listed[np.arange(len(flat_a)) + before_b[group_a]] = flat_a + last_a * len(a.bytes)
    listed[np.arange(len(flat_b)) + (before_a + in_a)[group_b]] = 2 * len(a.bytes) + flat_b + last_b * len(b.bytes)
    n_groups = np.bincount(doc_a[np.flatnonzero(last_a)], minlength=len(texts))
    n_links = np.bincount(doc_a, weights=in_b[group_a], minlength=len(texts)).astype(np.int64)
    numbers, at = [], 0
    for k in range(len(texts)):
        n_a, n_b = len(ids_a[k]), len(ids_b[k])
        text = "".join(map(names.__getitem__, listed[at:at + n_a + n_b].tolist()))[:-1]
        at += n_a + n_b
        digest = sha256(text.encode()).hexdigest() if text else ""
        numbers.append((n_a, n_b, int(n_groups[k]), int(n_links[k]), digest))
    # A document's pairs are distinct per block of products, and then in all.
    kinds = len(a.bytes) * len(b.bytes)
    parts = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))]
    for i, j in shared_links(group_a, group_b):
        parts.append(np.unique(doc_a[i] * kinds + flat_a[i] * len(b.bytes) + flat_b[j], return_counts=True))
    keys, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    times = np.bincount(where, weights=np.concatenate([p[1] for p in parts]), minlength=len(keys)).astype(np.int64)
    return Aligned(numbers, keys // kinds, keys % kinds, times)


def batches_of(docs: DataFrame, left: str, right: str, batch_bytes: int, id_col: str, text_col: str) -> DataFrame:
    """Rows of documents, with the places of their pairs among their batch's, and one row a batch
    with those pairs and the number of its documents that have each."""
    source = records(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    schema = (f"batch long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
              "places binary, times binary, pairs array<long>, holders array<int>")
    names = [f.split()[0] for f in schema.split(", ")]
    numbers = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    types = [*numbers, pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())]

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = TaskContext.get().partitionId() << 32
        ids, held, done = [], 0, []

        def out() -> Iterator[pa.RecordBatch]:
            pair = np.concatenate([d.pair for d in done])
            known, place, holders = np.unique(pair, return_inverse=True, return_counts=True)
            place, at = place.astype("<u4"), 0
            rows = []
            for d in done:
                ends = np.searchsorted(d.doc, np.arange(len(d.numbers) + 1))
                times = d.times.astype("<u4")
                for own, lo, hi in zip(d.numbers, ends, ends[1:]):
                    rows.append((*own, place[at + lo:at + hi].tobytes(), times[lo:hi].tobytes(), None, None))
                at += len(d.pair)
            arrays = [pa.array(c, type=t) for c, t in zip(zip(*rows), types)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch] * len(rows)), pa.concat_arrays(ids), *arrays], names=names)
            one = [None] * 7 + [known, holders.astype(np.int32)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch]), pa.nulls(1, ids[0].type), *[pa.array([v], type=t) for v, t in zip(one, types)]], names=names)

        for read in stream:
            first = 0
            for texts in text_slices(read.column("text")):
                done.append(align(texts, left, right))
                ids.append(read.column("doc_id").slice(first, len(texts)))
                first += len(texts)
                held += sum(map(len, filter(None, texts)))
                if held >= batch_bytes:
                    yield from out()
                    batch, ids, held, done = batch + 1, [], 0, []
        if done:
            yield from out()

    return source.mapInArrow(run, schema)


def alignment_digests(
    docs: DataFrame, left: str = BYTE_LEVEL, right: str = PIECES, batch_bytes: int = BATCH_BYTES,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Special tokens' strings are plain text. A text that is null or empty, or that a tokenizer
    changes (so that its tokens' bytes are not those of the text behind a space), has no tokens:
    zeros and an empty string. n_best counts the links whose pair of ids no other pair with the
    same left id exceeds in documents, ties included; count_sum adds the documents of each
    link's pair. Repeated rows count and are returned each; rows without an id too. Very long
    texts are aligned whole. An empty table gives no rows; other columns are not read.
    """
    aligned = written(batches_of(docs, left, right, batch_bytes, id_col, text_col), "alignment")
    size = len(sides(left, right)[1].bytes)
    asked = aligned.filter("pairs IS NOT NULL").select(
        "batch", F.posexplode(F.arrays_zip("pairs", "holders")).alias("place", "own")).select(
        "batch", "place", F.col("own.pairs").alias("pair"), F.col("own.holders").alias("holders"))
    counts = written(asked.groupBy("pair").agg(F.sum("holders").alias("documents")), "alignment-counts")
    # At most one row an id of the left vocabulary.
    top = counts.groupBy(F.expr(f"pair div {size}").alias("id")).agg(F.max("documents").alias("most"))
    rated = counts.withColumn("id", F.expr(f"pair div {size}")).join(F.broadcast(top), "id").select(
        "pair", "documents", (F.col("documents") == F.col("most")).alias("best"))
    answers = lookup(asked.select("batch", "place", "pair"), rated, "pair").select(
        F.col("batch").alias("asker"), "place", "documents", "best")
    rows = aligned.filter("pairs IS NULL").drop("pairs", "holders")
    kind = rows.schema["doc_id"].dataType.simpleString()
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]

    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        place = replies["place"].to_numpy()
        documents, best = np.zeros(len(place), dtype=np.int64), np.zeros(len(place), dtype=np.int64)
        documents[place], best[place] = replies["documents"].to_numpy(), replies["best"].to_numpy()
        n_best, total = [], []
        for places, times in zip(table["places"], table["times"]):
            own, often = np.frombuffer(places.as_py(), dtype="<u4"), np.frombuffer(times.as_py(), dtype="<u4").astype(np.int64)
            n_best.append(int((best[own] * often).sum()))
            total.append(int((documents[own] * often).sum()))
        columns = [*(table[c] for c in kept), pa.array(n_best, type=pa.int64()), pa.array(total, type=pa.int64()), table["groups_sha256"]]
        return pa.table(columns, names=[*kept, "n_best", "count_sum", "groups_sha256"])

    return rows.groupBy("batch").cogroup(answers.groupBy("asker")).applyInArrow(run, (
        f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"))
