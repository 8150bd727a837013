"""Byte-level BPE encoding and decoding by a file of ranks.

A text is cut by the vocabulary's pattern; each match is encoded by itself. All adjacent byte
pairs of a match are the leaves of a segment tree whose root is the leftmost pair of the
lowest rank. A merge kills one leaf and changes the pairs of its two live neighbours: three
point updates, each of which climbs only as far as a minimum changes. So a match of n bytes
takes n log n steps, whatever it holds.

Short matches of a slice of texts are merged in step, their trees of one size side by side in
an array; a long match has a tree of its own. Matches repeat: a worker keeps the ids of short
chunks (white space and the word behind it, which no match crosses), up to a number of
entries of bounded length.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import cache
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from placeledger.llm.common import records, slices, text_slices
from placeledger.llm.tokens import CHUNK, ODD

VOCABULARY = "byte_bpe_50k.tiktoken"
NONE = 1 << 62
# Chunks a worker remembers, and the characters up to which it does.
KEPT = 400_000
KEPT_CHARS = 48
# Bytes up to which a match shares an array of trees.
SHORT = 64
# Characters above which a text is cut into chunks a block at a time, and the chunks of a block.
LONG_TEXT = 1 << 20
BLOCK = 1 << 17


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one match: the lowest-ranked pair is merged, the leftmost first, until none is left.

    A leaf holds rank << 32 | place, so the root is the leftmost of the lowest.
    """
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    if n < 2:
        return [ranks[piece]] if n else []
    get, leaves = ranks.get, n - 1
    tree = [NONE] * (2 * leaves)
    for i in range(leaves):
        rank = get(piece[i:i + 2])
        if rank is not None:
            tree[leaves + i] = rank << 32 | i
    for i in range(leaves - 1, 0, -1):
        left, right = tree[2 * i], tree[2 * i + 1]
        tree[i] = left if left < right else right
    # Ends of live tokens by their starts, and the starts of the tokens before them (-1: none).
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    top = 1 if leaves > 1 else leaves
    while (lowest := tree[top]) != NONE:
        place = lowest & 0xFFFFFFFF
        gone = after[place]
        end = after[gone]
        after[place] = end
        last = before[place]
        changed = [(place, NONE)]
        if end < n:
            before[end] = place
            rank = get(piece[place:after[end]])
            if rank is not None:
                changed = [(place, rank << 32 | place)]
        if gone < leaves:
            changed.append((gone, NONE))
        if last >= 0:
            rank = get(piece[last:end])
            changed.append((last, NONE if rank is None else rank << 32 | last))
        for node, value in changed:
            node += leaves
            # A parent whose minimum stays ends the climb.
            while tree[node] != value:
                tree[node] = value
                if node == 1:
                    break
                other = tree[node ^ 1]
                if other < value:
                    value = other
                node >>= 1
    ids, place = [], 0
    while place < n:
        ids.append(ranks[piece[place:after[place]]])
        place = after[place]
    return ids


class Pairs:
    """The rank that two adjacent tokens have together, for arrays of tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        found = []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    found.append((left << 32 | right, rank))
        self.keys, self.ranks = np.array(sorted(found), dtype=np.int64).reshape(-1, 2).T.copy()

    def __call__(self, left: np.ndarray, right: np.ndarray, place: np.ndarray, there: np.ndarray) -> np.ndarray:
        """Leaves: rank << 32 | place, or NONE where the pair has no rank or is not `there`."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        there = there & (self.keys[at] == key)
        return np.where(there, self.ranks[at] << 32 | place, NONE)


def merged_together(pieces: list[bytes], pairs: Pairs, singles: np.ndarray) -> list[bytes]:
    """Ids of matches of one to SHORT bytes, each by a tree of its own; all trees take a merge at a time.
    `singles` has the id of each byte."""
    out: list[bytes] = [b""] * len(pieces)
    sizes = np.array([len(p) for p in pieces])
    width = 1
    while width < SHORT:
        width *= 2
        rows = np.flatnonzero((sizes <= width) & (sizes > (width // 2 if width > 2 else 0)))
        # A bounded number of trees at a time.
        for part in np.array_split(rows, -(-len(rows) // 8192)) if len(rows) else []:
            for row, ids in zip(part, merged_trees([pieces[r] for r in part], sizes[part], width, pairs, singles)):
                out[row] = ids
    return out


def merged_trees(pieces: list[bytes], n: np.ndarray, width: int, pairs: Pairs, singles: np.ndarray) -> list[bytes]:
    """Matches of at most `width` bytes, which is the number of leaves of each tree."""
    many, places = len(pieces), np.arange(width)
    data = b"".join(p.ljust(width, b"\0") for p in pieces)
    token = singles[np.frombuffer(data, dtype=np.uint8).reshape(many, width)]
    live = places < n[:, None]
    after = np.tile(np.arange(1, width + 2), (many, 1))
    before = np.tile(np.arange(-1, width), (many, 1))
    tree = np.full((many, 2 * width), NONE)
    tree[:, width:-1] = pairs(token[:, :-1], token[:, 1:], places[:-1], live[:, 1:])
    size = width
    while size > 1:
        tree[:, size // 2:size] = tree[:, size:2 * size].reshape(many, -1, 2).min(axis=2)
        size //= 2
    children = tree.reshape(many, width, 2)
    rows = np.flatnonzero(tree[:, 1] != NONE)
    while len(rows):
        lowest = tree[rows, 1]
        place = lowest & 0xFFFFFFFF
        gone = after[rows, place]
        end = after[rows, gone]
        last = before[rows, place]
        token[rows, place] = lowest >> 32
        live[rows, gone] = False
        after[rows, place] = end
        before[rows, end] = place
        right = token[rows, np.minimum(end, width - 1)]
        tree[rows, width + gone] = NONE
        tree[rows, width + place] = pairs(lowest >> 32, right, place, end < n[rows])
        some = last >= 0
        own, last = rows[some], last[some]
        tree[own, width + last] = pairs(token[own, last], token[own, place[some]], last, True)
        # The three leaves' ways to the root, a level at a time.
        nodes, at = np.concatenate([width + gone, width + place, width + last]), np.concatenate([rows, rows, own])
        level = width
        while level > 1:
            nodes >>= 1
            tree[at, nodes] = children[at, nodes].min(axis=1)
            level >>= 1
        rows = rows[tree[rows, 1] != NONE]
    counts = live.sum(axis=1)
    ids = token[live].astype("<u4").tobytes()
    ends = (np.cumsum(counts) * 4).tolist()
    return [ids[a:b] for a, b in zip([0, *ends], ends)]


class ByteBpe(dict):
    """Little-endian 32-bit ids of a chunk, as bytes; the dictionary is emptied when it is full."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self.ranks = ranks
        self.pairs = Pairs(ranks)
        self.singles = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.pattern = regex.compile(pattern)
        self.tokens = {rank: token for token, rank in ranks.items()}

    def matches(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks that are not known yet."""
        cut = [[m.encode() for m in self.pattern.findall(c)] for c in chunks]
        ids: dict[bytes, bytes] = {}
        short = []
        for match in set().union(*cut):
            whole = self.ranks.get(match)
            if whole is not None:
                ids[match] = whole.to_bytes(4, "little")
            elif len(match) > SHORT:
                ids[match] = array("I", merged(match, self.ranks)).tobytes()
            else:
                short.append(match)
        ids.update(zip(short, merged_together(short, self.pairs, self.singles)))
        return [b"".join(map(ids.__getitem__, c)) for c in cut]

    def joined(self, blocks: list[list[str]]) -> list[bytes]:
        """The ids of each block of chunks."""
        new = list(set().union(*blocks).difference(self))
        if len(self) + len(new) > KEPT:
            self.clear()
            new = list(set().union(*blocks))
        own = dict(zip(new, self.matches(new)))
        self.update((c, ids) for c, ids in own.items() if len(c) <= KEPT_CHARS)
        known = {c: ids for c, ids in own.items() if len(c) > KEPT_CHARS}
        return [b"".join([known[c] if c in known else self[c] for c in b] if known else map(self.__getitem__, b))
                for b in blocks]

    def cut(self, text: str) -> Iterator[list[str]]:
        """Chunks that hold whole matches, at most a block at a time."""
        # Where there is white space that only the pattern knows, the matches are the chunks.
        pattern = self.pattern if ODD.search(text) else CHUNK
        if len(text) < LONG_TEXT:
            yield pattern.findall(text)
        else:
            found = (m.group() for m in pattern.finditer(text))
            while block := list(islice(found, BLOCK)):
                yield block

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = []
        for text in texts:
            if text and len(text) >= LONG_TEXT:
                out.append(b"".join(self.joined([block])[0] for block in self.cut(text)))
            else:
                out.append(b"")
        short = [k for k, text in enumerate(texts) if text and len(text) < LONG_TEXT]
        for k, ids in zip(short, self.joined([next(self.cut(texts[k])) for k in short])):
            out[k] = ids
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


@cache
def vocabulary(name: str) -> ByteBpe:
    """One per worker process; `name` is a rank file of public_tokenizers: a token in base64 and
    its rank a line."""
    ranks = {}
    with open(public_tokenizers.path(name), "rb") as lines:
        for line in lines:
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
    return ByteBpe(ranks, public_tokenizers.PATTERN)


def encode_texts(docs: DataFrame, name: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, ids (little-endian unsigned 32-bit, as binary).

    Null, empty: no ids. Special tokens do not exist; their strings are ordinary text. A very
    long text is encoded whole, match by match. Repeated rows, and rows without an id, stay,
    one result each; other columns, whatever their names, are not read. An empty table gives
    no rows.
    """
    source = records(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(name)
        for batch in batches:
            done = 0
            for texts in text_slices(batch.column("text")):
                ids = pa.array(own.encode(texts), type=pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(done, len(texts)), ids], ["doc_id", "ids"])
                done += len(texts)

    return source.mapInArrow(run, f"doc_id {kind}, ids binary")


def decode_ids(encoded: DataFrame, name: str = VOCABULARY, kept: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `kept`, `ids` and `decoded`: the bytes of column `ids` (as encode_texts gives
    it; null as none). Bytes, for ids of part of a text may end inside a character."""
    source = encoded.select(*kept, "ids")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(name)
        for batch in batches:
            column = batch.column("ids")
            sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
            for lo, hi in slices(sizes, 1 << 20):
                part = batch.slice(lo, hi - lo)
                texts = [own.decode(np.frombuffer(x.as_py() or b"", dtype="<u4")) for x in part.column("ids")]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, type=pa.binary())], [*part.schema.names, "decoded"])

    return source.mapInArrow(run, f"{schema}, decoded binary")


def bpe_digests(docs: DataFrame, name: str = VOCABULARY, **columns) -> DataFrame:
    """Encode and decode each document: doc_id, n_tokens, and the sha256 of the ids and of the
    decoded bytes. A null or empty text has no ids; both digests are those of nothing."""
    decoded = decode_ids(encode_texts(docs, name, **columns), name)
    return decoded.select(
        "doc_id", F.expr("cast(octet_length(ids) div 4 as long)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
