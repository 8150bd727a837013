"""Packing by power-of-two decomposition.

A document of n ids is cut into pieces of `longest` ids and then one piece for each set bit
of the rest, longest first. Each piece is a sequence of its own, so none crosses documents
and none needs padding; sequences of one length form a bucket, from which batches are drawn.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from placeledger.llm.common import records
from placeledger.llm.tokens import token_ids

LONGEST = 2048
VOCABULARY = "byte_bpe_50k.json"
END = 1


def piece_lengths(n: int, longest: int = LONGEST) -> list[int]:
    """Powers of two that add up to n, each at most `longest` (itself a power of two)."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in reversed(range(longest.bit_length())) if rest >> b & 1]


def pack(
    docs: DataFrame, longest: int = LONGEST, vocabulary: str = VOCABULARY, end: int = END,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, bucket (log2 of the length), ids
    (little-endian unsigned 32-bit, as binary), sequence_id, offset (always 0).

    Every document ends with id `end`; a null or empty text is that id alone. A null doc_id
    and repeated rows are documents like any other. An empty table gives no rows. No
    shuffle: a piece stays where its document was read.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest piece must be a power of two")
    source = records(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "doc_tokens", "ids"]
    closing = np.array([end], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            at: list[int] = []

            def out() -> pa.RecordBatch:
                columns = list(zip(*rows))
                arrays = [batch.column("doc_id").take(pa.array(at))]
                arrays += [pa.array(c, type=t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.binary()])]
                return pa.RecordBatch.from_arrays(arrays, names)

            for i, text in enumerate(batch.column("text")):
                ids = token_ids(text.as_py(), vocabulary) + closing
                total, start = len(ids) // 4, 0
                for length in piece_lengths(total, longest):
                    rows.append((start, length, total, ids[4 * start:4 * (start + length)]))
                    at.append(i)
                    start += length
                held += total
                if held >= 1 << 20:
                    yield out()
                    rows, held = [], 0
                    at = []
            if rows:
                yield out()

    pieces = source.mapInArrow(run, f"doc_id {kind}, start long, length long, doc_tokens long, ids binary")
    # The id is unique: the task's number and the row's number in the task.
    return pieces.select(
        "*", F.log2("length").cast("int").alias("bucket"),
        F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """A folder per length; every row of it is one whole sequence."""
    pieces.write.partitionBy("bucket").parquet(path)


def piece_digests(docs: DataFrame, **options) -> DataFrame:
    """`pack` with the crc32 of a piece's ids in their place."""
    return pack(docs, **options).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket",
    )
