"""Token ids in one concatenated array, with Elias-Fano encoded document boundaries.

The file is a table of blocks, so that Spark's committer writes it whole into any store.
Blocks follow each other by (part, block); a block holds the ids of consecutive documents:

  part, block, first_token   place of the block; first_token counts inside the part
  doc_ids                    ids of the block's documents, ascending
  n_tokens, width, ids       the id array, 2 or 4 bytes an id, little endian
  low_bits, low, high, ranks the documents' ends: the lower `low_bits` bits of each, packed;
                             the upper bits in unary; ones before every 512 bits of `high`

An end is ((select(i) - i) << low_bits) | low(i), where select(i) is the place of the i-th
one in `high`. That takes about 2 + log2(tokens / documents) bits a document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from placeledger.llm.common import records, shuffles_freed, tasks
from placeledger.llm.tokens import token_ids, vocabulary as load
from placeledger.session import run_dir

VOCABULARY = "word_bpe_49k.json"
END = 2
BLOCK_TOKENS = 1 << 20
SPAN = 512


@dataclass
class EliasFano:
    """A non-decreasing sequence of numbers."""

    size: int
    low_bits: int
    low: bytes
    high: bytes
    ranks: bytes

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        values = values.astype(np.uint64)
        universe = int(values[-1]) if n else 0
        low_bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits((values[:, None] >> shifts & np.uint64(1)).astype(np.uint8), bitorder="little")
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros((int(ones[-1]) + SPAN if n else SPAN) // SPAN * SPAN, dtype=np.uint8)
        bits[ones] = 1
        ranks = np.concatenate([[0], np.cumsum(bits.reshape(-1, SPAN).sum(axis=1))[:-1]]).astype("<u4")
        return cls(n, low_bits, low.tobytes(), np.packbits(bits, bitorder="little").tobytes(), ranks.tobytes())

    def select(self, which: np.ndarray) -> np.ndarray:
        """Places of the given ones: the span by the ranks, the bit inside by counting."""
        ranks = np.frombuffer(self.ranks, dtype="<u4")
        span = np.searchsorted(ranks, which, side="right") - 1
        rows = np.frombuffer(self.high, dtype=np.uint8).reshape(-1, SPAN // 8)
        out = np.empty(len(which), dtype=np.int64)
        for at in range(0, len(which), 4096):
            s = span[at:at + 4096]
            seen = np.cumsum(np.unpackbits(rows[s], axis=1, bitorder="little"), axis=1, dtype=np.int32)
            wanted = which[at:at + 4096] - ranks[s].astype(np.int64) + 1
            out[at:at + 4096] = s * SPAN + (seen < wanted[:, None]).sum(axis=1)
        return out

    def __getitem__(self, which: np.ndarray) -> np.ndarray:
        which = np.asarray(which, dtype=np.int64)
        upper = (self.select(which) - which) << self.low_bits
        if not self.low_bits:
            return upper
        bits = np.unpackbits(np.frombuffer(self.low, dtype=np.uint8), bitorder="little")
        own = bits[: self.size * self.low_bits].reshape(self.size, self.low_bits)[which].astype(np.int64)
        return upper | (own << np.arange(self.low_bits)).sum(axis=1)


def write_token_file(
    docs: DataFrame, path: str, vocabulary: str = VOCABULARY, end: int = END, block_tokens: int = BLOCK_TOKENS,
    id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Encode all texts and write them in ascending doc_id order (null ids first, equal ids
    by a hash of their texts). Null and empty texts are the end id alone."""
    source = records(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    # Equal ids may be many: the second key lets their rows spread over parts.
    ordered = source.repartitionByRange(tasks(docs.sparkSession), "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    kind = source.schema["doc_id"].dataType.simpleString()
    closing = np.array([end], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = load(vocabulary).tokenizer.get_vocab_size()
        width = 2 if max(size, end + 1) <= 1 << 16 else 4
        part, block, first = TaskContext.get().partitionId(), 0, 0
        texts: list[bytes] = []
        doc_ids: list = []
        held = 0

        def out() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(texts), dtype="<u4").astype(f"<u{width}")
            bounds = EliasFano.of(np.cumsum([len(t) // 4 for t in texts]))
            row = {
                "part": [part], "block": [block], "first_token": [first], "doc_ids": [doc_ids], "n_tokens": [len(ids)],
                "width": [width], "ids": [ids.tobytes()], "low_bits": [bounds.low_bits], "low": [bounds.low],
                "high": [bounds.high], "ranks": [bounds.ranks],
            }
            fields = [pa.field(n, t) for n, t in zip(row, [
                pa.int32(), pa.int64(), pa.int64(), pa.list_(id_type), pa.int64(), pa.int32(), pa.binary(), pa.int32(),
                pa.binary(), pa.binary(), pa.binary()])]
            return pa.RecordBatch.from_pydict(row, schema=pa.schema(fields))

        id_type = pa.int64()
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = token_ids(text.as_py(), vocabulary) + closing
                texts.append(ids)
                doc_ids.append(doc_id)
                held += len(ids) // 4
                if held >= block_tokens:
                    yield out()
                    block, first, held = block + 1, first + held, 0
                    texts, doc_ids = [], []
        if texts:
            yield out()

    blocks = ordered.select("doc_id", "text").mapInArrow(run, (
        f"part int, block long, first_token long, doc_ids array<{kind}>, n_tokens long, width int, ids binary, "
        "low_bits int, low binary, high binary, ranks binary"
    ))
    with shuffles_freed(docs.sparkSession):
        blocks.write.option("compression", "zstd").parquet(path)


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, in file order inside a block: doc_id, start (ids of all documents
    before it), n_tokens, ids (little-endian unsigned 32-bit, as binary)."""
    blocks = spark.read.parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row a part: as many as the writer had tasks, whatever the texts hold.
    sizes = blocks.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    bases = sizes.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                b = {n: batch.column(n)[row] for n in batch.schema.names}
                ids = np.frombuffer(b["ids"].as_py(), dtype=f"<u{b['width'].as_py()}")
                doc_ids = b["doc_ids"].values
                n = len(doc_ids)
                ef = EliasFano(n, b["low_bits"].as_py(), b["low"].as_py(), b["high"].as_py(), b["ranks"].as_py())
                ends = ef[np.arange(n)]
                starts = np.concatenate([[0], ends[:-1]])
                whole = ids.astype("<u4").tobytes()
                own = [whole[4 * s:4 * e] for s, e in zip(starts.tolist(), ends.tolist())]
                place = b["base"].as_py() + b["first_token"].as_py()
                yield pa.RecordBatch.from_arrays(
                    [doc_ids, pa.array(starts + place), pa.array(ends - starts), pa.array(own, type=pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return blocks.join(F.broadcast(bases), "part").mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids binary")


def token_digests(docs: DataFrame, **options) -> DataFrame:
    """Write the file into the shared folder, read it back, and give each document's place
    and the crc32 of its ids. An empty table gives no rows; repeated rows one each."""
    path = run_dir(docs.sparkSession, "tokens")
    write_token_file(docs, path, **options)
    return read_token_file(docs.sparkSession, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
