"""From `documents` to packed training sequences, stage by stage.

Each stage reads the table that the stage before it wrote and works on all of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from placeledger.llm.common import row_key, written
from placeledger.llm.copies import first_copies
from placeledger.llm.decontaminate import contained_items
from placeledger.llm.langid import fit_languages, keep_identified
from placeledger.llm.packing import pack
from placeledger.llm.toxicity import fit_toxicity, keep_civil


# Bits that one of the fingerprints of near duplicates may differ in: copies with a word in
# thirty replaced differ in four to six, unrelated texts in about 32. The texts decide.
RADIUS = 6


def named(docs: DataFrame) -> DataFrame:
    """(row, key, text): each row whole, whatever its columns are called, and what names it."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return docs.select(F.struct(*columns).alias("row"), row_key().alias("key"), F.col("text").cast("string").alias("text"))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with enough confidence; null, empty and wordless texts
    and those without letters go. Repeated rows, ties and very long texts are told like any other;
    an empty table, or one without a known language, keeps no rows."""
    return keep_identified(docs, fit_languages(docs))


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic. Without both labels nothing is rejected. Null and
    empty texts have the score of no words; repeated rows stay or go together."""
    return keep_civil(docs, fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near duplicates (five-word shingles
    with a Jaccard similarity of 0.8 or more). A document without an id stays only where its
    group has none with one. Of rows with the same id and text the one with the smallest hash of
    its columns stays. Null, empty and wordless texts are one group."""
    # Maps have no hash; rows that differ in nothing else are told apart by none.
    hashed = [F.col(f"row.`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]
    keyed = named(docs).withColumn("tie", F.xxhash64(*hashed))
    first = first_copies(keyed, RADIUS, id_col="key").withColumnRenamed("doc_id", "key")
    kept = keyed.select("key", "tie", "row").join(first, "key")
    return kept.groupBy("key").agg(F.min_by("row", "tie").alias("row")).select("row.*")


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts hold none; rows without an id
    or with a repeated one are judged by their own text, and so are items."""
    keyed = named(docs)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    held = contained_items(keyed, items, id_col="key")
    leaks = written(held.select(F.col("doc_id").alias("key")).distinct(), "leaks")
    return keyed.select("key", "row").join(leaks, "key", "left_anti").select("row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two sequences of the documents' token ids; a null or empty text is its end id
    alone, repeated rows are packed each, and a very long text fills many sequences."""
    return pack(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("language_id", known_language), ("toxicity", civil), ("near_duplicates", distinct_texts),
    ("decontamination", uncontaminated), ("packing", packed),
]

# Trained models, 64-bit text hashes and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each but the last is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
