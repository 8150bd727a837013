"""Merkle manifest of a dataset, with leaf places from bitmaps.

A row's digest is a leaf. Inside a group leaves ascend by id; every FANOUT consecutive nodes
make one of the next level, until one is left, the group's subroot; the subroots, in the order
of their groups, make the root in the same way.

Places without sorting the rows: ids are merged into bitmaps of 64 ids, only those that hold an
id (bit_or, folded where the rows lie). Directories of counts stand above them as the levels of
a radix tree: a node is told how many rows its group has before it by its parent and its
siblings, never more than 2^DIGIT of them. A row's place is the count before its bitmap plus
the set bits below its own. Rows that share an id are placed among each other by their digests,
through the same directories over the digests' first 64 bits; equal rows stand side by side.

Levels are reduced STEP at a time: the nodes of a span of FANOUT^STEP places are put into an
array by place and hashed pairwise up; spans are as many tasks as needed. On the way down each
span gets the siblings on its way to the root from the span above it.
"""

from __future__ import annotations

from collections.abc import Callable
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from placeledger.llm.common import written
from placeledger.operators.joins import lookup
from placeledger.operators.numbering import number_rows

FANOUT = 8
STEP = 4
SPAN = FANOUT ** STEP
WORD = 6
DIGIT = 16
TAMPERED = 3
# Copies of one row that one task writes out.
COPIES = 1 << 16


def field(value: Column) -> Column:
    """A value's part of a leaf: its length in UTF-8 bytes, a colon and itself; null is a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, columns)), 256)


def before(df: DataFrame, group: list[str], within: list[str], at: str, count: str, name: str, shift: int) -> DataFrame:
    """`df`, one row a (group, within, at), with `name`: the sum of `count` over the group's rows
    of lower (within, at). `at` is a long without its lowest `shift` bits; `within` has few values.

    Rows are summed up by all but the last DIGIT bits of `at`, and so on until nothing is left
    of it; the sums before a node come down again, added to those of its siblings.
    """
    def earlier(keys: list[str], *order: str) -> Column:
        rows = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(count).over(rows), F.lit(0))

    if shift + DIGIT >= 64:
        return df.withColumn(name, earlier(group, *within, at))
    up, above = f"_up{shift}", f"_above{shift}"
    keys = [*group, *within, up]
    here = df.withColumn(up, F.shiftright(at, DIGIT)).withColumn(name, earlier(keys, at))
    sums = here.groupBy(*keys).agg(F.sum(count).alias("_rows"))
    nodes = before(sums, group, within, up, "_rows", above, shift + DIGIT).select(*keys, above)
    return here.join(nodes, keys).withColumn(name, F.col(name) + F.col(above)).drop(up, above)


def ranked(rows: DataFrame, group: list[str], within: list[str], at: str) -> DataFrame:
    """`rows` (with a number `n` of copies each) with `rank`, the number of the group's rows of
    lower (within, at), and `shared`: whether other rows have the same."""
    keys = [*group, *within]
    bit = F.col(at).bitwiseAND((1 << WORD) - 1).cast("int")
    own, lower_bits = F.call_function("shiftleft", F.lit(1).cast("long"), bit), F.bitwise_not(
        F.call_function("shiftleft", F.lit(-1).cast("long"), bit))
    rows = rows.withColumn("word", F.shiftright(at, WORD))
    words = rows.groupBy(*keys, "word").agg(F.bit_or(own).alias("bits"), F.sum("n").alias("rows"))
    words = before(words, group, within, "word", "rows", "first", WORD)
    words = written(words.withColumn("crowded", F.col("rows") > F.bit_count("bits")), "manifest-bitmaps")
    # Where a bitmap has more rows than set bits, they are counted id by id.
    crowds = rows.join(words.filter("crowded").select(*keys, "word"), [*keys, "word"], "left_semi")
    lower = Window.partitionBy(*keys, "word").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    counted = crowds.groupBy(*keys, "word", at).agg(F.sum("n").alias("_own")).withColumn(
        "_below", F.coalesce(F.sum("_own").over(lower), F.lit(0))).drop("word")
    placed = lookup(rows, words.drop("rows"), [*keys, "word"])
    alone = placed.filter("NOT crowded").withColumns(
        {"rank": F.col("first") + F.bit_count(F.col("bits").bitwiseAND(lower_bits)), "shared": F.lit(False)})
    crowded = lookup(placed.filter("crowded"), counted, [*keys, at]).withColumns(
        {"rank": F.col("first") + F.col("_below"), "shared": F.col("_own") > F.col("n")})
    names = [*(c for c in rows.columns if c != "word"), "rank", "shared"]
    return alone.select(*names).unionByName(crowded.select(*names))


def placed_leaves(
    docs: DataFrame, columns: list[str], id_col: str, group_col: str, altered: dict[str, Callable[[Column], Column]],
    tampered: Callable[[Column], Column],
) -> DataFrame:
    """(tree, at, id, leaf, other): each row's group, its place among the group's rows, its leaf,
    and the leaf it has when `tampered` (else null)."""
    def value(c: str) -> Column:
        return F.col(f"row.`{c}`")

    # Columns are reached through one struct, so no name of theirs can meet one of ours.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    changed = [altered[c](value(c)) if c in altered else value(c) for c in columns]
    number = value(id_col).cast("long")
    leaves = rows.select(
        # '' for no group, which sorts before all others.
        F.coalesce(F.concat(F.lit("+"), value(group_col).cast("string")), F.lit("")).alias("tree"),
        number.alias("id"), F.unhex(leaf([value(c) for c in columns])).alias("leaf"),
        F.when(tampered(number), F.unhex(leaf(changed))).alias("other"),
    )
    # Equal rows are one here, with their number.
    folded = leaves.groupBy("tree", "id", "leaf", "other").agg(F.count("*").alias("n"))
    folded = folded.withColumns({"named": F.col("id").isNotNull(), "key": F.coalesce("id", F.lit(0))})
    folded = written(folded, "manifest-leaves")
    first = ranked(folded, ["tree"], ["named"], "key").withColumnRenamed("rank", "at")
    first = written(first, "manifest-ranks")
    # The digest's first eight bytes, unsigned, in the order of longs.
    head = F.conv(F.hex(F.substring("leaf", 1, 8)), 16, -10).cast("long").bitwiseXOR(F.lit(-(1 << 63)))
    ties = first.filter("shared").drop("shared").withColumn("head", head)
    among = ranked(ties, ["tree", "named", "key"], [], "head")
    # Leaves that agree in those, if there ever are any.
    again = Window.partitionBy("tree", "named", "key", "head").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
    among = among.withColumn("at", F.col("at") + F.col("rank") + F.coalesce(F.sum("n").over(again), F.lit(0)))
    names = ["tree", "at", "id", "leaf", "other", "n"]
    every = first.filter("NOT shared").select(*names).unionByName(among.select(*names))
    # Copies are written out a bounded number at a time, by as many tasks as it takes.
    runs = every.filter("n > 1").select(*names, F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {COPIES}"))).alias("run"))
    runs = runs.repartition("tree", "at", "run").select(*names, F.explode(F.sequence(
        F.col("run") * COPIES, F.least(F.col("n"), (F.col("run") + 1) * COPIES) - 1)).alias("copy"))
    copies = runs.withColumn("at", F.col("at") + F.col("copy")).drop("copy")
    return every.filter("n = 1").unionByName(copies).drop("n")


def levels_of(n: int) -> int:
    """Levels of one span: until one node is left, at most STEP."""
    levels = 0
    while n > 1 and levels < STEP:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def hashed(data: bytes) -> bytes:
    return sha256(data).hexdigest().encode()


def span_levels(table: pa.Table, column: str) -> list[list[bytes]]:
    """The nodes of a span as hex text, in an array by place, and the levels above them."""
    values = table[column].to_pylist()
    nodes = [b""] * len(values)
    for place, value in zip((table["at"].to_numpy() % SPAN).tolist(), values):
        nodes[place] = value.hex().encode()
    out = [nodes]
    for _ in range(levels_of(table["size"][0].as_py())):
        last = out[-1]
        out.append([hashed(b"".join(last[i:i + FANOUT])) for i in range(0, len(last), FANOUT)])
    return out


def siblings(span: list[list[bytes]], place: int) -> list[tuple[bytes, bytes]]:
    """For each level of a span, what stands left and right of the node on the way up."""
    out = []
    for level in span[:-1]:
        start = place // FANOUT * FANOUT
        out.append((b"".join(level[start:place]), b"".join(level[place + 1:start + FANOUT])))
        place //= FANOUT
    return out


def spans(nodes: DataFrame, sizes: DataFrame, *kept: str) -> DataFrame:
    """The nodes with their tree's size, by span of places."""
    sized = lookup(nodes, sizes, "tree").withColumn("span", F.expr(f"at div {SPAN}"))
    return sized.select("tree", "span", "at", "size", *kept)


def climb(nodes: DataFrame, sizes: DataFrame) -> tuple[list[tuple[DataFrame, DataFrame]], DataFrame]:
    """The stages from `nodes` (tree, at, digest) to one node a tree, each with its trees' sizes
    (tree, size), and those last nodes."""
    def run(table: pa.Table) -> pa.Table:
        top = bytes.fromhex(span_levels(table, "digest")[-1][0].decode())
        return pa.table([table["tree"].slice(0, 1), table["span"].slice(0, 1), pa.array([top])], names=["tree", "at", "digest"])

    stages = []
    while True:
        most = sizes.agg(F.max("size")).first()[0] or 0
        if most <= 1:
            return stages, nodes
        stages.append((nodes, sizes))
        nodes = written(spans(nodes, sizes, "digest").groupBy("tree", "span").applyInArrow(
            run, "tree string, at long, digest binary"), "manifest-level")
        sizes = sizes.withColumn("size", F.expr(f"(size + {SPAN - 1}) div {SPAN}"))


WAY = "array<struct<left: binary, right: binary>>"
WAY_TYPE = pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())]))


def rest_of(above: pa.Table) -> list[tuple[bytes, bytes]]:
    return [(s["left"], s["right"]) for s in above["way"][0].as_py()]


def descend(stages: list[tuple[DataFrame, DataFrame]], ways: DataFrame) -> DataFrame:
    """(tree, at, way, subroot) of the first stage's nodes: the siblings on the way to the root,
    from those of each tree's last node (`ways`, at 0)."""
    def run(table: pa.Table, above: pa.Table) -> pa.Table:
        span, rest = span_levels(table, "digest"), rest_of(above)
        many = len(span[0])
        own = [[{"left": a, "right": b} for a, b in [*siblings(span, p), *rest]] for p in range(many)]
        first = table["span"][0].as_py() * SPAN
        same = pa.array(np.zeros(many, dtype=np.int64))
        return pa.table([
            table["tree"].take(same), pa.array(np.arange(many) + first), pa.array(own, type=WAY_TYPE), above["subroot"].take(same),
        ], names=["tree", "at", "way", "subroot"])

    for nodes, sizes in reversed(stages):
        above = ways.withColumnRenamed("at", "span").groupBy("tree", "span")
        ways = spans(nodes, sizes, "digest").groupBy("tree", "span").cogroup(above).applyInArrow(
            run, f"tree string, at long, way {WAY}, subroot binary")
    return ways


def proofs(leaves: DataFrame, sizes: DataFrame, ways: DataFrame) -> DataFrame:
    """(id, leaf, subroot, proof_sha256, folded_root) of every leaf: the last step down, where ways
    end in a digest and the leaf, or the tampered one, is folded up along its own."""
    def run(table: pa.Table, above: pa.Table) -> pa.Table:
        span, rest = span_levels(table, "leaf"), rest_of(above)
        at = (table["at"].to_numpy() % SPAN).tolist()
        proof, folded = [], []
        for place, other in zip(at, table["other"].to_pylist()):
            node = span[0][place] if other is None else other.hex().encode()
            held = sha256()
            for left, right in [*siblings(span, place), *rest]:
                held.update(left + right)
                node = hashed(left + node + right)
            proof.append(held.hexdigest())
            folded.append(node.decode())
        subroot = above["subroot"].take(pa.array(np.zeros(len(at), dtype=np.int64)))
        return pa.table([table["id"], table["leaf"], subroot, pa.array(proof, type=pa.string()), pa.array(folded, type=pa.string())],
                        names=["id", "leaf", "subroot", "proof_sha256", "folded_root"])

    above = ways.withColumnRenamed("at", "span").groupBy("tree", "span")
    return spans(leaves, sizes, "id", "leaf", "other").groupBy("tree", "span").cogroup(above).applyInArrow(
        run, "id long, leaf binary, subroot binary, proof_sha256 string, folded_root string")


def lower_ascii(text: Column) -> Column:
    return F.translate(text.cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def every_third(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % TAMPERED == 0


def manifest(
    docs: DataFrame, columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), id_col: str = "doc_id",
    group_col: str = "lang", altered: dict[str, Callable[[Column], Column]] | None = None,
    tampered: Callable[[Column], Column] = every_third,
) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256 (all of the data as it is),
    folded_root (from the leaf, which is that of the altered columns where `tampered` says so, up
    along the siblings of the untampered tree) and verified (folded_root is the root).

    `altered` maps columns to what tampering makes of them; by default it lower-cases A-Z of
    `text`. Null values are dashes in a leaf and stay null when tampered with. Rows without an
    id come first in their group (and count as the empty text for tampering); rows that share an
    id follow each other by their leaves; equal rows are leaves of their own, side by side. A
    group of null comes before all others. Very long texts are hashed where they lie; only
    digests travel. Other columns are not read. A table of one row has its leaf for root and the
    digest of nothing for a proof; an empty table gives no rows.
    """
    altered = altered or {"text": lower_ascii}
    leaves = written(placed_leaves(docs, list(columns), id_col, group_col, altered, tampered), "manifest-places")
    sizes = written(leaves.groupBy("tree").agg(F.count("*").alias("size")), "manifest-sizes")
    stages, subroots = climb(leaves.select("tree", "at", F.col("leaf").alias("digest")), sizes)
    # One node a group, whose place in the last tree is its group's in the order of groups.
    groups = number_rows(subroots.select(F.col("tree").alias("group"), "digest"), "at", "group")
    groups = written(groups.withColumn("tree", F.lit("")).select("tree", "at", "digest", "group"), "manifest-groups")
    upper, top = climb(groups.drop("group"), groups.groupBy("tree").agg(F.count("*").alias("size")))
    last = top.first()
    root = last["digest"].hex() if last else ""
    ways = descend(upper, top.select(
        "tree", "at", F.expr(f"cast(array() as {WAY})").alias("way"), F.lit(None).cast("binary").alias("subroot")))
    ways = groups.join(ways.select("at", "way"), "at").select(
        F.col("group").alias("tree"), F.lit(0).cast("long").alias("at"), "way", F.col("digest").alias("subroot"))
    # The first stage's spans are the leaves' own, below.
    done = proofs(leaves, sizes, written(descend(stages[1:], written(ways, "manifest-ways")), "manifest-ways"))
    return done.select(
        F.col("id").alias(id_col), F.lower(F.hex("leaf")).alias("leaf"), F.lower(F.hex("subroot")).alias("subroot"),
        F.lit(root).alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))
