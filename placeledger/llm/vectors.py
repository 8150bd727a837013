"""Near-duplicate vectors by an exact metric range join.

On unit vectors a cosine of at least c is a distance of at most r = sqrt(2 - 2c). Every
vector has its home in the cell of its nearest pivot; a cell is dealt to blocks, one row each,
with the least and the greatest distance of its vectors to every pivot. Two blocks meet unless
these differ by more than r for some pivot, and there a vector is left out when the triangle
inequality leaves no room for a partner in the other block: its distance to a pivot is out of
the block's reach, or its distance to the other cell's pivot exceeds the one to its own by more
than 2r. Each pair meets once. Equal vectors are folded first. Blocks are read from the shared
folder where they meet and are never shuffled in pairs: what is written grows with the vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from placeledger.llm.common import hot_free_join, set_for, smallest_reachable, tasks, written
from placeledger.operators.identity import connected_components

COSINE = 0.95
ROWS_PER_CELL = 8192
MOST_PIVOTS = 512
CHUNK = 8192
# Numbers in the vectors of a block: wide vectors come in blocks of fewer rows.
BLOCK_VALUES = 1 << 19
# Blocks of a table that would fit in fewer, and rows that a block has nevertheless.
SPREAD, LEAST_ROWS = 32, 512
# Groups of blocks that meet two at a time in a task of their own.
MOST_GROUPS = 512
HELD_BLOCKS = 8


def usable(v: str) -> Column:
    """Not null or empty, all components finite, not all zero."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(v).isNotNull() & finite & F.exists(v, lambda x: x != 0)


def units(rows: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled by the largest component first, so that no square overflows."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return units(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.float64))


def distances(unit: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * unit @ pivots.T, 0))


def with_cells(classes: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Classes with their home cell. Cells are numbered within a width; a width without pivots
    is one cell."""
    names = ["width", "cls", "size", "v"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column("width").to_numpy()
            cell = np.zeros(batch.num_rows, dtype=np.int64)
            for width in np.unique(widths).tolist():
                if width in pivots:
                    own = np.flatnonzero(widths == width)
                    unit = matrix(batch.column("v").take(pa.array(own)), width)
                    cell[own] = distances(unit, pivots[width]).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(cell), *[batch.column(c) for c in names]], ["cell", *names])

    return classes.select(*names).mapInArrow(
        run, f"cell long, width int, cls long, size long, v {classes.schema['v'].dataType.simpleString()}")


def blocks_of(classes: DataFrame, pivots: dict[int, np.ndarray], chunk: int, rows: int) -> DataFrame:
    """A row a block: its vectors, and the least and greatest distance of them to each pivot."""
    def pack(table: pa.Table) -> pa.Table:
        width, cell, part = (table[c][0].as_py() for c in ("width", "cell", "part"))
        v = table["v"].combine_chunks()
        away = distances(matrix(v, width), pivots[width]) if width in pivots else np.empty((len(table), 0))
        return pa.table({
            "width": pa.array([width], pa.int32()), "cell": [cell], "block": [(cell << 32) + part],
            "cls": [table["cls"].to_numpy().tobytes()], "size": [table["size"].to_numpy().tobytes()],
            "v": [v.flatten().to_numpy(zero_copy_only=False).tobytes()],
            "lows": pa.array([away.min(axis=0)], pa.list_(pa.float64())), "highs": pa.array([away.max(axis=0)], pa.list_(pa.float64())),
        })

    placed = with_cells(classes, pivots)
    most = F.least(F.lit(chunk), F.lit(max(LEAST_ROWS, -(-rows // SPREAD))), F.greatest(F.lit(1), F.expr(f"{BLOCK_VALUES} div width")))
    # A row a cell: the pivots bound it.
    cells = placed.groupBy("width", "cell").agg(F.count("*").alias("n")).select(
        "width", "cell", F.ceil(F.col("n") / most).cast("int").alias("parts"))
    dealt = placed.join(F.broadcast(cells), ["width", "cell"]).withColumn("part", F.pmod(F.xxhash64("cls"), "parts").cast("int"))
    keys = ["width", "cell", "part"]
    return dealt.repartition(tasks(classes.sparkSession), *keys).groupBy(*keys).applyInArrow(
        pack, "width int, cell long, block long, cls binary, size binary, v binary, lows array<double>, highs array<double>")


def near_links(unit: np.ndarray, short: np.ndarray, size: np.ndarray, left: np.ndarray, right: np.ndarray,
               cosine: float, home: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(root, linked): the smallest row that each row of `unit` reaches, and the number of vectors
    linked to it, by pairs of a row of `left` and one of `right`; with the same array twice, by
    pairs of two rows of it. Without `home` all pairs count, with it those of which one row is.

    Products of `short`, the rows in 32 bits, rule pairs out; what they cannot rule out for
    their rounding is decided in 64 bits.
    """
    crossing = right is not left
    least = np.float32(cosine - (unit.shape[1] + 8) * 2.0 ** -23)
    linked = np.zeros(len(unit))
    lefts, rights = [], []
    one, other = short[left], short[right] if crossing else short[left]
    for a in range(0, len(left), 512):
        for b in range(0 if crossing else a, len(right), 1024):
            product = one[a:a + 512] @ other[b:b + 1024].T
            if product.max() < least:
                continue
            near = product >= least
            i = left[a:a + 512][near.any(axis=1)]
            j = right[b:b + 1024][near.any(axis=0)]
            near = unit[i] @ unit[j].T >= cosine
            if home is not None:
                near &= home[i][:, None] | home[j][None, :]
            if not crossing:
                near &= i[:, None] < j[None, :]
            if not near.any():
                continue
            linked[i] += near @ size[j]
            linked[j] += size[i] @ near
            x, y = np.nonzero(near)
            # Only what joins the block's groups is kept, never all its pairs.
            both, places = np.unique(np.concatenate([i[x], j[y]]), return_inverse=True)
            root = smallest_reachable(len(both), places[:len(x)], places[len(x):])
            lefts.append(both)
            rights.append(both[root])
    if lefts:
        return smallest_reachable(len(unit), np.concatenate(lefts), np.concatenate(rights)), linked
    return np.arange(len(unit)), linked


def link_table(a: np.ndarray, b: np.ndarray, counted: np.ndarray, n: np.ndarray) -> pa.Table:
    return pa.table([
        pa.array(np.concatenate([a, counted])),
        pa.concat_arrays([pa.array(b), pa.nulls(len(counted), pa.int64())]),
        pa.array(np.concatenate([np.zeros(len(a)), n]).astype(np.int64)),
    ], names=["a", "b", "n"])


def join_tile(table: pa.Table, cosine: float) -> pa.Table:
    """Links of one tile: (a, null, n) adds n linked vectors to class a; (a, b, 0) joins a and b,
    as stars around the smallest class a group has in the tile."""
    cls, size, home, side = (table[c].to_numpy() for c in ("cls", "size", "home", "side"))
    order = np.argsort(cls, kind="stable")
    cls, size, home, side = cls[order], size[order].astype(float), home[order], side[order]
    unit = matrix(table["v"], table["width"][0].as_py())[order]
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1) if side.any() else left
    root, linked = near_links(unit, unit.astype(np.float32), size, left, right, cosine, home)
    moved, counted = np.flatnonzero(root != np.arange(len(cls))), np.flatnonzero(linked)
    return link_table(cls[moved], cls[root[moved]], cls[counted], linked[counted])


class Block:
    """The vectors of one row of `blocks_of`."""

    def __init__(self, row: dict, pivots: dict[int, np.ndarray], dtype: type) -> None:
        self.cell = row["cell"]
        self.cls, self.size = np.frombuffer(row["cls"], np.int64), np.frombuffer(row["size"], np.int64).astype(float)
        self.unit = units(np.frombuffer(row["v"], dtype).reshape(-1, row["width"]).astype(np.float64))
        self.short = self.unit.astype(np.float32)
        self.lows, self.highs = (np.array(row[c], dtype=np.float64) for c in ("lows", "highs"))
        self.away = distances(self.unit, pivots[row["width"]]) if len(self.lows) else None

    def near(self, other: Block, radius: float) -> np.ndarray:
        """The vectors that may have a partner in the other block."""
        if self.away is None:
            return np.arange(len(self.cls))
        room = ((self.away >= other.lows - radius) & (self.away <= other.highs + radius)).all(axis=1)
        return np.flatnonzero(room & (self.away[:, other.cell] - self.away[:, self.cell] <= 2 * radius))


class Links:
    """Links of many tiles; those that say the same are folded when there are many."""

    def __init__(self, most: int = 1 << 20) -> None:
        self.most, self.rows = most, 0
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []
        self.counts: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, cls: np.ndarray, root: np.ndarray, linked: np.ndarray) -> None:
        moved, counted = np.flatnonzero(root != np.arange(len(cls))), np.flatnonzero(linked)
        if len(counted):
            self.edges.append((cls[moved], cls[root[moved]]))
            self.counts.append((cls[counted], linked[counted]))
            self.rows += len(moved) + len(counted)

    def folded(self) -> tuple[np.ndarray, ...]:
        a, b = (np.concatenate([e[k] for e in self.edges]) for k in (0, 1))
        nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
        root = smallest_reachable(len(nodes), places[:len(a)], places[len(a):])
        moved = np.flatnonzero(root != np.arange(len(nodes)))
        counted, places = np.unique(np.concatenate([c[0] for c in self.counts]), return_inverse=True)
        return nodes[moved], nodes[root[moved]], counted, np.bincount(places, np.concatenate([c[1] for c in self.counts]), len(counted))

    def given(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        """What is to leave the task now: everything at its end, before that only what does not fold."""
        if not self.rows or not last and self.rows < self.most:
            return
        a, b, counted, n = self.folded()
        if last or len(a) + len(counted) > self.most // 2:
            yield from link_table(a, b, counted, n).to_batches(max_chunksize=8192)
            self.__init__(self.most)
        else:
            self.edges, self.counts, self.rows = [(a, b)], [(counted, n)], len(a) + len(counted)


def meet(pivots: dict[int, np.ndarray], cosine: float, radius: float, dtype: type) -> Callable:
    """Links of the pairs of blocks l and h that a task is given."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Block] = {}
        links = Links()

        def opened(batch: pa.RecordBatch, at: int, side: str) -> Block:
            row = {c: batch.column(f"{side}_{c}")[at] for c in ("width", "cell", "block", "lows", "highs")}
            row = {c: x.as_py() for c, x in row.items()} | {
                c: batch.column(f"{side}_{c}")[at].as_buffer() for c in ("cls", "size", "v")}
            key = (row["width"], row["block"])
            found = held.pop(key, None) or Block(row, pivots, dtype)
            held[key] = found
            if len(held) > HELD_BLOCKS:
                del held[next(iter(held))]
            return found

        for batch in batches:
            for at in range(batch.num_rows):
                low, high = opened(batch, at, "l"), opened(batch, at, "h")
                if low is high:
                    everyone = np.arange(len(low.cls))
                    links.add(low.cls, *near_links(low.unit, low.short, low.size, everyone, everyone, cosine))
                else:
                    i, j = low.near(high, radius), high.near(low, radius)
                    if len(i) and len(j):
                        both = [np.concatenate([x[i], y[j]]) for x, y in (
                            (low.unit, high.unit), (low.short, high.short), (low.size, high.size), (low.cls, high.cls))]
                        n = np.arange(len(i) + len(j))
                        links.add(both[3], *near_links(*both[:3], n[:len(i)], n[len(i):], cosine))
                yield from links.given()
        yield from links.given(last=True)

    return run


def block_links(blocks: DataFrame, pivots: dict[int, np.ndarray], cosine: float, dtype: type) -> DataFrame:
    """Links of all pairs of blocks that are not too far from each other. A task reads two groups
    of blocks from where they are written; nothing is shuffled."""
    # A little more than it is: distances are roots of rounded numbers.
    radius = float(np.sqrt(2 - 2 * cosine)) + 1e-5
    blocks = blocks.withColumn("odd", F.xxhash64("block") % 2 != 0).coalesce(MOST_GROUPS)
    l, h = (blocks.select(*[F.col(c).alias(f"{side}_{c}") for c in blocks.columns]) for side in "lh")

    def beyond(highs: str, lows: str) -> Column:
        return F.exists(F.zip_with(highs, lows, lambda x, y: y - x > radius), lambda apart: apart)

    # Of (a, b) and (b, a) one is kept, by turns, so that all tasks have as much to do.
    once = (F.col("l_block") == F.col("h_block")) | (
        (F.col("l_block") < F.col("h_block")) == (F.col("l_odd") == F.col("h_odd")))
    met = l.join(h.hint("shuffle_replicate_nl"), (F.col("l_width") == F.col("h_width")) & once
                 & ~beyond("l_highs", "h_lows") & ~beyond("h_highs", "l_lows"))
    return met.drop("l_odd", "h_odd").mapInArrow(meet(pivots, cosine, radius, dtype), "a long, b long, n long")


def range_links(classes: DataFrame, cosine: float, rows_per_cell: int, chunk: int) -> DataFrame:
    """Links of all classes: (a, null, n) adds n linked vectors to class a; (a, b, 0) joins a and b."""
    rows = classes.count()
    wanted = min(MOST_PIVOTS, rows // rows_per_cell)
    drawn: dict[int, list] = {}
    # At most MOST_PIVOTS vectors, drawn by hash; they only set the cells, never a result.
    for row in classes.orderBy("k1", "k2").select("width", "v").limit(wanted).collect() if wanted > 1 else []:
        drawn.setdefault(row["width"], []).append(row["v"])
    pivots = {w: units(np.array(p, dtype=np.float64)) for w, p in drawn.items()}
    dtype = np.float32 if "float" in classes.schema["v"].dataType.simpleString() else np.float64
    # Rows of blocks are large: a file is read at once, and so is a batch for Python.
    with set_for(classes.sparkSession, {"spark.sql.files.maxRecordsPerFile": str(HELD_BLOCKS)}):
        blocks = written(blocks_of(classes, pivots, chunk, rows), "vector-blocks")
    with set_for(classes.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "4"}):
        return written(block_links(blocks, pivots, cosine, dtype), "vector-links")


def vector_components(
    vectors: DataFrame, cosine: float = COSINE, rows_per_cell: int = ROWS_PER_CELL, chunk: int = CHUNK,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """One row per vector: vec_id, n_links (other rows with a cosine of at least `cosine`),
    component_id (the smallest vec_id reachable by links, itself included), kept.

    Vectors that are null, empty, zero or hold null or non-finite components link with
    nothing, and so do vectors of different widths. Repeated rows stay and count as links of
    each other. A null vec_id can be linked but names no component. An empty table gives no rows.
    """
    kind = vectors.select(vector_col).schema[0].dataType.simpleString()
    # Numbers of 32 bits are stored as such; all is computed in 64.
    kept = "array<float>" if kind == "array<float>" else "array<double>"
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    good = usable("v")
    keyed = rows.withColumns({
        "k1": F.when(good, F.xxhash64("v")), "k2": F.when(good, F.xxhash64(F.lit(1), "v")),
    })
    # Two 64-bit hashes name a vector's class; equal vectors are compared once.
    classes = written(
        keyed.filter("k1 IS NOT NULL").groupBy("k1", "k2").agg(
            F.any_value(F.col("v").cast(kept)).alias("v"), F.min("vec_id").alias("first_vec"), F.count("*").alias("size"),
        ).withColumns({"width": F.size("v"), "cls": F.monotonically_increasing_id()}), "vector-classes")
    found = range_links(classes, cosine, rows_per_cell, chunk)
    counted = found.filter("b IS NULL").groupBy("a").agg(F.sum("n").alias("n"))
    roots = connected_components(found.filter("b IS NOT NULL").select("a", "b"))
    rooted = classes.drop("v").join(roots.withColumnsRenamed({"node": "cls", "component": "root"}), "cls", "left").join(
        counted.withColumnRenamed("a", "cls"), "cls", "left")
    rooted = written(rooted.select(
        "k1", "k2", "first_vec", "size", F.coalesce("root", "cls").alias("root"), F.coalesce("n", F.lit(0)).alias("n")
    ), "vector-roots")
    lowest = rooted.groupBy("root").agg(F.min("first_vec").alias("low"))
    named = hot_free_join(rooted, lowest, "root").select(F.struct("k1", "k2").alias("key"), "size", "n", "low")
    members = keyed.select("vec_id", F.when(F.col("k1").isNotNull(), F.struct("k1", "k2")).alias("key"))
    # Rows without a class need no partner; they would all meet under one null key.
    alone = members.filter("key IS NULL").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    joined = hot_free_join(members.filter("key IS NOT NULL"), named, "key").select(
        "vec_id", (F.col("size") - 1 + F.col("n")).alias("n_links"), F.col("low").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.col("low")).alias("kept"))
    return joined.unionByName(alone)
