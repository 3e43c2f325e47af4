"""Near-duplicate embeddings by counting collisions of one-dimensional projections.

Equal vectors of a label collapse into one class first. Each table sorts the
classes of a grid cell (a few projections, cut at random offsets) by one more
projection and takes every pair within a window around the query. For such a
pair the windows of all ``PROJECTIONS`` projections are tested; pairs that
collide in fewer than the calibrated count are dropped, the others are verified
by the cosine in double precision. The count is the binomial quantile that a
pair exactly at the threshold reaches with probability ``RECALL``; the number of
tables is what finds such a pair with that probability, and the number of grid
projections follows the size of the largest label, so that cells keep their size.

A pair is counted in the first table that brings it together, which both
vectors show, so links are summed without emitting pairs: a task returns one
row per class with its links and one tree link. Cells with more than
``CELL_ROWS`` classes are compared block against block.

Cases: null, zero, ragged or non-finite vectors and null labels link with
nothing and are their own component; vectors only compare with the same length;
each repeated row counts as a vector; other columns are not carried; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import ceil, comb, erf, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import common, graph
from strata.session import materialise

THRESHOLD = 0.98
PROJECTIONS = 64
RECALL = 0.999
CELL = 1.2  # width of a grid cell
CELL_ROWS = 2048
PAIRS_AT_ONCE = 100_000


class Plan:
    """Windows, tables and the calibrated count for a threshold and a number of vectors."""

    def __init__(self, n: int, threshold: float = THRESHOLD, projections: int = PROJECTIONS, recall: float = RECALL):
        self.threshold, self.m = threshold, projections
        spread = sqrt(2 - 2 * threshold)  # distance of unit vectors at the threshold
        self.window = 1.5 * spread
        hit = erf(1.5 / sqrt(2))
        # Largest count that a threshold pair reaches with the wanted probability.
        tail, self.least = 1.0, 0
        while True:
            tail -= comb(projections, self.least) * hit**self.least * (1 - hit) ** (projections - self.least)
            if tail < recall:
                break
            self.least += 1
        stay = max(0.05, 1 - spread * sqrt(2 / np.pi) / CELL)
        apart = 0.3  # chance that unlike vectors share a cell of one projection
        self.grid = max(0, round(log(max(n, 1) / 150) / log(1 / apart))) if n > 150 else 0
        found = stay**self.grid * hit
        self.tables = max(1, ceil(log(1 - recall) / log(1 - found)))

    def directions(self, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return _directions(d, self.m, self.tables, self.grid)

    def places(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per vector: all projections, the grid cells (table x grid) and the sorted projection of each table."""
        lines, grid, shift = self.directions(unit.shape[1])
        cells = np.floor((unit @ grid) / CELL + shift).astype(np.int64).reshape(len(unit), self.tables, self.grid)
        across = unit @ lines
        return across, cells, across[:, np.arange(self.tables) % self.m]


@lru_cache(maxsize=4)
def _directions(d: int, m: int, tables: int, grid: int):
    rng = np.random.default_rng(20_240_229 + d)
    return rng.standard_normal((d, m)), rng.standard_normal((d, tables * grid)), rng.random(tables * grid)


def _matrix(column: pa.Array) -> np.ndarray:
    flat, at = common.bytes_of(column)
    x = np.frombuffer(flat.tobytes(), "<f8").reshape(len(at) - 1, -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _tree(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest reachable number of each of n nodes over the pairs (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _pairs(order_key: np.ndarray, side: np.ndarray, crossed: bool, window: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs within the window along the sorted key; ``crossed`` keeps those of two blocks only."""
    order = np.argsort(order_key, kind="stable")
    key = order_key[order]
    last = np.searchsorted(key, key + window, side="right")
    n = last - np.arange(len(key)) - 1
    total = np.concatenate([[0], np.cumsum(n)])
    start = 0
    while start < len(key):
        end = max(start + 1, int(np.searchsorted(total, total[start] + PAIRS_AT_ONCE, side="right")) - 1)
        own = n[start:end]
        left = np.repeat(np.arange(start, end), own)
        right = left + 1 + np.arange(len(left)) - np.repeat(total[start:end] - total[start], own)
        left, right = order[left], order[right]
        if crossed:
            keep = side[left] != side[right]
            left, right = left[keep], right[keep]
        if len(left):
            yield left, right
        start = end


def _compare(plan: Plan):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        t, crossed = key[1].as_py(), key[2].as_py() != key[3].as_py()
        table = table.combine_chunks()
        ids, side = table["cid"].to_numpy(), table["block"].to_numpy()
        weight = table["copies"].to_numpy()
        unit = _matrix(table["vector"])
        across, cells, sorted_by = plan.places(unit)
        close = across.astype(np.float32)
        links, a_all, b_all = np.zeros(len(ids), np.int64), [], []
        for a, b in _pairs(sorted_by[:, t], side, crossed, plan.window):
            hits = np.zeros(len(a), np.int16)
            for i in range(plan.m):
                hits += np.abs(close[a, i] - close[b, i]) <= plan.window
            a, b = a[hits >= plan.least], b[hits >= plan.least]
            same = np.einsum("ij,ij->i", unit[a], unit[b]) >= plan.threshold
            a, b = a[same], b[same]
            earlier = np.zeros(len(a), bool)
            for u in range(t):
                earlier |= (cells[a, u] == cells[b, u]).all(axis=1) & (np.abs(sorted_by[a, u] - sorted_by[b, u]) <= plan.window)
            fresh = ~earlier
            np.add.at(links, a[fresh], weight[b[fresh]])
            np.add.at(links, b[fresh], weight[a[fresh]])
            a_all.append(a[fresh])
            b_all.append(b[fresh])
        if a_all:
            root = _tree(np.concatenate(a_all), np.concatenate(b_all), len(ids))
        else:
            root = np.arange(len(ids))
        some = (links > 0) | (root != np.arange(len(ids)))
        return pa.table({"cid": pa.array(ids[some], pa.int64()), "links": pa.array(links[some], pa.int64()), "root": pa.array(ids[root][some], pa.int64())})

    return run


def near_embeddings(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept."""
    common.small_batches(df.sparkSession)
    wide = F.transform(F.col(embedding), lambda x: x.cast("double"))
    sound = F.col(label).isNotNull() & F.col(embedding).isNotNull() & (F.size(embedding) > 0) & F.coalesce(
        F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(wide, lambda x: x != 0), F.lit(False))
    rows = df.select(F.col(vec_id).alias("id"), F.col(label).alias("l"), F.col(embedding).alias("e"), F.coalesce(sound, F.lit(False)).alias("sound"))
    hashed = F.xxhash64("l", "e")
    good = rows.where("sound").withColumn("h", hashed)
    grouped = good.groupBy("h", "l", "e").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    classes = materialise(grouped.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")
    largest = classes.groupBy("l", F.size("e")).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    plan = Plan(int(largest), threshold)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_size: dict[int, list[int]] = {}
            lists = batch.column(3).to_pylist()
            for i, v in enumerate(lists):
                by_size.setdefault(len(v), []).append(i)
            for own in by_size.values():
                x = np.array([lists[i] for i in own], np.float64)
                scaled = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow of squares
                _, cells, _ = plan.places(scaled / np.linalg.norm(scaled, axis=1, keepdims=True))
                blobs = [r.tobytes() for r in scaled.astype("<f8")]
                take = batch.take(pa.array(own))
                for t in range(plan.tables):
                    key = common.grams(cells[:, t].T.astype(np.uint64), max(1, plan.grid))[0] if plan.grid else np.zeros(len(own), np.uint64)
                    yield pa.RecordBatch.from_arrays(
                        [take.column(0), take.column(1), take.column(2), pa.array(np.full(len(own), t, np.int32)), pa.array(key.view(np.int64)), pa.array([len(lists[i]) for i in own], pa.int32()), common.binary_array(blobs)],
                        names=["cid", "copies", "lh", "t", "cell", "d", "vector"])

    placed = classes.select("cid", "copies", F.xxhash64("l").alias("lh"), "e").mapInArrow(place, "cid long, copies long, lh long, t int, cell long, d int, vector binary")
    placed = materialise(placed.withColumn("group", F.xxhash64("lh", "t", "cell", "d")), "vector-cells")
    large = placed.groupBy("group").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > CELL_ROWS).withColumn("blocks", F.ceil(F.col("rows") / CELL_ROWS).cast("int"))
    cut = placed.join(large.select("group", "blocks"), "group", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    cut = cut.withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    paired = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    paired = paired.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).select("group", "t", "i", "j", "cid", "copies", "block", "vector")
    found = materialise(paired.groupBy("group", "t", "i", "j").applyInArrow(_compare(plan), "cid long, links long, root long"), "vector-links")

    joined = graph.components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    named = classes.select("cid", "first_id").join(joined, F.col("cid") == F.col("node"))
    lowest = named.groupBy("component").agg(F.min("first_id").alias("lowest"))
    reach = joined.join(lowest, "component").select(F.col("node").alias("cid"), "lowest")
    summary = classes.join(links, "cid", "left").join(reach, "cid", "left").select(
        F.col("h").alias("h2"), F.col("l").alias("l2"), F.col("e").alias("e2"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("lowest", "first_id").alias("component_id"))
    linked = good.join(materialise(summary, "vector-summary"), (F.col("h") == F.col("h2")) & (F.col("l") == F.col("l2")) & (F.col("e") == F.col("e2"))).select("id", "n_links", "component_id")
    alone = rows.where(~F.col("sound")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.select(F.col("id").alias(vec_id), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op9_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return near_embeddings(common.table(spark, sf_dir, "embeddings"))
