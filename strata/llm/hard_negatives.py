"""Hard negatives for anchor vectors: threshold joins over an inverted index with norm bounds.

Vectors hold whole numbers and a score is an inner product. An anchor's
positives are its best rows of the same label; for each of them the best rows
of other labels are wanted whose score lies within given shares of the
positive's score.

Both steps are the same join. Rows are dealt by their id to parts, a task gets
one part and a block of anchors, and returns the best ``k`` rows of each
window, so what is shuffled afterwards grows with anchors and parts only. In a
task, dimensions stand from the lowest energy to the highest, and:

* The leading dimensions of a row stay out of the inverted index as long as
  their norm, times the anchor's, cannot reach the threshold of any anchor at
  work; a row that never gets there is not indexed at all.
* Partial scores are accumulated over the index's lists from the last
  dimensions on. A pair is given up once its partial score and the product of
  what remains of both norms stay below the anchor's threshold.
* Pairs that are left are scored in full. Anchors whose windows all hold ``k``
  rows are done; for the others the threshold is lowered, at last to the bottom
  of their lowest window, or to nothing for positives.

Every row above a threshold is found, so a window that fills holds its best
rows, and the best ``k`` of all parts are among the best ``k`` of each.

Cases: rows with a null id, label or vector, an empty vector, or null or
non-finite components take no part; vectors only meet vectors of their length;
ties in score go to the smaller id, then label; a repeated row is a row of its
own, but no row with the anchor's id is its partner; repeated anchors count once
where id, label and vector agree, else apart; a positive below zero has an empty
window; scores are held within 64 bits; an empty table gives an empty result.
Other columns are not used, so clashing names do no harm.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from strata.llm import common
from strata.session import materialise

POSITIVES = 5
NEGATIVES = 10
SHARES = (30, 90)  # percent of the positive's score
PART_ROWS = 1 << 16  # rows of a part
BLOCK_ANCHORS = 1 << 14  # anchors that meet a part in one task
TILE_ANCHORS, TILE_ROWS = 256, 8192  # scored together
STEP = 8  # dimensions accumulated between two prunings
SPARSE = 32  # pairs are scored one by one when fewer than one in so many is left
FIRST = (0.9, 0.6, 0.3)  # thresholds for positives, in shares of the anchor's squared norm
LOWERED = (0.125, 0.5, 1.0)  # thresholds for negatives, in shares of the way down to the lowest window


def norms_before(x: np.ndarray) -> np.ndarray:
    """Norm of the dimensions before each step border, a hair too large; one column more than steps."""
    squares = np.zeros((len(x), x.shape[1] + 1))
    np.cumsum(np.square(x), axis=1, out=squares[:, 1:])
    norms = np.sqrt(squares[:, [*range(0, x.shape[1], STEP), x.shape[1]]])
    return norms * (1 + 1e-9) + norms[:, -1:] * 1e-6


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows of whole numbers, held within 64 bits."""
    if not len(a):
        return np.empty(0, np.int64)
    if float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1] < 2.0**53:
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    top = 2**63 - 1
    return np.array([max(-top, min(top, sum(int(x) * int(y) for x, y in zip(u, v)))) for u, v in zip(a, b)], np.int64)


def pairs_above(queries: np.ndarray, rows: np.ndarray, least: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All allowed pairs (query, row) with a score of ``least`` (one per query) or more, and their scores."""
    q_norms, x_norms = norms_before(queries), norms_before(rows)
    n_steps = x_norms.shape[1] - 1
    # What a row's leading steps may reach before they have to be listed.
    reach = float(np.min(np.where(least > 0, least / np.maximum(q_norms[:, -1], 1e-300), -np.inf)))
    omitted = (x_norms[:, 1:] < reach).sum(axis=1)
    order = np.argsort(omitted, kind="stable")
    listed = np.searchsorted(omitted[order], np.arange(n_steps), side="right")
    order = order[: listed[-1]]
    x, x_norms, omitted, alive = rows[order], x_norms[order], omitted[order], allowed[:, order]
    at = np.arange(len(order))
    partial = np.zeros((len(queries), len(order)))
    for step in range(n_steps - 1, -1, -1):
        cut, n = slice(step * STEP, (step + 1) * STEP), int(listed[step])
        partial[:, :n] += queries[:, cut] @ x[:n, cut].T
        left = np.maximum(step, omitted)
        alive &= partial + q_norms[:, left] * x_norms[at, left] >= least[:, None]
        if np.count_nonzero(alive) * SPARSE < alive.size:
            break
    q, r = np.nonzero(alive)
    scores = np.concatenate([np.empty(0, np.int64), *[exact_scores(queries[q[i : i + 65536]], x[r[i : i + 65536]]) for i in range(0, len(q), 65536)]])
    good = scores >= least[q]
    return q[good], order[r[good]], scores[good]


def best_in_windows(q: np.ndarray, row: np.ndarray, score: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
    """The best ``k`` of each query's windows: (query, window, row, score); ties to the smaller row."""
    order = np.lexsort((row, -score, q))
    q, row, score = q[order], row[order], score[order]
    out = []
    for w in range(low.shape[1]):
        inside = np.flatnonzero((score >= low[q, w]) & (score <= high[q, w]))
        of = q[inside]
        first = np.searchsorted(of, of)
        inside = inside[np.arange(len(of)) - first < k]
        out.append((q[inside], np.full(len(inside), w), row[inside], score[inside]))
    return tuple(np.concatenate(parts) for parts in zip(*out))


def windows_filled(queries: np.ndarray, rows: np.ndarray, allowed, thresholds: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
    """(query, window, row, score): the best ``k`` rows of every window, by lowering thresholds.

    ``allowed(queries, rows)`` says which pairs may meet; ``thresholds`` has a
    column per level, falling; the last is at or below every window's bottom.
    """
    energy = np.argsort(np.square(rows).sum(axis=0), kind="stable")
    queries, rows = np.ascontiguousarray(queries[:, energy]), np.ascontiguousarray(rows[:, energy])
    out = []
    for start in range(0, len(queries), TILE_ANCHORS):
        at_work = np.arange(start, min(start + TILE_ANCHORS, len(queries)))
        for level in range(thresholds.shape[1]):
            least, lo, hi = thresholds[at_work, level], low[at_work], high[at_work]
            held = (np.empty(0, np.int64),) * 3
            for first in range(0, len(rows), TILE_ROWS):
                part = np.arange(first, min(first + TILE_ROWS, len(rows)))
                q, r, s = pairs_above(queries[at_work], rows[part], least, allowed(at_work, part))
                q, r, s = (np.concatenate(two) for two in zip(held, (q, part[r], s)))
                # A row may stand in several windows: keep it once, then deal it out again.
                q, _, r, s = best_in_windows(q, r, s, lo, hi, k)
                once = np.unique(q * np.int64(len(rows)) + r, return_index=True)[1]
                held = q[once], r[once], s[once]
            q, w, r, s = best_in_windows(*held, lo, hi, k)
            counts = np.zeros(lo.shape, np.int64)
            np.add.at(counts, (q, w), 1)
            done = ((counts >= k) | (least[:, None] <= lo) | (lo > hi)).all(axis=1)
            final = done[q]
            out.append((at_work[q[final]], w[final], r[final], s[final]))
            at_work = at_work[~done]
            if not len(at_work):
                break
    return tuple(np.concatenate(parts) for parts in zip(*out)) if out else (np.empty(0, np.int64),) * 4


def _vectors(table: pa.Table) -> np.ndarray:
    column = table.column("v").combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)


def _join(same_label: bool, k: int):
    """Cogroup of a block of anchors and a part of the rows, both with vectors of one length."""

    def work(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        if not anchors.num_rows or not rows.num_rows:
            return _found(anchors.slice(0, 0), rows.slice(0, 0), *(np.empty(0, np.int64),) * 4)
        rows = rows.take(np.lexsort((rows.column("label").to_numpy(), rows.column("id").to_numpy())))
        q, x = _vectors(anchors), _vectors(rows)
        codes = pa.chunked_array([*anchors.column("label").chunks, *rows.column("label").chunks]).combine_chunks().dictionary_encode().indices.to_numpy()
        q_label, x_label = codes[: len(q)], codes[len(q) :]
        q_id, x_id = anchors.column("id").to_numpy(), rows.column("id").to_numpy()

        def allowed(of: np.ndarray, to: np.ndarray) -> np.ndarray:
            return ((q_label[of, None] == x_label[to]) == same_label) & (q_id[of, None] != x_id[to])

        if same_label:
            squared = np.square(q).sum(axis=1)
            thresholds = np.stack([*[squared * share for share in FIRST], np.full(len(q), -np.inf)], axis=1)
            low, high = np.full((len(q), 1), -np.inf), np.full((len(q), 1), np.inf)
        else:
            most = max(len(p) for p in anchors.column("positives").to_pylist())
            low, high = np.full((len(q), most), np.inf), np.full((len(q), most), -np.inf)
            for i, windows in enumerate(anchors.column("positives").to_pylist()):
                for p in windows:
                    low[i, p["rank"] - 1], high[i, p["rank"] - 1] = p["low"], p["high"]
            real = low <= high
            bottom = np.where(real, low, np.inf).min(axis=1)
            top = np.where(real, high, np.inf).min(axis=1)
            low, high = np.where(real, low, np.inf), np.where(real, high, -np.inf)
            thresholds = np.stack([top - share * (top - bottom) for share in LOWERED[:-1]] + [bottom], axis=1)
        return _found(anchors, rows, *windows_filled(q, x, allowed, thresholds, low, high, k))

    return work


def _found(anchors: pa.Table, rows: pa.Table, q: np.ndarray, w: np.ndarray, r: np.ndarray, s: np.ndarray) -> pa.Table:
    return pa.table({
        "anchor": anchors.column("anchor").take(pa.array(q, pa.int64())), "window": pa.array(w + 1, pa.int32()),
        "id": rows.column("id").take(pa.array(r, pa.int64())), "label": rows.column("label").take(pa.array(r, pa.int64())), "score": pa.array(s, pa.int64()),
    })


def _meet(anchors: DataFrame, rows: DataFrame, parts: int, same_label: bool, k: int) -> DataFrame:
    """Best ``k`` rows per anchor and window: (anchor, window, id, label, score, rank)."""
    spark = rows.sparkSession
    blocks = max(1, -(-anchors.count() // BLOCK_ANCHORS))
    to_parts = anchors.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(blocks)).cast("int"))
    to_blocks = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["part", "block", "d"]
    label = rows.schema["label"].dataType.simpleString()
    found = to_parts.groupBy(*keys).cogroup(to_blocks.groupBy(*keys)).applyInArrow(
        _join(same_label, k), f"anchor long, window int, id long, label {label}, score long")
    best = W.partitionBy("anchor", "window").orderBy(F.desc("score"), "id", "label")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, id: str = "vec_id", vector: str = "embedding", label: str = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES, shares: tuple[int, int] = SHARES, part_rows: int = PART_ROWS,
) -> DataFrame:
    """Per anchor and positive the best negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score, negative_label.

    ``vector`` holds whole numbers; ``is_anchor`` is a condition on the columns of ``vectors``. A negative's
    score, in percent of the positive's, lies within ``shares``, which are below 100 and not negative.
    """
    spark = vectors.sparkSession
    v = F.col(f"`{vector}`").cast("array<double>")
    size = F.size(v)
    sound = F.col(f"`{id}`").isNotNull() & F.col(f"`{label}`").isNotNull() & (size > 0) & F.forall(v, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    kept = vectors.where(F.coalesce(sound, F.lit(False)))
    kept = kept.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{label}`").alias("label"), v.alias("v"), size.alias("d"), F.coalesce(is_anchor, F.lit(False)).alias("a"))
    n = kept.count()
    parts = max(1, -(-n // part_rows), min(n, spark.sparkContext.defaultParallelism))
    # Dealt by row, so that a repeated id fills no part; the written table keeps the deal.
    rows = materialise(kept.withColumn("part", F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(parts)).cast("int")), "vectors")
    anchors = rows.where("a").select("id", "label", "v", "d").distinct()
    anchors = materialise(anchors.withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    rows = rows.drop("a")
    same = materialise(_meet(anchors, rows, parts, True, positives), "positives")
    low, high = F.ceil(F.lit(shares[0]) * F.col("score").cast("decimal(38,0)") / 100), F.floor(F.lit(shares[1]) * F.col("score").cast("decimal(38,0)") / 100)
    windows = same.select("anchor", F.struct("rank", F.col("id").alias("id"), "score", low.cast("double").alias("low"), high.cast("double").alias("high")).alias("p")).where("p.low <= p.high")
    open_ = materialise(anchors.join(windows.groupBy("anchor").agg(F.sort_array(F.collect_list("p")).alias("positives")), "anchor"), "windows")
    found = _meet(open_, rows, parts, False, negatives)
    ours = open_.select("anchor", F.col("id").alias("anchor_id"), F.explode("positives").alias("p"))
    ours = ours.select("anchor", F.col("p.rank").alias("window"), "anchor_id", F.col("p.id").alias("positive_id"), F.col("p.score").alias("positive_score"))
    return found.join(ours, ["anchor", "window"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"), F.col("label").alias("negative_label"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives for every hundredth vector, with vectors and labels as the contract changes them."""
    vectors = common.table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("double"))
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    vectors = vectors.where(finite).select("vec_id", label.alias("label"), whole.alias("embedding"))
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0)
