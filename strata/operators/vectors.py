"""Embeddings and similarity search as distributed jobs.

Scores are computed next to the data: each Arrow batch becomes one matrix, and
only the best k rows per batch and query leave the task. The final order is a
limited sort over those candidates. Many queries meet the rows block against
block; an index of inverted lists narrows the rows a search reads.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import BucketedRandomProjectionLSH, HashingTF, Normalizer, Tokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.functions.hashing import row_hash
from strata.operators.merge import Update, merge
from strata.session import broadcast_if_small, materialise

SCORE_DIGITS = 9  # scores are rounded before ranking, so equal vectors tie and the id decides
QUERY_BLOCK = 1 << 14  # query vectors that meet a block of rows in one task
ROW_BLOCK = 1 << 16
TILE_QUERIES, TILE_ROWS, TILE_FIRST = 256, 2048, 512  # scored together
PROBE_ROWS = 256  # rows that meet all centroids at once
POSTING_BYTES = 8 * 1024 * 1024  # of text per range of postings
INDEX_SAMPLE = 20_000  # rows that centroids are fitted on


def hashing_tf(df: DataFrame, text_col: str, out: str, dims: int = 256, normalize: bool = True) -> DataFrame:
    """Hashed term-frequency vector of unit length (JVM only, no shuffle)."""
    words = Tokenizer(inputCol="_text", outputCol="_words").transform(
        df.withColumn("_text", F.coalesce(F.col(text_col), F.lit("")))
    )
    counted = HashingTF(inputCol="_words", outputCol="_tf", numFeatures=dims).transform(words)
    vector = "_tf"
    if normalize:
        counted = Normalizer(inputCol="_tf", outputCol="_unit", p=2.0).transform(counted)
        vector = "_unit"
    return counted.withColumn(out, vector_to_array(F.col(vector), "float32")).drop("_text", "_words", "_tf", "_unit")


def embed(
    df: DataFrame, text_col: str, out: str = "embedding", error: str = "embedding_error",
    fn: Callable[[DataFrame, str, str], DataFrame] = hashing_tf,
) -> DataFrame:
    """Embedding column plus an error column. Rows without text get an error
    and no vector. ``fn`` may be any embedding step with the same signature."""
    blank = F.coalesce(F.trim(F.col(text_col)) == "", F.lit(True))
    done = fn(df, text_col, out)
    return done.withColumns({
        error: F.when(blank, F.lit("empty text")),
        out: F.when(~blank, F.col(out)),
    })


def _unit(matrix: np.ndarray) -> np.ndarray:
    norms = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return matrix / np.where(norms == 0, 1.0, norms)


def _candidates(df: DataFrame, id_col: str, vec_col: str, queries: dict, k: int) -> DataFrame:
    """Best k rows per query of every Arrow batch."""
    names = list(queries)
    wanted = _unit(np.array([queries[n] for n in names], dtype="float64"))
    dims = wanted.shape[1]
    id_type = df.schema[id_col].dataType.simpleString()
    source = df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Missing vectors and vectors of another length are left out here;
            # a filter in the plan would compute the vector column twice.
            batch = batch.filter(pc.equal(pc.list_value_length(batch.column(1)), dims))
            if not batch.num_rows:
                continue
            ids = batch.column(0)
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            rows = _unit(values.astype("float64").reshape(-1, dims))
            order_ids = ids.to_numpy(zero_copy_only=False)
            if order_ids.dtype == object:
                order_ids = order_ids.astype(str)
            picks, keys, scores = [], [], []
            scored = np.round(rows @ wanted.T, SCORE_DIGITS)
            for number in range(len(names)):
                score = scored[:, number]
                if len(score) > k:
                    # Everything at or above the k-th best score, then ids decide.
                    edge = np.partition(score, len(score) - k)[len(score) - k]
                    near = np.flatnonzero(score >= edge)
                else:
                    near = np.arange(len(score))
                best = near[np.lexsort((order_ids[near], -score[near]))][:k]
                picks.extend(best.tolist())
                keys.extend([names[number]] * len(best))
                scores.extend(score[best].tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), ids.take(pa.array(picks, pa.int64())), pa.array(scores, pa.float64())],
                names=["query_id", "id", "score"],
            )

    return source.mapInArrow(work, f"query_id string, id {id_type}, score double")


def similar(
    df: DataFrame, query: Sequence[float], k: int, id_col: str, vec_col: str, where: Column | None = None
) -> DataFrame:
    """Cosine top-k for one query vector; ``where`` filters rows before scoring."""
    rows = df if where is None else df.filter(where)
    found = _candidates(rows, id_col, vec_col, {"q": list(query)}, k)
    return found.select(F.col("id").alias(id_col), "score").orderBy(F.desc("score"), id_col).limit(k)


def _best_rows(queries: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of the best k rows per query; ties go to the smaller
    row. Both are unit vectors.

    Tile after tile of the rows is scored in single precision; only pairs that
    may beat a query's running k-th best are scored in double. A row that comes
    later has to be better by a whole digit, so copies are not looked at again.
    """
    at, to, score = (np.empty(0, np.int64),) * 2 + (np.empty(0),)
    least = np.full(len(queries), -np.inf)
    digit = 10.0**-SCORE_DIGITS
    margin = (queries.shape[1] + 4) * 2.0**-23  # error of a single-precision score
    rough = queries.astype("float32")
    first = 0
    while first < len(rows):
        tile = rows[first : first + (TILE_ROWS if first else TILE_FIRST)]
        edge = (least + 0.4 * digit)[:, None]
        q = None
        if np.isfinite(least).all():
            q, r = np.nonzero(rough @ tile.astype("float32").T > (edge - margin).astype("float32"))
            if len(q) * 16 > len(rough) * len(tile):
                q = None
            else:
                found = np.einsum("ij,ij->i", queries[q], tile[r])
                keep = found > edge[q, 0]
                q, r, found = q[keep], r[keep], found[keep]
        if q is None:
            scored = queries @ tile.T
            if len(tile) > k:
                known = np.where(np.isnan(scored), -np.inf, scored)
                edge = np.maximum(edge, np.partition(known, len(tile) - k, axis=1)[:, len(tile) - k, None] - digit)
            q, r = np.nonzero(scored >= edge)
            found = scored[q, r]
        at, to, score = np.concatenate([at, q]), np.concatenate([to, r + first]), np.concatenate([score, np.round(found, SCORE_DIGITS)])
        order = np.lexsort((to, -score, at))
        at, to, score = at[order], to[order], score[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        at, to, score, place = at[place < k], to[place < k], score[place < k], place[place < k]
        full = place == k - 1
        least[at[full]] = score[full]
        first += len(tile)
    return at, to, score


def _matrix(table: pa.Table) -> np.ndarray:
    return table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches in slices that bound what is held with every centroid, and copied for every list."""
    for batch in batches:
        for start in range(0, max(batch.num_rows, 1), PROBE_ROWS):
            yield batch.slice(start, PROBE_ROWS)


def _meet(k: int):
    """Cogroup of a block of queries and a block of rows, all vectors of one length."""

    def work(queries: pa.Table, rows: pa.Table) -> pa.Table:
        q, r, s = (np.empty(0, np.int64),) * 2 + (np.empty(0),)
        if queries.num_rows and rows.num_rows:
            rows = rows.sort_by("id")
            wanted, data = _unit(_matrix(queries)), _unit(_matrix(rows))
            parts = [_best_rows(wanted[i : i + TILE_QUERIES], data, k) for i in range(0, len(wanted), TILE_QUERIES)]
            q = np.concatenate([part[0] + i * TILE_QUERIES for i, part in enumerate(parts)])
            r, s = (np.concatenate([part[n] for part in parts]) for n in (1, 2))
        return pa.table({"query_id": queries.column("q").take(pa.array(q, pa.int64())), "id": rows.column("id").take(pa.array(r, pa.int64())), "score": pa.array(s)})

    return work


def _sound(df: DataFrame, key: str | Column, vec_col: str | Column, name: str) -> DataFrame:
    """Key, vector and length of the rows whose vector has only finite components."""
    rows = df.select((F.col(key) if isinstance(key, str) else key).alias(name), (F.col(vec_col) if isinstance(vec_col, str) else vec_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return rows.filter(F.coalesce(finite, F.lit(False)) & (F.size("v") > 0)).withColumn("d", F.size("v"))


def similar_join(
    queries: DataFrame, df: DataFrame, k: int, *, query_id: str, query_vec: str, id_col: str, vec_col: str,
    query_block: int = QUERY_BLOCK, row_block: int = ROW_BLOCK,
) -> DataFrame:
    """Top-k per query for many queries, exact: query_id (as text), id, score, rank.

    Queries and rows are dealt into blocks, and each block of queries meets each
    block of rows in a task of its own, which returns the best k rows per query.
    No vector passes through the driver, and what is shuffled to the last rank
    is k rows per query and block. Rows without a whole vector take no part.
    """
    asked = _sound(queries, F.col(query_id).cast("string"), query_vec, "q")
    rows = _sound(df, id_col, vec_col, "id")
    lines = max(1, min(df.sparkSession.sparkContext.defaultParallelism, 64))
    n_queries, n_rows = max(1, -(-queries.count() // query_block)), max(lines, -(-df.count() // row_block))
    asked = asked.withColumn("i", F.pmod(F.xxhash64("q"), F.lit(n_queries)).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1))))
    rows = rows.withColumn("j", F.pmod(F.xxhash64("id"), F.lit(n_rows)).cast("int")).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))))
    return _ranked_pairs(asked, rows, ["i", "j", "d"], k, id_col)


def _ranked_pairs(asked: DataFrame, rows: DataFrame, keys: list[str], k: int, id_col: str) -> DataFrame:
    id_type = rows.schema["id"].dataType.simpleString()
    found = asked.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInArrow(_meet(k), f"query_id string, id {id_type}, score double")
    by = W.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k).withColumnRenamed("id", id_col)


def _overlap(df: DataFrame, text: str, id_col: str, text_col: str) -> DataFrame:
    """Number of distinct query words in each text."""
    words = sorted(set(text.lower().split()))
    score = F.size(F.array_intersect(F.split(F.lower(F.trim(F.col(text_col))), r"\s+"), F.array(*[F.lit(w) for w in words])))
    return df.select(F.col(id_col), score.alias("text_score"))


def text_overlap(df: DataFrame, text: str, k: int, id_col: str, text_col: str) -> DataFrame:
    """Top-k by the number of distinct query words a text contains."""
    # Filtered after the limit, so that the score is computed once per row.
    best = _overlap(df, text, id_col, text_col).orderBy(F.desc("text_score"), id_col).limit(k)
    return best.filter(F.col("text_score") > 0)


def _places(scored: DataFrame, score: str, id_col: str, wanted: list[tuple]) -> dict:
    """Rank by falling score, then id, of a few rows (id, score) of a list: one
    more than the rows ahead, counted in a pass that returns numbers only."""
    ordered = sorted(wanted, key=lambda r: (-r[1], r[0]))
    ids = np.array([r[0] for r in ordered])
    behind = np.array([-r[1] for r in ordered], "float64")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ahead = np.zeros(len(ordered) + 1, np.int64)
        for batch in batches:
            own = -batch.column(1).to_numpy(zero_copy_only=False).astype("float64")
            first = np.searchsorted(behind, own, side="right")  # the first wanted row this one is ahead of
            low = np.searchsorted(behind, own, side="left")
            tied = np.flatnonzero(low < first)
            if len(tied):
                keys = batch.column(0).to_numpy(zero_copy_only=False)
                for start in np.unique(low[tied]):
                    of = tied[low[tied] == start]
                    first[of] = start + np.searchsorted(ids[start : first[of[0]]], keys[of].astype(ids.dtype), side="right")
            ahead += np.bincount(first, minlength=len(ahead))
        at = np.flatnonzero(ahead)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(ahead[at], pa.int64())], names=["at", "n"])

    counts = scored.select(id_col, score).mapInArrow(work, "at long, n long").groupBy("at").agg(F.sum("n")).collect()
    ahead = np.zeros(len(ordered) + 1, np.int64)
    for at, n in counts:
        ahead[at] = n
    return dict(zip((r[0] for r in ordered), (np.cumsum(ahead)[: len(ordered)] + 1).tolist()))


def fuse_ranks(lists: Sequence[DataFrame], k: int, id_col: str, constant: int = 60) -> DataFrame:
    """Exact top-k of the reciprocal rank fusion of whole lists (id, score): the
    sum of ``1 / (constant + rank)`` over the lists that hold a row, without
    ranking any list.

    A row beyond place ``D`` of all m lists has at most ``m / (constant + D + 1)``,
    and the k-th row of one list at least ``1 / (constant + k)``. So candidates
    are the first ``(m - 1) * constant + m * k`` rows of each list, a number that
    does not grow with the data; their ranks elsewhere are counted.
    """
    depth = (len(lists) - 1) * constant + len(lists) * k
    spark = lists[0].sparkSession
    heads = [r[0] for scored in lists for r in scored.orderBy(F.desc(scored.columns[1]), id_col).limit(depth).select(id_col).collect()]
    kind = lists[0].schema[id_col].dataType.simpleString()
    if not heads:
        return spark.createDataFrame([], f"`{id_col}` {kind}, fused_score double")
    asked = F.broadcast(spark.createDataFrame([(i,) for i in sorted(set(heads))], f"`{id_col}` {kind}"))
    total: dict = {}
    for scored in lists:
        wanted = [tuple(r) for r in scored.join(asked, id_col, "left_semi").select(id_col, scored.columns[1]).collect()]
        for i, rank in _places(scored, scored.columns[1], id_col, wanted).items():
            total[i] = total.get(i, 0.0) + 1.0 / (constant + rank)
    best = sorted(total.items(), key=lambda r: (-r[1], r[0]))[:k]
    return spark.createDataFrame(best, f"`{id_col}` {kind}, fused_score double")


def hybrid(
    df: DataFrame, text: str, query: Sequence[float], k: int, *, id_col: str, text_col: str, vec_col: str, constant: int = 60
) -> DataFrame:
    """Text match and vector match merged into one list by reciprocal rank
    fusion. The lists are whole: every text with a query word and every vector
    has its rank. One pass scores both; the fused rows come from ``fuse_ranks``."""
    words = sorted(set(text.lower().split()))
    overlap = F.size(F.array_intersect(F.split(F.lower(F.trim(F.col(text_col))), r"\s+"), F.array(*[F.lit(w) for w in words])))
    wanted = _unit(np.array([query], dtype="float64"))[0]
    id_type = df.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits = pc.fill_null(pc.equal(pc.list_value_length(batch.column(2)), len(wanted)), False)
            scores = np.full(batch.num_rows, np.nan)
            vectors = batch.column(2).filter(fits).flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(-1, len(wanted))
            scores[fits.to_numpy(zero_copy_only=False)] = np.round(_unit(vectors) @ wanted, SCORE_DIGITS)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, from_pandas=True)], names=["id", "text_score", "score"])

    both = df.select(F.col(id_col), overlap.alias("t"), F.col(vec_col)).mapInArrow(work, f"id {id_type}, text_score int, score double")
    both = materialise(both, "hybrid-scores").withColumnRenamed("id", id_col)
    return fuse_ranks([both.filter("text_score > 0").select(id_col, "text_score"), both.filter("score IS NOT NULL").select(id_col, "score")], k, id_col, constant)


def write_postings(df: DataFrame, path: str, *, id_col: str, text_col: str) -> None:
    """Word -> documents, one row per different word of a document. Rows are
    range-partitioned by word and document, so a word in every document spreads
    over files, and sorted, so a search reads only the row groups of its words."""
    words = F.explode(F.array_distinct(F.split(F.lower(F.trim(F.col(text_col))), r"\s+")))
    posted = df.select(words.alias("word"), F.col(id_col)).filter("word <> ''")
    # So many ranges that the sort of one stays small, however long the texts are.
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    ranges = max(least, -(-held // POSTING_BYTES))
    posted.repartitionByRange(ranges, "word", id_col).sortWithinPartitions("word", id_col).write.mode("overwrite").parquet(path)


def search_postings(postings: DataFrame, text: str, id_col: str) -> DataFrame:
    """(id, text_score): documents with a word of the query, by how many of its different words they have."""
    words = sorted(set(text.lower().split()))
    return postings.filter(F.col("word").isin(words)).groupBy(id_col).agg(F.count(F.lit(1)).cast("int").alias("text_score"))


def hybrid_indexed(postings: DataFrame, vectors: DataFrame, text: str, query: Sequence[float], k: int, *, id_col: str, vec_col: str, constant: int = 60) -> DataFrame:
    """``hybrid`` over stored posting lists and stored vectors; no text is read."""
    by_text = materialise(search_postings(postings, text, id_col), "text-scores")
    by_vector = materialise(_candidates(vectors, id_col, vec_col, {"q": list(query)}, sys.maxsize), "vector-scores").select(F.col("id").alias(id_col), "score")
    return fuse_ranks([by_text, by_vector], k, id_col, constant)


class VectorIndex:
    """Inverted lists on shared storage: ``centroids`` (list, centroid, rows, radius) and
    ``vectors``, a folder per list. Fitted once, used by any number of searches.

    A search reads the lists whose centroids are nearest. With ``exact`` it goes
    on until no list left can hold a better row: a row of a list is at least the
    angle of its centroid, less the list's radius, away from the query.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.meta = spark.read.parquet(f"{path}/meta").first()

    @property
    def centroids(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/centroids")

    @property
    def vectors(self) -> DataFrame:
        return self.spark.read.schema(StructType.fromDDL(f"id {self.meta['id_type']}, v array<double>, angle double, part int, list int")).parquet(f"{self.path}/vectors")

    @classmethod
    def build(cls, df: DataFrame, path: str, *, id_col: str, vec_col: str, lists: int | None = None, sample: int = INDEX_SAMPLE, recall: float = 0.98, seed: int = 42) -> VectorIndex:
        """Fit, write and measure. Centroids, and the number of lists a search has
        to read for ``recall``, come from about ``sample`` rows by hash of the id;
        every row is indexed. There are about ``sqrt(rows)`` lists."""
        spark = df.sparkSession
        rows = materialise(_sound(df, id_col, vec_col, "id"), "index-vectors")
        sizes = {r["d"]: r["n"] for r in rows.groupBy("d").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(2).collect()}
        if len(sizes) > 1:
            raise ValueError("an index holds vectors of one length")
        n = sum(sizes.values())
        dims = next(iter(sizes), 0)
        lists = lists or max(1, ceil(sqrt(n)))
        place = F.xxhash64("id").cast("double") / 2.0**64 + 0.5
        unit = Normalizer(inputCol="raw", outputCol="features", p=2.0)
        chosen = unit.transform(rows.filter(place < sample / max(n, 1)).select("id", "v", array_to_vector("v").alias("raw")))
        chosen = chosen.filter(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x) > 0)
        held = chosen.select("id", vector_to_array("features").alias("v")).orderBy("id").limit(4 * sample).toPandas()
        known = np.array(held["v"].tolist()).reshape(len(held), -1)
        if lists > 1 and len(known) > lists:
            model = KMeans(k=lists, seed=seed, distanceMeasure="cosine", maxIter=10, featuresCol="features").fit(chosen.select("features"))
            centres = _unit(np.array(model.clusterCenters()))
        else:
            centres = _unit(known[:lists]) if len(known) else np.zeros((1, max(dims, 1)))
        shared = spark.sparkContext.broadcast(centres)  # sqrt(rows) vectors

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _pieces(batches):
                v = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                cosine = _unit(v) @ shared.value.T if batch.num_rows else np.zeros((0, len(shared.value)))
                own = cosine.argmax(axis=1) if batch.num_rows else np.empty(0, np.int64)
                angle = np.arccos(np.clip(cosine[np.arange(len(own)), own], -1, 1))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(angle), pa.array(own.astype(np.int32))], names=["id", "v", "angle", "list"])

        id_type = rows.schema["id"].dataType.simpleString()
        assigned = materialise(rows.select("id", "v").mapInArrow(assign, f"id {id_type}, v array<double>, angle double, list int"), "assigned")
        stats = assigned.groupBy("list").agg(F.count(F.lit(1)).alias("rows"), F.max("angle").alias("radius"))
        centre_rows = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "list int, centroid array<double>")
        centre_rows = centre_rows.join(stats, "list").withColumn("parts", F.ceil(F.col("rows") / ROW_BLOCK).cast("int"))
        centre_rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/centroids")
        centroids = spark.read.parquet(f"{path}/centroids")
        # A list of many rows, such as copies of one vector, is cut into parts.
        parted = assigned.join(broadcast_if_small(centroids.select("list", "parts")), "list").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
        parted.select("id", "v", "angle", "part", "list").hint("rebalance", F.col("list")).write.mode("overwrite").partitionBy("list").parquet(f"{path}/vectors")
        probes = _probes_for(known, centres, recall)
        spark.createDataFrame([(int(n), int(dims), int(probes), id_type)], "rows long, dims int, probes int, id_type string").coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")
        return cls(spark, path)

    def search(self, query: Sequence[float], k: int, *, exact: bool = False, probes: int | None = None) -> DataFrame:
        """(id, score): the best k rows of the nearest lists; of all lists where
        ``exact``. Lists are added until k rows are found or none is left."""
        wanted = _unit(np.array([query], dtype="float64"))[0]
        order = [(float(np.arccos(np.clip(np.dot(r["centroid"], wanted), -1, 1))), r) for r in self.centroids.collect()]  # sqrt(rows) rows
        order.sort(key=lambda r: (r[0] - r[1]["radius"] if exact else r[0], r[1]["list"]))
        take = max(1, min(probes or self.meta["probes"], len(order)))
        while take < len(order) and sum(r["rows"] for _, r in order[:take]) < k:
            take += 1
        while True:
            near = self.vectors.filter(F.col("list").isin([r["list"] for _, r in order[:take]]))
            found = similar(near, query, k, "id", "v")
            if take >= len(order) or not exact:
                return found
            best = [r["score"] for r in materialise(found, "found").collect()]
            # Scores are rounded, so a list as near as the k-th row is read too.
            if len(best) >= k and order[take][0] - order[take][1]["radius"] > float(np.arccos(np.clip(best[-1], -1, 1))) + 1e-4:
                return found
            take = min(len(order), 2 * take)

    def search_many(self, queries: DataFrame, k: int, *, query_id: str, query_vec: str, id_col: str, probes: int | None = None) -> DataFrame:
        """Top-k per query over the lists nearest to it: query_id (as text), id, score, rank."""
        asked = _sound(queries, F.col(query_id).cast("string"), query_vec, "q").filter(F.col("d") == self.meta["dims"])
        held = [(r["list"], r["parts"], r["rows"], r["centroid"]) for r in self.centroids.orderBy("list").collect()]
        shared = self.spark.sparkContext.broadcast(held)
        least = probes or self.meta["probes"]

        def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            centres = np.array([c for *_, c in shared.value])
            rows = np.array([r for _, _, r, _ in shared.value])
            for batch in _pieces(batches):
                v = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                at, lists, parts = [], [], []
                for i, order in enumerate(np.argsort(-(_unit(v) @ centres.T), axis=1, kind="stable") if batch.num_rows else ()):
                    enough = int(np.searchsorted(np.cumsum(rows[order]), k)) + 1
                    for c in order[: max(least, enough)]:
                        n = shared.value[c][1]
                        at += [i] * n
                        lists += [shared.value[c][0]] * n
                        parts += range(n)
                take = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(lists, pa.int32()), pa.array(parts, pa.int32())], names=["q", "v", "list", "part"])

        probed = asked.select("q", "v").mapInArrow(nearest, "q string, v array<double>, list int, part int")
        return _ranked_pairs(probed, self.vectors.select("id", "v", "list", "part"), ["list", "part"], k, id_col)


def _probes_for(known: np.ndarray, centres: np.ndarray, recall: float, k: int = 10, queries: int = 200) -> int:
    """Lists that hold ``recall`` of the nearest neighbours among sampled rows, nearest lists first."""
    if len(known) < 2 or len(centres) < 2:
        return len(centres)
    own = (known @ centres.T).argmax(axis=1)
    asked = np.linspace(0, len(known) - 1, min(queries, len(known))).astype(int)
    cosine = known[asked] @ known.T
    cosine[np.arange(len(asked)), asked] = -np.inf
    near = np.argsort(-cosine, axis=1, kind="stable")[:, : min(k, len(known) - 1)]
    place = np.argsort(np.argsort(-(known[asked] @ centres.T), axis=1, kind="stable"), axis=1, kind="stable")
    needed = np.sort(np.take_along_axis(place, own[near], axis=1).ravel())
    return int(needed[min(len(needed) - 1, ceil(recall * len(needed)))]) + 1


def ann(
    df: DataFrame, query: Sequence[float], k: int, *, id_col: str, vec_col: str, bucket: float = 1.0, tables: int = 8, seed: int = 42
) -> DataFrame:
    """Approximate neighbours of one vector by random-projection hashing on
    unit vectors, where Euclidean order equals cosine order. Rows of the
    query's own buckets are scored; none of them are paired with each other.
    Where those buckets hold fewer than k rows, all rows are scored."""
    from pyspark.ml.linalg import Vectors

    rows = Normalizer(inputCol="_v", outputCol="features", p=2.0).transform(
        df.filter(F.size(vec_col) == len(query)).select(id_col, array_to_vector(F.col(vec_col).cast("array<double>")).alias("_v"))
    ).select(id_col, "features")
    unit = _unit(np.array([query], dtype="float64"))[0]
    lsh = BucketedRandomProjectionLSH(
        inputCol="features", outputCol="hashes", bucketLength=bucket, numHashTables=tables, seed=seed
    )
    model = lsh.fit(rows)
    near = model.approxNearestNeighbors(rows, Vectors.dense(unit.tolist()), k, distCol="distance")
    found = materialise(near.select(id_col, F.round(1 - F.col("distance") * F.col("distance") / 2, SCORE_DIGITS).alias("score")), "neighbours")
    return found if found.count() >= k else similar(df, query, k, id_col, vec_col)


def sync_embeddings(
    target: DataFrame, changed: DataFrame, *, id_col: str, text_col: str,
    fn: Callable[[DataFrame, str, str], DataFrame] = hashing_tf, mark_changes: bool = False,
) -> DataFrame:
    """Embedding table brought up to date from changed rows. Only rows whose
    content hash is new or different are embedded again, once each: the new
    vectors are written before the merge reads them.

    ``target`` has the id, ``content_hash``, ``embedding`` and
    ``embedding_error``.
    """
    hashed = changed.select(id_col, text_col, row_hash([text_col]).alias("content_hash"))
    known = target.select(F.col(id_col).alias("_id"), F.col("content_hash").alias("_hash"))
    stale = hashed.join(known, (F.col(id_col) == F.col("_id")) & (F.col("content_hash") == F.col("_hash")), "left_anti")
    fresh = materialise(embed(stale, text_col, fn=fn).select(id_col, "content_hash", "embedding", "embedding_error"), "fresh-embeddings")
    return merge(target, fresh, [id_col], updates=(Update(),), mark_changes=mark_changes)
