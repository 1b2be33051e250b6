"""Exact top-k inner-product search by distributed histogram selection.

Every query is scored against all vectors, several times, and no score is kept:

1. Refine: each task counts its scores in bins between a query's bounds; the
   global histogram (summed by query and bin) tells the bin that holds the k-th
   highest score, which becomes the next bounds. Repeat until so few scores lie
   at or above the bounds that they can be listed, or a bin is one value wide.
2. Filter: scores at or above the lower bound are listed; ties are broken by the
   smaller vector id. A task lists at most k rows of a query, since no more of its
   rows can be among the first k.

Vectors are packed in blocks of ``BLOCK_ROWS``, queries in blocks of
``QUERY_ROWS``; a task multiplies one pair of blocks. Both are dealt by row, so
neither equal vectors nor a frequent id make a block larger.

Components are floor(scale * x). Only vectors of equal length are scored against
each other. Scores are exact as long as they fit 64 bits.

Defined cases: rows with null id, null vector, or null, NaN or infinite
components take no part, nor do components that come to 2**53 or more in size, whose
products no 64-bit score holds; a score beyond 2**62 in size counts as that; a vector of no components scores 0; rows with the query's
id are its own and no candidates; repeated query rows are answered once; a table
with fewer candidates than k gives all; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farelake.llm.tables import table, written

BLOCK_ROWS, QUERY_ROWS = 8192, 1024
BINS = 256
LISTED = 4  # times k: so many scores a query may list
CHUNK = 128  # queries scored at once in a task
LARGEST = 1 << 53  # components of this size or more take no part
MOST = (1 << 62) - 1  # scores beyond count as this


def integer_vectors(rows: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(id, v array<long>) of the rows that take part."""
    fine = F.col(key).isNotNull() & F.col(vector).isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) * scale < float(LARGEST)))
    return rows.where(fine).select(
        F.col(key).cast("long").alias("id"),
        F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")).alias("v"))


def _blocks(vectors: DataFrame, n: int, rows: int) -> DataFrame:
    """(block, dim, ids, data): the vectors, dealt in ceil(n / rows) blocks."""

    def packed(batches):
        by_dim: dict[int, list] = {}
        for batch in batches:
            v = batch.column(1)
            sizes = np.diff(v.offsets.to_numpy()) if len(v) else np.zeros(0, int)
            flat, at = v.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(sizes)])
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for dim in np.unique(sizes):
                some = np.flatnonzero(sizes == dim)
                values = flat[(at[some][:, None] + np.arange(dim)).ravel()]
                by_dim.setdefault(int(dim), []).append((ids[some], values))
        for dim, parts in sorted(by_dim.items()):
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([dim], pa.int32()),
                 pa.array([np.concatenate([p[0] for p in parts]).astype("<i8").tobytes()], pa.binary()),
                 pa.array([np.concatenate([p[1] for p in parts]).astype("<i8").tobytes()], pa.binary())],
                ["block", "dim", "ids", "data"])

    return vectors.repartition(max(1, -(-n // rows))).mapInArrow(
        packed, "block long, dim int, ids binary, data binary")


def _scores(cand: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, (queries, candidates); by floating point where that is exact."""
    top = int(np.abs(cand).max(initial=0)) * int(np.abs(query).max(initial=0)) * max(1, cand.shape[1])
    if top < 1 << 53:
        return (query.astype(float) @ cand.astype(float).T).astype(np.int64)
    if top <= MOST:
        return query @ cand.T
    return np.clip(query.astype(object) @ cand.astype(object).T, -MOST, MOST).astype(np.int64)


def _pairs(batch: pa.RecordBatch):
    """(query numbers in block, query ids, lower, width, candidate ids, scores, counted) of each pair of blocks."""
    names = batch.schema.names
    get = lambda name, i: batch.column(names.index(name))[i].as_py()
    for i in range(len(batch)):
        dim = get("dim", i)
        ids, qids = (np.frombuffer(get(c, i), "<i8") for c in ("ids", "qids"))
        cand = np.frombuffer(get("data", i), "<i8").reshape(len(ids), dim)
        query = np.frombuffer(get("qdata", i), "<i8").reshape(len(qids), dim)
        low, width = (np.array(get(c, i), np.int64) for c in ("low", "width"))
        for a in range(0, len(qids), CHUNK):
            part = slice(a, a + CHUNK)
            yield get("qblock", i), dim, np.arange(len(qids))[part], qids[part], low[part], width[part], ids, \
                _scores(cand, query[part]), qids[part][:, None] != ids[None, :]


def _floor_of(scores: np.ndarray, fine: np.ndarray, low: np.ndarray, k: int) -> np.ndarray:
    """Which scores can be among a query's first k: at or above the bound and the task's own k-th."""
    least = np.iinfo(np.int64).min
    held = np.where(fine, scores, least)
    if held.shape[1] > k:
        low = np.maximum(low, np.partition(held, held.shape[1] - k, axis=1)[:, held.shape[1] - k])
    return fine & (held >= low[:, None])


def top_k(rows: DataFrame, is_query: Column, k: int, key: str = "vec_id", vector: str = "embedding",
          scale: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest scores."""
    vectors = integer_vectors(rows, key, vector, scale)
    queries = integer_vectors(rows.where(is_query), key, vector, scale).dropDuplicates(["id", "v"])
    n, top = vectors.agg(F.count("*"), F.max(F.array_max(F.transform("v", F.abs)))).first()
    spark = rows.sparkSession
    empty = "query_id long, rank int, vec_id long, score long"
    n_queries = queries.count()
    if not n_queries:
        return spark.createDataFrame([], empty)
    blocks = written(_blocks(vectors, n, BLOCK_ROWS), "topk-blocks")
    packed = written(_blocks(queries, n_queries, QUERY_ROWS).select(
        F.col("block").alias("qblock"), "dim", F.col("ids").alias("qids"), F.col("data").alias("qdata")), "topk-queries")

    # One row for each query: its bounds [low, low + span) and how many scores reach low.
    def queries_of(batches):
        for batch in batches:
            for i in range(len(batch)):
                ids = np.frombuffer(batch.column(2)[i].as_py(), "<i8")
                data = np.frombuffer(batch.column(3)[i].as_py(), "<i8").reshape(len(ids), -1)
                m = len(ids)
                size = np.abs(data).sum(1, dtype=float)
                size = np.where(size < LARGEST, np.abs(data).sum(1), MOST)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(m, batch.column(0)[i].as_py())), pa.array(np.full(m, batch.column(1)[i].as_py(), np.int32)),
                     pa.array(np.arange(m, dtype=np.int32)), pa.array(ids), pa.array(size.astype(np.int64))],
                    ["qblock", "dim", "pos", "query_id", "size"])

    bound = F.least(F.col("size").cast("decimal(19,0)") * F.lit(int(top or 0)).cast("decimal(17,0)"),
                    F.lit(MOST).cast("decimal(38,0)")).cast("long")
    state = packed.mapInArrow(queries_of, "qblock long, dim int, pos int, query_id long, size long").select(
        "qblock", "dim", "pos", "query_id", (-bound).alias("low"), (2 * bound + 1).alias("span"),
        F.lit(n).cast("long").alias("listed"))
    numbers = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(1, -(-n // BLOCK_ROWS)) - 1).cast("long")))

    def paired(state: DataFrame) -> DataFrame:
        bounds = state.groupBy("qblock", "dim").agg(F.array_sort(F.collect_list(F.struct(
            "pos", "low", F.ceil(F.col("span") / BINS).cast("long").alias("width")))).alias("b"))
        # A stated query set against all rows, in blocks: every query block meets every block once.
        ready = packed.join(bounds, ["qblock", "dim"]).select(
            "qblock", "dim", "qids", "qdata", F.col("b")["low"].alias("low"), F.col("b")["width"].alias("width"),
            numbers.alias("block"))
        return ready.join(blocks, ["block", "dim"])

    def count(batches):
        for batch in batches:
            for qblock, dim, pos, _, low, width, _, scores, fine in _pairs(batch):
                q, c = np.nonzero(_floor_of(scores, fine, low, k))
                # Scores above the bounds are counted in the last bin but one more.
                bins = np.minimum((scores[q, c] - low[q]) // width[q], BINS)
                keys, count_of = np.unique(q * (BINS + 1) + bins, return_counts=True)
                m = len(keys)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(m, qblock)), pa.array(np.full(m, dim, np.int32)),
                     pa.array(pos[keys // (BINS + 1)].astype(np.int32)), pa.array((keys % (BINS + 1)).astype(np.int32)),
                     pa.array(count_of.astype(np.int64))], ["qblock", "dim", "pos", "bin", "n"])

    of = ["qblock", "dim", "pos"]
    while True:
        state = written(state, "topk-bounds")
        if not state.where((F.col("listed") > LISTED * k) & (F.col("span") > 1)).limit(1).count():
            break
        bins = paired(state).mapInArrow(count, "qblock long, dim int, pos int, bin int, n long").groupBy(
            *of, "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy(*of).orderBy(F.desc("bin"))
        reached = bins.withColumn("at_least", F.sum("n").over(down))
        # The highest bin at which k scores are reached; the lowest of all if they never are.
        found = reached.groupBy(*of).agg(
            F.max(F.when(F.col("at_least") >= k, F.struct("bin", "at_least"))).alias("hit"),
            F.max("at_least").alias("all"))
        width = F.ceil(F.col("span") / BINS).cast("long")
        state = state.join(found, of, "left").select(
            *of, "query_id",
            F.when(F.col("hit").isNotNull(), F.col("low") + F.col("hit")["bin"] * width).otherwise(F.col("low")).alias("low"),
            F.when(F.col("hit").isNotNull(), width).otherwise(F.lit(1).cast("long")).alias("span"),
            F.coalesce(F.col("hit")["at_least"], F.col("all"), F.lit(0).cast("long")).alias("listed"))

    def listed(batches):
        for batch in batches:
            for _, _, _, qids, low, _, ids, scores, fine in _pairs(batch):
                q, c = np.nonzero(_floor_of(scores, fine, low, k))
                order = np.lexsort((ids[c], -scores[q, c], q))
                q, c = q[order], c[order]
                rank = np.arange(len(q)) - np.searchsorted(q, q)
                q, c = q[rank < k], c[rank < k]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(qids[q]), pa.array(ids[c]), pa.array(scores[q, c])], ["query_id", "vec_id", "score"])

    found = paired(state).mapInArrow(listed, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 highest scores of every vector whose id is divisible by 100."""
    rows = table(spark, sf_dir, "embeddings", ("vec_id", "embedding"))
    return top_k(rows, F.col("vec_id") % 100 == 0, 10)


ORACLE = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), c as (select vec_id, unnest(v) as x, generate_subscripts(v, 1) as i from v
), s as (
  select q.vec_id as query_id, c.vec_id, cast(sum(q.x * c.x) as bigint) as score
  from c as q join c using (i) where q.vec_id % 100 = 0 and q.vec_id <> c.vec_id group by 1, 2
)
select query_id, cast(rank as integer) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
where rank <= 10
"""
