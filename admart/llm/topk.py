"""Exact top-k search by inner product: the three-phase uniform threshold over lists of partial scores.

The components are dealt to ``lists`` lists; a list's score of a (query, row) pair is the inner product over
its components, and the pair's score is the sum over lists. For each bounded block of queries:

1. Every partition takes, per query and list, its best rows by that list's score, and passes on the k best sums
   of these; the k-th best over all partitions is a safe cutoff: k rows reach it, so the k-th best score does.
2. The cutoffs are broadcast. A pair that reaches cutoff c has a list score of c / ``lists`` or more, the same
   threshold in every list, so entries at or above it are sufficient.
3. The other lists' scores of these entries are added, and those that reach the cutoff are ranked.

Rows are never moved: only cutoffs, k sums and k ranked rows per query and partition are. Queries come in blocks
of ``block`` rows, the bound of what is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Pairs scored at once in a task.
PAIRS = 1 << 20
LONG = (1 << 63) - 1
#: Partial lists of a query are merged in so many groups first.
GROUPS = 64


def encode(df: DataFrame, scale: float, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v array<double>: floor(scale * x)); without null ids, null vectors and null or non-finite components."""
    x = lambda c: c.cast("double")
    fine = lambda c: c.isNotNull() & ~F.isnan(x(c)) & (F.abs(x(c)) < float("inf"))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    return (rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", fine))
            .select("vec_id", F.transform("v", lambda c: F.lit(scale) * c).alias("v")))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as integer-valued rows of ``width``; shorter ones end with zeros, longer ones are cut where the
    queries end (what a query lacks adds nothing)."""
    flat = np.clip(np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)), -1e300, 1e300)
    ends = np.cumsum(np.asarray(column.value_lengths().fill_null(0)))
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    if len(ends) and (np.diff(np.concatenate([[0], ends])) == width).all():
        return flat.reshape(len(ends), width)
    out = np.zeros((len(ends), width))
    for i, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
        n = min(width, b - a)
        out[i, :n] = flat[a:a + n]
    return out


def partial(q: np.ndarray, c: np.ndarray, most: int) -> np.ndarray:
    """Exact integer inner products: in doubles while every sum stays below 2**53, else in Python's integers
    (held to ``most``, so that the lists' sum is a long)."""
    if q.shape[1] == 0:
        return np.zeros((len(q), len(c)))
    top = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1]
    if top < 2.0 ** 51:
        return q @ c.T
    big = np.vectorize(int, otypes=[object])
    return np.clip(big(q) @ big(c).T, -most, most)


def _scores(q: np.ndarray, c: np.ndarray, lists: int) -> list[np.ndarray]:
    cuts = np.linspace(0, q.shape[1], lists + 1).astype(int)
    return [partial(q[:, a:b], c[:, a:b], LONG // lists) for a, b in zip(cuts, cuts[1:])]


def _best_sums(parts: list[np.ndarray], own: np.ndarray, k: int) -> np.ndarray:
    """The k best sums per query among each list's k best rows; -inf where there are fewer."""
    n = own.shape[1]
    take = min(n, k + 1)  # one more, as the query's own row may be among them
    places = np.concatenate([np.argpartition(p, n - take, axis=1)[:, n - take:] for p in parts], axis=1)
    places.sort(axis=1)
    again = np.zeros(places.shape, dtype=bool)
    again[:, 1:] = places[:, 1:] == places[:, :-1]  # a row counts once, whatever lists it leads
    total = sum(np.take_along_axis(p, places, axis=1) for p in parts).astype(np.float64)
    total[again | np.take_along_axis(own, places, axis=1)] = -np.inf
    if total.shape[1] < k:
        total = np.concatenate([total, np.full((len(total), k - total.shape[1]), -np.inf)], axis=1)
    return -np.sort(-total, axis=1)[:, :k]


def _ranked(q: np.ndarray, score: np.ndarray, vec: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k first entries of each query by score, then vec_id."""
    order = np.lexsort((vec, -score, q))
    q, score, vec = q[order], score[order], vec[order]
    first = np.concatenate([[True], q[1:] != q[:-1]]) if len(q) else np.zeros(0, dtype=bool)
    place = np.arange(len(q)) - np.maximum.accumulate(np.where(first, np.arange(len(q)), 0))
    return q[place < k], score[place < k], vec[place < k]


def _chunks(batches: Iterator[pa.RecordBatch], queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """(ids, vectors, query range) so that PAIRS pairs are scored at once."""
    rows = max(64, min(4096, PAIRS // max(1, min(len(queries), 512))))
    step = max(1, PAIRS // rows)
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            some = batch.slice(low, rows)
            vectors = matrix(some.column(1), queries.shape[1])
            for a in range(0, len(queries), step):
                yield some.column(0).to_numpy(), vectors, a, min(len(queries), a + step)


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 20, scale: float = 64.0, lists: int = 2, block: int = 4096,
          id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best rows of ``candidates`` for every row of ``queries``.

    Scores are integer inner products of floor(scale * x). Ties go to the smaller vec_id. A query's own row, by
    vec_id, is no candidate of it. Of queries that share a vec_id one counts; repeated candidate rows each rank.
    Null ids, null vectors and vectors with null or non-finite components take no part. Vectors of other lengths
    are filled up with zeros. No queries or no candidates give no rows.
    """
    spark = queries.sparkSession
    asked = materialize(encode(queries, scale, id_col, vec_col).dropDuplicates(["vec_id"]), "queries")
    rows = encode(candidates, scale, id_col, vec_col)
    done, last = [], None
    while True:
        part = asked.where(F.col("vec_id") > last) if last is not None else asked
        table = part.orderBy("vec_id").limit(block).toArrow()  # one block of queries: bounded
        if not table.num_rows:
            break
        ids = table.column("vec_id").to_numpy()
        vectors = table.column("v").combine_chunks()
        last = int(ids[-1])
        width = int(max(len(v) for v in vectors))
        done.append(materialize(_block(rows, ids, matrix(vectors, width), k, lists), "ranked"))
        if table.num_rows < block:
            break
    if not done:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _merge(df: DataFrame, k: int, value: str) -> DataFrame:
    """The k first values per query of sorted arrays, merged group by group, then over groups."""
    for keys in (["q", "g"], ["q"]):
        df = df.groupBy(*keys).agg(F.slice(F.sort_array(F.flatten(F.collect_list(value))), 1, k).alias(value))
    return df


def _block(rows: DataFrame, ids: np.ndarray, vectors: np.ndarray, k: int, lists: int) -> DataFrame:
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((ids, vectors))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries = shared.value
        best = np.full((len(ids), k), -np.inf)
        for found, c, a, b in _chunks(batches, queries):
            own = ids[a:b, None] == found[None, :]
            sums = _best_sums(_scores(queries[a:b], c, lists), own, k)
            best[a:b] = -np.sort(-np.concatenate([best[a:b], sums], axis=1), axis=1)[:, :k]
        some = np.flatnonzero(best[:, 0] > -np.inf)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(np.full(len(some), TaskContext.get().partitionId() % GROUPS, dtype=np.int32)),
             pa.array([[-x for x in best[i].tolist() if x > -np.inf] for i in some.tolist()], type=pa.list_(pa.float64()))],
            names=["q", "g", "negative"])

    sums = rows.mapInArrow(gather, "q int, g int, negative array<double>")
    kth = _merge(sums, k, "negative").where(F.size("negative") == k).select("q", (-F.element_at("negative", k)).alias("cutoff")).toArrow()
    cutoff = np.full(len(ids), -np.inf)  # with fewer than k rows found everything counts
    cutoff[kth.column("q").to_numpy()] = np.nextafter(kth.column("cutoff").to_numpy(), -np.inf)  # never above an integer it was rounded from
    cutoffs = spark.sparkContext.broadcast(cutoff)

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (ids, queries), least = shared.value, cutoffs.value
        held = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))
        for found, c, a, b in _chunks(batches, queries):
            parts = _scores(queries[a:b], c, lists)
            enough = np.zeros(parts[0].shape, dtype=bool)
            for p in parts:
                enough |= (p * lists >= least[a:b, None]).astype(bool)
            enough &= ids[a:b, None] != found[None, :]
            qi, ci = np.nonzero(enough)
            total = sum(p[qi, ci] for p in parts)
            reach = (total >= least[a:b][qi]).astype(bool)
            new = (qi[reach] + a, total[reach].astype(np.int64), found[ci[reach]])
            held = _ranked(*(np.concatenate(x) for x in zip(held, new)), k)
        q, score, vec = held
        first = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.zeros(0, dtype=np.int64)
        entries = pa.StructArray.from_arrays([pa.array(-score), pa.array(vec)], names=["negative", "vec_id"])
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[q[first]]), pa.array(np.full(len(first), TaskContext.get().partitionId() % GROUPS, dtype=np.int32)),
             pa.ListArray.from_arrays(pa.array(np.append(first, len(q)).astype(np.int32)), entries)], names=["q", "g", "entries"])

    ranked = _merge(rows.mapInArrow(resolve, "q long, g int, entries array<struct<negative: long, vec_id: long>>"), k, "entries")
    return (ranked.select(F.col("q").alias("query_id"), F.posexplode("entries").alias("place", "e"))
            .select("query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("e.vec_id").alias("vec_id"), (-F.col("e.negative")).alias("score")))
