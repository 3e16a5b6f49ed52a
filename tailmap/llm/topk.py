"""Exact top-k search by inner product, with pivot-table elimination.

With |q - x| the distance, q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2, and by the triangle inequality |q - x| is at least
| |q - p| - |x - p| | for every pivot p.  The distances of all vectors to the pivots are computed once; the largest of these
lower bounds gives an upper bound of the inner product.  A query's candidates are scored in the order of that bound, and it
stops at the first that cannot reach its k-th best any more, so the result is exact.

Queries and candidates are dealt into blocks of bounded size, and a pair of blocks meets in one task by an equi-join on block
numbers; what is stored and joined is bounded for every task, and nothing is broadcast.  Of vectors that are equal only the
k + 1 smallest ids can be in any result; the others, a third of all rows perhaps, are left behind before blocks are made.

Pivots are chosen from ``PIVOT_SAMPLE`` rows at most, each the farthest from those before it; they change what is scored, not
the result.

Bounds are floating-point numbers with a slack for their rounding; scores are exact, in floating point where no sum can reach
2^52, else in 64 bits, else in Python's integers.

Defined results: vectors that are null or hold null or non-finite components take no part; a component whose scaled value, or
a result whose score, is no 64-bit integer is an error; vectors of different length do not meet; a query meets every row
but those with its own id; a query with too few candidates gets fewer rows, with none no row; rows that repeat an id are
searched for each; null ids are candidates, after all others; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored

K, SCALE, PIVOTS, PIVOT_SAMPLE, QUERY_BLOCK, CANDIDATE_BLOCK = 10, 1024.0, 32, 2048, 4096, 8192
#: Candidates scored at a time.
STEP = 128
RESULT = "query_id long, query_row long, vec_id long, score long"


def scaled(vector: Column, scale: float = SCALE) -> Column:
    """Components times scale, rounded down; null where the vector takes no part."""
    at = lambda x: F.floor(F.lit(scale) * x.cast("double"))
    fits = lambda x: F.when(F.abs(F.lit(scale) * x.cast("double")) < 2.0**63, at(x)).otherwise(F.raise_error(F.lit("a scaled component is no 64-bit integer")).cast("long"))
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(good, F.transform(vector, fits))


def _matrix(column: pa.ChunkedArray | pa.Array, kind: type = np.float64) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(flat), -1) if len(flat) else np.zeros((0, 0), dtype=kind)


def choose_pivots(sample: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Rows of the sample, each the farthest from those before it; fewer where the sample has fewer different rows."""
    if not len(sample):
        return sample
    far = np.linalg.norm(sample - sample.mean(axis=0), axis=1)
    chosen: list[int] = []
    nearest = np.full(len(sample), np.inf)
    for _ in range(n):
        i = int(np.argmax(nearest if chosen else far))
        if chosen and nearest[i] == 0:
            break
        chosen.append(i)
        nearest = np.minimum(nearest, np.linalg.norm(sample - sample[i], axis=1))
    return sample[chosen]


def fit_pivots(vectors: DataFrame, *, n: int = PIVOTS, sample: int = PIVOT_SAMPLE) -> dict[int, np.ndarray]:
    """Pivots by length of the vectors, from a bounded sample that a hash of the components chooses."""
    rows, key = vectors.select("v", F.xxhash64("v").alias("key")), F.pmod("key", F.lit(1 << 32))
    # So few rows pass the filter that ordering them is little work; four times as many as are wanted.
    part = min(1 << 32, int(4 * sample / max(1, rows.count()) * (1 << 32)))
    rows = rows.where(key < part).orderBy("key", "v").limit(sample).collect()  # at most ``sample`` vectors
    by_length: dict[int, list] = {}
    for r in rows:
        by_length.setdefault(len(r.v), []).append(r.v)
    return {d: choose_pivots(np.array(v, dtype=np.float64).reshape(len(v), d), n) for d, v in by_length.items()}


def pivot_table(vectors: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """``vectors`` (id, v) with dim and the distances to all pivots of that length."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = np.diff(b.column(1).offsets.to_numpy())
            for d in np.unique(dims).tolist():
                part = b.filter(pa.array(dims == d))
                x, p = _matrix(part.column(1)).reshape(part.num_rows, d), pivots.get(d, np.zeros((0, d)))
                far = np.stack([np.sqrt(((x - one) ** 2).sum(axis=1)) for one in p], axis=1) if len(p) else np.zeros((len(x), 0))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * far.shape[1], pa.int32()), pa.array(far.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(np.full(len(x), d), pa.int32()), lists], names=["id", "v", "dim", "far"])

    return vectors.select("id", "v").mapInArrow(work, "id long, v array<bigint>, dim int, far array<double>")


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: highest score, then smallest id."""
    if scores.dtype == object:
        return np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k], dtype=np.int64)
    return np.lexsort((ids, -scores))[:k]


def search_block(queries: tuple, candidates: tuple, k: int) -> tuple[list[int], list[int], list[int], int]:
    """Of each query its k best of these candidates: places of queries, places of candidates, scores; and how many were scored.

    Both are (ids, row numbers, vectors, distances to pivots); ids of null candidates are the largest number.  A query's own row is no
    candidate of it; other rows with its id are.
    """
    _, q_rows, q, q_far = queries
    ids, rows, x, x_far = candidates
    largest = lambda m: max(-int(m.min(initial=0)), int(m.max(initial=0)), 1)
    biggest = largest(q) * largest(x) * max(1, x.shape[1])
    exact = np.float64 if biggest < 2**52 else np.int64 if biggest < 2**63 else object  # sums of float64 are exact below 2^53
    vectors, asked = x.astype(exact), q.astype(exact)
    x_norm, q_norm = (x.astype(np.float64) ** 2).sum(axis=1), (q.astype(np.float64) ** 2).sum(axis=1)
    of, places, scores, scored = [], [], [], 0
    for j in range(len(q_rows)):
        lower = np.abs(x_far - q_far[j]).max(axis=1) if x_far.shape[1] else np.zeros(len(ids))
        # The slack covers rounding in distances and squares.
        bound = (x_norm + q_norm[j] - lower**2) / 2 + 1e-9 * (x_norm + q_norm[j]) + 1e-6
        order = np.argsort(-bound, kind="stable")
        order = order[rows[order] != q_rows[j]]
        have_p, have_s, at = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=object if exact is object else np.int64), 0
        # An equal bound may still hold a smaller id with an equal score.
        while at < len(order) and (len(have_p) < k or bound[order[at]] >= have_s[-1]):
            step = order[at : at + STEP]
            have_p = np.concatenate([have_p, step])
            have_s = np.concatenate([have_s, (vectors[step] @ asked[j]).astype(have_s.dtype)])
            keep = _best(ids[have_p], have_s, k)
            have_p, have_s, at = have_p[keep], have_s[keep], at + len(step)
        scored += at
        of += [j] * len(have_p)
        places += have_p.tolist()
        scores += have_s.tolist()
    return of, places, scores, scored


def _partial(rows: DataFrame, is_query: Column, k: int, scale: float, pivots: int, pivot_sample: int, query_block: int, candidate_block: int, id_col: str, vector_col: str) -> DataFrame | None:
    """RESULT of each query in each block of candidates; a row without a query has a block's numbers of pairs and of scored ones."""
    vectors = rows.select(F.col(id_col).cast("long").alias("id"), scaled(F.col(vector_col), scale).alias("v")).where("v is not null").select("id", "v")
    table = stored(pivot_table(vectors, fit_pivots(vectors, n=pivots, sample=pivot_sample)).withColumn("row", F.monotonically_increasing_id()), "pivot-table")
    asked = table.where(is_query).select("id", "v", "dim", "far", "row")
    same = W.partitionBy("v").orderBy(F.col("id").asc_nulls_last(), "row")
    found = table.withColumn("n", F.row_number().over(same)).where(F.col("n") <= k + 1).drop("n")
    asked, found = stored(asked, "queries"), stored(found, "candidates")
    n_q, n_c = -(-asked.count() // query_block), -(-found.count() // candidate_block)
    if not n_q or not n_c:
        return None
    mixed = lambda n, *c: F.pmod(F.xxhash64(*c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.select("id", "row", "v", "far", "dim", mixed(n_q, "row").alias("qb"), every(n_c).alias("cb"))
    right = found.select("id", "row", "v", "far", "dim", mixed(n_c, "row").alias("cb"), every(n_q).alias("qb"))

    def meet(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        if not queries.num_rows or not candidates.num_rows:
            return pa.table({c.split()[0]: pa.array([], pa.int64()) for c in RESULT.split(", ")})
        parts = []
        for t in (queries, candidates):
            ids = t.column("id").combine_chunks().fill_null(np.iinfo(np.int64).max).to_numpy()
            parts.append((ids, t.column("row").to_numpy(), _matrix(t.column("v"), np.int64), _matrix(t.column("far")).reshape(t.num_rows, -1)))
        of, places, scores, scored = search_block(parts[0], parts[1], k)
        at = pa.array(of, pa.int64())
        best = pa.table({"query_id": queries.column("id").take(at), "query_row": queries.column("row").take(at), "vec_id": candidates.column("id").take(pa.array(places, pa.int64())), "score": pa.array([int(x) for x in scores], pa.int64())})
        return pa.concat_tables([best, pa.table({"query_id": pa.array([None], pa.int64()), "query_row": pa.array([None], pa.int64()), "vec_id": pa.array([queries.num_rows * candidates.num_rows]), "score": pa.array([scored], pa.int64())})])

    by = ["dim", "qb", "cb"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(meet, RESULT)


def _options(options: dict) -> dict:
    return {"k": K, "scale": SCALE, "pivots": PIVOTS, "pivot_sample": PIVOT_SAMPLE, "query_block": QUERY_BLOCK, "candidate_block": CANDIDATE_BLOCK, "id_col": "vec_id", "vector_col": "embedding"} | options


def search(rows: DataFrame, is_query: Column, **options: object) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's k best; ``is_query`` is a condition on the column ``id``.

    Options: k, scale, pivots, pivot_sample, query_block, candidate_block, id_col, vector_col.
    """
    options = _options(options)
    partial = _partial(rows, is_query, **options)
    if partial is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    best = W.partitionBy("query_id", "query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return partial.where("query_row is not null").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= options["k"]).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def scored_share(rows: DataFrame, is_query: Column, **options: object) -> DataFrame:
    """pairs (of a query and a candidate of its length), scored (those that no bound ruled out): one row."""
    partial = _partial(rows, is_query, **_options(options))
    if partial is None:
        return rows.sparkSession.createDataFrame([(0, 0)], "pairs long, scored long")
    return partial.where("query_row is null").agg(F.sum("vec_id").alias("pairs"), F.sum("score").alias("scored"))
