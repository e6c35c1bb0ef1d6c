"""Exact top-k search by inner product over a pivot-distance index.

Components become whole numbers, floor(scale * x). An inner product turns into a distance by one more
coordinate: with M the largest norm, x gets sqrt(M^2 - |x|^2) and a query gets 0; then
|q - x|^2 = |q|^2 + M^2 - 2 q.x, so the nearest vectors are those of the highest product.

Index. Pivots are spread out over a bounded sample (``sample`` vectors of the smallest hashes). Every
vector is keyed by its nearest pivot and its distance from it, and keeps its distances from all pivots; the
table is range-partitioned and sorted by (pivot, distance, id), so that a pivot with a third of all vectors,
or a vector with very many copies, is spread over tasks like any other. Each run of at most ``annulus`` rows
of a pivot is an annulus; the smallest and largest distance of its vectors from every pivot bound it.

Search. Queries go in blocks of a bounded number to all tasks. The k-th best product within the sample
is a query's first bound. A task expands over its annuli from the query's own distance outwards: by the
triangle inequality no vector of an annulus is nearer than the gap between the query's distance from a
pivot and the annulus', the largest over all pivots, so annuli whose gap is beyond the k-th best distance so
far are not read. The task carries bounds and best vectors through all its annuli and returns k rows a query.
Products are compared in whole numbers, distances with a margin for rounding, so results are exact.

How much is left out depends on the vectors: where these lie in clusters most annuli are, and where all are
about equally far apart, as random vectors of many components are, none can be. ``report`` tells.

Vectors that are null, or hold null, NaN or infinite components, take no part, nor do rows without an id.
Vectors of other lengths are compared as if filled up with zeros. Of several vectors with one id, the
smallest in array order counts. Ties go to the smaller id; with fewer than k candidates all are returned;
an empty table gives an empty result. Components so large that products leave 53 bits raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import map_arrow, shuffle_partitions
from clickloom.sources.tables import fresh_path, materialize

#: Products up to here are exact in the double precision they are computed in.
EXACT = 1 << 53


def whole_vectors(rows: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """id and v (whole components as doubles), one row an id, without vectors that take no part."""
    components = F.col(vector).cast("array<double>")
    finite = F.forall(components, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform(components, lambda x: F.floor(x * scale).cast("double"))
    return (
        rows.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & finite)
        .select(F.col(key).cast("long").alias("id"), whole.alias("v"))
        .groupBy("id")
        .agg(F.min("v").alias("v"))
    )


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors as rows of whole numbers, filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(lengths), dim))
    out[np.arange(dim) < lengths[:, None]] = flat
    return out


def spread_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first: each pivot is the sample vector farthest from those before it."""
    chosen = [0]
    gap = np.full(len(sample), np.inf)
    while len(chosen) < min(count, len(sample)):
        gap = np.minimum(gap, ((sample - sample[chosen[-1]]) ** 2).sum(1))
        best = int(gap.argmax())
        if gap[best] <= 0:
            break
        chosen.append(best)
    return sample[chosen]


class Search:
    """What a task needs to search its part of the index for a block of queries."""

    def __init__(self, pivots: np.ndarray, top: float, k: int, ids: np.ndarray, queries: np.ndarray, sample_ids: np.ndarray, sample: np.ndarray):
        self.pivots, self.top, self.k, self.ids, self.queries = pivots, top, k, ids, queries
        self.norms = (queries**2).sum(1)
        lifted = np.sqrt(np.maximum(top - (pivots**2).sum(1), 0))
        self.lifted = lifted
        squared = self.norms[:, None] + top - 2 * queries @ pivots.T  # pivots lie on the sphere of radius M
        self.apart = np.sqrt(np.maximum(squared, 0))
        self.bound = self._first_bound(sample_ids, sample)

    def _first_bound(self, sample_ids: np.ndarray, sample: np.ndarray) -> np.ndarray:
        """A product that k candidates of each query reach, or minus infinity."""
        bound = np.full(len(self.ids), -np.inf)
        for at in range(0, len(self.ids), 1024):
            part = slice(at, at + 1024)
            scores = self.queries[part] @ sample.T
            scores[self.ids[part, None] == sample_ids] = -np.inf
            if len(sample_ids) >= self.k:
                bound[part] = np.partition(scores, -self.k, axis=1)[:, -self.k]
        return bound

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest pivot of each vector, its distance, and those of all pivots, lifted onto the sphere."""
        lifted = np.sqrt(np.maximum(self.top - (vectors**2).sum(1), 0))
        products = vectors @ self.pivots.T + lifted[:, None] * self.lifted
        apart = np.sqrt(np.maximum(2 * self.top - 2 * products, 0))
        nearest = apart.argmin(1)
        return nearest, apart[np.arange(len(vectors)), nearest], apart.astype("<f4")


class Running:
    """The best vectors a task has found for each query, from batch to batch."""

    def __init__(self, search: Search):
        self.search = search
        self.bound = search.bound.copy()
        self.best = np.full((len(search.ids), search.k), -np.inf)
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = self.read = self.seen = 0

    def add(self, pivot: np.ndarray, ids: np.ndarray, vectors: np.ndarray, apart: np.ndarray, annulus: int) -> None:
        """Rows in index order, with their distances from all pivots."""
        s = self.search
        cuts = np.flatnonzero(np.diff(pivot)) + 1
        starts = [x for a, b in zip([0, *cuts], [*cuts, len(pivot)]) for x in range(a, b, annulus)]
        ends = [*starts[1:], len(pivot)]
        near, far = np.minimum.reduceat(apart, starts), np.maximum.reduceat(apart, starts)
        margin = 1e-5 * np.sqrt(s.top + 1) + 1e-9  # distances are kept in single precision
        gap = np.zeros((len(s.ids), len(starts)))
        for p in range(len(s.pivots)):
            own = s.apart[:, p, None]
            np.maximum(gap, np.maximum(near[:, p] - own, own - far[:, p]), out=gap)
        gap = np.maximum(gap - margin, 0)
        # The highest product that the gap leaves possible.
        ceiling = (s.norms[:, None] + s.top - gap**2) / 2 + 0.5
        self.seen += len(s.ids) * len(ids)
        home = s.apart.argmin(1)
        for group in np.unique(home):  # queries of one neighbourhood expand in one order
            members = np.flatnonzero(home == group)
            for a in np.argsort(gap[members].mean(0), kind="stable"):
                active = members[ceiling[members, a] >= self.bound[members]]
                if len(active):
                    self._compare(active, ids[starts[a] : ends[a]], vectors[starts[a] : ends[a]])

    def _compare(self, active: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        s = self.search
        self.read += len(active) * len(ids)
        scores = s.queries[active] @ vectors.T
        scores[s.ids[active, None] == ids] = -np.inf
        q, c = np.nonzero(scores >= np.maximum(self.bound[active], -1e300)[:, None])
        if not len(q):
            return
        self.found.append(first_k(active[q], ids[c], scores[q, c], s.k))
        merged = np.concatenate([self.best[active], scores], axis=1)
        self.best[active] = np.partition(merged, -s.k, axis=1)[:, -s.k :]
        self.bound[active] = np.maximum(self.bound[active], self.best[active].min(1))
        self.held += len(self.found[-1][0])
        if self.held > 4 * s.k * len(s.ids) + 4096:
            self._thin()

    def _thin(self) -> None:
        q, c, score = (np.concatenate(x) for x in zip(*self.found))
        keep = score >= self.bound[q]
        self.found = [first_k(q[keep], c[keep], score[keep], self.search.k)]
        self.held = len(self.found[0][0])

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query ids, candidate ids and products: at most k of a query."""
        if not self.found:
            return tuple(np.empty(0, np.int64) for _ in range(3))
        self._thin()
        q, c, score = self.found[0]
        return self.search.ids[q], c, score.astype(np.int64)


def first_k(query: np.ndarray, candidate: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k highest scores of each query, ties to the smaller candidate."""
    order = np.lexsort((candidate, -score, query))
    query = query[order]
    keep = np.arange(len(query)) - np.searchsorted(query, query) < k
    order = order[keep]
    return query[keep], candidate[order], score[order]


def top_k(
    rows: DataFrame,
    is_query: Column,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 256,
    pivots: int = 32,
    sample: int = 2048,
    annulus: int = 512,
    query_block: int = 8192,
    part_rows: int = 65_536,
    report: dict[str, int] | None = None,
) -> DataFrame:
    """query_id, rank, the candidate's id under ``key``, score: the ``k`` best of all other rows for each query.

    ``is_query`` is a condition on the column ``id``. ``report`` is given the number of ``pairs`` of query and vector,
    and of those ``read``, which the index could not leave out.
    """
    spark = rows.sparkSession
    schema = f"query_id long, rank int, {key} long, score long"
    vectors = materialize(whole_vectors(rows, key, vector, scale), "topk-vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x * x)
    size = F.max(F.array_max(F.transform("v", lambda x: F.abs(x))))
    stats = vectors.agg(F.max(F.size("v")).alias("dim"), F.max(norm).alias("top"), F.count("*").alias("n"), size.alias("largest")).first()
    if not stats["n"]:
        return spark.createDataFrame([], schema)
    dim, top = max(stats["dim"], 1), float(stats["top"])
    if dim * float(stats["largest"] or 0) ** 2 >= EXACT:
        raise ValueError(f"components up to {stats['largest']:.0f} after scaling: products would not be exact")

    picked = vectors.orderBy(F.xxhash64("id"), "id").limit(sample).toArrow().combine_chunks()
    sample_ids = picked.column("id").to_numpy()
    sample_vectors = _matrix(picked.column("v").combine_chunks(), dim)
    lifted = np.sqrt(np.maximum(top - (sample_vectors**2).sum(1), 0))
    chosen = spread_pivots(np.column_stack([sample_vectors, lifted]), pivots)[:, :-1]

    def search(ids: np.ndarray, queries: np.ndarray) -> Search:
        return Search(chosen, top, k, ids, queries, sample_ids, sample_vectors)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = search(np.empty(0, np.int64), np.empty((0, dim)))
        for batch in batches:
            pivot, distance, apart = none.assign(_matrix(batch.column("v"), dim))
            apart = pa.array([row.tobytes() for row in apart], pa.binary())
            columns = [pa.array(pivot, pa.int32()), pa.array(distance), batch.column("id"), batch.column("v"), apart]
            yield pa.RecordBatch.from_arrays(columns, names=["pivot", "distance", "id", "v", "apart"])

    parts = max(shuffle_partitions(spark) // 2, -(-stats["n"] // part_rows))
    keyed = map_arrow(vectors, assign, "pivot int, distance double, id long, v array<double>, apart binary")
    index = materialize(
        keyed.repartitionByRange(parts, "pivot", "distance", "id").sortWithinPartitions("pivot", "distance", "id"),
        "topk-index",
    )

    wanted = vectors.where(is_query)
    blocks = -(-wanted.count() // query_block)
    if not blocks:
        return spark.createDataFrame([], schema)
    out = fresh_path(spark, "topk-found")
    for block in range(blocks):
        part = wanted.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).toArrow().combine_chunks()
        if not part.num_rows:
            continue
        known = spark.sparkContext.broadcast(search(part.column("id").to_numpy(), _matrix(part.column("v").combine_chunks(), dim)))

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            running = Running(known.value)
            for batch in batches:
                apart = np.frombuffer(b"".join(batch.column(3).to_pylist()), "<f4").reshape(batch.num_rows, -1)
                running.add(batch.column(0).to_numpy(), batch.column(1).to_numpy(), _matrix(batch.column(2), dim), apart, annulus)
            for found in (running.result(), ([None], [running.seen], [running.read])):  # without a query: what was read
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=["query_id", key, "score"])

        found = map_arrow(index.select("pivot", "id", "v", "apart"), scan, f"query_id long, {key} long, score long")
        found.write.mode("append").parquet(out)
        known.unpersist()
    found = spark.read.schema(f"query_id long, {key} long, score long").parquet(out)
    if report is not None:
        sums = found.where("query_id is null").agg(F.sum(key).alias("pairs"), F.sum("score").alias("read")).first()
        report.update(pairs=sums["pairs"] or 0, read=sums["read"] or 0)
    found = found.where("query_id is not null")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col(key))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", key, "score")
