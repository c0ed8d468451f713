"""Approximate nearest neighbours: robust-pruned directed graphs, searched shard by shard.

Equal vectors are indexed once, with the ``k + 1`` smallest of their ids: no answer can use
more. A k-means of a bounded sample (``SAMPLE`` vectors) gives at most ``CLUSTERS`` regions;
every vector is indexed, in the shard of its nearest centroid. Regions of more than
``SHARD`` vectors are dealt over several shards by hash, so a hot region does not make a
large task.

A query goes to all shards of every region whose centroid is at most a margin farther than
its nearest one. The margin is measured, not set: brute force within the sample gives true
neighbours of ``ASKED`` of its vectors, and the margin is the least that reaches the regions
of the share ``coverage`` of them. Neighbours in the whole table are nearer than those in a
sample, so the share reached there is rather larger. A coverage of 1 visits all regions.

In each shard the graph is built once, in batches, and written: a beam search proposes the
neighbours of new vectors, relaxed pruning (an edge goes if a kept neighbour is closer to
its end by the factor ``ALPHA``) keeps diverse ones, and the reverse edges are added and
pruned likewise. Queries run the same beam search from the medoid; those of one shard are
dealt over tasks of about ``QUERIES``. Distances are Euclidean, in double precision, on
vectors divided by a power of two near the largest component, which changes no digit and
keeps squares finite.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components
take no part; only vectors of equal length are compared; repeated rows count once; fewer
candidates give fewer neighbours; ties go to the smaller id; no query gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.llm.common import saved

K = 10
SHARD = 8_192
SAMPLE = 20_000
CLUSTERS = 256
#: Vectors of the sample whose true neighbours set the margin, and the share to be reached.
ASKED, COVERAGE = 512, 0.97
QUERIES = 4_096
DEGREE, BUILD_BEAM, BEAM, ALPHA = 32, 48, 96, 1.2
BATCH = 256

FOUND = "query_id bigint, vec_id bigint, score double"


def _distances(queries: np.ndarray, vectors: np.ndarray, at: np.ndarray) -> np.ndarray:
    gap = vectors[at] - queries[:, None, :]
    return np.einsum("brd,brd->br", gap, gap)


class Graph:
    """Directed graph over the rows of ``x`` with at most ``DEGREE`` edges a row."""

    def __init__(self, x: np.ndarray, seed: int = 0, edges: np.ndarray | None = None):
        self.x, n = x, len(x)
        centre = self.x.mean(axis=0)
        self.entry = int(((self.x - centre) ** 2).sum(axis=1).argmin())
        if edges is not None:
            self.edges = edges
            return
        self.edges = np.full((n, DEGREE), -1, np.int64)
        if n <= DEGREE:
            for i in range(n):
                self.edges[i, : n - 1] = np.delete(np.arange(n), i)
            return
        order = np.random.default_rng(seed).permutation(n)
        order = np.concatenate([[self.entry], order[order != self.entry]])
        done = 1
        while done < n:
            batch = order[done : done + min(BATCH, max(1, done))]
            found, _ = self.search(self.x[batch], BUILD_BEAM)
            self.edges[batch] = self.pruned(batch, found)
            self.link_back(batch)
            done += len(batch)

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` nearest rows found for each query, nearest first; -1 where fewer."""
        b = len(queries)
        lines = np.arange(b)
        seen = np.zeros((b, len(self.x)), bool)
        seen[:, self.entry] = True
        ids = np.full((b, beam), -1, np.int64)
        dist = np.full((b, beam), np.inf)
        fresh = np.zeros((b, beam), bool)
        ids[:, 0], fresh[:, 0] = self.entry, True
        dist[:, 0] = _distances(queries, self.x, ids[:, :1])[:, 0]
        while True:
            live = fresh.any(axis=1)
            if not live.any():
                return ids, dist
            rows = lines[live]
            at = fresh[rows].argmax(axis=1)  # beams are sorted: the first is the nearest
            fresh[rows, at] = False
            near = self.edges[ids[rows, at]]
            new = (near >= 0) & ~seen[rows[:, None], near]
            seen[rows[:, None], np.where(new, near, self.entry)] = True
            far = np.where(new, _distances(queries[rows], self.x, near), np.inf)
            all_ids = np.concatenate([ids[rows], near], axis=1)
            all_dist = np.concatenate([dist[rows], far], axis=1)
            all_fresh = np.concatenate([fresh[rows], new], axis=1)
            best = np.argsort(all_dist, axis=1, kind="stable")[:, :beam]
            ids[rows] = np.take_along_axis(all_ids, best, 1)
            dist[rows] = np.take_along_axis(all_dist, best, 1)
            fresh[rows] = np.take_along_axis(all_fresh, best, 1) & np.isfinite(dist[rows])
            ids[rows] = np.where(np.isfinite(dist[rows]), ids[rows], -1)

    def pruned(self, rows: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """Diverse neighbours of each row among its candidates (-1: none)."""
        b, c = candidates.shape
        valid = (candidates >= 0) & (candidates != rows[:, None])
        at = np.where(valid, candidates, 0)
        own = np.where(valid, _distances(self.x[rows], self.x, at), np.inf)
        order = np.argsort(own, axis=1, kind="stable")
        at, own = np.take_along_axis(at, order, 1), np.take_along_axis(own, order, 1)
        points = self.x[at]
        norms = np.einsum("bcd,bcd->bc", points, points)
        apart = norms[:, :, None] + norms[:, None, :] - 2 * points @ points.transpose(0, 2, 1)
        alive = np.isfinite(own)
        # A repeated candidate stands at distance 0 from its first copy and goes with it.
        out = np.full((b, DEGREE), -1, np.int64)
        lines = np.arange(b)
        for k in range(DEGREE):
            some = alive.any(axis=1)
            if not some.any():
                break
            pick = alive.argmax(axis=1)
            out[some, k] = at[lines[some], pick[some]]
            alive &= ~((ALPHA**2) * apart[lines, pick] <= own)
            alive[lines, pick] = False
            alive &= at != at[lines, pick][:, None]
        return out

    def link_back(self, rows: np.ndarray) -> None:
        source = np.repeat(rows, DEGREE)
        target = self.edges[rows].ravel()
        source, target = source[target >= 0], target[target >= 0]
        while len(target):
            order = np.argsort(target, kind="stable")
            source, target = source[order], target[order]
            ends, first, count = np.unique(target, return_index=True, return_counts=True)
            nth = np.arange(len(target)) - np.repeat(first, count)
            now = nth < DEGREE
            more = np.full((len(ends), DEGREE), -1, np.int64)
            more[np.searchsorted(ends, target[now]), nth[now]] = source[now]
            both = np.concatenate([self.edges[ends], more], axis=1)
            room = (both >= 0).sum(axis=1) <= DEGREE
            packed = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)[:, :DEGREE]
            result = packed
            if not room.all():
                result = packed.copy()
                result[~room] = self.pruned(ends[~room], both[~room])
            self.edges[ends] = result
            source, target = source[~now], target[~now]


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda v: v != 0)


def _centroids(sample: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    found = sample[np.random.default_rng(1).permutation(len(sample))[:k]].copy()
    for _ in range(rounds):
        near = _to_regions(sample, found).argmin(axis=1)
        for j in range(k):
            if (near == j).any():
                found[j] = sample[near == j].mean(axis=0)
    return found


def _to_regions(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Distances of vectors to centroids."""
    square = (x**2).sum(axis=1)[:, None] + (centroids**2).sum(axis=1) - 2 * x @ centroids.T
    return np.sqrt(np.maximum(square, 0.0))


def _margin(sample: np.ndarray, centroids: np.ndarray, k: int, coverage: float) -> float:
    """How much farther than the nearest centroid those of true neighbours' regions are."""
    if coverage >= 1:
        return np.inf
    if len(centroids) == 1 or len(sample) < 2:
        return 0.0
    asked = sample[:ASKED]
    apart = _to_regions(asked, sample)
    apart[np.arange(len(asked)), np.arange(len(asked))] = np.inf
    near = np.argsort(apart, axis=1, kind="stable")[:, : min(k, len(sample) - 1)]
    region = np.concatenate([_to_regions(part, centroids).argmin(axis=1) for part in np.array_split(sample, -(-len(sample) // 2_048))])
    far = _to_regions(asked, centroids)
    need = np.take_along_axis(far, region[near], 1) - far.min(axis=1)[:, None]
    return float(np.quantile(need, coverage, method="higher"))


def _scale(largest: float) -> float:
    """The power of two at or below ``largest``."""
    return float(np.ldexp(1.0, int(np.frexp(largest)[1]) - 1))


def _regions(vectors: DataFrame, sent, nearest: bool) -> DataFrame:
    """Append ``regions``: the nearest one of the vector's length, or all within the margin."""
    schema = T.StructType([*vectors.schema.fields, T.StructField("regions", T.ArrayType(T.IntegerType()))])
    at = vectors.columns.index("vector")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(at).to_pylist()
            out: list[list[int]] = [[] for _ in rows]
            sizes = np.array([len(r) for r in rows], np.int64)
            for d in np.unique(sizes):
                here = np.flatnonzero(sizes == d)
                base, centroids, margin, scale = sent.value[int(d)]
                far = _to_regions(np.array([rows[i] for i in here], float) / scale, centroids)
                for i, row in zip(here, far, strict=True):
                    found = row.argmin(keepdims=True) if nearest else np.flatnonzero(row <= row.min() + margin)
                    out[i] = (found + base).tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int32()))], names=schema.names)

    return vectors.mapInArrow(run, schema)


def _matrix(vectors: pd.Series, scale: float) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(float) / scale


def _graphs(indexed: DataFrame, sent) -> DataFrame:
    """Every vector of ``indexed`` with its ``line`` in its shard and its ``edges`` to other lines."""
    schema = T.StructType(
        [*indexed.schema.fields, T.StructField("line", T.IntegerType()), T.StructField("edges", T.ArrayType(T.IntegerType()))]
    )

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        scale = sent.value[len(rows["vector"].iloc[0])][3]
        edges = Graph(_matrix(rows["vector"], scale)).edges
        return rows.assign(line=np.arange(len(rows), dtype=np.int32), edges=list(edges.astype(np.int32)))

    return indexed.groupBy("region", "salt").applyInPandas(build, schema)


def _search_shard(points: pd.DataFrame, queries: pd.DataFrame, k: int, sent) -> pd.DataFrame:
    empty = pd.DataFrame({"query_id": np.array([], np.int64), "vec_id": np.array([], np.int64), "score": np.array([], float)})
    if not len(points) or not len(queries):
        return empty
    points = points.sort_values("line")
    scale = sent.value[len(points["vector"].iloc[0])][3]
    x = _matrix(points["vector"], scale)
    graph = Graph(x, edges=np.stack(points["edges"].to_numpy()).astype(np.int64))
    ids = points["ids"].tolist()
    out: list[tuple[int, int, float]] = []
    for start in range(0, len(queries), BATCH):
        part = queries.iloc[start : start + BATCH]
        asked = _matrix(part["vector"], scale)
        rows, _ = graph.search(asked, BEAM)
        for query, vector, found in zip(part["query_id"], asked, rows, strict=True):
            found = found[found >= 0]
            score = np.sqrt(((x[found] - vector) ** 2).sum(axis=1)) * scale
            # Rows of equal score may hide the smallest ids; take whole ties.
            pairs = sorted((s, i) for r, s in zip(found, score, strict=True) for i in ids[r] if i != query)[:k]
            out += [(query, i, s) for s, i in pairs]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]) if out else empty


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    shard: int = SHARD,
    coverage: float = COVERAGE,
    queries: int = QUERIES,
) -> DataFrame:
    """The ``k`` nearest found of every query row of (``vec_id``, ``embedding``)."""
    spark = vectors.sparkSession
    plain = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").alias("vector"))
    valid = plain.where(F.col("vec_id").isNotNull() & usable(F.col("vector"))).distinct()
    nth = F.row_number().over(W.partitionBy("vector").orderBy("vec_id"))
    points = saved(
        valid.withColumn("nth", nth)
        .where(F.col("nth") <= k + 1)
        .groupBy("vector")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids")),
        "ann_points",
    )
    # Rows a length; lengths are few, and each has a sample of its own.
    largest = F.max(F.array_max(F.transform("vector", lambda v: F.abs(v.cast("double"))))).alias("largest")
    sizes = points.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("count"), largest).collect()
    total, base, regions = max(1, sum(r["count"] for r in sizes)), 0, {}
    for r in sorted(sizes):
        share = max(1, SAMPLE * r["count"] // total)
        rows = points.where(F.size("vector") == r.d).orderBy(F.xxhash64("vector")).limit(share).select("vector").collect()
        scale = _scale(r.largest)
        sample = np.array([x.vector for x in rows], float) / scale
        clusters = min(CLUSTERS, len(sample), -(-r["count"] // shard))
        centroids = _centroids(sample, clusters)
        regions[r.d] = (base, centroids, _margin(sample, centroids, k, coverage), scale)
        base += clusters
    sent = spark.sparkContext.broadcast(regions)
    placed = saved(
        _regions(points, sent, True).select("vector", "ids", F.col("regions")[0].alias("region")), "ann_placed"
    )
    # One row a region, at most ``CLUSTERS`` a vector length.
    salts = placed.groupBy("region").agg(F.ceil(F.count("*") / shard).cast("int").alias("salts"))
    salts = F.broadcast(salts)
    indexed = placed.join(salts, "region").select(
        "region", F.pmod(F.xxhash64("vector"), F.col("salts")).cast("int").alias("salt"), "vector", "ids"
    )
    graphs = saved(_graphs(indexed, sent), "ann_graphs")
    asked = _regions(valid.where(is_query).select(F.col("vec_id").alias("query_id"), "vector"), sent, False)
    asked = saved(asked.select("query_id", "vector", F.explode("regions").alias("region")), "ann_asked")
    # Also one row a region: tasks that share the queries of each of its shards.
    tasks = F.broadcast(asked.groupBy("region").agg(F.ceil(F.count("*") / queries).cast("int").alias("tasks")))
    asked = (
        asked.join(tasks, "region")
        .join(salts, "region")
        .withColumn("task", F.pmod(F.xxhash64("query_id"), F.col("tasks")).cast("int"))
        .select("region", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "task", "query_id", "vector")
    )
    dealt = graphs.join(tasks, "region").select(
        "region", "salt", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("task"), "vector", "ids", "line", "edges"
    )

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _search_shard(left, right, k, sent)

    by = ["region", "salt", "task"]
    found = dealt.groupBy(*by).cogroup(asked.groupBy(*by)).applyInPandas(run, FOUND)
    by_score = W.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.distinct()
        .withColumn("rank", F.row_number().over(by_score))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
