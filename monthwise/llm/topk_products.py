"""Exact top-k inner products by norm-bucketed retrieval.

1. Vectors are grouped by length (buckets of a quarter power of two), and large buckets are dealt by hash into
   blocks of about ``BLOCK`` vectors; queries into blocks of about ``QUERY_BLOCK``.
2. The ``SEEDS`` longest vectors give every query a first threshold: its k-th best product with them.
3. A query needs a bucket only if threshold / (|q| * longest of the bucket), its local cosine threshold, is at
   most 1.  Block pairs no query needs are never joined.
4. Inside a block a query with a local threshold of at least ``COORDINATE_FROM`` is pruned by its strongest
   coordinate (the range that the cosine allows), the others by length; what is left is verified by its product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from monthwise.llm.common import col, written

BLOCK, QUERY_BLOCK, SEEDS = 8192, 2048, 1024
BUCKETS_PER_DOUBLING = 4
COORDINATE_FROM = 0.8
SAFE = float(1 << 52)


def _matrix(raw: list[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(raw), dtype="<f8").reshape(len(raw), dim)


def _products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact integer products (rows of q by rows of v) within the range of long; beyond it they saturate."""
    if len(q) and len(v):
        top = np.sqrt((q * q).sum(1).max()) * np.sqrt((v * v).sum(1).max())
        if not top < SAFE:
            ints = lambda m: np.array([[int(x) for x in row] for row in m.tolist()], dtype=object)
            exact = ints(q).reshape(q.shape) @ ints(v).reshape(v.shape).T
            return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)
    return np.rint(q @ v.T).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores, ties to smaller ids."""
    if len(scores) > k:
        keep = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], ~scores[keep]))][:k]


def _thresholds(seeds: dict[int, tuple[np.ndarray, np.ndarray]], k: int):
    """k-th best product of each query with the seeds of its dimension (a lower bound), else the smallest double."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.full(batch.num_rows, -np.inf)
            dims = batch["dim"].to_numpy()
            for dim in np.unique(dims).tolist():
                ids, v = seeds.get(dim, (np.empty(0), np.empty((0, dim))))
                rows = np.flatnonzero(dims == dim)
                q = _matrix([batch["vec"][i].as_py() for i in rows.tolist()], dim)
                scores = _products(q, v)
                own = batch["id"].to_numpy()[rows]
                for at, (row, s) in enumerate(zip(rows.tolist(), scores)):
                    s = s[ids != own[at]]
                    if len(s) >= k:
                        out[row] = float(np.partition(s, len(s) - k)[len(s) - k])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], [*batch.schema.names, "least"])
    return run


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _pair(row, k)
    return run


def _pair(row: dict, k: int) -> Iterator[pa.RecordBatch]:
    """The best of one block of vectors for one block of queries."""
    dim = row["dim"]
    v, q = _matrix(row["vecs"], dim), _matrix(row["queries"], dim)
    ids, qids = np.asarray(row["ids"], dtype=np.int64), np.asarray(row["query_ids"], dtype=np.int64)
    norms, qnorms = np.sqrt((v * v).sum(1)), np.sqrt((q * q).sum(1))
    order = np.argsort(-norms, kind="stable")
    v, ids, norms = v[order], ids[order], norms[order]
    least = np.asarray(row["least"])
    with np.errstate(divide="ignore", invalid="ignore"):
        local = np.where(qnorms * norms[0] > 0, least / (qnorms * norms[0]), np.where(least > 0, np.inf, -np.inf))
        shortest = np.where(qnorms > 0, least / qnorms, np.where(least > 0, np.inf, -np.inf))
    slack = 1 - 1e-9  # rounding must not lose a vector at the threshold
    found: list[tuple[int, np.ndarray, np.ndarray]] = []

    def keep(at: int, rows: np.ndarray, scores: np.ndarray) -> None:
        other = ids[rows] != qids[at]
        rows, scores = rows[other], scores[other]
        best = _best(scores, ids[rows], k)
        found.append((at, ids[rows][best], scores[best]))

    by_coordinate = np.flatnonzero((local * slack <= 1) & (local >= COORDINATE_FROM))
    if len(by_coordinate):
        unit = v / np.maximum(norms, 1e-300)[:, None]
        sorted_by = {}
        for at in by_coordinate.tolist():
            u = q[at] / qnorms[at]
            f = int(np.argmax(np.abs(u)))
            if f not in sorted_by:
                by = np.argsort(unit[:, f], kind="stable")
                sorted_by[f] = (by, unit[by, f])
            by, values = sorted_by[f]
            t = min(local[at] * slack, 1.0)
            spread = np.sqrt(max(0.0, (1 - t * t) * (1 - u[f] * u[f]))) + 1e-9
            # what stays has a cosine of at least t with the query
            lo, hi = u[f] * t - spread, u[f] * t + spread
            if u[f] > t:
                hi = 1.0 + 1e-9
            if u[f] < -t:
                lo = -1.0 - 1e-9
            rows = by[np.searchsorted(values, lo):np.searchsorted(values, hi, side="right")]
            if len(rows):
                keep(at, rows, _products(q[at:at + 1], v[rows])[0])
    by_length = np.flatnonzero(~(local >= COORDINATE_FROM))
    for begin in range(0, len(by_length), 256):
        some = by_length[begin:begin + 256]
        last = np.searchsorted(-norms, -shortest[some] * slack, side="right")
        scores = _products(q[some], v[:last.max(initial=0)])
        for at, n, s in zip(some.tolist(), last.tolist(), scores):
            if n:
                keep(at, np.arange(n), s[:n])
    if found:
        yield pa.RecordBatch.from_pydict({
            "query_id": pa.array(np.repeat(qids[[x[0] for x in found]], [len(x[1]) for x in found]), pa.int64()),
            "vec_id": pa.array(np.concatenate([x[1] for x in found]), pa.int64()),
            "score": pa.array(np.concatenate([x[2] for x in found]), pa.int64())})


def top_products(vectors: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5,
                 scale: int = 256) -> DataFrame:
    """The ``k`` highest inner products of each query row (condition ``is_query``) with every row of another id.

    Components are ``floor(scale * x)``, x as double.  Returns ``query_id``, ``rank`` (from 1), ``vec_id``,
    ``score``; ties go to the smaller id.  Vectors that are null or hold null or non-finite components, and rows
    with a null id, take no part.  A query meets only vectors of its own dimension; fewer than ``k`` give fewer
    rows.  Repeated rows count once; an id with several vectors is answered by the best over them.  An empty table
    gives an empty result; scores beyond the range of long saturate.  Other columns are dropped, so extra names
    can't clash.
    """
    spark = vectors.sparkSession
    parts = vectors.select(col(id_col).cast("long").alias("id"), col(vec_col).cast("array<double>").alias("x"),
                           is_query.alias("is_query"))
    parts = parts.where("id IS NOT NULL AND x IS NOT NULL AND forall(x, e -> e IS NOT NULL AND NOT isnan(e) AND "
                        f"abs(e) < double('inf') AND abs(e * {scale}) < double('inf'))")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch["x"]
            values = np.floor(np.asarray(x.flatten()) * scale)
            dims = np.asarray(x.value_lengths()).astype(np.int64)
            ends = np.concatenate(([0], np.cumsum(dims)))
            vecs = [values[i:j].astype("<f8").tobytes() for i, j in zip(ends, ends[1:])]
            norms = np.array([np.sqrt((values[i:j] ** 2).sum()) for i, j in zip(ends, ends[1:])])
            with np.errstate(divide="ignore"):
                bucket = np.floor(BUCKETS_PER_DOUBLING * np.log2(np.maximum(norms, 0.5)))
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["is_query"], pa.array(dims.astype(np.int32)), pa.array(norms),
                 pa.array(np.minimum(bucket, 1e6).astype(np.int32)), pa.array(vecs, pa.binary())],
                ["id", "is_query", "dim", "norm", "bucket", "vec"])

    rows = written(parts.mapInArrow(pack, "id long, is_query boolean, dim int, norm double, bucket int, vec binary")
                   .dropDuplicates(["id", "vec"]), "vectors")
    dims = [r["dim"] for r in rows.select("dim").distinct().collect()]
    seeds = {}
    for dim in dims:
        longest = rows.where(F.col("dim") == dim).orderBy(F.desc("norm"), "id").select("id", "vec").limit(SEEDS).collect()
        seeds[dim] = (np.array([r["id"] for r in longest]), _matrix([bytes(r["vec"]) for r in longest], dim))

    sizes = rows.groupBy("dim", "bucket").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    blocks = (rows.join(sizes, ["dim", "bucket"])
              .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
              .groupBy("dim", "bucket", "block")
              .agg(F.collect_list(F.struct("id", "vec")).alias("all"), F.max("norm").alias("longest")))
    blocks = written(blocks.select("dim", "bucket", "block", "longest", F.col("all.id").alias("ids"),
                                   F.col("all.vec").alias("vecs")), "blocks")
    queries = rows.where("is_query").mapInArrow(_thresholds(seeds, k), StructType([*rows.schema.fields, StructField("least", DoubleType())]))
    count = rows.where("is_query").groupBy("dim").agg(F.ceil(F.count("*") / QUERY_BLOCK).alias("blocks"))
    asked = (queries.join(count, "dim").withColumn("query_block", F.pmod(F.xxhash64("id"), F.col("blocks")))
             .groupBy("dim", "query_block")
             .agg(F.collect_list(F.struct("id", "vec", "least")).alias("all"),
                  F.min(F.when(F.col("norm") > 0, F.col("least") / F.col("norm"))
                        .otherwise(F.when(F.col("least") > 0, float("inf")).otherwise(float("-inf")))).alias("need")))
    asked = written(asked.select("dim", "query_block", "need", F.col("all.id").alias("query_ids"),
                                 F.col("all.vec").alias("queries"), F.col("all.least").alias("least")), "queries")
    # Which block pairs are needed is decided on their figures alone; the blocks follow by their own keys.
    pairs = written(asked.select("dim", "query_block", "need").join(
        blocks.select("dim", "bucket", "block", "longest"), "dim").where("need * (1 - 1e-9) <= longest")
        .select("dim", "query_block", "bucket", "block"), "pairs")
    joined = pairs.join(asked.drop("need"), ["dim", "query_block"]).join(
        blocks.drop("longest"), ["dim", "bucket", "block"])
    found = joined.select("dim", "query_ids", "queries", "least", "ids", "vecs").mapInArrow(
        _search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
