"""Approximate nearest neighbours by multi-index hashing.

Vectors get learned binary codes: several independently started rotations, each fitted to
the sample's principal directions so that signs lose little (iterative quantisation), give
BITS bits in all. A code is cut into substrings; every block of index rows has one table a
substring. Two codes within a Hamming radius r differ by at most r // substrings bits in
some substring (pigeonhole), so probing all substring values that near returns every code
within the radius. What is within it is reranked by exact distances.

The radius is a parameter of the fitted model: learned on the sample as the Hamming
distance that holds all but a few of the true neighbours. The stated query set meets the
index in blocks of bounded size on both sides; each pair of blocks returns its 10 nearest.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import partitions, staged, table

#: Bound on the vectors that the codes and the radius are fitted on.
SAMPLE_ROWS = 8000
SAMPLE_QUERIES = 200
CODES = 4
SUBSTRING_BITS = 16
#: Share of the sample's true neighbours that the radius must hold.
COVERED = 0.985
NEAREST = 10
#: Rows of a block of the index, and of a block of queries.
INDEX_BLOCK = 1 << 15
QUERY_BLOCK = 1 << 11
_SEED = 601


class Codes(NamedTuple):
    """Codes of x: signs of (x - mean) @ rotations, ``radius`` in bits."""

    mean: np.ndarray
    rotations: np.ndarray
    radius: int

    def encode(self, x: np.ndarray) -> np.ndarray:
        """Packed substrings (uint16), one row a vector."""
        signs = (x - self.mean) @ self.rotations > 0
        pad = -signs.shape[1] % SUBSTRING_BITS
        signs = np.pad(signs, ((0, 0), (0, pad)))
        return np.packbits(signs, axis=1).view(">u2").astype(np.uint16)


_POPCOUNT = np.array([bin(i).count("1") for i in range(1 << 16)], np.uint8)


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of all rows of a to one code, or of paired rows."""
    return _POPCOUNT[a ^ b].sum(-1, dtype=np.int32)


def fit_codes(x: np.ndarray, codes: int = CODES, covered: float = COVERED,
              nearest: int = NEAREST) -> Codes:
    """Learn rotations and radius from sample vectors."""
    dims = x.shape[1]
    mean = x.mean(0)
    centred = x - mean
    _, _, axes = np.linalg.svd(centred.T @ centred + 1e-9 * np.eye(dims))
    main = centred @ axes.T
    rng = np.random.default_rng(_SEED)
    rotations = []
    for _ in range(codes):
        r, _ = np.linalg.qr(rng.normal(size=(dims, dims)))
        for _ in range(10):
            signs = np.sign(main @ r)
            u, _, vt = np.linalg.svd(signs.T @ main)
            r = (u @ vt).T
        rotations.append(axes.T @ r)
    fitted = Codes(mean, np.concatenate(rotations, 1), 0)
    own = fitted.encode(x)
    apart = []
    for i in range(min(SAMPLE_QUERIES, len(x))):
        d = ((x - x[i]) ** 2).sum(1)
        d[i] = np.inf
        near = np.argsort(d, kind="stable")[:min(nearest, len(x) - 1)]
        apart.append(hamming(own[near], own[i]))
    apart = np.concatenate(apart) if apart else np.zeros(1, np.int64)
    radius = int(np.quantile(apart, covered)) + 1 if len(apart) else 0
    return fitted._replace(radius=radius)


class Index:
    """One block of index rows with a table for each substring."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, codes: Codes):
        self.ids, self.vectors, self.codes = ids, vectors, codes
        self.packed = codes.encode(vectors)
        self.tables = []
        for s in range(self.packed.shape[1]):
            order = np.argsort(self.packed[:, s], kind="stable")
            counts = np.bincount(self.packed[:, s], minlength=1 << SUBSTRING_BITS)
            ends = np.cumsum(counts)
            values = np.flatnonzero(counts).astype(np.uint16)
            self.tables.append((order, ends - counts, ends, values))

    def within(self, code: np.ndarray) -> np.ndarray:
        """Rows whose code is within the radius: probe, unite, then filter."""
        reach = self.codes.radius // self.packed.shape[1]
        hit = np.zeros(len(self.ids), bool)
        for s, (order, begin, end, values) in enumerate(self.tables):
            # buckets in use whose value is within the substring's share of the radius
            near = values[_POPCOUNT[values ^ code[s]] <= reach]
            sizes = end[near] - begin[near]
            total = int(sizes.sum())
            if total:
                at = np.arange(total) + np.repeat(begin[near] - (np.cumsum(sizes) - sizes), sizes)
                hit[order[at]] = True
        rows = np.flatnonzero(hit)
        return rows[hamming(self.packed[rows], code) <= self.codes.radius]

    def search(self, query_id: int, query: np.ndarray, code: np.ndarray, nearest: int):
        """The nearest rows within the radius but for the query's own."""
        rows = self.within(code)
        rows = rows[self.ids[rows] != query_id]
        score = np.sqrt(((self.vectors[rows] - query) ** 2).sum(1))
        if len(rows) > nearest:
            part = np.partition(score, nearest - 1)[nearest - 1]
            rows, score = rows[score <= part], score[score <= part]
        order = np.lexsort((self.ids[rows], score))[:nearest]
        return self.ids[rows[order]], score[order]


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part: neither null, zero nor with a null or
    non-finite component."""
    v = F.col("embedding").cast("array<double>")
    fine = (F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
            & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x)
                       & (F.abs(x) < float("inf")))
            & F.exists(v, lambda x: x != 0))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")) \
        .filter(fine)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _block_search(whole: pa.Table, codes: Codes, nearest: int) -> pa.Table:
    """One block of index rows against one block of queries."""
    query = np.asarray(whole.column("is_query").combine_chunks())
    ids = np.asarray(whole.column("vec_id").combine_chunks())
    vectors = _matrix(whole.column("v").combine_chunks())
    out: list[tuple] = []
    if (~query).any() and query.any():
        index = Index(ids[~query], vectors[~query], codes)
        packed = codes.encode(vectors[query])
        for q, x, c in zip(ids[query].tolist(), vectors[query], packed, strict=True):
            found, score = index.search(q, x, c, nearest)
            out += zip([q] * len(found), found.tolist(), score.tolist(), strict=True)
    columns = list(zip(*out, strict=True)) or [[], [], []]
    return pa.table({"query_id": pa.array(columns[0], pa.int64()),
                     "vec_id": pa.array(columns[1], pa.int64()),
                     "score": pa.array(columns[2], pa.float64())})


def _search(rows: DataFrame, asked: DataFrame, codes: Codes, nearest: int, index_blocks: int,
            query_blocks: int) -> DataFrame:
    """The nearest rows within the radius of each query, from all pairs of blocks."""
    place = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(index_blocks)).cast("int")
    query_place = F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(query_blocks)).cast("int")
    # an index row goes to each block of queries, a query to each block of the index
    blocks = rows.select(
        place.alias("i"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("j"),
        F.lit(False).alias("is_query"), "vec_id", "v").unionByName(asked.select(
            F.explode(F.sequence(F.lit(0), F.lit(index_blocks - 1))).alias("i"),
            query_place.alias("j"), F.lit(True).alias("is_query"), "vec_id", "v"))
    found = blocks.groupBy("i", "j").applyInArrow(
        lambda block: _block_search(block, codes, nearest),
        "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)) \
        .filter(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, codes: Codes | None = None,
                       nearest: int = NEAREST, index_block: int = INDEX_BLOCK,
                       query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's nearest rows by Euclidean distance, its
    own vec_id excepted, ties to the smaller vec_id.

    Unusable vectors (see ``usable``) and those without vec_id take no part, as rows or as
    queries. Vectors of another length than the commonest one (the longer of two as common)
    are unusable too. Rows
    that repeat a vec_id are one row, that of the smallest vector. Tables without usable
    vectors give no rows. Other columns are not read."""
    spark = vectors.sparkSession
    clean = usable(vectors)
    lengths = clean.groupBy(F.size("v").alias("size")).count() \
        .orderBy(F.desc("count"), F.desc("size")).first()
    dims = lengths["size"] if lengths else 0
    one = F.min("v").alias("v")
    rows = staged(clean.filter(F.size("v") == F.lit(dims)).groupBy("vec_id").agg(one),
                  "vectors")
    asked = staged(usable(queries).filter(F.size("v") == F.lit(dims))
                   .groupBy("vec_id").agg(one), "queries")
    n, q = rows.count(), asked.count()
    if codes is None:
        sample = rows.orderBy(F.xxhash64("vec_id", F.lit(_SEED)), "vec_id") \
            .limit(SAMPLE_ROWS).select("v").toArrow()  # bounded
        x = _matrix(sample.column("v").combine_chunks())
        codes = fit_codes(x, nearest=nearest) if len(x) else Codes(
            np.zeros(0), np.zeros((0, 0)), 0)
    index_blocks = max(partitions(spark), math.ceil(n / index_block))
    query_blocks = max(1, math.ceil(q / query_block))
    found = staged(_search(rows, asked, codes, nearest, index_blocks, query_blocks), "found")
    # an exact way for queries with too few rows within the radius: every code is
    enough = found.groupBy("query_id").count() \
        .filter(F.col("count") >= min(nearest, n - 1)).select("query_id")
    short = staged(asked.join(enough, F.col("vec_id") == F.col("query_id"), "left_anti"), "short")
    lacking = short.count()
    if not lacking or n < 2:
        return found
    everything = codes._replace(radius=2 * codes.rotations.shape[1] + SUBSTRING_BITS ** 2)
    rest = _search(rows, short, everything, nearest, index_blocks,
                   max(1, math.ceil(lacking / query_block)))
    return found.join(short, F.col("query_id") == short["vec_id"], "left_anti") \
        .unionByName(rest)


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest_neighbours(vectors, vectors.filter(F.col("vec_id") % 100 == 0))
