"""Nearest neighbours by a hash-prefix forest, largest inner product first.

A vector's hash string in a tree is a row of signs of random projections. The
rows of a shard are sorted by hash string once per tree; a query descends to the
rows with its longest prefix by binary search, and all trees ascend together, a
bit at a time, until enough rows share a prefix with it. Those are scored on the
original vectors.

Inner products become distances by one more component, which gives all vectors
the largest norm. Projections go between two rows of a bounded sample and are cut
at the sample's median, so the bits are balanced. Equal vectors are one row: a
group of copies costs as much as its one vector, and lists of its smallest ids
stand for it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from noticehouse.llm.common import stage

NEAREST = 20
TREES, BITS = 16, 24
#: Rows sharing a prefix that a query ascends for, summed over the trees, as a
#: share of the rows. Vectors without clusters need as many; see the README.
ASCENT = 1.5
SAMPLE = 8192
SHARD_ROWS, QUERY_BLOCK = 4096, 1024


@dataclass(frozen=True)
class Forest:
    """Projections of all trees (columns) and their cuts."""

    directions: np.ndarray
    cuts: np.ndarray
    norm2: float
    trees: int
    bits: int

    def keys(self, rows: np.ndarray, queries: bool = False) -> np.ndarray:
        """Hash strings by row and tree, the first bit highest."""
        if queries:
            last = np.zeros(len(rows))
        else:
            last = np.sqrt(np.maximum(self.norm2 - (rows * rows).sum(axis=1), 0.0))
        signs = np.column_stack([rows, last]) @ self.directions > self.cuts
        weights = 1 << np.arange(self.bits - 1, -1, -1, dtype=np.int64)
        return signs.reshape(len(rows), self.trees, self.bits) @ weights


def fit_forest(sample: np.ndarray, norm2: float, trees: int, bits: int) -> Forest:
    random = np.random.default_rng(11)
    last = np.sqrt(np.maximum(norm2 - (sample * sample).sum(axis=1), 0.0))
    rows = np.column_stack([sample, last])
    width = trees * bits
    a, b = random.integers(len(rows), size=(2, width))
    noise = 1e-3 * np.sqrt(norm2) * random.standard_normal((width, rows.shape[1]))
    directions = (rows[a] - rows[b] + noise).T
    return Forest(directions, np.median(rows @ directions, axis=0), norm2, trees, bits)


def search_shard(
    forest: Forest, rows: np.ndarray, queries: np.ndarray, ascent: float, most: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per query: its position, and positions and scores of the best rows found."""
    keys, wanted = forest.keys(rows), forest.keys(queries, queries=True)
    order = np.argsort(keys, axis=0, kind="stable")
    sorted_keys = np.take_along_axis(keys, order, axis=0)
    # One tree at least then holds as many rows as are wanted.
    enough = min(max(ascent * len(rows), forest.trees * most), forest.trees * len(rows))
    low = np.zeros((len(queries), forest.trees), np.int64)
    high = np.zeros_like(low)
    todo = np.arange(len(queries))
    # Synchronous ascent: drop a bit in all trees until enough rows are met.
    for dropped in range(forest.bits + 1):
        if not len(todo):
            break
        first = wanted[todo] >> dropped << dropped
        for t in range(forest.trees):
            low[todo, t] = np.searchsorted(sorted_keys[:, t], first[:, t], "left")
            high[todo, t] = np.searchsorted(
                sorted_keys[:, t], first[:, t] + (1 << dropped) - 1, "right"
            )
        met = (high[todo] - low[todo]).sum(axis=1)
        todo = todo[met < enough]
    for k, query in enumerate(queries):
        seen = np.zeros(len(rows), bool)
        for t in range(forest.trees):
            seen[order[low[k, t] : high[k, t], t]] = True
        found = np.flatnonzero(seen)
        scores = (rows[found] * query).sum(axis=1)
        if len(found) > most:
            # All that tie with the last place stay.
            last = np.partition(scores, len(scores) - most)[len(scores) - most]
            kept = scores >= last
            found, scores = found[kept], scores[kept]
        yield k, found, scores


def _valid(vectors: DataFrame) -> DataFrame:
    """Rows with an id and a finite, non-zero vector of the usual length."""
    x = F.col("v")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = (
        vectors.select(
            F.col("vec_id").cast("bigint").alias("vec_id"),
            F.col("embedding").cast("array<double>").alias("v"),
        )
        .where("vec_id is not null and v is not null")
        .where(~bad & F.exists(x, lambda c: c != 0))
    )
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).head()
    return rows.where(F.size("v") == (size["n"] if size else 0))


def nearest(
    vectors: DataFrame,
    query_ids,
    count: int = NEAREST,
    ascent: float = ASCENT,
    trees: int = TREES,
    bits: int = BITS,
) -> DataFrame:
    """The ``count`` best candidates found for each query: ``query_id``, ``rank``,
    ``vec_id`` and ``score``, the inner product in double precision.

    ``query_ids`` is a condition on ``vec_id``; candidates are all rows but those
    with the query's id. Ties go to the smaller id. Null ids, and vectors that
    are null, zero, of another length than most, or hold null or non-finite
    components take no part; repeated rows count once. The forest is fitted on
    ``SAMPLE`` rows; every row is indexed. Queries meet all shards, in blocks.
    """
    spark = vectors.sparkSession
    key = (F.xxhash64(F.lit(1), "v").alias("k1"), F.xxhash64(F.lit(2), "v").alias("k2"))
    rows = stage(_valid(vectors).select("vec_id", "v", *key), "vectors")
    keys = ["k1", "k2"]
    ids = rows.select("vec_id", *keys).distinct()
    size = rows.count()
    distinct = rows.groupBy(*keys).agg(F.min("vec_id").alias("class_id"), F.first("v").alias("v"))
    classes = stage(distinct, "vector-classes", 4 * size)
    numbered = ids.join(classes.select(*keys, "class_id"), keys).drop(*keys)
    class_of = stage(numbered, "vector-class", size)
    firsts = Window.partitionBy("class_id").orderBy("vec_id")
    members = (
        class_of.withColumn("n", F.row_number().over(firsts))
        .where(F.col("n") <= count + 1)
        .drop("n")
    )
    looking_for = class_of.where(query_ids).withColumnRenamed("vec_id", "query_id")
    queries = stage(looking_for, "queries", size)
    asked = queries.select("class_id").distinct()
    stats = classes.agg(
        F.count("*").alias("n"),
        F.max(F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c)).alias("norm2"),
    ).head()
    if not stats["n"]:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    picked = classes.orderBy(F.xxhash64("class_id"), "class_id").limit(SAMPLE).select("v")
    sample = np.array([r["v"] for r in picked.collect()])
    forest = fit_forest(sample, stats["norm2"], trees, bits)
    shards = -(-stats["n"] // SHARD_ROWS)
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))

    def place(n: int, seed: int):
        return F.pmod(F.xxhash64(F.lit(seed), "class_id"), F.lit(n))

    def all_of(n: int):
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))

    index = classes.select("class_id", "v", place(shards, 3).alias("shard")).withColumn(
        "block", all_of(blocks)
    )
    looking = (
        classes.join(asked, "class_id")
        .select("class_id", "v", place(blocks, 4).alias("block"))
        .withColumn("shard", all_of(shards))
    )
    both = index.withColumn("is_query", F.lit(False)).unionByName(
        looking.withColumn("is_query", F.lit(True))
    )

    def search(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("class_id")
        asking = group["is_query"].to_numpy(bool)
        found = []
        if asking.any() and not asking.all():
            numbers = group["class_id"].to_numpy()
            matrix = np.stack(group["v"].to_list())
            mine, theirs = numbers[~asking], numbers[asking]
            hits = search_shard(forest, matrix[~asking], matrix[asking], ascent, count + 1)
            for k, at, scores in hits:
                found.append((np.full(len(at), theirs[k]), mine[at], scores))
        columns = zip(*found) if found else ([np.zeros(0, np.int64)],) * 2 + ([np.zeros(0)],)
        asker, other, score = (np.concatenate(list(c)) for c in columns)
        return pd.DataFrame({"asker": asker, "class_id": other, "score": score})

    pairs = both.groupBy("shard", "block").applyInPandas(
        search, "asker bigint, class_id bigint, score double"
    )

    def best(df: DataFrame, by: str, ties: str, most: int, name: str) -> DataFrame:
        order = Window.partitionBy(by).orderBy(F.desc("score"), ties)
        return df.withColumn(name, F.row_number().over(order)).where(F.col(name) <= most)

    top_classes = best(pairs, "asker", "class_id", count + 1, "n").drop("n")
    top_rows = best(top_classes.join(members, "class_id"), "asker", "vec_id", count + 1, "n")
    of_query = top_rows.select(F.col("asker").alias("class_id"), "vec_id", "score")
    answers = queries.join(of_query, "class_id").where("query_id <> vec_id")
    ranked = best(answers, "query_id", "vec_id", count, "rank")
    return ranked.select("query_id", "rank", "vec_id", "score")
