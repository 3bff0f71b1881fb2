"""Report queries over gold and silver.

Counts are taken per foreign key before a dimension is joined: a hot key arrives
at the join as one row, and a large dimension meets a small aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticehouse.functions.keys import UNKNOWN_LABEL
from noticehouse.spec import DimSpec, FeedSpec

# Fixed value: name of the count column in the reports.
COUNT = "nb_rappels"


def _current_per(fact: DataFrame, key: str) -> DataFrame:
    return fact.where("is_current").groupBy(key).agg(F.count("*").alias("_n"))


def _total(counted: DataFrame, *by: Column) -> DataFrame:
    return counted.groupBy(*by).agg(F.sum("_n").alias(COUNT))


def current_by_category(
    fact: DataFrame, product: DataFrame, dim: DimSpec, category: str, top: int = 15
) -> DataFrame:
    """Current notices per category, most first; ties by name."""
    name = F.coalesce(F.col(category), F.lit(UNKNOWN_LABEL)).alias("categorie")
    joined = _current_per(fact, dim.key).join(product.select(dim.key, category), dim.key)
    return _total(joined, name).orderBy(F.desc(COUNT), "categorie").limit(top)


def current_by_month(fact: DataFrame, dates: DataFrame) -> DataFrame:
    joined = _current_per(fact, "date_key").join(
        dates.select("date_key", "year", "month"), "date_key"
    )
    return _total(joined, F.col("year"), F.col("month")).orderBy("year", "month")


def top_members(fact: DataFrame, members: DataFrame, dim: DimSpec, top: int = 10) -> DataFrame:
    """Members with the most current notices, the unknown one left out."""
    known = members.where(F.col(dim.label) != UNKNOWN_LABEL).select(dim.key, dim.label)
    joined = _current_per(fact, dim.key).join(known, dim.key)
    return _total(joined, F.col(dim.label)).orderBy(F.desc(COUNT), dim.label).limit(top)


def total_current(fact: DataFrame) -> DataFrame:
    return fact.where("is_current").agg(F.count("*").alias("total_rappels"))


def layer_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each layer, one row per layer."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
        for name, df in layers.items()
    ]
    first, *rest = counts
    for other in rest:
        first = first.unionByName(other)
    return first


def recent_notices(
    silver: DataFrame, spec: FeedSpec, columns: list[str], top: int = 20
) -> DataFrame:
    """Newest by event time. As in SQL engines that sort nulls as largest, a
    notice without a date comes first; ties by key."""
    order = [F.col(spec.event_time).desc_nulls_first(), F.col(spec.key)]
    return silver.orderBy(*order).limit(top).select(*columns)


def history_browse(
    fact: DataFrame,
    members: Mapping[str, DataFrame],
    dims: tuple[DimSpec, ...],
    columns: list[str],
    tie: str,
    top: int = 20,
) -> DataFrame:
    """Versions with the latest validity, with the labels of some dimensions.

    The fact's first ``top`` rows are a top-k, run once and then held as a table of
    that many rows, with which each dimension is cut to their keys by a broadcast
    before its labels are joined: a dimension is never shuffled. The sort comes last,
    since joins keep no order.
    """
    order = [F.col("valid_from").desc_nulls_first(), F.col(tie)]
    labels = [dim.label for dim in dims]
    needed = [c for c in columns if c not in labels] + [dim.key for dim in dims] + ["valid_from", tie]
    first = fact.select(*dict.fromkeys(needed)).orderBy(*order).limit(top)
    rows = fact.sparkSession.createDataFrame(first.toArrow())
    result = rows
    for dim in dims:
        wanted = F.broadcast(rows.select(dim.key))
        named = members[dim.name].select(dim.key, dim.label).join(wanted, dim.key, "left_semi")
        result = result.join(F.broadcast(named), dim.key, "left")
    return result.orderBy(*order).select(*columns)


def recent_runs(audit: DataFrame, top: int = 5) -> DataFrame:
    return audit.orderBy(F.desc("started_at"), "dag_run_id").limit(top)
