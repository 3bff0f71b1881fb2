"""The feed made from the orders table."""

from pyspark.sql import functions as F

from checks import feed


def test_tasks_grow_with_the_orders(spark, tmp_path, monkeypatch):
    """More orders are more tasks of the same size, and the same rows."""
    spark.range(600).select(
        F.col("id").alias("o_orderkey"),
        (F.col("id") % 50).alias("o_custkey"),
        F.lit("O").alias("o_orderstatus"),
        F.lit(1.0).alias("o_totalprice"),
        F.to_timestamp(F.lit("1996-01-02")).alias("o_orderdate"),
        F.lit("1-URGENT").alias("o_orderpriority"),
    ).write.parquet(str(tmp_path / "orders.parquet"))
    few = feed.messages(spark, str(tmp_path)).collect()
    monkeypatch.setattr(feed, "ORDERS_PER_TASK", 50)
    made = feed.messages(spark, str(tmp_path))
    assert made.select(F.spark_partition_id()).distinct().count() > spark.sparkContext.defaultParallelism
    assert sorted(made.collect(), key=str) == sorted(few, key=str)
