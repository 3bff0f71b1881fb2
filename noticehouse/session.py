"""Session defaults and the place for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Results depend on the zone; the rest lets Spark re-plan at run time: merge
# small shuffle partitions, split skewed ones, pick broadcasts by measured size.
# The JVM never compiles a method over 8000 bytes of bytecode, so for the widest
# projections whole-stage code is slower than split-up expression code.
# Messages are some 1.3 KB of text that packs to a fifteenth, and 2.5 KB as typed rows: a
# task of 64 MB of files sorts 2 GB of them and spills, one of 12 MB does not.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.files.maxPartitionBytes": "12m",
    # Messages repeat their field names: half of snappy's bytes.
    "spark.sql.parquet.compression.codec": "zstd",
    # Stream state is kept on disk, and a checkpoint holds its changes only.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Fixed when the session starts. Generated code is kept for reuse, and columns do
# not record the Python line they were made on, which costs driver time.
STATIC_CONF = {
    "spark.sql.codegen.cache.maxEntries": "2000",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app_name: str = "noticehouse", master: str | None = None, **conf: object
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **STATIC_CONF, **conf}.items():
        builder = builder.config(key, str(value))
    return apply_runtime_conf(builder.getOrCreate())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for tables a query writes on its way: in the shared folder named
    by ``spark.checkpoint.dir``, else in the session's warehouse folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    shared = shared or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows of a schema, as a plan the optimizer sees through."""
    nulls = (F.lit(None).cast(f.dataType).alias(f.name) for f in schema)
    return spark.range(0).select(*nulls)
