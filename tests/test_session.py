from types import SimpleNamespace

from pyspark.sql import types as T

from noticehouse.session import empty, scratch_path


def fake(**conf):
    conf = {k.replace("_", "."): v for k, v in conf.items()}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: conf.get(key, default)))


def test_scratch_is_in_the_shared_folder():
    session = fake(spark_checkpoint_dir="/shared/", spark_sql_warehouse_dir="/w")
    first = scratch_path(session, "x")
    assert first.startswith("/shared/x-")
    assert first != scratch_path(session, "x")


def test_scratch_is_else_in_the_warehouse():
    assert scratch_path(fake(spark_sql_warehouse_dir="s3://w/"), "x").startswith("s3://w/scratch/x-")


def test_empty(spark):
    schema = T.StructType().add("a", "integer").add("b", T.ArrayType(T.StringType()))
    assert empty(spark, schema).schema.names == ["a", "b"]
    assert empty(spark, schema).count() == 0
