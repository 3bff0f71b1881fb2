"""What payloads hold that the declared schema does not know.

Messages are read as variants, so fields need no declaration: each message gives its
top-level fields with the kind of their values, counted per group before anything is
shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticehouse.spec import FeedSpec

KNOWN, CHANGED, UNKNOWN = "known", "changed", "unknown"
NULL = "null"


def kind_of(value: Column) -> Column:
    """JSON kind of a variant: string, number, boolean, array, object or null."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind == "VOID", NULL)
        .when(kind == "STRING", "string")
        .when(kind == "BOOLEAN", "boolean")
        .when(kind.startswith("ARRAY"), "array")
        .when(kind.startswith("OBJECT"), "object")
        .otherwise("number")
    )


def declared_kinds(spec: FeedSpec) -> dict[str, str]:
    def kind(declared: T.DataType) -> str:
        if isinstance(declared, T.ArrayType):
            return "array"
        if isinstance(declared, (T.StructType, T.MapType)):
            return "object"
        if isinstance(declared, T.BooleanType):
            return "boolean"
        return "number" if isinstance(declared, T.NumericType) else "string"

    return {f.name: kind(f.dataType) for f in spec.schema}


def payload_fields(messages: DataFrame, spec: FeedSpec, by: Sequence[str] = ()) -> DataFrame:
    """Per group, field and kind of value: how many messages have it, and whether it is
    known, of another kind than declared, or unknown. Null is of any kind. Messages
    that are no JSON object give nothing."""
    spark = messages.sparkSession
    parsed = messages.select(*by, F.try_parse_json("value").alias("_payload"))
    objects = parsed.where(F.schema_of_variant("_payload").startswith("OBJECT"))
    fields = objects.lateralJoin(spark.tvf.variant_explode(F.col("_payload").outer()))
    counted = (
        fields.select(*by, F.col("key").alias("field"), kind_of(F.col("value")).alias("kind"))
        .groupBy(*by, "field", "kind")
        .agg(F.count("*").alias("messages"))
    )
    declared = F.create_map(*(F.lit(x) for pair in declared_kinds(spec).items() for x in pair))
    expected = F.try_element_at(declared, F.col("field"))
    status = (
        F.when(expected.isNull(), UNKNOWN)
        .when(F.col("kind").isin(NULL) | (F.col("kind") == expected), KNOWN)
        .otherwise(CHANGED)
    )
    return counted.withColumn("status", status)


def payload_drift(messages: DataFrame, spec: FeedSpec, by: Sequence[str] = ()) -> DataFrame:
    """Fields and kinds that the declared schema does not know."""
    return payload_fields(messages, spec, by).where(F.col("status") != KNOWN)
