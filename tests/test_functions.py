import hashlib

from pyspark.sql import functions as F

from noticehouse.functions import dates, keys, payload


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_parse_publication(spark):
    texts = [
        "2026-06-29T12:30:00Z",
        "2026-06-29T14:30:00+02:00",
        "2026-06-29T12:30:00",
        "2026-06-29 and more",
        "2026-6-9",
        "not-a-date",
        "2026",
        "",
        None,
    ]
    parsed = column(spark, texts, lambda c: dates.parse_publication(c).cast("string"))
    assert parsed == [
        "2026-06-29 12:30:00",
        "2026-06-29 12:30:00",
        "2026-06-29 12:30:00",
        "2026-06-29 00:00:00",
        "2026-06-09 00:00:00",
        None,
        None,
        None,
        None,
    ]


def test_date_key_and_days(spark):
    df = spark.sql(
        "select timestamp'2026-01-05 23:59:59' as t, date'2026-01-03' as d, null as n"
    )
    row = df.select(
        dates.date_key(F.col("t")),
        dates.days_between(F.col("d"), F.col("t")),
        dates.days_between(F.col("n").cast("date"), F.col("t")),
        dates.date_key(F.col("n").cast("timestamp")),
    ).first()
    assert tuple(row) == (20260105, -2, None, None)


def test_surrogate_keys(spark):
    df = spark.createDataFrame([("a", None), ("b", "c")], "x string, y string")
    found = [r[0] for r in df.select(keys.surrogate_key(F.col("x"), F.col("y"))).collect()]
    expected = ["a-_dbt_utils_surrogate_key_null_", "b-c"]
    assert found == [hashlib.md5(t.encode()).hexdigest() for t in expected]
    unknown = spark.range(1).select(keys.unknown_key("dim_marque")).first()[0]
    assert unknown == hashlib.md5(b"unknown_marque").hexdigest()


def test_array_length(spark):
    texts = ['["a","b"]', "[]", None]
    assert column(spark, texts, payload.array_length) == [2, 0, 0]


def test_digest_agrees_with_comparison(spark):
    """Null, empty text, the word null and moved borders are all different."""
    values = [
        (None, None), ("", None), (None, ""), ("null", None), ("a", "b"), ("ab", ""),
        ('a","y":"b', None), ("a", 'b"'),
    ]
    df = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], "i int, x string, y string")
    with_digest = df.withColumn("digest", payload.content_digest(["x", "y"]))
    pairs = with_digest.alias("l").crossJoin(with_digest.alias("r"))
    differ = payload.differs(
        [F.col("l.x"), F.col("l.y")], [F.col("r.x"), F.col("r.y")]
    )
    wrong = pairs.where(differ != (F.col("l.digest") != F.col("r.digest")))
    assert wrong.count() == 0
    assert with_digest.select("digest").distinct().count() == len(values)


def test_digest_sees_microseconds(spark):
    df = spark.sql(
        "select inline(array(struct(timestamp'2026-01-01 00:00:00.000001' as t),"
        " struct(timestamp'2026-01-01 00:00:00.000002' as t)))"
    )
    assert df.select(payload.content_digest(["t"])).distinct().count() == 2
