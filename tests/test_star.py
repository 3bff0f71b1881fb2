import datetime as dt

import pytest
from pyspark.sql import functions as F

from noticehouse.feeds.recall_notice import BRAND, PRODUCT, RISK
from noticehouse.functions.keys import unknown_key
from noticehouse.operators import calendar, clean, history, quality, reports, star

NOTICES = [
    {"id": 1, "categorie_produit": "Jouets", "libelle": "Ours", "marque_produit": "M1",
     "risques_encourus": "r", "motif_rappel": None, "identification_produits": ["x", "y"],
     "date_publication": "2026-01-10T00:00:00Z", "date_de_fin_de_la_procedure_de_rappel": "2026-02-10"},
    {"id": 2, "categorie_produit": None, "libelle": "Ours", "marque_produit": " m1 ",
     "risques_encourus": "r", "motif_rappel": "m",
     "date_publication": "2026-01-12T00:00:00Z"},
    {"id": 3, "categorie_produit": "Jouets", "libelle": None, "distributeurs": "D"},
]


@pytest.fixture
def silver(messages, spec):
    now = F.lit(dt.datetime(2026, 3, 1)).cast("timestamp")
    rows = clean.silver_rows(messages(*NOTICES), spec)
    return rows.withColumns({spec.inserted_at: now, spec.updated_at: now})


@pytest.fixture
def gold(silver, spec):
    members = star.dimensions(star.staging_view(silver, spec), spec)
    snapshot = history.open_versions(history.snapshot_source(silver, spec), spec)
    return {**members, "fact": star.fact(snapshot, members, spec)}


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_dimensions_are_distinct_and_have_an_unknown_member(gold):
    assert values(gold["dim_marque"], "marque_produit") == [("Unknown",), ("m1",)]
    assert values(gold["dim_produit"], "categorie_produit", "nom_produit") == [
        ("jouets", "ours"), (None, "Unknown"), (None, "ours"),
    ]
    assert values(gold["dim_risque"], "risques_encourus", "motif_rappel") == [
        ("Unknown", None), ("r", "m"), ("r", None),
    ]


def test_fact(gold, spark):
    rows = {r.deduplication_key: r for r in gold["fact"].collect()}
    assert len(rows) == 3
    one, two, three = rows["1"], rows["2"], rows["3"]
    assert (one.date_key, one.nb_produits_identifies, one.jours_procedure_rappel) == (20260110, 2, 31)
    assert (two.nb_produits_identifies, two.jours_procedure_rappel) == (0, None)
    assert (three.date_key, three.is_current) == (None, True)
    assert one.marque_key == two.marque_key
    assert one.produit_key != two.produit_key and one.risque_key != two.risque_key
    unknown = spark.range(1).select(unknown_key("dim_produit"), unknown_key("dim_marque")).first()
    assert (three.produit_key, three.marque_key) == tuple(unknown)


def test_vanished_attribute_falls_to_unknown(silver, spec, spark):
    """Dimensions hold current values only; an old version may find none."""
    members = star.dimensions(star.staging_view(silver.where("api_id = 3"), spec), spec)
    snapshot = history.open_versions(history.snapshot_source(silver, spec), spec)
    fact = star.fact(snapshot, members, spec)
    unknown = spark.range(1).select(unknown_key("dim_marque")).first()[0]
    assert {r.marque_key for r in fact.collect()} == {unknown}


def test_own_keys_are_the_lookups_where_nothing_vanished(silver, gold, spec):
    snapshot = history.open_versions(history.snapshot_source(silver, spec), spec)
    direct = star.fact(snapshot, None, spec)
    assert sorted(direct.collect(), key=str) == sorted(gold["fact"].collect(), key=str)
    assert "Join" not in direct._jdf.queryExecution().executedPlan().toString()


def test_lookup_matches_nulls(gold, silver):
    found = star.lookup(silver, gold["dim_risque"], RISK)
    assert found.count() == 3
    assert found.where(f"{RISK.key} is null").count() == 1


def test_hot_value_is_split_when_a_dimension_is_too_large_to_broadcast(spark):
    """Two thirds of the rows share one brand or none: adaptive execution splits
    their partitions, and no row is lost or doubled."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "50",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        facts = spark.range(0, 60_000, 1, 8).selectExpr(
            "id", "case when id % 3 = 0 then 'hot' when id % 3 = 1 then 'b' || id end as marque_produit"
        )
        members = star.dimension(facts.where("id % 5 <> 0 or id % 3 = 0"), BRAND)
        found = star.lookup(facts, members, BRAND)
        totals = found.agg(
            F.count("*"), F.countDistinct("id"), F.count_if(F.col(BRAND.key).isNull())
        )
        assert tuple(totals.first()) == (60_000, 60_000, 20_000 + 4_000)
        found.collect()
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_small_dimensions_are_broadcast(gold):
    gold["fact"].collect()  # adaptive execution picks joins by measured sizes
    plan = gold["fact"]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan.split("Initial Plan")[0]
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_calendar(spark):
    spine = calendar.date_spine(spark)
    assert spine.count() == 7305
    assert spine.agg(F.min("date_day"), F.max("date_day")).first() == (
        dt.date(2015, 1, 1), dt.date(2034, 12, 31),
    )
    days = {r.date_key: r for r in calendar.dim_date(spark, "2026-02-27", "2026-03-03").collect()}
    assert sorted(days) == [20260227, 20260228, 20260301, 20260302]
    saturday = days[20260228]
    assert (saturday.month_name, saturday.day_name) == ("February ", "Saturday ")
    assert (saturday.day_of_week, saturday.is_weekend, saturday.quarter) == (6, True, 1)
    assert not days[20260302].is_weekend


def test_quality_finds_what_is_wrong(gold, silver, spec, spark):
    tables = {d.name: gold[d.name] for d in spec.fact.dims}
    tables["dim_date"] = calendar.dim_date(spark)
    one = gold["fact"].where(f"{spec.key} = '1'").withColumn("marque_key", F.lit("nowhere"))
    broken = gold["fact"].unionByName(one)
    tables["fact_rappel"] = broken
    results = quality.run_tests(silver, tables, spec)
    failing = {
        (r.test, r.table_name, r.column_name): r.failures
        for r in results.where("failures > 0").collect()
    }
    assert failing == {
        ("not_null", "fact_rappel", "date_key"): 1,
        ("unique", "fact_rappel", "fact_rappel_key"): 1,
        ("relationships", "fact_rappel", "marque_key"): 1,
    }
    assert results.count() == 12 + 7 + 5


def test_reports(gold, spec, spark):
    fact = gold["fact"]
    by_category = reports.current_by_category(fact, gold["dim_produit"], PRODUCT, "categorie_produit")
    assert [tuple(r) for r in by_category.collect()] == [("Unknown", 2), ("jouets", 1)]
    by_month = reports.current_by_month(fact, calendar.dim_date(spark))
    assert [tuple(r) for r in by_month.collect()] == [(2026, 1, 2)]
    distributor = spec.fact.dims[3]
    top = reports.top_members(fact, gold["dim_distributeur"], distributor)
    assert [tuple(r) for r in top.collect()] == [("d", 1)]
    assert reports.total_current(fact).first()[0] == 3
    browse = reports.history_browse(
        fact, gold, (PRODUCT, BRAND), ["nom_produit", "marque_produit"], spec.key, top=2
    )
    assert browse.count() == 2
    # The fact was read once, for its first rows; what is left reads two dimensions.
    plan = browse._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LocalRelation") == 3


def test_null_dates_come_first_in_recent_notices(silver, spec):
    rows = reports.recent_notices(silver, spec, ["api_id"], top=2).collect()
    assert {r.api_id for r in rows} == {3, 2}
