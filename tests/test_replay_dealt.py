"""History from messages that are partitioned already: the text moves once."""

import pytest
from pyspark.sql import functions as F

from checks import feed, queries
from noticehouse.operators import clean, merge, rebuild

DEAL = feed.DEAL


def stamp():
    return F.expr("timestamp'2026-01-01 00:00:00' + make_dt_interval(batch_no)")


@pytest.fixture
def sent(messages):
    """Ties by payload in one deal and in several, repeats, stale and missing versions, no
    key, broken text."""
    return messages(
        {"id": 1, "numero_fiche": "a", "numero_version": 1, "libelle": "x"},
        {"id": 1, "numero_fiche": "a", "numero_version": 1, "libelle": "y"},
        {"id": 1, "numero_fiche": "a", "numero_version": 1, "libelle": "w"},
        {"id": 2, "numero_fiche": "a", "numero_version": 1, "libelle": "Y "},
        {"id": 1, "numero_fiche": "a", "numero_version": 0, "libelle": "z"},
        {"id": 3, "numero_fiche": "b", "identification_produits": ["p"]},
        {"id": 3, "numero_fiche": "b", "identification_produits": "none"},
        {"libelle": "no id"},
        {"id": 4, "numero_version": "bad", "date_publication": "2026-01-05"},
        "broken{",
        None,
        batch_no=[0, 0, 0, 1, 2, 0, 1, 0, 1, 0, 0],
        deal=[0, 1, 1, 0, 1, 2, 2, 0, 0, 1, 2],
    ).repartition(3, DEAL)


def whole(spec):
    return [*spec.silver_columns, spec.key, merge.DIGEST, spec.updated_at, spec.inserted_at]


@pytest.mark.parametrize("dealt", [(), (DEAL,)])
def test_same_states_as_from_rows(spec, sent, dealt):
    states = rebuild.replay_history(clean.silver_rows(sent, spec, ["batch_no"]), spec, "batch_no", stamp())
    for columns in (whole(spec), list(spec.staging_columns)):
        wanted = states.select(*columns, rebuild.VALID_FROM, rebuild.VALID_TO)
        found = rebuild.replay_columns(sent, spec, "batch_no", stamp(), columns, dealt=dealt)
        assert found.schema.simpleString() == wanted.schema.simpleString()
        assert sorted(found.collect(), key=str) == sorted(wanted.collect(), key=str)


def test_the_text_moves_once(spec, sent):
    """One shuffle after the deal, and one row per key, batch and deal in it."""
    found = rebuild.replay_columns(sent, spec, "batch_no", stamp(), whole(spec), dealt=[DEAL])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    below = plan[plan.index("Exchange hashpartitioning") :]
    assert below.index("WindowGroupLimit") < below.index(f"Exchange hashpartitioning({DEAL}")


@pytest.mark.parametrize("name", ["history", "staged_history"])
def test_layers_move_the_text_once(spark, tmp_path, name):
    """As the layers are made: the feed's own deal is known to Spark."""
    made, plans = queries.Layers(spark, with_orders(spark, tmp_path), str(tmp_path / "layers")), []
    made.table = lambda _, build: plans.append(build()._jdf.queryExecution().executedPlan().toString())
    getattr(made, name)()
    assert plans[0].count("Exchange hashpartitioning") == 2


def with_orders(spark, tmp_path):
    orders = spark.range(40).selectExpr(
        "id as o_orderkey", "id % 7 as o_custkey", "'O' as o_orderstatus",
        "timestamp'1995-01-01 00:00:00' as o_orderdate", "'1-URGENT' as o_orderpriority",
    )
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    return str(tmp_path)


def test_staged_history_is_read_from_the_whole_one(spark, tmp_path):
    """Where both are wanted, the messages are made and moved once."""
    folder = with_orders(spark, tmp_path)
    alone = queries.Layers(spark, folder, str(tmp_path / "alone")).staged_history()
    made = queries.Layers(spark, folder, str(tmp_path / "layers"))
    made.silver()
    found = made.staged_history()
    assert made.written == {"history"} and found.columns == alone.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, alone.collect())) != []
