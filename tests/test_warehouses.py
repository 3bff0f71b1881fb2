"""The stores that whole runs leave: a query runs those it reads."""

import pytest

import __spark_entry__ as entry
from checks import queries


def fails(*_, **__):
    raise AssertionError("the query does not read this store")


@pytest.fixture
def anew(monkeypatch):
    """No store has been run."""
    monkeypatch.setattr(queries, "_RAN", {}, raising=False)
    monkeypatch.setattr(queries, "_WAREHOUSES", {}, raising=False)


def test_counts_run_the_dated_store_alone(spark, anew, monkeypatch):
    monkeypatch.setattr(queries, "_streamed", fails)
    assert queries.QUERIES["audit_counts"](spark, entry.SMALL).count() == 6


def test_the_fact_runs_the_store_of_all_messages_alone(spark, anew, monkeypatch):
    monkeypatch.setattr(queries, "row_counts", fails)
    fact = queries.QUERIES["warehouse_fact"](spark, entry.SMALL)
    assert fact.where("is_current").count() == fact.select("deduplication_key").distinct().count()
