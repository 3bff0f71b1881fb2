"""Operators know roles, not names: a feed of application events."""

import pytest
from pyspark.sql import types as T

from noticehouse.plans import build
from noticehouse.sources.store import Store
from noticehouse.spec import DimSpec, FactSpec, FeedSpec
from noticehouse.streaming import ingest
from tests.test_merge import stamp

KIND = DimSpec("dim_kind", "kind_key", {"kind": "kind"}, "kind")

EVENTS = FeedSpec(
    schema=T.StructType()
    .add("event_id", "long")
    .add("uuid", "string")
    .add("revision", "integer")
    .add("at", "string")
    .add("kind", "string")
    .add("tags", T.ArrayType(T.StringType()))
    .add("due", "string")
    .add("fetched", "string"),
    id_field="event_id",
    key_fields=("uuid",),
    version="revision",
    event_time="at",
    ingest_time="fetched",
    date_fields=("due",),
    array_fields=("tags",),
    verbatim_fields=("uuid",),
    renames={"raw_json": "raw_data"},
    staging_columns=("entity", "kind", "silver_updated_at"),
    fact=FactSpec(
        "fact_event", "event_key", ("entity", "revision"), ("tags", "n_tags"),
        ("due", "days_left"), (KIND,),
    ),
    key="entity",
)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path), EVENTS)


def test_another_feed(store, messages):
    first = messages(
        {"event_id": 5_000_000_000, "revision": 1, "kind": " Click ", "tags": ["a"],
         "at": "2026-01-01T10:00:00Z", "due": "2026-01-04"},
        {"event_id": 2, "uuid": "U", "kind": ""},
    )
    ingest.ingest_batch(store, first, "run", 0, stamp)
    build.take_snapshot(store)
    second = messages({"event_id": 3, "uuid": "U", "revision": 2, "kind": "view"})
    ingest.ingest_batch(store, second, "run", 1, stamp)
    build.take_snapshot(store)
    build.build_gold(store)
    gold = store.gold()
    rows = gold["fact_event"].join(gold["dim_kind"], "kind_key").collect()
    found = {(r.entity, r.revision): (r.kind, r.n_tags, r.days_left, r.is_current) for r in rows}
    assert found == {
        ("5000000000", 1): ("click", 1, 3, True),
        ("U", None): ("Unknown", 0, None, False),
        ("U", 2): ("view", 0, None, True),
    }
