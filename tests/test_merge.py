"""The upsert against a plain fold in Python, and all its forms against each other."""

import random

import pytest
from pyspark.sql import functions as F

from noticehouse.operators import clean, dedup, merge, rebuild

BATCHES = 5


def notices(seed, keys=40, per_batch=60):
    """Random messages: few versions, few contents, so that every case occurs."""
    rng = random.Random(seed)
    return [
        (
            batch,
            {
                "id": rng.randrange(3),
                "rappel_guid": f"k{rng.randrange(keys)}",
                "numero_version": rng.choice([None, 1, 1, 2, 3]),
                "libelle": rng.choice(["a", "b"]),
                "raw_ingested_at_utc": f"2026-01-0{batch + 1}T00:00:{n:02d}",
            },
        )
        for batch in range(BATCHES)
        for n in range(per_batch)
    ]


def fold(rows, strict=False):
    """Key -> state and every state it went through, batch by batch."""
    state, history = {}, []
    for batch in range(BATCHES):
        newest = {}
        for b, r in rows:
            if b != batch:
                continue
            rank = (r["numero_version"] or 0, r["id"], r["libelle"], r["raw_ingested_at_utc"])
            key = r["rappel_guid"]
            if key not in newest or rank > newest[key][0]:
                newest[key] = (rank, r)
        for key, (_, r) in newest.items():
            old = state.get(key)
            if old is not None and not wins(old, r, strict):
                continue
            first = batch if old is None else old["first"]
            state[key] = {**r, "first": first, "last": batch}
            history.append((key, batch))
    return state, sorted(history)


def wins(old, new, strict):
    changed = (old["id"], old["libelle"]) != (new["id"], new["libelle"])
    if old["numero_version"] is None:
        return not (strict and new["numero_version"] is None and not changed)
    if new["numero_version"] is None:
        return False
    if new["numero_version"] != old["numero_version"]:
        return new["numero_version"] > old["numero_version"]
    return changed


def stamp(batch):
    return F.expr(f"timestamp'2026-01-01 00:00:00' + make_dt_interval({batch})")


def summary(df, spec):
    day = "datediff({}, date'2026-01-01')"
    rows = df.selectExpr(
        spec.key, "numero_version", "libelle", "api_id",
        day.format(spec.inserted_at), day.format(spec.updated_at),
    ).collect()
    return sorted(map(tuple, rows), key=str)


def expected(state):
    rows = [
        (k, s["numero_version"], s["libelle"], s["id"], s["first"], s["last"])
        for k, s in state.items()
    ]
    return sorted(rows, key=str)


@pytest.fixture(scope="module", params=[1, 2])
def rows(request):
    return notices(request.param)


@pytest.fixture
def typed(messages, spec, rows):
    df = messages(*(r for _, r in rows), batch=[b for b, _ in rows])
    return clean.silver_rows(df, spec, ["batch"]).cache()


def batch_of(typed, spec, batch):
    return dedup.latest_versions(typed.where(F.col("batch") == batch), spec).drop("batch")


def first_state(typed, spec):
    first = batch_of(typed, spec, 0)
    return first.withColumns({spec.inserted_at: stamp(0), spec.updated_at: stamp(0)})


@pytest.mark.parametrize("strict", [False, True])
def test_upsert_is_the_fold(typed, spec, rows, strict):
    state = first_state(typed, spec)
    for batch in range(1, BATCHES):
        incoming = batch_of(typed, spec, batch)
        changes = merge.upsert_changes(state, incoming, spec, stamp(batch), strict)
        state = merge.overlay(state, changes, spec).cache()
    assert summary(state, spec) == expected(fold(rows, strict)[0])


@pytest.mark.parametrize("strict", [False, True])
def test_rebuild_is_the_fold(typed, spec, rows, strict):
    state, history = fold(rows, strict)
    rebuilt = rebuild.rebuild_silver(typed, spec, "batch", stamp("batch"), strict)
    assert summary(rebuilt, spec) == expected(state)
    replayed = rebuild.replay_history(typed, spec, "batch", stamp("batch"), strict)
    found = replayed.selectExpr(
        spec.key, f"datediff({rebuild.VALID_FROM}, date'2026-01-01')"
    ).collect()
    assert sorted(map(tuple, found)) == history


@pytest.mark.parametrize("digests", [False, True])
def test_changes_are_what_the_upsert_changes(typed, spec, digests):
    stored = first_state(typed, spec)
    if digests:
        stored = merge.with_digest(stored, spec)
    incoming = batch_of(typed, spec, 1)
    changed = merge.upsert_changes(stored, incoming, spec, stamp(1))
    whole = merge.overlay(stored, changed, spec)
    plain = merge.upsert_changes(stored.drop(merge.DIGEST), incoming, spec, stamp(1))
    assert summary(whole, spec) == summary(merge.overlay(stored, plain, spec), spec)
    outcomes = merge.upsert_outcomes(stored, incoming, spec)
    effective = outcomes.where(F.col("outcome").isin(*merge.EFFECTIVE))
    assert changed.count() == effective.count()
    assert outcomes.count() == incoming.count()


CASES = [
    # stored version, incoming version, content differs -> class, class when strict
    (None, None, False, "updated_unversioned", "ignored_same"),
    (None, None, True, "updated_unversioned", "updated_unversioned"),
    (None, 1, False, "updated_unversioned", "updated_unversioned"),
    (2, None, True, "ignored_stale", "ignored_stale"),
    (2, 1, True, "ignored_stale", "ignored_stale"),
    (2, 3, False, "updated_newer", "updated_newer"),
    (2, 2, True, "updated_content", "updated_content"),
    (2, 2, False, "ignored_same", "ignored_same"),
]


def test_outcome_table(spark):
    df = spark.createDataFrame(
        [(i, *case) for i, case in enumerate(CASES)],
        "i int, s int, v int, changed boolean, loose string, strict string",
    )
    args = [F.lit(False), F.col("s"), F.col("v"), F.col("changed")]
    wrong = df.where(
        (merge.outcome(*args) != F.col("loose"))
        | (merge.outcome(*args, strict_noop=True) != F.col("strict"))
    )
    assert wrong.count() == 0
    none, one = F.lit(None).cast("int"), F.lit(1)
    new = merge.outcome(F.lit(True), none, one, F.lit(None).cast("boolean"))
    assert spark.range(1).select(new).first()[0] == "inserted"


def test_payload_and_version_are_not_content(spec):
    assert "numero_version" not in spec.diff_columns
    assert "raw_data" not in spec.diff_columns
    assert len(spec.diff_columns) == 33


def test_stored_side_of_a_merge_is_narrow(spark, spec, messages, tmp_path):
    """With digests, a merge reads four columns of silver."""
    typed = clean.silver_rows(messages({"id": 1, "rappel_guid": "a"}), spec)
    stamps = {spec.inserted_at: stamp(0), spec.updated_at: stamp(0)}
    merge.with_digest(typed.withColumns(stamps), spec).write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    changed = merge.upsert_changes(stored, typed, spec, stamp(1))
    plan = changed._jdf.queryExecution().executedPlan().toString()
    (schema,) = {p.split(">")[0] for p in plan.split("ReadSchema: ")[1:]}
    assert schema.count(":") == 4


def test_backfills(spark, spec):
    legacy = spark.createDataFrame(
        [(1, "g1", None, 1, None), (2, None, "s2", 1, '{"x": 1}'), (3, None, None, 1, "{}"),
         (4, "g1", None, 2, "{}"), (None, None, None, 9, "{}")],
        "api_id int, rappel_guid string, numero_fiche string, numero_version int, raw_data string",
    ).withColumns({
        c: F.lit(None).cast(spec.silver_schema[c].dataType)
        for c in spec.silver_columns
        if c not in ("api_id", "rappel_guid", "numero_fiche", "numero_version", "raw_data")
    } | {spec.key: F.lit(None).cast("string"), spec.inserted_at: stamp(0),
         "db_id": F.monotonically_increasing_id()})
    filled = dedup.backfill_key(legacy, spec).cache()
    assert {r[spec.key] for r in filled.collect()} == {"g1", "s2", "3", None}
    kept = dedup.drop_duplicate_keys(filled, spec, "db_id").cache()
    assert sorted((r[spec.key] or "", r.numero_version) for r in kept.collect()) == [
        ("", 9), ("3", 1), ("g1", 2), ("s2", 1),
    ]
    assert {r.raw_json for r in merge.backfill_bronze(legacy, spec).collect()} == {"{}", '{"x": 1}'}

    stored = kept.where(f"{spec.key} = 'g1'").withColumns(
        {spec.updated_at: stamp(3), "libelle": F.lit("stored")}
    )
    silver = merge.backfill_silver(stored, kept, spec).collect()
    by_key = {r[spec.key]: r for r in silver}
    assert len(silver) == 4
    assert by_key["g1"].libelle == "stored"
    assert by_key["s2"][spec.updated_at] == by_key["s2"][spec.inserted_at]


def test_null_keys_are_all_kept(spark, spec):
    legacy = spark.createDataFrame(
        [(i, None, 1) for i in range(50)], f"db_id int, {spec.key} string, numero_version int"
    )
    assert dedup.drop_duplicate_keys(legacy, spec, "db_id").count() == 50
