"""History in some columns, from the messages."""

import re

from pyspark.sql import functions as F

from noticehouse.operators import clean, rebuild


def stamp():
    return F.expr("timestamp'2026-01-01 00:00:00' + make_dt_interval(batch_no)")


def replayed(sent, spec):
    return rebuild.replay_columns(sent, spec, "batch_no", stamp(), spec.staging_columns)


def test_same_states_as_from_rows(spec, messages):
    """Ties by payload, unchanged and stale repeats, no version, no key, broken text."""
    sent = messages(
        {"id": 1, "numero_fiche": "a", "numero_version": 1, "libelle": "x"},
        {"id": 1, "numero_fiche": "a", "numero_version": 1, "libelle": "y"},
        {"id": 2, "numero_fiche": "a", "numero_version": 1, "libelle": "Y "},
        {"id": 1, "numero_fiche": "a", "numero_version": 0, "libelle": "z"},
        {"id": 3, "numero_fiche": "b", "identification_produits": ["p"]},
        {"id": 3, "numero_fiche": "b", "identification_produits": "none"},
        {"libelle": "no id"},
        {"id": 4, "numero_version": "bad", "date_publication": "2026-01-05"},
        "broken{",
        None,
        batch_no=[0, 0, 1, 2, 0, 1, 0, 1, 0, 0],
    )
    rows = clean.silver_rows(sent, spec, ["batch_no"])
    states = rebuild.replay_history(rows, spec, "batch_no", stamp())
    wanted = [*spec.staging_columns, rebuild.VALID_FROM, rebuild.VALID_TO]
    found = replayed(sent, spec)
    assert found.columns == wanted
    assert sorted(found.collect(), key=str) == sorted(states.select(*wanted).collect(), key=str)
    assert found.where("libelle = 'y'").count() == 2 and found.where("deduplication_key = '4'").count() == 1


def test_text_and_columns_are_not_moved_together(spec, messages):
    """One shuffle moves the text, without what is parsed from it; the other the columns."""
    plan = replayed(messages({"id": 1}, batch_no=[0]), spec)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    moved = [re.findall(r"(\w+)#", line) for line in plan.splitlines() if "Project [" in line]
    assert not any({"raw_data", "libelle"} <= set(names) for names in moved)
