import datetime as dt
import json

from pyspark.sql import functions as F

from noticehouse.operators import bronze, clean

PAYLOAD = {
    "id": 7,
    "rappel_guid": "GUID-7",
    "numero_fiche": "2026-01-0007",
    "numero_version": 3,
    "date_publication": "2026-05-17T08:15:00+00:00",
    "categorie_produit": "  Maison  ",
    "libelle": " Théière Émaillée",
    "numero_contact": " 0800 ABC ",
    "identification_produits": ["456", "Lot É"],
    "date_debut_commercialisation": "2026-02-01",
    "date_date_fin_commercialisation": "2026-03-31",
    "date_de_fin_de_la_procedure_de_rappel": "31/12/2026",
    "raw_ingested_at_utc": "2026-05-17T08:16:00+00:00",
}


def test_whole_chain(messages, spec):
    df = messages(PAYLOAD, "null", "not-json", "[1]", None, "")
    (row,) = clean.clean_messages(df, spec).collect()
    assert row.categorie_produit == "maison"
    assert row.libelle == "théière émaillée"
    assert row.numero_contact == " 0800 ABC "
    assert row.rappel_guid == "GUID-7"
    assert row.identification_produits == '["456","Lot É"]'
    assert row.date_debut_commercialisation == dt.date(2026, 2, 1)
    assert row.date_fin_commercialisation == dt.date(2026, 3, 31)
    assert row.date_de_fin_de_la_procedure_de_rappel is None
    assert row.raw_json == json.dumps(PAYLOAD)


def test_blank_text_becomes_null(messages, spec):
    df = messages({"id": 1, "categorie_produit": "   ", "libelle": "", "marque_produit": "\t"})
    (row,) = clean.clean_messages(df, spec).collect()
    assert row.categorie_produit is None and row.libelle is None
    assert row.marque_produit == "\t"  # only spaces are stripped


def test_wrong_types_null_the_field_not_the_row(messages, spec):
    df = messages(
        {"id": 1, "numero_version": "7", "libelle": {"a": 1}},
        {"id": "one"},
        '{"id": 2, "unknown_field": 1} trailing',
    )
    found = {r.id: r for r in clean.parse_messages(df, spec).collect()}
    assert set(found) == {1, 2}
    assert found[1].numero_version is None
    assert found[1].libelle == '{"a":1}'


def test_offset_date_keeps_its_local_day(messages, spec):
    df = messages({"id": 1, "date_debut_commercialisation": "2026-01-02T00:30:00+05:00"})
    (row,) = clean.clean_messages(df, spec).collect()
    assert row.date_debut_commercialisation == dt.date(2026, 1, 2)


def test_offset_time_becomes_utc(messages, spec):
    df = messages({"id": 1, "date_publication": "2026-01-02T00:30:00+02:00"})
    out = clean.clean_messages(df, spec).select(F.col("date_publication").cast("string"))
    assert out.first()[0] == "2026-01-01 22:30:00"


def test_silver_projection_has_the_write_set(messages, spec):
    df = clean.to_silver_columns(clean.clean_messages(messages(PAYLOAD), spec), spec)
    assert len(df.columns) == 35
    assert df.columns == list(spec.silver_columns)
    assert "raw_ingested_at_utc" not in df.columns
    assert "raw_ingested_at_utc" in df.first().raw_data
    assert clean.with_dedup_key(df, spec).columns == df.columns + [spec.key]


def test_dedup_key_falls_back(messages, spec):
    df = messages(
        {"id": 1, "rappel_guid": "guid", "numero_fiche": "sheet"},
        {"id": 2, "numero_fiche": "sheet-2"},
        {"id": 3},
        {"id": 4, "rappel_guid": "", "numero_fiche": "sheet-4"},
    )
    keyed = clean.silver_rows(df, spec).orderBy("api_id").collect()
    assert [r[spec.key] for r in keyed] == ["guid", "sheet-2", "3", ""]


def test_producer_key_takes_the_first_truthy(spark, spec):
    df = spark.createDataFrame(
        [("guid", "sheet", 1, 0), ("", "sheet", 1, 1), (None, "", 5, 2), ("", None, 0, 3)],
        "rappel_guid string, numero_fiche string, id int, position int",
    )
    keyed = clean.with_producer_key(df, spec, "position").orderBy("position").collect()
    assert [r.producer_key for r in keyed] == ["guid", "sheet", "5", "missing_key_3"]


def test_messages_are_parsed_once(messages, spec):
    rows = clean.silver_rows(messages(PAYLOAD), spec)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_bronze_keeps_every_message(messages, spec):
    df = messages(PAYLOAD, "not-json{{{", None, "null")
    rows = bronze.bronze_rows(df, spec, bronze.batch_stamp("run", F.lit(4))).collect()
    assert len(rows) == 4
    by_text = {r.raw_json: r for r in rows}
    good = by_text[json.dumps(PAYLOAD)]
    assert (good[spec.key], good.api_id, good.numero_version) == ("GUID-7", 7, 3)
    assert {r._batch_id for r in rows} == {"run_4"}
    for text in ("not-json{{{", "{}", "null"):
        assert by_text[text][spec.key] is None and by_text[text].api_id is None
    assert all(r._ingested_at is not None for r in rows)


def test_bronze_accepts_binary_values(spark, spec):
    df = spark.createDataFrame([(bytearray(b'{"id": 1}'),)], "value binary")
    (row,) = bronze.bronze_rows(df, spec, F.lit("b")).collect()
    assert row.raw_json == '{"id": 1}' and row.api_id == 1
