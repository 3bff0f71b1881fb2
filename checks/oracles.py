"""The same results in SQL, one statement per query of :mod:`checks.queries`.

The statements start from the record columns, before any message is built, and
take other ways than the operators: the upsert is a join per batch in order, and
the snapshot a union of the sampled states.
"""

from __future__ import annotations

import re

from checks import feed

# Column roles, spelled out here so that the checks do not lean on
# the spec they check.
TEXT = [
    "nature_juridique_rappel",
    "categorie_produit",
    "sous_categorie_produit",
    "marque_produit",
    "libelle",
    "modeles_ou_references",
    "conditionnements",
    "temperature_conservation",
    "marque_salubrite",
    "informations_complementaires",
    "zone_geographique_de_vente",
    "distributeurs",
    "motif_rappel",
    "risques_encourus",
    "preconisations_sanitaires",
    "description_complementaire_risque",
    "conduites_a_tenir_par_le_consommateur",
    "modalites_de_compensation",
    "informations_complementaires_publiques",
]
VERBATIM = [
    "rappel_guid",
    "numero_fiche",
    "numero_contact",
    "liens_vers_les_images",
    "lien_vers_la_liste_des_produits",
    "lien_vers_la_liste_des_distributeurs",
    "lien_vers_affichette_pdf",
    "lien_vers_la_fiche_rappel",
]
TIMES = ["date_publication", "raw_ingested_at_utc"]
DATES = [
    "date_debut_commercialisation",
    "date_date_fin_commercialisation",
    "date_de_fin_de_la_procedure_de_rappel",
]
END_FIELD, END = "date_date_fin_commercialisation", "date_fin_commercialisation"
KEY, VERSION = "deduplication_key", "numero_version"
STAGED = [
    "deduplication_key",
    "api_id",
    "rappel_guid",
    "numero_fiche",
    "numero_version",
    "date_publication",
    "categorie_produit",
    "sous_categorie_produit",
    "marque_produit",
    "libelle",
    "modeles_ou_references",
    "identification_produits",
    "distributeurs",
    "motif_rappel",
    "risques_encourus",
    "description_complementaire_risque",
    "preconisations_sanitaires",
    "date_debut_commercialisation",
    "date_fin_commercialisation",
    "date_de_fin_de_la_procedure_de_rappel",
    "zone_geographique_de_vente",
    "silver_updated_at",
]
MOMENTS = {*TIMES, *DATES, END, "inserted_at", "silver_updated_at"}
MOMENTS |= {"dbt_valid_from", "dbt_valid_to", "dbt_updated_at", "valid_from", "valid_to"}

SILVER = [
    {"id": "api_id", END_FIELD: END}.get(f, f)
    for f in feed.FIELDS
    if f != "raw_ingested_at_utc"
] + ["raw_data"]
STATE = [*SILVER, KEY, "inserted_at", "silver_updated_at"]
DIFF = [c for c in SILVER if c not in (VERSION, "raw_data")]


def stamp(batch: object) -> str:
    return f"(timestamp '2024-01-01' + {batch} * interval '1' day)"


def shown(columns, prefix: str = "") -> str:
    return ", ".join(
        f"cast({prefix}{c} as varchar) as {c}" if c in MOMENTS else f"{prefix}{c}"
        for c in columns
    )


def _time(c: str) -> str:
    return f"try_cast(replace(replace({c}, '+00:00', ''), 'T', ' ') as timestamp)"


def _cleaned(c: str) -> str:
    if c in TEXT:
        return f"nullif(lower(trim({c})), '') as {c}"
    if c in TIMES:
        return f"{_time(c)} as {c}"
    if c in DATES:
        return f"try_cast({c} as date) as {END if c == END_FIELD else c}"
    return c


CLEANED = [END if f == END_FIELD else f for f in feed.FIELDS]

LATEST = (
    f"{VERSION} desc nulls last, date_publication desc nulls last,"
    " api_id desc nulls last, raw_data desc nulls last"
)

# Named parts; a statement lists those it reads.
CTES: dict[str, str] = {
    "feed": feed.sql_records(),
    "notice": f"select *, {feed.VALUE} as raw_json from feed where kind = 'notice'",
    "clean": f"select {', '.join(map(_cleaned, feed.FIELDS))}, raw_json, batch_no from notice",
    "keyed": "select * exclude (id, raw_json, raw_ingested_at_utc), id as api_id,"
    " raw_json as raw_data,"
    f" coalesce(rappel_guid, numero_fiche, cast(id as varchar)) as {KEY} from clean",
    "newest": f"select * from keyed qualify row_number() over"
    f" (partition by batch_no, {KEY} order by {LATEST}) = 1",
}


def _merge(state: str, incoming: str, now: str) -> str:
    changed = " or ".join(f"s.{c} is distinct from i.{c}" for c in DIFF)
    wins = (
        f"i.{KEY} is not null and (s.{KEY} is null or s.{VERSION} is null or"
        f" (i.{VERSION} is not null and (i.{VERSION} > s.{VERSION}"
        f" or (i.{VERSION} = s.{VERSION} and ({changed})))))"
    )
    columns = ", ".join(
        f"case when {wins} then i.{c} else s.{c} end as {c}" for c in (*SILVER, KEY)
    )
    return (
        f"select {columns}, coalesce(s.inserted_at, {now}) as inserted_at,"
        f" case when {wins} then {now} else s.silver_updated_at end as silver_updated_at"
        f" from {state} s full outer join {incoming} i on s.{KEY} = i.{KEY}"
    )


def _fold(prefix: str, source: str, batches: int) -> None:
    CTES[f"{prefix}0"] = (
        f"select {', '.join(SILVER)}, {KEY}, {stamp(0)} as inserted_at,"
        f" {stamp(0)} as silver_updated_at from {source} where batch_no = 0"
    )
    for b in range(1, batches):
        incoming = f"(select * from {source} where batch_no = {b})"
        CTES[f"{prefix}{b}"] = _merge(f"{prefix}{b - 1}", incoming, stamp(b))


_fold("state", "newest", feed.BATCHES)
# The streaming queries take the batches in three deliveries.
CTES["delivered"] = (
    "select * replace (case when batch_no < 3 then 0 when batch_no < 6 then 1 else 2 end"
    " as batch_no) from keyed"
)
CTES["delivered_newest"] = CTES["newest"].replace("keyed", "delivered")
_fold("delivery", "delivered_newest", 3)


def _snapshot(states: list[str]) -> str:
    seen = " union ".join(f"select * from {s}" for s in states)
    return (
        "select *, silver_updated_at as dbt_valid_from, silver_updated_at as dbt_updated_at,"
        f" md5({KEY} || '|' || cast(silver_updated_at as varchar)) as dbt_scd_id,"
        f" lead(silver_updated_at) over (partition by {KEY} order by silver_updated_at)"
        f" as dbt_valid_to from ({seen})"
    )


CTES["late"] = (
    "select * from keyed where batch_no >= 3 qualify row_number() over"
    f" (partition by {KEY} order by {LATEST}) = 1"
)
CTES["upserted"] = _merge("state2", "late", stamp(3))
CTES["silver"] = "select * from state6"
CTES["snapshot"] = _snapshot(["state2", "state4", "state6"])
CTES["delivered_snapshot"] = _snapshot(["delivery0", "delivery1", "delivery2"])

NULL = "_dbt_utils_surrogate_key_null_"


def md5_of(*columns: str) -> str:
    parts = " || '-' || ".join(f"coalesce(cast({c} as varchar), '{NULL}')" for c in columns)
    return f"md5({parts})"


DIMS = {
    "dim_produit": (
        "produit_key",
        {
            "categorie_produit": "categorie_produit",
            "sous_categorie_produit": "sous_categorie_produit",
            "libelle": "nom_produit",
            "modeles_ou_references": "modeles_ou_references",
        },
        "libelle",
    ),
    "dim_marque": ("marque_key", {"marque_produit": "marque_produit"}, "marque_produit"),
    "dim_risque": (
        "risque_key",
        {"risques_encourus": "risques_encourus", "motif_rappel": "motif_rappel"},
        "risques_encourus",
    ),
    "dim_distributeur": (
        "distributeur_key",
        {"distributeurs": "distributeurs"},
        "distributeurs",
    ),
}


def unknown(dim: str) -> str:
    return f"md5('unknown_{dim.removeprefix('dim_')}')"


def _dimension(dim: str, source: str) -> str:
    key, columns, required = DIMS[dim]
    known = ", ".join(f"{c} as {out}" for c, out in columns.items())
    blank = ", ".join(
        ("'Unknown'" if c == required else "cast(null as varchar)") + f" as {out}"
        for c, out in columns.items()
    )
    return (
        f"select distinct {md5_of(*columns)} as {key}, {known} from {source}"
        f" where {required} is not null union all select {unknown(dim)}, {blank}"
    )


for _dim in DIMS:
    CTES[_dim] = _dimension(_dim, "silver")

DAY = "cast(strftime({}, '%Y%m%d') as integer)"
CTES["dim_date"] = (
    f"select {DAY.format('date_day')} as date_key, date_day,"
    " cast(year(date_day) as integer) as year, cast(quarter(date_day) as integer) as quarter,"
    " cast(month(date_day) as integer) as month, rpad(monthname(date_day), 9, ' ') as month_name,"
    " cast(day(date_day) as integer) as day_of_month,"
    " cast(isodow(date_day) as integer) as day_of_week,"
    " rpad(dayname(date_day), 9, ' ') as day_name, isodow(date_day) in (6, 7) as is_weekend"
    " from (select cast(d as date) as date_day"
    " from range(date '2015-01-01', date '2035-01-01', interval 1 day) r(d))"
)

DIM_KEYS = [DIMS[d][0] for d in DIMS]
LOOKUP = "from {} s " + " ".join(
    f"left join {d} on "
    + " and ".join(f"{d}.{out} is not distinct from s.{c}" for c, out in DIMS[d][1].items())
    for d in DIMS
)
COUNT_ITEMS = "cast(json_array_length(coalesce(s.identification_produits, '[]')) as integer)"
LENGTH = (
    "cast(date_diff('day', cast(s.date_publication as date),"
    " s.date_de_fin_de_la_procedure_de_rappel) as integer)"
)
FALLBACKS = ", ".join(
    f"coalesce({d}.{key}, {unknown(d)}) as {key}" for d, (key, _, _) in DIMS.items()
)
FACT = (
    f"select {md5_of(f's.{KEY}', 's.dbt_valid_from')} as fact_rappel_key, s.{KEY},"
    f" s.numero_fiche, s.rappel_guid, s.{VERSION}, {DAY.format('s.date_publication')} as date_key,"
    f" {FALLBACKS}, {COUNT_ITEMS} as nb_produits_identifies,"
    f" {LENGTH} as jours_procedure_rappel, s.dbt_valid_from as valid_from,"
    " s.dbt_valid_to as valid_to, s.dbt_valid_to is null as is_current "
)
CTES["fact"] = FACT + LOOKUP.format("snapshot")
# The fact's columns.
FACT_COLUMNS = [
    "fact_rappel_key",
    "deduplication_key",
    "numero_fiche",
    "rappel_guid",
    "numero_version",
    "date_key",
    "produit_key",
    "marque_key",
    "risque_key",
    "distributeur_key",
    "nb_produits_identifies",
    "jours_procedure_rappel",
    "valid_from",
    "valid_to",
    "is_current",
]
CTES["per_day"] = (
    f"select {DAY.format('date_publication')} as date_key, count(*) as notices"
    " from silver group by 1"
)
CTES["legacy"] = (
    f"select * exclude ({KEY}), case when api_id % 4 <> 0 then {KEY} end as {KEY},"
    f" batch_no * {feed.POSITIONS} + api_id as db_id, {stamp('batch_no')} as inserted_at"
    " from keyed"
)
CTES["legacy_keyed"] = (
    f"select * replace (coalesce({KEY}, rappel_guid, numero_fiche, cast(api_id as varchar))"
    f" as {KEY}) from legacy"
)
CTES["position_of"] = f"select *, batch_no * {feed.POSITIONS} + o_orderkey as position from notice"
_STATE_OF_STEP = (
    "case when event_type = 'error' and value < 1 then 'failed'"
    " when event_type = 'view' and value < 1 then 'skipped' else 'success' end"
)
CTES["steps"] = (
    "select 'run-' || cast(user_id as varchar) as dag_run_id, event_id as task_id, ts,"
    f" {_STATE_OF_STEP} as state from events"
)
_STATUS = (
    "case when count(*) filter (state in ('failed', 'upstream_failed')) > 0 then 'failed'"
    " when count(*) filter (state <> 'success') = 0 then 'success' else 'partial' end"
)
CTES["audit"] = (
    "select dag_run_id, started_at, ended_at,"
    " round(epoch(ended_at) - epoch(started_at), 6) as duration_seconds, status,"
    " bronze_row_count, bronze_row_count - 1 as silver_row_count,"
    " case when status = 'success' then bronze_row_count end as gold_row_count"
    f" from (select dag_run_id, min(ts) as started_at, max(ts) as ended_at,"
    f" count(*) as bronze_row_count, {_STATUS} as status from steps group by 1)"
)


def statement(final: str) -> str:
    """A final select with the parts it reads in front, each after its own."""
    needed: list[str] = []

    def need(sql: str) -> None:
        for name in re.findall(r"\b(?:from|join) (\w+)", sql):
            if name in CTES and name not in needed:
                need(CTES[name])
                needed.append(name)

    need(final)
    parts = ", ".join(f"{n} as materialized ({CTES[n]})" for n in needed)
    return f"with {parts} {final}" if parts else final


def _compact(stamp_text: str) -> str:
    """Message text as the envelope spells it: no spaces, fresh stamp."""
    bare = {"id", VERSION, "identification_produits"}
    members = []
    for name in feed.FIELDS[:-1]:
        text = f"cast({name} as varchar)" if name in bare else f"""'"' || {name} || '"'"""
        members.append(f"""'"{name}":' || coalesce({text}, 'null')""")
    members.append(f"""'"raw_ingested_at_utc":"{stamp_text}"'""")
    return "'{' || " + " || ',' || ".join(members) + " || '}'"


BRONZE_SOURCE = (
    f"select batch_no, kind, case kind when 'notice' then {feed.VALUE}"
    f" when 'broken' then {feed.BROKEN_VALUE} else '{{}}' end as raw_json,"
    + ", ".join(
        f"case when kind = 'notice' then {c} end as {c}"
        for c in ("id", "rappel_guid", "numero_fiche", VERSION, "date_publication")
    )
    + " from feed"
)
CTES["bronze"] = (
    f"select coalesce(rappel_guid, numero_fiche, cast(id as varchar)) as {KEY}, id as api_id,"
    f" rappel_guid, numero_fiche, {VERSION}, {_time('date_publication')} as date_publication,"
    f" raw_json, 'run_' || cast(batch_no as varchar) as _batch_id, batch_no from ({BRONZE_SOURCE})"
)

_PUBLISHED = _time("date_publication")
_PUBLICATION_VALUE = (
    f"case when {_PUBLISHED} is null then null when id % 10 in (0, 2, 3, 7) then"
    f" date_trunc('day', {_PUBLISHED}) when id % 10 = 6 then {_PUBLISHED} - interval 2 hour"
    f" when id % 10 = 8 then date_trunc('minute', {_PUBLISHED}) + interval 90 minute"
    f" when id % 10 = 9 then {_PUBLISHED} + interval 500 millisecond else {_PUBLISHED} end"
)
_OUTCOME = (
    f"case when s.{KEY} is null then 'inserted' when s.{VERSION} is null"
    " then 'updated_unversioned'"
    f" when i.{VERSION} is null or i.{VERSION} < s.{VERSION} then 'ignored_stale'"
    f" when i.{VERSION} > s.{VERSION} then 'updated_newer'"
    f" when {' or '.join(f's.{c} is distinct from i.{c}' for c in DIFF)}"
    " then 'updated_content' else 'ignored_same' end"
)


def _nulls(table: str, column: str, source: str | None = None) -> str:
    return (
        f"select '{table}' as table_name, '{column}' as column_name, count(*) as failures"
        f" from {source or table} where {column} is null"
    )


def _doubles(table: str, column: str, source: str | None = None) -> str:
    return (
        f"select '{table}' as table_name, '{column}' as column_name, count(*) as failures from"
        f" (select {column} from {source or table} where {column} is not null"
        f" group by 1 having count(*) > 1)"
    )


def _orphans(child: str, column: str, parent: str, source: str, target: str, to: str) -> str:
    return (
        f"select '{child}' as table_name, '{column}' as column_name, '{parent}' as parent_table,"
        f" count(*) as failures from {source} c where {column} is not null"
        f" and not exists (select 1 from {target} p where p.{to} = c.{column})"
    )


TABLE_KEYS = {**{d: DIMS[d][0] for d in DIMS}, "dim_date": "date_key"}

ORACLES: dict[str, str] = {
    "bronze_append": f"select {shown([KEY, 'api_id', 'rappel_guid', 'numero_fiche', VERSION, 'date_publication', 'raw_json', '_batch_id'])} from bronze",
    "bronze_batch_stamp": "select _batch_id, count(*) as messages,"
    f" cast(min({stamp('batch_no')}) as varchar) as first_ingested,"
    f" cast(max({stamp('batch_no')}) as varchar) as last_ingested from bronze group by 1",
    "produce_envelope": f"select position, {_compact('2024-01-02T00:00:00.000000+00:00')} as value"
    " from position_of",
    "parse_messages": "select "
    + ", ".join(
        "array_to_string(from_json(identification_produits, '[\"VARCHAR\"]'), '|')"
        " as identification_produits"
        if f == "identification_produits"
        else f
        for f in feed.FIELDS
    )
    + ", raw_json, batch_no from notice",
    "payload_drift": "select batch_no, field, kind, count(*) as messages, case when field = 'motif_rappel'"
    " then 'unknown' when field = 'libelle' and kind = 'string' then 'changed' else 'known' end as status from"
    " (select batch_no, field, case json_type(raw_json, '$.' || field) when 'NULL' then 'null'"
    " when 'VARCHAR' then 'string' when 'ARRAY' then 'array' else 'number' end as kind from"
    " (select batch_no, raw_json, unnest(json_keys(raw_json)) as field from notice)) group by 1, 2, 3",
    "normalize_text": f"select id, batch_no, {', '.join([*TEXT, *VERBATIM])} from clean",
    "cast_dates": f"select id, batch_no, {shown([*TIMES, DATES[0], END, DATES[2]])} from clean",
    "array_to_json": "select id, batch_no, identification_produits from notice",
    "clean_messages": f"select {shown(CLEANED)}, raw_json, batch_no from clean",
    "silver_projection": f"select {shown(SILVER)}, batch_no from keyed",
    "dedup_key": f"select {KEY}, api_id, rappel_guid, numero_fiche, batch_no from keyed",
    "producer_key": "select position, coalesce(nullif(guid, ''), nullif(numero_fiche, ''),"
    " cast(nullif(id, 0) as varchar), 'missing_key_' || cast(position as varchar))"
    " as producer_key from (select *, case when o_orderkey % 12 = 0 then ''"
    " else rappel_guid end as guid from position_of)",
    "parse_publication": f"select id, batch_no, {feed.PUBLICATION_TEXT} as text,"
    f" cast({_PUBLICATION_VALUE} as varchar) as published from notice",
    "latest_versions": f"select {shown(SILVER)}, {KEY}, batch_no from keyed"
    f" qualify row_number() over (partition by {KEY} order by {LATEST}) = 1",
    "dedup_keep_last": "select k as producer_key, max(position) as position,"
    " min(position) as first_position, arg_max(id, position) as id,"
    f" arg_max({VERSION}, position) filter (position = last) as {VERSION},"
    " arg_max(libelle, position) filter (position = last) as libelle from"
    " (select *, max(position) over (partition by k) as last from"
    " (select *, coalesce(rappel_guid, numero_fiche, cast(nullif(id, 0) as varchar),"
    " 'missing_key_' || cast(position as varchar)) as k from position_of)) group by 1",
    "silver_upsert": f"select {shown(STATE)} from upserted",
    "content_changed": f"select s.{KEY}, ({' or '.join(f's.{c} is distinct from i.{c}' for c in DIFF)})"
    f" as changed from state2 s join late i on s.{KEY} = i.{KEY}",
    "upsert_outcomes": f"select i.{KEY}, {_OUTCOME} as outcome from late i"
    f" left join state2 s on s.{KEY} = i.{KEY}",
    "rebuild_silver": f"select {shown(STATE)} from state6",
    "backfill_key": f"select db_id, {KEY} from legacy_keyed",
    "distinct_on_cleanup": f"select db_id, {KEY}, {VERSION} from legacy where {KEY} is null"
    f" union all (select distinct on ({KEY}) db_id, {KEY}, {VERSION} from legacy"
    f" where {KEY} is not null order by {KEY}, {VERSION} desc nulls last, db_id desc)",
    "backfill_bronze": f"select {KEY}, api_id, rappel_guid, numero_fiche, {VERSION},"
    " cast(date_publication as varchar) as date_publication,"
    " case when db_id % 7 <> 0 then raw_data else '{}' end as raw_json,"
    " cast(inserted_at as varchar) as _ingested_at, 'backfill_dev' as _batch_id from legacy",
    "backfill_silver": f"select {shown(STATE)} from state2 union all select"
    f" {shown([*SILVER, KEY, 'inserted_at'])}, cast(inserted_at as varchar) from"
    f" (select distinct on ({KEY}) * from legacy_keyed"
    f" order by {KEY}, {VERSION} desc nulls last, inserted_at desc, raw_data desc) l"
    f" where {KEY} not in (select {KEY} from state2)",
    "scd2_snapshot": f"select {shown([*STATE, 'dbt_scd_id', 'dbt_updated_at', 'dbt_valid_from', 'dbt_valid_to'])}"
    " from snapshot",
    "maintained_counts": " union all ".join(
        f"select '{d}' as dimension, coalesce({DIMS[d][2]}, 'Unknown') as label, count(*) as n"
        " from state6 group by 2"
        for d in DIMS
    ),
    "insertion_ids": f"select row_number() over (order by inserted_at, {KEY}) as id, {KEY} from silver",
    "scd2_intervals": f"select {KEY}, {VERSION}, cast(dbt_valid_from as varchar) as valid_from,"
    " cast(dbt_valid_to as varchar) as valid_to, dbt_valid_to is null as is_current from snapshot",
    "replay_messages": "select raw_data as value from silver where raw_data is not null",
    "staging_view": f"select {shown(STAGED)} from silver",
    "surrogate_key": f"select {KEY}, {md5_of(*DIMS['dim_produit'][1])} as surrogate_key from silver",
    "unknown_member": " union all ".join(
        f"select '{d}' as dimension, {unknown(d)} as member_key, 'Unknown' as label,"
        f" count(*) as notices from silver where {DIMS[d][2]} is null"
        for d in DIMS
    ),
    "dim_product": "select * from dim_produit",
    "dim_brand": "select * from dim_marque",
    "dim_risk": "select * from dim_risque",
    "dim_distributor": "select * from dim_distributeur",
    "date_spine": "select cast(date_day as varchar) as date_day, coalesce(notices, 0) as notices"
    " from dim_date left join per_day using (date_key)",
    "dim_date": "select d.* replace (cast(date_day as varchar) as date_day),"
    " coalesce(notices, 0) as notices from dim_date d left join per_day p"
    " on d.date_key = p.date_key",
    "null_safe_join": f"select s.{KEY}, cast(s.dbt_valid_from as varchar) as dbt_valid_from,"
    f" {', '.join(DIM_KEYS)} " + LOOKUP.format("snapshot"),
    "fk_unknown_fallback": f"select s.{KEY}, cast(s.dbt_valid_from as varchar) as dbt_valid_from,"
    f" {FALLBACKS} " + LOOKUP.format("snapshot"),
    "array_length": f"select {KEY}, cast(dbt_valid_from as varchar) as dbt_valid_from,"
    f" {COUNT_ITEMS} as nb_produits_identifies from snapshot s",
    "duration_days": f"select {KEY}, cast(dbt_valid_from as varchar) as dbt_valid_from,"
    f" {LENGTH} as jours_procedure_rappel from snapshot s",
    "date_key": f"select api_id, batch_no, {DAY.format('date_publication')} as date_key from keyed",
    "fact_recall": f"select {shown(FACT_COLUMNS)} from fact",
    "report_by_category": "select coalesce(p.categorie_produit, 'Unknown') as categorie,"
    " count(*) as nb_rappels from fact f join dim_produit p on p.produit_key = f.produit_key"
    " where f.is_current group by 1 order by 2 desc, 1 limit 15",
    "report_monthly": "select d.year, d.month, count(*) as nb_rappels from fact f"
    " join dim_date d on d.date_key = f.date_key where f.is_current group by 1, 2 order by 1, 2",
    "report_top_distributors": "select d.distributeurs, count(*) as nb_rappels from fact f"
    " join dim_distributeur d on d.distributeur_key = f.distributeur_key"
    " where f.is_current and d.distributeurs <> 'Unknown' group by 1 order by 2 desc, 1 limit 10",
    "report_total": "select count(*) as total_rappels from fact where is_current",
    "layer_counts": "select 'bronze' as layer, count(*) as row_count from feed union all"
    " select 'silver', count(*) from silver union all select 'gold', count(*) from fact",
    "recent_notices": f"select numero_fiche, {VERSION}, cast(date_publication as varchar)"
    " as date_publication, categorie_produit, marque_produit, libelle from silver"
    f" order by silver.date_publication desc nulls first, {KEY} limit 20",
    "history_browse": f"select f.numero_fiche, f.{VERSION}, d.nom_produit, m.marque_produit,"
    " cast(f.valid_from as varchar) as valid_from, cast(f.valid_to as varchar) as valid_to,"
    " f.is_current from fact f left join dim_produit d on d.produit_key = f.produit_key"
    " left join dim_marque m on m.marque_key = f.marque_key"
    f" order by f.valid_from desc, f.{KEY} limit 20",
    "next_cursor": "select strftime(cast(max(t) as date) - interval 1 day, '%Y-%m-%d')"
    f" as next_cursor from (select {_time('date_publication')} as t from notice)",
    "incremental_filter": "select event_id, cast(ts as varchar) as ts, user_id, event_type, value,"
    " props from events where ts > timestamp '2024-01-03' order by ts",
    "cursor_advance": "with recursive source as (select list(ts order by ts) as all_ts from events),"
    " pages(cursor, pulled, next) as (select '1900-01-01', 0::bigint, '1900-01-01'"
    " union all select next, len(page), strftime(cast(page[-1] as date) - interval 1 day,"
    " '%Y-%m-%d') from (select next, list_filter(all_ts, lambda t: t > cast(next as timestamp))[:5000]"
    " as page from pages, source where (pulled = 0 and cursor = next)"
    " or (pulled = 5000 and next > cursor)))"
    " select cursor, pulled, case when pulled < 5000 then 'exhausted' when next <= cursor"
    " then 'stuck' else 'advanced' end as status, case when pulled < 5000 then cursor else next end"
    " as next_cursor from pages where pulled > 0",
    "test_not_null": " union all ".join(
        [
            *(_nulls(t, c) for t, c in TABLE_KEYS.items()),
            *(
                _nulls("fact_rappel", c, "fact")
                for c in ("fact_rappel_key", "date_key", *DIM_KEYS)
            ),
        ]
    ),
    "test_unique": " union all ".join(
        [
            *(_doubles(t, c) for t, c in TABLE_KEYS.items()),
            _doubles("fact_rappel", "fact_rappel_key", "fact"),
            _doubles("lineitem", "l_orderkey"),
        ]
    ),
    "test_relationships": " union all ".join(
        [
            *(_orphans("fact_rappel", c, t, "fact", t, c) for t, c in TABLE_KEYS.items()),
            _orphans(
                "lineitem",
                "l_orderkey",
                "closed_orders",
                "lineitem",
                "(select * from orders where o_orderstatus <> 'P')",
                "o_orderkey",
            ),
        ]
    ),
    "test_silver_key": _doubles("silver", KEY),
    "audit_counts": "select moment, layer, case layer when 'bronze' then bronze when 'silver'"
    " then silver when 'gold' then case moment when 'after' then gold end end as row_count"
    " from dated_counts cross join (select unnest(['before', 'after']) as moment)"
    " cross join (select unnest(['bronze', 'silver', 'gold']) as layer)",
    "run_status": f"select dag_run_id, case when count(*) filter"
    " (task_id % 10 <> 0 and state in ('failed', 'upstream_failed')) > 0 then 'failed'"
    " when count(*) filter (task_id % 10 <> 0 and state <> 'success') = 0 then 'success'"
    " else 'partial' end as status from steps group by 1",
    "audit_log": "select * replace (cast(started_at as varchar) as started_at,"
    " cast(ended_at as varchar) as ended_at), '{\"bronze\":' || cast(bronze_row_count as varchar)"
    " || ',\"silver\":' || cast(silver_row_count as varchar) || ',\"gold\":'"
    " || coalesce(cast(gold_row_count as varchar), 'null') || '}' as details from audit",
}
ORACLES["recent_runs"] = (
    ORACLES["audit_log"].replace(" from audit", " from (select * from audit"
    " order by started_at desc, dag_run_id limit 5)")
)


CTES["dated"] = "select * replace (0 as batch_no) from keyed where date_publication is not null"
CTES["dated_counts"] = (
    f"select count(*) as bronze, count(distinct {KEY}) as silver,"
    f" count(distinct {KEY}) as gold from dated"
)
CTES["delivered_counts"] = " union all ".join(
    f"select {n} as delivery, (select count(*) from feed where batch_no < {upto}) as bronze,"
    f" (select count(*) from delivery{n}) as silver, (select count(*) from (select distinct {KEY},"
    f" silver_updated_at from ({' union all '.join(f'select * from delivery{k}' for k in range(n + 1))}))) as gold"
    for n, upto in enumerate((3, 6, 7))
)
_DELIVERED_FACT = FACT + LOOKUP.format("delivered_snapshot")
for _dim in DIMS:
    CTES[f"delivered_{_dim}"] = _dimension(_dim, "delivery2")
    _DELIVERED_FACT = _DELIVERED_FACT.replace(
        f"left join {_dim} on", f"left join delivered_{_dim} {_dim} on"
    )
CTES["delivered_fact"] = _DELIVERED_FACT
ORACLES |= {
    "stream_source": "select case when kind = 'empty' then '' else raw_json end as value"
    f" from ({BRONZE_SOURCE})",
    "stream_available_now": "select 'stream0_' || case when batch_no < 3 then '0'"
    " when batch_no < 6 then '1' else '2' end as _batch_id, count(*) as messages"
    " from feed group by 1",
    "stream_keyed_state": f"select {shown(STATE)} from delivery2",
    "stream_to_silver": f"select {shown(STATE)} from delivery2",
    "warehouse_fact": f"select {shown(FACT_COLUMNS)} from delivered_fact",
    "warehouse_run": "select run_id, step, case when tidy or step <> 'tests' then 'success'"
    " else 'failed' end as state, case when not tidy and step = 'tests'"
    " then 'not_null fact_rappel.date_key' end as failure,"
    " case when tidy then 'success' else 'failed' end as status, bronze as bronze_row_count,"
    " silver as silver_row_count, gold as gold_row_count from"
    " (select 'dated-0' as run_id, true as tidy, * from dated_counts union all"
    " select 'all-' || cast(delivery as varchar), false, bronze, silver, gold from delivered_counts)"
    " cross join (select unnest(['ingest', 'snapshot', 'gold', 'tests']) as step)",
}


def oracle_sql() -> dict[str, str]:
    return {name: statement(sql) for name, sql in ORACLES.items()}
