"""A recall feed derived from the ``orders`` table.

One record per order, ten orders per notice key, six batches by order number,
and a seventh batch that repeats the first with fresh fetch stamps. Some orders
also yield a broken or an empty message. The expressions read the same in Spark
and DuckDB, so the SQL checks start from the record columns and share no
operator code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticehouse.feeds.recall_notice import FIELDS

BATCHES = 7
REPLAYED, REPLAY = 0, 6
ORDERS_PER_TASK = 50_000  # of some 2.5 KB as typed rows: what one task sorts stays small
DEALS = 64  # per task: enough that tasks get about the same
DEAL = "deal"
POSITIONS = 10_000_000_000_000  # order numbers per batch in an arrival position

_PUBLISHED = (
    "(o_orderdate + interval '20' year + interval '1' second * (o_orderkey % 86399))"
)
_GROUP = "cast(o_orderkey - o_orderkey % 10 as string)"
_DAY = "cast(cast({} as date) as string)"

RECORD = {
    "id": "cast(o_orderkey as int)",  # fails on a feed beyond the type
    "rappel_guid": f"case when o_orderkey % 11 = 0 then null else 'G' || {_GROUP} end",
    "numero_fiche": f"case when o_orderkey % 22 = 0 then null else 'S' || {_GROUP} end",
    "numero_version": "case when o_orderkey % 17 = 0 then null"
    " else cast(1 + o_custkey % 3 as int) end",
    "date_publication": "case when o_orderkey % 29 = 0 then 'not-a-date'"
    f" else replace(cast({_PUBLISHED} as string), ' ', 'T') || '+00:00' end",
    "nature_juridique_rappel": "case when o_orderkey % 13 = 0 then ''"
    " else 'Volontaire' end",
    "categorie_produit": "'  ' || o_orderpriority || ' '",
    "sous_categorie_produit": "case when o_custkey % 8 = 0 then null"
    " else ' Famille ' || cast(o_custkey % 12 as string) end",
    "marque_produit": "case when o_custkey % 9 = 0 then '   '"
    " else 'Marque ' || cast(o_custkey % 600 as string) end",
    "libelle": "case when o_custkey % 19 = 0 then null"
    " else 'Crème ' || cast(o_custkey as string) end",
    "modeles_ou_references": "case when o_orderkey % 4 = 0 then null"
    " else 'REF-' || cast(o_custkey % 5 as string) end",
    "identification_produits": "case o_orderkey % 4 when 0 then null when 1 then '[]'"
    """ when 2 then '["' || cast(o_custkey as string) || '","LOT-A"]'"""
    """ else '["' || cast(o_custkey as string) || '","LOT-A","LOT-B"]' end""",
    "conditionnements": "'Boîte de ' || cast(o_custkey % 12 as string)",
    "date_debut_commercialisation": _DAY.format(f"{_PUBLISHED} - interval '90' day"),
    "date_date_fin_commercialisation": "case when o_custkey % 6 = 0 then 'inconnue'"
    f" else {_DAY.format(f"{_PUBLISHED} - interval '3' day")} end",
    "temperature_conservation": "case when o_custkey % 3 = 0 then null"
    " else 'Produit à conserver au réfrigérateur' end",
    "marque_salubrite": "'FR ' || cast(o_custkey % 97 as string) || ' CE'",
    "informations_complementaires": "cast(null as string)",
    "zone_geographique_de_vente": "'France entière'",
    "distributeurs": "case when o_custkey % 7 = 0 then null"
    " else 'Magasin ' || cast(o_custkey % 400 as string) end",
    "motif_rappel": "case when o_orderkey % 5 = 0 then null"
    " else 'Motif ' || cast(o_custkey % 3 as string) end",
    "risques_encourus": "case when o_orderkey % 23 = 0 then null"
    " else 'Risque ' || o_orderstatus end",
    "preconisations_sanitaires": "'Ne plus consommer'",
    "description_complementaire_risque": "cast(null as string)",
    "conduites_a_tenir_par_le_consommateur": "'Rapporter au point de vente'",
    "numero_contact": "'Tél. ' || cast(o_custkey as string)",
    "modalites_de_compensation": "'Remboursement'",
    "date_de_fin_de_la_procedure_de_rappel": "case when o_custkey % 5 = 0 then null"
    f" when o_custkey % 31 = 0 then {_DAY.format(f"{_PUBLISHED} - interval '2' day")}"
    f" else {_DAY.format(f"{_PUBLISHED} + interval '30' day")} end",
    "informations_complementaires_publiques": "cast(null as string)",
    "liens_vers_les_images": "'https://example.org/Image/' || cast(o_orderkey as string)",
    "lien_vers_la_liste_des_produits": "cast(null as string)",
    "lien_vers_la_liste_des_distributeurs": "cast(null as string)",
    "lien_vers_affichette_pdf": "cast(null as string)",
    "lien_vers_la_fiche_rappel": "'https://example.org/Fiche/'"
    " || cast(o_orderkey as string)",
    "raw_ingested_at_utc": "'2024-01-0' || cast(1 + batch_no as string)"
    " || 'T00:00:00+00:00'",
}
assert tuple(RECORD) == FIELDS

_BARE = {"id", "numero_version", "identification_produits"}


def _json_member(name: str) -> str:
    text = f"cast({name} as string)" if name in _BARE else f"""'"' || {name} || '"'"""
    return f"""'"{name}": ' || coalesce({text}, 'null')"""


# Ways to write a publication date; the last of each pair is what it should mean.
_AT, _DAY_OF = "date_publication", "substr(date_publication, 1, 10)"
_BASIC_DAY, _CLOCK = f"replace({_DAY_OF}, '-', '')", "substr(date_publication, 12, 8)"
PUBLICATION_FORMS = (
    _DAY_OF,
    f"replace({_AT}, '+00:00', 'Z')",
    f"{_DAY_OF} || ' (reporté)'",
    _BASIC_DAY,
    f"{_BASIC_DAY} || 'T' || replace({_CLOCK}, ':', '') || 'Z'",
    f"{_DAY_OF} || 'T' || replace({_CLOCK}, ':', '')",
    f"{_DAY_OF} || ' ' || {_CLOCK} || '+02:00'",
    f"{_DAY_OF} || 'T' || {_CLOCK} || ' Europe/Paris'",
    f"{_DAY_OF} || 'T' || substr({_AT}, 12, 5) || '-0130'",
    f"{_DAY_OF} || 'T' || {_CLOCK} || ',5'",
)
PUBLICATION_TEXT = (
    "case id % 10 "
    + " ".join(f"when {k} then {form}" for k, form in enumerate(PUBLICATION_FORMS))
    + " end"
)

VALUE = "'{' || " + " || ', ' || ".join(map(_json_member, FIELDS)) + " || '}'"
BROKEN_VALUE = "'not-json{{{' || cast(o_orderkey as string)"

# kind of a message -> which orders yield it, in which batch
_ROWS = (
    ("notice", "true", f"o_orderkey % {BATCHES - 1}"),
    ("notice", f"o_orderkey % {BATCHES - 1} = {REPLAYED}", str(REPLAY)),
    ("broken", "o_orderkey % 97 = 0", f"o_orderkey % {BATCHES - 1}"),
    ("empty", "o_orderkey % 101 = 0", f"o_orderkey % {BATCHES - 1}"),
)


def _select(columns: dict[str, str]) -> list[str]:
    return [f"{expr} as {name}" for name, expr in columns.items()]


def _yields(batches: range) -> str:
    """Which orders yield a message in some batches."""
    numbers = ", ".join(map(str, batches))
    return " or ".join(f"({cond} and {batch} in ({numbers}))" for _, cond, batch in _ROWS)


def records(
    spark: SparkSession, sf_dir: str, batches: range | None = None, dealt: bool = False
) -> DataFrame:
    """Feed rows: batch, arrival position, kind, record columns. One scan; of some
    batches only the orders that yield them are dealt. ``dealt`` rows are partitioned
    by a column more."""
    copies = ", ".join(
        f"case when {cond} then named_struct('kind', '{kind}',"
        f" 'batch_no', cast({batch} as int)) end"
        for kind, cond, batch in _ROWS
    )
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    if batches is not None:
        orders = orders.where(_yields(batches))
    # Making messages is CPU-bound: at any size the orders are dealt over all cores.
    # Messages are wide: with more orders there are more tasks, not larger ones.
    tasks = max(spark.sparkContext.defaultParallelism, -(-orders.count() // ORDERS_PER_TASK))
    deal = F.pmod(F.xxhash64("o_orderkey"), F.lit(tasks * DEALS)).cast("int")
    orders = orders.withColumn(DEAL, deal).repartition(tasks, DEAL if dealt else "o_orderkey")
    copied = orders.selectExpr("*", f"inline(filter(array({copies}), x -> x is not null))")
    if batches is not None:
        copied = copied.where(F.col("batch_no").isin(list(batches)))
    return copied.selectExpr("batch_no", "o_orderkey", "kind", *[DEAL] * dealt, *_select(RECORD))


def messages(
    spark: SparkSession, sf_dir: str, batches: range | None = None, dealt: bool = False
) -> DataFrame:
    """The feed as message text, with its batch number and order number."""
    return records(spark, sf_dir, batches, dealt).selectExpr(
        "batch_no",
        "o_orderkey as seq",
        *[DEAL] * dealt,
        f"case kind when 'notice' then {VALUE} when 'broken' then {BROKEN_VALUE} end as value",
    )


def sql_records() -> str:
    """The same records for DuckDB."""
    rows = " union all ".join(
        f"select *, '{kind}' as kind, cast({batch} as int) as batch_no"
        f" from orders where {cond}"
        for kind, cond, batch in _ROWS
    )
    return f"select batch_no, o_orderkey, kind, {', '.join(_select(RECORD))} from ({rows})"
