"""French product-recall notices: the feed this warehouse ships with."""

from __future__ import annotations

from pyspark.sql import types as T

from noticehouse.spec import DimSpec, FactSpec, FeedSpec

# Field names of the public recall-notice records, in feed order.
FIELDS = (
    "id",
    "rappel_guid",
    "numero_fiche",
    "numero_version",
    "date_publication",
    "nature_juridique_rappel",
    "categorie_produit",
    "sous_categorie_produit",
    "marque_produit",
    "libelle",
    "modeles_ou_references",
    "identification_produits",
    "conditionnements",
    "date_debut_commercialisation",
    "date_date_fin_commercialisation",
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
    "numero_contact",
    "modalites_de_compensation",
    "date_de_fin_de_la_procedure_de_rappel",
    "informations_complementaires_publiques",
    "liens_vers_les_images",
    "lien_vers_la_liste_des_produits",
    "lien_vers_la_liste_des_distributeurs",
    "lien_vers_affichette_pdf",
    "lien_vers_la_fiche_rappel",
    "raw_ingested_at_utc",
)

# The fields that are not plain strings.
FIELD_TYPES = {
    "id": T.IntegerType(),
    "numero_version": T.IntegerType(),
    "identification_produits": T.ArrayType(T.StringType()),
}

# Names of the gold tables, their keys and columns.
PRODUCT = DimSpec(
    name="dim_produit",
    key="produit_key",
    columns={
        "categorie_produit": "categorie_produit",
        "sous_categorie_produit": "sous_categorie_produit",
        "libelle": "nom_produit",
        "modeles_ou_references": "modeles_ou_references",
    },
    required="libelle",
)
BRAND = DimSpec(
    name="dim_marque",
    key="marque_key",
    columns={"marque_produit": "marque_produit"},
    required="marque_produit",
)
RISK = DimSpec(
    name="dim_risque",
    key="risque_key",
    columns={"risques_encourus": "risques_encourus", "motif_rappel": "motif_rappel"},
    required="risques_encourus",
)
DISTRIBUTOR = DimSpec(
    name="dim_distributeur",
    key="distributeur_key",
    columns={"distributeurs": "distributeurs"},
    required="distributeurs",
)

RECALL_NOTICE = FeedSpec(
    schema=T.StructType(
        [T.StructField(name, FIELD_TYPES.get(name, T.StringType())) for name in FIELDS]
    ),
    id_field="id",
    key_fields=("rappel_guid", "numero_fiche"),
    version="numero_version",
    event_time="date_publication",
    ingest_time="raw_ingested_at_utc",
    date_fields=(
        "date_debut_commercialisation",
        "date_date_fin_commercialisation",
        "date_de_fin_de_la_procedure_de_rappel",
    ),
    array_fields=("identification_produits",),
    verbatim_fields=(
        "rappel_guid",
        "numero_fiche",
        "numero_contact",
        "liens_vers_les_images",
        "lien_vers_la_liste_des_produits",
        "lien_vers_la_liste_des_distributeurs",
        "lien_vers_affichette_pdf",
        "lien_vers_la_fiche_rappel",
    ),
    renames={
        "id": "api_id",
        "date_date_fin_commercialisation": "date_fin_commercialisation",
        "raw_json": "raw_data",
    },
    # Columns of the staging view over silver.
    staging_columns=(
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
    ),
    fact=FactSpec(
        name="fact_rappel",
        key="fact_rappel_key",
        carried=("deduplication_key", "numero_fiche", "rappel_guid", "numero_version"),
        array_count=("identification_produits", "nb_produits_identifies"),
        duration=("date_de_fin_de_la_procedure_de_rappel", "jours_procedure_rappel"),
        dims=(PRODUCT, BRAND, RISK, DISTRIBUTOR),
    ),
)
