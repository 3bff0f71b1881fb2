"""Bronze: every message, as it came."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticehouse.functions.dates import as_timestamp
from noticehouse.functions.keys import first_present
from noticehouse.functions.payload import EMPTY_OBJECT, message_text, parse_payload
from noticehouse.functions.text import normalize
from noticehouse.operators.clean import RAW
from noticehouse.operators.dedup import latest_versions
from noticehouse.spec import FeedSpec

# Names of the bronze stamps.
BATCH = "_batch_id"
INGESTED = "_ingested_at"


def batch_stamp(run: str, batch: Column) -> Column:
    return F.concat_ws("_", F.lit(run), batch.cast("string"))


def bronze_rows(
    messages: DataFrame,
    spec: FeedSpec,
    batch_id: Column,
    ingested_at: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per message, broken and empty ones included.

    The extracted fields are best effort: text that does not parse gives nulls.
    """
    wanted = {spec.id_field, *spec.key_fields, spec.version, spec.event_time}
    fields = [f for f in spec.schema if f.name in wanted]
    text = F.coalesce(message_text(F.col("value")), F.lit(EMPTY_OBJECT))
    data = parse_payload(F.col(RAW), type(spec.schema)(fields))
    return (
        messages.select(text.alias(RAW), batch_id.alias(BATCH), *keep)
        .select("*", F.inline_outer(F.array(data)))
        .select(
            first_present(*map(F.col, (*spec.key_fields, spec.id_field))).alias(spec.key),
            F.col(spec.id_field).alias(spec.api_id),
            *spec.key_fields,
            spec.version,
            as_timestamp(F.col(spec.event_time)).alias(spec.event_time),
            RAW,
            (F.current_timestamp() if ingested_at is None else ingested_at).alias(INGESTED),
            BATCH,
            *keep,
        )
    )


def newest_messages(bronze: DataFrame, spec: FeedSpec) -> DataFrame:
    """The newest message of each key, as text: the one :func:`dedup.latest_versions`
    takes of the typed rows.

    Key and order are read from the columns that bronze has parsed, cleaned as silver
    cleans them, and go with the text; so only the messages that win are parsed in full.
    """
    fields = (spec.id_field, *spec.key_fields, spec.version)
    texts = [spec.silver_name(f) for f in fields if f in spec.text_fields]
    usable = bronze.where(F.col(spec.api_id).isNotNull())
    cleaned = usable.withColumns({c: normalize(F.col(c)) for c in texts})
    keyed = cleaned.select(
        first_present(*map(F.col, (*spec.key_fields, spec.api_id))).alias(spec.key),
        spec.version,
        spec.event_time,
        spec.api_id,
        F.col(RAW).alias(spec.payload),
    )
    known = keyed.where(F.col(spec.key).isNotNull())
    return latest_versions(known, spec).select(F.col(spec.payload).alias("value"))
