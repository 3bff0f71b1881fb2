"""What a feed looks like, declared once.

Operators never name a feed's columns: they ask the spec for a role (key,
version, event time, text columns, ...), so another feed needs another spec and
no other operator code.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import types as T


@dataclass(frozen=True)
class DimSpec:
    """A type-1 dimension over current silver rows.

    ``columns`` maps silver columns to dimension columns; rows whose
    ``required`` silver column is null are left to the unknown member.
    """

    name: str
    key: str
    columns: dict[str, str]
    required: str

    @property
    def label(self) -> str:
        """Dimension column that carries the text of the unknown member."""
        return self.columns[self.required]


@dataclass(frozen=True)
class FactSpec:
    name: str
    key: str
    carried: tuple[str, ...]
    array_count: tuple[str, str]
    duration: tuple[str, str]
    dims: tuple[DimSpec, ...]
    date_dim: str = "dim_date"


@dataclass(frozen=True)
class FeedSpec:
    schema: T.StructType
    id_field: str
    key_fields: tuple[str, ...]
    version: str
    event_time: str
    ingest_time: str
    date_fields: tuple[str, ...]
    array_fields: tuple[str, ...]
    verbatim_fields: tuple[str, ...]
    renames: dict[str, str]
    staging_columns: tuple[str, ...]
    fact: FactSpec
    key: str = "deduplication_key"
    payload: str = "raw_data"
    inserted_at: str = "inserted_at"
    updated_at: str = "silver_updated_at"

    def silver_name(self, field: str) -> str:
        return self.renames.get(field, field)

    @property
    def api_id(self) -> str:
        return self.silver_name(self.id_field)

    @property
    def timestamp_fields(self) -> tuple[str, ...]:
        return (self.event_time, self.ingest_time)

    @cached_property
    def text_fields(self) -> tuple[str, ...]:
        """String fields that get normalized: all but dates and verbatim ones."""
        kept = {*self.verbatim_fields, *self.date_fields, *self.timestamp_fields}
        return tuple(
            f.name
            for f in self.schema
            if isinstance(f.dataType, T.StringType) and f.name not in kept
        )

    @cached_property
    def silver_columns(self) -> tuple[str, ...]:
        """Columns an upsert writes, beside the key and the two stamps."""
        fields = (f.name for f in self.schema if f.name != self.ingest_time)
        return (*(self.silver_name(name) for name in fields), self.payload)

    @cached_property
    def diff_columns(self) -> tuple[str, ...]:
        """Columns that count as content. The version has its own rule, and the
        payload carries the fetch stamp, so it differs on every re-fetch."""
        return tuple(
            c for c in self.silver_columns if c not in (self.version, self.payload)
        )

    def _silver_type(self, field: T.StructField) -> T.DataType:
        if field.name in self.timestamp_fields:
            return T.TimestampType()
        if field.name in self.date_fields:
            return T.DateType()
        return T.StringType() if field.name in self.array_fields else field.dataType

    @cached_property
    def silver_schema(self) -> T.StructType:
        """Silver as stored: the write set, the key and the two stamps."""
        types = {self.silver_name(f.name): self._silver_type(f) for f in self.schema}
        columns = {
            **{c: types.get(c, T.StringType()) for c in (*self.silver_columns, self.key)},
            self.inserted_at: T.TimestampType(),
            self.updated_at: T.TimestampType(),
        }
        return T.StructType([T.StructField(c, t) for c, t in columns.items()])

    @cached_property
    def ordering(self) -> FeedSpec:
        """The same feed, of whose fields only those are read that tell a row's key
        and which of two versions is newer."""
        wanted = {self.id_field, *self.key_fields, self.version, *self.timestamp_fields}
        return replace(
            self,
            schema=T.StructType([f for f in self.schema if f.name in wanted]),
            date_fields=tuple(f for f in self.date_fields if f in wanted),
            array_fields=tuple(f for f in self.array_fields if f in wanted),
        )

    @cached_property
    def bronze_schema(self) -> T.StructType:
        silver = self.silver_schema
        names = (self.key, self.api_id, *self.key_fields, self.version, self.event_time)
        return (
            T.StructType([silver[n] for n in names])
            .add("raw_json", T.StringType())
            .add("_ingested_at", T.TimestampType())
            .add("_batch_id", T.StringType())
        )
