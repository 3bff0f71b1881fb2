"""What the operators share: staged tables, whole texts as bytes, label splits."""

from __future__ import annotations

import importlib
import io
import zipfile
from collections.abc import Callable, Hashable
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticehouse.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def write_file(folder: str, name: str, data: bytes) -> None:
    """Through Arrow's file systems, so the folder may be a local path or a URI."""
    from pyarrow import fs

    uri = folder if "://" in folder else f"file://{folder.removeprefix('file:')}"
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path, recursive=True)
    with system.open_output_stream(f"{path}/{name}") as out:
        out.write(data)


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package where it is not installed."""
    _ship(spark, spark.sparkContext.applicationId)


@cache
def _ship(spark: SparkSession, application: str) -> None:
    root = Path(__file__).resolve().parent.parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    folder = scratch_path(spark, "package")
    write_file(folder, f"{root.name}.zip", packed.getvalue())
    spark.sparkContext.addPyFile(f"{folder}/{root.name}.zip")


#: Rows of a narrow table that one task writes.
TASK_ROWS = 1 << 16


_KEPT: dict[Hashable, object] = {}


def kept(key: Hashable, build: Callable[[], object]) -> object:
    """A worker process's large object, built once and used by its later tasks.

    Only the last is kept, so that a worker that goes on to another stage does not
    hold the models of all before.
    """
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = build()
    return _KEPT[key]


def stage(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back.

    What follows re-reads it after a lost executor, and Python work before it
    runs once. For a narrow table whose ``rows`` are known or bounded, tasks are
    joined so that a small one does not become many tiny files.
    """
    path = scratch_path(df.sparkSession, name)
    if rows is not None:
        df = df.coalesce(1 + rows // TASK_ROWS)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(name: str = "text") -> Column:
    """A text column as UTF-8; null is empty."""
    return F.coalesce(F.col(name), F.lit("")).cast("binary")


def split_of(id_col: str, parts: int) -> Column:
    """The part of a document: crc32 of its id as text, modulo ``parts``.

    A null id is in part 0.
    """
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % parts


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """The place of a public tokenizer's vocabulary on this machine."""
    return importlib.import_module("public_tokenizers").path(name)
