"""Scans of days whose files do not all have the declared column types.

A Parquet scan under a fixed schema stops at the first file that stores a
column as another type. ``scan_drifted`` reads the footers of the wanted days'
files in a Spark job first and sorts the files by what they hold:

* files of the declared types (columns may be absent) are one ordinary scan,
  with the same pushed filters as without this module;
* files with other types that convert are read as they are stored, one scan
  per set of types, and cast: whole, decimal and single-precision numbers to
  double (the nearest one), whole numbers to text, time stamps with and without
  a zone into each other in the session's zone;
* the rest are listed in a quarantine table with the reason and not read: files
  without a readable footer, and columns whose type does not convert without
  guessing (text for a number, a date for a time stamp, nanoseconds).

The driver holds one row per file of the wanted days, as Spark's own file index
does. Footers are opened by ``pyarrow``, for the schemes it has.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlens.sources.days import DayDirs, Folders, day_folders

FOOTER_SCHEMA = "base string, path string, stored string, reason string"
QUARANTINE_SCHEMA = "path string, reason string"
FILES_PER_TASK = 64

# Stored types each declared type can be cast from.
CONVERTS = {
    "double": ("int", "bigint", "float", "decimal"),
    "string": ("int", "bigint"),
    "timestamp": ("timestamp_ntz",),
    "timestamp_ntz": ("timestamp",),
}


def stored_type(field: pa.Field, physical: str, logical: str) -> str | None:
    """Spark type (DDL) a Parquet column is read as; None for those it has
    none for here."""
    t = field.type
    if physical == "INT96":
        return "timestamp"
    if pa.types.is_timestamp(t):
        if "nanoseconds" in logical:
            return None
        return "timestamp" if "isAdjustedToUTC=true" in logical else "timestamp_ntz"
    if pa.types.is_dictionary(t):
        t = t.value_type
    if pa.types.is_uint64(t):
        return "decimal(20,0)"
    if pa.types.is_uint32(t) or pa.types.is_int64(t):
        return "bigint"
    if pa.types.is_integer(t):
        return "int"
    if pa.types.is_float32(t):
        return "float"
    if pa.types.is_float64(t):
        return "double"
    if pa.types.is_decimal128(t):
        return f"decimal({t.precision},{t.scale})"
    if any(is_text(t) for is_text in (pa.types.is_string, pa.types.is_large_string,
                                      pa.types.is_binary, pa.types.is_large_binary)):
        return "string"
    return None


def stored_columns(path: str, declared: dict[str, str]) -> tuple[str | None, str | None]:
    """(DDL of the declared columns as a file stores them, None) or
    (None, why the file cannot be read). Columns of NULL type count as absent;
    columns that are not declared are not looked at."""
    try:
        system, at = ((pafs.LocalFileSystem(), path.removeprefix("file:")) if path.startswith("file:/")
                      else pafs.FileSystem.from_uri(path))
        with system.open_input_file(at) as f, pq.ParquetFile(f) as parquet:
            arrow = parquet.schema_arrow
            leaves = [parquet.schema.column(i) for i in range(len(parquet.schema))]
    except (pa.ArrowException, OSError) as exc:
        return None, f"unreadable footer: {str(exc).splitlines()[0][:200]}"
    fields = {f.name.lower(): f for f in arrow}
    kinds = {c.path.lower(): (c.physical_type, str(c.logical_type)) for c in leaves}
    stored = []
    for name, want in declared.items():
        field = fields.get(name.lower())
        if field is None or pa.types.is_null(field.type):
            continue
        have = stored_type(field, *kinds.get(name.lower(), ("", "")))
        if have != want and (have is None or have.split("(")[0] not in CONVERTS.get(want, ())):
            return None, f"{name}: {field.type} for {want}"
        stored.append(f"`{name}` {have}")
    return ", ".join(stored), None


def footers(spark: SparkSession, files: list[tuple[str, str]], declared: dict[str, str]) -> DataFrame:
    """One row per (base path, file): its declared columns as stored, or the
    reason why it is not read."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [stored_columns(path, declared) for path in pdf["path"]]
            yield pdf.assign(stored=[s for s, _ in found], reason=[r for _, r in found])

    listed = spark.createDataFrame(files, "base string, path string")
    return listed.repartition(max(1, -(-len(files) // FILES_PER_TASK)), "path").mapInPandas(read, FOOTER_SCHEMA)


def _group(spark: SparkSession, base: str, paths: list[str], stored: str, declared: T.StructType,
           parts: list[T.StructField]) -> DataFrame:
    as_stored = T.StructType((T.StructType.fromDDL(stored).fields if stored else []) + parts)
    rows = spark.read.schema(as_stored).option("basePath", base).parquet(*paths)
    return rows.select(*[(F.col(f.name) if f.name in as_stored.names else F.lit(None)).cast(f.dataType).alias(f.name)
                         for f in declared.fields])


def scan_drifted(spark: SparkSession, root: str, schema: T.StructType, first_day, last_day, dirs: DayDirs,
                 n_parts: int = 3) -> tuple[DataFrame, DataFrame]:
    """Rows of the days in [first_day, last_day] under ``schema``, whose last
    ``n_parts`` fields are directory columns, and the quarantine table
    (``path, reason``). Days without files give no rows; so does a file
    without any declared column, but for its directory columns."""
    folders = Folders(spark, root)
    files = [(base, path) for base, days in day_folders(spark, root, first_day, last_day, dirs)
             for day in days for path in folders.files(day)]
    if not files:
        return spark.createDataFrame([], schema), spark.createDataFrame([], QUARANTINE_SCHEMA)
    data, parts = schema.fields[:-n_parts], schema.fields[-n_parts:]
    declared = {f.name: f.dataType.simpleString() for f in data}
    plain: dict[str, list[str]] = {}
    drifted: dict[tuple[str, str], list[str]] = {}
    misfits = []
    for base, path, stored, reason in sorted(footers(spark, files, declared).collect()):  # one row per file
        if reason:
            misfits.append((path, reason))
        elif set(stored.split(", ")) <= {f"`{n}` {t}" for n, t in declared.items()}:
            plain.setdefault(base, []).append(path)
        else:
            drifted.setdefault((base, stored), []).append(path)
    found = [spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)
             for base, paths in plain.items()]
    found += [_group(spark, base, paths, stored, schema, parts) for (base, stored), paths in drifted.items()]
    rows = found[0] if found else spark.createDataFrame([], schema)
    for more in found[1:]:
        rows = rows.unionByName(more)
    return rows, spark.createDataFrame(misfits, QUARANTINE_SCHEMA)
