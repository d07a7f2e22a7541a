"""Readers and writers of labelled tables, name lists and templates."""

from __future__ import annotations

import json
import warnings
from collections.abc import Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediameta.functions.render import template_parts
from mediameta.schema import RAW_COLUMNS, normalize_header, require_columns
from mediameta.sources.pieces import csv_records
from mediameta.sources.rowid import with_row_id

_ODD_ROW, _NUMBER = "__odd_row", "__number"
# A quoted field, or a part of one between doubled quotes.
_QUOTED = r'"[^"]*+"'


def read_labelled_csv(
    spark: SparkSession,
    path: str,
    *,
    key: str | None = None,
    multi_line: bool = True,
    split: bool = True,
    long_rows: str = "raise",
) -> DataFrame:
    """The seven required columns as text plus ``row_id``; lazy but for the header line.

    Commas, doubled quotes and newlines inside quotes are kept. Short rows are
    padded with nulls. Rows with more fields than the header, empty ones
    included, fail the job, or with ``long_rows="mark"`` keep their place and get
    ``overflow`` set. All files under ``path`` must have the same header: one with
    other columns, or in another order, fails the job. ``multi_line`` files are read
    in pieces by many tasks, whose lines ``csv_records`` joins to records; without
    ``split`` one task reads each file. Turn ``multi_line`` off when no value holds a
    newline: it is the quickest way.
    """
    if long_rows not in ("raise", "mark"):
        raise ValueError(f"unknown treatment of long rows: {long_rows}")
    options = {"header": True, "multiLine": multi_line, "quote": '"', "escape": '"', "encoding": "UTF-8"}
    found = spark.read.options(**options).csv(path).columns
    header = normalize_header(found)
    wanted = [key.strip().lower()] if key else []
    extra = [c for c in require_columns(header) if c not in wanted]
    if extra:
        warnings.warn(f"ignoring extra columns: {extra}", stacklevel=2)

    # Rows whose number of fields differs from the header's come with their text. Files are held to the header's names.
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*found, _ODD_ROW]])
    needed = [found[header.index(c)] for c in [*wanted, *RAW_COLUMNS]]
    if multi_line and split:
        rows = _parsed_records(spark, path, found, schema, options).select(_NUMBER, *[F.col(f"`{c}`") for c in needed], _ODD_ROW)
        numbered = with_row_id(rows.drop(_NUMBER), needed[0]) if key else rows
    else:
        checks = {"columnPruning": False, "enforceSchema": False, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _ODD_ROW}
        rows = spark.read.options(**options, **checks).schema(schema).csv(path)
        numbered = with_row_id(rows.select(*[F.col(f"`{c}`") for c in needed], _ODD_ROW), *needed[: len(wanted)])
    named = numbered.toDF("row_id", *RAW_COLUMNS, _ODD_ROW)
    fields = F.regexp_count(F.regexp_replace(_ODD_ROW, _QUOTED, ""), F.lit(",")) + 1
    # The text of odd rows cannot be read without any other column, so false is spelled with one.
    overflow = F.coalesce(fields > len(found), F.col(RAW_COLUMNS[0]).isNull() & F.col(RAW_COLUMNS[0]).isNotNull())
    if long_rows == "mark":
        return named.select("row_id", *RAW_COLUMNS, overflow.alias("overflow"))
    message = F.concat(F.lit("row with more fields than the header: "), F.col("row_id").cast("string"))
    checked = named.filter(F.when(~overflow, True).otherwise(F.raise_error(message).cast("boolean")))
    return checked.select("row_id", *RAW_COLUMNS)


def _parsed_records(spark: SparkSession, path: str, found: list[str], schema: T.StructType, options: dict) -> DataFrame:
    """Every record but the headers, parsed by the options of the reader, with its number."""
    rules = {k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items() if k != "header"}
    rules |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _ODD_ROW}
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema.fields)
    parsed = csv_records(spark, path).withColumn("__row", F.from_csv("text", ddl, rules))
    field = lambda c: F.col("__row").getField(c)
    # A header without names in some places gets made-up ones.
    same = [F.coalesce(field(c), F.lit("")).isin(c, "") if c == f"_c{i}" else field(c).eqNullSafe(c) for i, c in enumerate(found)]
    fits = reduce(Column.__and__, same) & field(_ODD_ROW).isNull()
    message = F.concat(F.lit("header does not match that of the first file: "), "text")
    checked = parsed.filter(F.when(~F.col("header"), True).when(fits, False).otherwise(F.raise_error(message).cast("boolean")))
    return checked.select(F.col("record").alias(_NUMBER), "__row.*")


def write_labelled_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """CSV with header, doubled quotes and untrimmed values; nulls as empty fields."""
    df.write.mode(mode).options(
        header=True,
        quote='"',
        escape='"',
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        encoding="UTF-8",
    ).csv(path)


def write_training_text(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "error") -> None:
    """Only the ``text`` column, as Parquet or JSON lines."""
    if fmt not in ("parquet", "json"):
        raise ValueError(f"unknown format: {fmt}")
    df.select("text").write.mode(mode).format(fmt).save(path)


def read_filenames(spark: SparkSession, source: str | list[str]) -> DataFrame:
    """(row_id, name) from a text file with one name per line, or from a short literal list."""
    if isinstance(source, str):
        lines = with_row_id(spark.read.text(source)).withColumnRenamed("value", "name")
        return lines.filter(F.length(F.trim("name")) > 0)
    return spark.createDataFrame(list(enumerate(source)), "row_id bigint, name string")


def load_templates(
    spark: SparkSession, folder: str, system_file: str = "system.txt", user_file: str = "user.txt"
) -> tuple[str, str]:
    """(system text, user template), trimmed. Two small files are read to the driver."""
    return (
        _small_text(spark, f"{folder.rstrip('/')}/{system_file}"),
        _checked_template(_small_text(spark, f"{folder.rstrip('/')}/{user_file}")),
    )


def _checked_template(template: str) -> str:
    template_parts(template)
    return template


def _small_text(spark: SparkSession, path: str) -> str:
    try:
        rows = spark.read.text(path, wholetext=True).take(1)
    except AnalysisException as e:
        raise FileNotFoundError(f"no template file: {path}") from e
    return rows[0][0].strip() if rows else ""


def run_manifest(
    df: DataFrame, config: Mapping[str, object], version: str = "unknown", timestamp: str | None = None
) -> DataFrame:
    """One row: code version, UTC time, configuration as JSON, and the row count of ``df``."""
    return _manifest(df.agg(F.count(F.lit(1)).alias("row_count")), config, version, timestamp)


def manifest_row(
    spark: SparkSession, row_count: int, config: Mapping[str, object], version: str = "unknown", timestamp: str | None = None
) -> DataFrame:
    """``run_manifest`` where the row count is known."""
    return _manifest(spark.range(1).select(F.lit(row_count).cast("bigint").alias("row_count")), config, version, timestamp)


def _manifest(counted: DataFrame, config: Mapping[str, object], version: str, timestamp: str | None) -> DataFrame:
    now = F.lit(timestamp) if timestamp else F.date_format(
        F.convert_timezone(None, F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz")),
        "yyyy-MM-dd'T'HH:mm:ss'Z'",
    )
    return counted.select(
        F.lit(version).alias("code_version"),
        now.alias("timestamp"),
        F.lit(json.dumps(dict(config), sort_keys=True)).alias("config"),
        "row_count",
    )


def write_manifest(manifest: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The one-row manifest as JSON beside the output."""
    manifest.coalesce(1).write.mode(mode).json(path)
