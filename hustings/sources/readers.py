"""Sources: nested JSON files, CSV with stated types, text, served script files, versions.  Schemas are stated, never inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hustings.operators.drift import json_body

RACE = "struct<office: string, scope: string, n_districts: int, seats: int, max_votes: int, block_vote: boolean, not_in_structure_csv: boolean, districts: map<string, array<string>>>"
RAW_DOC = f"census_id string, csdname string, name_format string, candidate_list_url string, notes map<string, string>, races map<string, array<{RACE}>>"
CORRUPT = "_corrupt_record"


class SourceError(ValueError):
    """An input is missing, lacks columns or can't be parsed."""


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or anything a pattern names, is there; asked of the file system that holds it."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(jpath)
    return found is not None and len(found) > 0


def require(spark: SparkSession, *paths: str) -> None:
    missing = [p for p in paths if not exists(spark, p)]
    if missing:
        raise SourceError("missing: " + ", ".join(missing))


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` itself if it has all the columns."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise SourceError("missing columns: " + ", ".join(missing))
    return df


def json_documents(spark: SparkSession, path: str, schema: str = RAW_DOC) -> DataFrame:
    """One row per nested JSON file with its name; a map keeps the order of its keys in the text."""
    require(spark, path)
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path).select("*", F.col("_metadata.file_name").alias("file_name"))


def keyed_documents(spark: SparkSession, path: str, value_schema: str, meta: str = "_meta") -> DataFrame:
    """(key, value) of a JSON object with data keys, its metadata member left out."""
    require(spark, path)
    # The members are taken as text first: the metadata's own shape must not spoil the others.
    entries = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string, string>")).alias("key", "text"))
    return entries.filter(F.col("key") != meta).select("key", F.from_json("text", value_schema).alias("value"))


def csv(spark: SparkSession, path: str, schema: str, nulls: Sequence[str] = ("", "NA"), strict: bool = True) -> DataFrame:
    """A CSV with a header, quoted by doubled quotes, in the stated columns.

    The words in ``nulls`` read as null - ``N/A`` isn't one of them, it is a value.  ``strict`` fails on a row that doesn't fit;
    otherwise such rows come with their text in ``_corrupt_record``.
    """
    require(spark, path)
    wanted = T.StructType.fromDDL(schema)
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in wanted] + ([] if strict else [T.StructField(CORRUPT, T.StringType())]))
    reader = spark.read.schema(texts).options(header=True, quote='"', escape='"', multiLine=True, enforceSchema=False, mode="FAILFAST" if strict else "PERMISSIVE")
    if not strict:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    rows = reader.csv(path)
    blank = lambda c: F.when(F.col(c).isin(*nulls), None).otherwise(F.col(c))
    cast = (lambda c, t: c.cast(t)) if strict else (lambda c, t: c.try_cast(t))
    return rows.select(*(cast(blank(f.name), f.dataType).alias(f.name) for f in wanted), *([] if strict else [CORRUPT]))


def parse_problems(df: DataFrame) -> DataFrame:
    """Rows of a CSV read without ``strict`` that couldn't be parsed."""
    return df.filter(F.col(CORRUPT).isNotNull())


def scalar_text(spark: SparkSession, path: str) -> str:
    """The one trimmed, non-empty line of a small file, such as a version."""
    require(spark, path)
    rows = spark.read.text(path).select(F.trim("value").alias("v")).filter("v <> ''").limit(2).collect()
    if len(rows) != 1:
        raise SourceError(f"{path} must hold one line")
    return rows[0]["v"]


def lines(spark: SparkSession, path: str) -> DataFrame:
    require(spark, path)
    return spark.read.text(path)


def served_script(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The JSON that a served script file assigns, parsed; the script is never evaluated."""
    require(spark, path)
    return spark.read.text(path, wholetext=True).select(F.from_json(json_body(F.col("value")), schema).alias("served")).select("served.*")


def versions(files: DataFrame, column: str = "file_name") -> DataFrame:
    """(file_name, built, version) of files named name-date-vN.js; others are left out."""
    pattern = r"-(\d{4}-\d{2}-\d{2})-v(\d+)\.js$"
    found = files.filter(F.col(column).rlike(pattern))
    return found.select(F.col(column).alias("file_name"), F.regexp_extract(column, pattern, 1).cast("date").alias("built"), F.regexp_extract(column, pattern, 2).cast("bigint").alias("version"))


def newest(files: DataFrame, column: str = "file_name") -> DataFrame:
    """The newest of them, versions compared as numbers: v10 comes after v9."""
    return versions(files, column).agg(F.max(F.struct("built", "version", "file_name")).alias("m")).select("m.file_name", "m.built", "m.version").filter("file_name IS NOT NULL")


def scalar_or_null(column: str, kind: str) -> Column:
    """A list column of mixed lengths as a scalar: its one element, else null."""
    c = F.col(column)
    return F.when(F.size(c) == 1, F.get(c, F.lit(0)).cast(kind))
