"""Sinks: written to a scratch path first and renamed, so that a reader sees the whole result or none of it."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.operators.constraints import Rule, enforce

#: A document that one process formats may have so many rows; larger results are written as a table of documents.
SINGLE_FILE_ROWS = 1_000_000


def file_system(spark: SparkSession, path: str):
    """The file system that holds a path, and the path in its terms."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def replace_path(spark: SparkSession, scratch: str, path: str) -> None:
    """Puts what was written to ``scratch`` in the place of ``path``; what was there is removed only after it has been set aside."""
    fs, target = file_system(spark, path)
    source, aside = spark._jvm.org.apache.hadoop.fs.Path(scratch), spark._jvm.org.apache.hadoop.fs.Path(f"{path}.aside-{uuid.uuid4().hex}")
    fs.mkdirs(target.getParent())
    had = fs.exists(target)
    if had and not fs.rename(target, aside):
        raise OSError(f"can't set aside {path}")
    if not fs.rename(source, target):
        if had:
            fs.rename(aside, target)
        raise OSError(f"can't rename to {path}")
    if had:
        fs.delete(aside, True)


def _scratch(path: str) -> str:
    head, _, tail = path.rstrip("/").rpartition("/")
    return f"{head or '.'}/.{tail}-{uuid.uuid4().hex}"


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A small text as one UTF-8 file."""
    scratch = _scratch(path)
    fs, jpath = file_system(spark, scratch)
    stream = fs.create(jpath, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    replace_path(spark, scratch, path)


def read_text_file(spark: SparkSession, path: str) -> str | None:
    """A small UTF-8 file, or None if there is none."""
    fs, jpath = file_system(spark, path)
    if not fs.exists(jpath):
        return None
    stream = fs.open(jpath)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    scratch = _scratch(path)
    df.write.partitionBy(*partition_by).parquet(scratch)
    replace_path(df.sparkSession, scratch, path)


def as_csv_columns(df: DataFrame, columns: Sequence[str], null: str = "") -> DataFrame:
    """The columns in order as strings: booleans in capitals, lists joined by a semicolon, nulls as the given word."""
    kinds = dict(df.dtypes)

    def text(c: str):
        v = F.upper(F.col(c).cast("string")) if kinds[c] == "boolean" else F.array_join(c, "; ") if kinds[c].startswith("array") else F.col(c).cast("string")
        return F.coalesce(v, F.lit(null)).alias(c)

    return df.select(*map(text, columns))


def write_csv(df: DataFrame, path: str, columns: Sequence[str], order: Sequence[str] = (), null: str = "", single: bool = False) -> None:
    """A CSV with a header and the stated columns; ordered over all of its files, whose names follow the order.

    ``single``: one file of that name, written by one process and refused beyond ``SINGLE_FILE_ROWS`` rows.
    """
    spark = df.sparkSession
    rows = as_csv_columns(df.orderBy(*order) if order else df, columns, null)
    if single and df.limit(SINGLE_FILE_ROWS + 1).count() > SINGLE_FILE_ROWS:
        raise ValueError(f"more than {SINGLE_FILE_ROWS} rows for one file; write them as a folder")
    scratch = _scratch(path)
    (rows.coalesce(1) if single else rows).write.options(header=True, quote='"', escape='"', emptyValue="").csv(scratch)
    if not single:
        replace_path(spark, scratch, path)
        return
    fs, folder = file_system(spark, scratch)
    part = next(f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-"))
    try:
        replace_path(spark, part.toString(), path)
    finally:
        fs.delete(folder, True)


def write_all(rules: Iterable[Rule], writes: Sequence[tuple]) -> DataFrame:
    """Checks all rules, then runs the writes (function, arguments...); nothing is written if a rule is broken."""
    told = enforce(rules)
    for write, *arguments in writes:
        write(*arguments)
    return told


def nested_map(df: DataFrame, keys: Sequence[str], key: str, value: str, order: str, name: str) -> DataFrame:
    """One row per key with a map of its rows in order; the key within it must be unique, as a map can't hold it twice.

    Without keys the whole table is one map in one task, which is refused beyond ``SINGLE_FILE_ROWS`` rows.
    """
    if not keys and df.limit(SINGLE_FILE_ROWS + 1).count() > SINGLE_FILE_ROWS:
        raise ValueError(f"more than {SINGLE_FILE_ROWS} rows for one map; give keys to nest by")
    entries = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(key).alias("k"), F.col(value).alias("v"))))
    return df.groupBy(*keys).agg(F.map_from_entries(F.transform(entries, lambda e: F.struct(e["k"], e["v"]))).alias(name))


def _compact(value, indent: int, at: int) -> str:
    """JSON with its structure indented and lists, scalars and maps of scalars on one line, in ASCII."""
    flat = not isinstance(value, dict) or not any(isinstance(v, (dict, list)) for v in value.values())
    if flat or not value:
        return json.dumps(value, ensure_ascii=True)
    pad = " " * (at + indent)
    inner = ",\n".join(f"{pad}{json.dumps(k, ensure_ascii=True)}: {_compact(v, indent, at + indent)}" for k, v in value.items())
    return "{\n" + inner + "\n" + " " * at + "}"


def script_text(served: Mapping, variable: str, header: Sequence[str]) -> str:
    """A script file that assigns the served document: comment lines, the assignment, ASCII only."""
    comments = "".join(f"// {line.encode('ascii', 'backslashreplace').decode()}\n" for line in header)
    return f"{comments}window.{variable} = {_compact(served, 1, 0)};\n"


def documents(df: DataFrame, key: str, value: str) -> dict:
    """A keyed document gathered on the driver, in order of its keys; refused beyond the bound."""
    rows = df.select(key, F.to_json(value).alias("j")).limit(SINGLE_FILE_ROWS + 1).collect()
    if len(rows) > SINGLE_FILE_ROWS:
        raise ValueError(f"more than {SINGLE_FILE_ROWS} rows for one file; write them as a table")
    return {r[0]: json.loads(r["j"]) for r in sorted(rows, key=lambda r: r[0])}


def write_json_document(df: DataFrame, path: str, key: str, value: str, meta: Mapping) -> None:
    """One pretty UTF-8 JSON file: the metadata first, then the keys in order."""
    body = {"_meta": dict(meta)} | documents(df, key, value)
    write_text(df.sparkSession, json.dumps(body, ensure_ascii=False, indent=1) + "\n", path)


def version_name(stem: str, built: dt.date, version: int) -> str:
    return f"{stem}-{built.isoformat()}-v{version}.js"


def csv_in_script(df: DataFrame, variable: str, columns: Sequence[str]) -> str:
    """A small CSV inside a quoted script literal, its closing characters escaped."""
    rows = as_csv_columns(df, columns).limit(SINGLE_FILE_ROWS + 1).collect()
    if len(rows) > SINGLE_FILE_ROWS:
        raise ValueError(f"more than {SINGLE_FILE_ROWS} rows for one file")
    text = "\n".join([",".join(columns), *(",".join(f'"{v.replace(chr(34), chr(34) * 2)}"' if set(v) & set(',"\n') else v for v in r) for r in rows)])
    for ch in "\\`$":
        text = text.replace(ch, "\\" + ch)
    return f"window.{variable} = `{text}`;\n"
