"""The command line: runs a query over a folder of tables and writes its result, or serves election records once all rules hold.

Input and arguments are checked before a session is started; everything else is the library's.
"""

from __future__ import annotations

import argparse
import importlib
import os
import sys
from collections.abc import Sequence
from pathlib import Path

#: What a folder holds that is the root of a checkout.
ROOT_MARK = "pyproject.toml"


def root_of(path: str | Path) -> Path | None:
    """The nearest folder at or above a path that holds the mark of a checkout's root."""
    here = Path(path).resolve()
    return next((p for p in (here, *here.parents) if (p / ROOT_MARK).exists()), None)


def dependency(name: str, needed_for: str):
    """A module that only some runs need, imported when they do; a missing one is told by name."""
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as e:
        raise SystemExit(f"missing dependency: {e.name}, needed for {needed_for}") from e


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="hustings", description=__doc__.splitlines()[0])
    commands = out.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="write the result of a query")
    run.add_argument("query")
    run.add_argument("tables", help="a folder of Parquet tables")
    run.add_argument("--output", required=True, help="where the result is put, as a whole")
    run.add_argument("--format", choices=("parquet", "csv"), default="parquet")
    serve = commands.add_parser("serve", help="check election records, then write what each ward is served")
    serve.add_argument("tables", help="a folder of Parquet tables")
    serve.add_argument("--output", required=True)
    wrap = commands.add_parser("wrap", help="write a CSV as a script literal")
    wrap.add_argument("csv", help="a CSV file")
    wrap.add_argument("--output", required=True)
    wrap.add_argument("--variable", default="TABLE")
    return out


def _local(path: str) -> bool:
    return "://" not in path


def main(argv: Sequence[str] | None = None) -> int:
    """0 if everything was written, 1 if a rule is broken; a wrong call ends with status 2 and writes nothing."""
    asked = parser().parse_args(argv)
    source = asked.csv if asked.command == "wrap" else asked.tables
    if _local(source) and not os.path.exists(source):
        parser().error(f"no such file or folder: {source}")
    sql = dependency("pyspark.sql", "any run")
    spark = sql.SparkSession.builder.appName("hustings").getOrCreate()
    from hustings.operators.constraints import ConstraintError
    from hustings.plans import contests as C
    from hustings.session import table
    from hustings.sources import readers, writers

    if asked.command == "wrap":
        rows = spark.read.options(header=True, quote='"', escape='"', multiLine=True).csv(source)
        writers.write_text(spark, writers.csv_in_script(rows, asked.variable, rows.columns), asked.output)
        return 0
    if asked.command == "run":
        root = root_of(__file__)
        if root is not None and str(root) not in sys.path:
            sys.path.insert(0, str(root))
        queries = dependency("__spark_entry__", "the queries by name").queries()
        if asked.query not in queries:
            parser().error(f"unknown query: {asked.query}; known are {', '.join(sorted(queries))}")
        result = queries[asked.query](spark, source)
        if asked.format == "csv":
            writers.write_csv(result, asked.output, result.columns, single=True)
        else:
            writers.write_parquet(result, asked.output)
        return 0
    readers.require(spark, *(f"{source}/{name}.parquet" for name in ("municipality_doc", "municipality_type", "election_structure")))
    _, tables, contest = C.flow(spark, source)
    rules = C.rules(contest, table(spark, source, "municipality_type"), table(spark, source, "election_structure"), names=C.served_names(contest, tables))
    try:
        writers.write_all(rules, [(writers.write_parquet, C.served_fields(contest), f"{asked.output}/fields"), (writers.write_parquet, C.served_names(contest, tables), f"{asked.output}/names")])
    except ConstraintError as e:
        print("nothing written: " + str(e), file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
