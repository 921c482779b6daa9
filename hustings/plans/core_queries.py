"""Queries of the general training-data problems: cells, records, drift and snapshots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.operators.cells import split_cells
from hustings.operators.dewey import RECORD_KEYED, record_nodes, record_tables, tables_by_path
from hustings.operators.drift import drift, fused_schema, leaves, tagged_union, value_kind
from hustings.operators.snapshots import changed_values, snapshot_changes
from hustings.session import table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per value of each cell that holds two or more."""
    races, structure = table(spark, sf_dir, "council_races"), table(spark, sf_dir, "election_structure")
    parts = [
        split_cells(races, "row_id", "districts", "list", count="n_districts").withColumn("field_name", F.lit("districts")),
        *(split_cells(structure, "row_id", c, "source").withColumn("field_name", F.lit(c)) for c in ("district_source_url", "max_votes_source")),
    ]
    return reduce(DataFrame.unionByName, parts).filter("n_values >= 2").select("row_id", "field_name", "pos", "val")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per race, district and name of every record, with positions."""
    return record_nodes(table(spark, sf_dir, "municipality_doc")).select("record_id", "race_key", "race_pos", "district_pos", "cand_pos")


def _record_table(name: str):
    return lambda spark, sf_dir: record_tables(table(spark, sf_dir, "municipality_doc"))[name]


def p3_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables that the records' schema paths come to: rows, linked rows and filled cells of each."""
    counts = []
    for name, rows in tables_by_path(table(spark, sf_dir, "municipality_doc"), "record_id", "races", RECORD_KEYED).items():
        cells = sum((F.col(f"`{c}`").isNotNull().cast("bigint") for c in rows.columns if c not in ("record_id", "node", "parent", "parent_table", "pos", "key", "kind") and not c.endswith("_kind")), F.lit(0))
        counts.append(rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(cells), F.lit(0)).alias("cells")).select(F.lit(name).alias("table"), "n", "cells"))
    return reduce(DataFrame.unionByName, counts)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each change of a field between consecutive builds of a municipality."""
    return drift(table(spark, sf_dir, "served_raw"))


def p4_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All deliveries as one consistent table with a branch for each type, renamed fields under their common name."""
    common = table(spark, sf_dir, "served_field").select(F.col("field_name").alias("member"))
    return tagged_union(table(spark, sf_dir, "served_raw"), common).withColumn("alternatives", F.array_join("alternatives", "|"))


def p4_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schema inferred from all deliveries: each path with its alternative types and when they appear."""
    return fused_schema(table(spark, sf_dir, "served_raw"))


def p4_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every leaf of every delivery with its type and its values as text."""
    rows = leaves(table(spark, sf_dir, "served_raw"))
    text = F.array_join(F.coalesce(F.try_variant_get("v", "$", "array<string>"), F.array(F.try_variant_get("v", "$", "string"))), "|")
    kind = value_kind(F.col("v"))
    return rows.select("census_id", "build_no", "half", "ward", "section", "member", kind.alias("kind"), F.when(kind.isNotNull() & (kind != "object"), text).alias("text"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries added, removed or changed since the build before."""
    return snapshot_changes(table(spark, sf_dir, "served_entry"))


def p5_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The names that came and went in each changed entry."""
    return changed_values(table(spark, sf_dir, "served_entry"))


QUERIES = {
    "p2_found": p2_found,
    "p3_found": p3_found,
    **{f"p3_{name}": _record_table(name) for name in ("race", "district", "name")},
    "p3_tables": p3_tables,
    "p4_found": p4_found,
    "p4_union": p4_union,
    "p4_schema": p4_schema,
    "p4_leaves": p4_leaves,
    "p5_found": p5_found,
    "p5_values": p5_values,
}

#: The leaves of the newest readable delivery of each municipality and build.
_LEAVES = r"""
    body AS (SELECT record_id, census_id, build_no, received_at, regexp_replace(regexp_replace(payload, '^\x{FEFF}?\s*(?:(?://[^\n]*\n|/\*(?s:.*?)\*/)\s*)*(?:(?:window\.|var |const |let )[\w.]*\s*=\s*)?', ''), '\s*;?\s*$', '') AS b FROM served_raw),
    doc AS (SELECT census_id, build_no, CASE WHEN json_valid(b) THEN b::JSON END AS d FROM body WHERE census_id IS NOT NULL AND build_no IS NOT NULL AND json_valid(b) AND CASE WHEN json_valid(b) THEN coalesce(json_type(b::JSON->'wards') = 'OBJECT', false) OR coalesce(json_type(b::JSON->'shared') = 'OBJECT', false) END
        QUALIFY row_number() OVER (PARTITION BY census_id, build_no ORDER BY received_at DESC NULLS LAST, record_id DESC NULLS LAST) = 1),
    top AS (SELECT census_id, build_no, e.key AS k, e.value AS v FROM doc, json_each(d) e),
    entry AS (SELECT census_id, build_no, 'shared' AS half, NULL AS ward, v FROM top WHERE k = 'shared' UNION ALL SELECT census_id, build_no, 'wards', e.key, e.value FROM (SELECT * FROM top WHERE k = 'wards' AND json_type(v) = 'OBJECT'), json_each(v) e),
    section AS (SELECT census_id, build_no, half, ward, e.key AS section, e.value AS v FROM (SELECT * FROM entry WHERE json_type(v) = 'OBJECT'), json_each(v) e UNION ALL SELECT census_id, build_no, half, ward, '', v FROM entry WHERE json_type(v) <> 'OBJECT'),
    leaf AS (SELECT census_id, build_no, half, ward, section, e.key AS member, e.value AS v FROM (SELECT * FROM section WHERE json_type(v) = 'OBJECT'), json_each(v) e UNION ALL SELECT census_id, build_no, half, ward, section, '', v FROM section WHERE json_type(v) <> 'OBJECT'
        UNION ALL SELECT census_id, build_no, 'record', NULL, '', k, v FROM top WHERE k NOT IN ('shared', 'wards')),
    told AS (SELECT *, CASE WHEN json_type(v) = 'VARCHAR' THEN CASE WHEN trim(v->>'$', ' ') <> '' THEN 'string' END WHEN json_type(v) = 'BOOLEAN' THEN 'boolean' WHEN json_type(v) = 'ARRAY' THEN 'array' WHEN json_type(v) = 'OBJECT' THEN 'object' WHEN json_type(v) = 'NULL' THEN NULL ELSE 'number' END AS kind FROM leaf)"""

ORACLE = {
    "p4_leaves": f"""WITH {_LEAVES} SELECT census_id, build_no, half, ward, section, member, kind, CASE WHEN kind = 'array' THEN array_to_string(list_transform(v::JSON[], lambda x: x->>'$'), '|') WHEN kind <> 'object' THEN v->>'$' END AS text FROM told""",
    "p4_schema": f"WITH {_LEAVES} SELECT half, section, member, kind, count(*) AS n, min(build_no) AS first_build, max(build_no) AS last_build FROM told WHERE kind IS NOT NULL GROUP BY ALL",
    "p5_found": """
        WITH last AS (SELECT build_no, census_id, ward, mayor, coun_ward, coun_reg FROM served_entry WHERE build_no IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY build_no, census_id, ward ORDER BY received_at DESC NULLS LAST, entry_id DESC) = 1),
        s AS (SELECT build_no, census_id, ward, list_sort(list_distinct(coalesce(mayor, []))) m, list_sort(list_distinct(coalesce(coun_ward, []))) w,
            list_sort(list_distinct(coalesce(coun_reg, []))) r FROM last),
        b AS (SELECT build_no, lag(build_no) OVER (ORDER BY build_no) AS prev FROM (SELECT DISTINCT build_no FROM s)),
        n AS (SELECT s.*, b.prev FROM s JOIN b USING (build_no) WHERE b.prev IS NOT NULL),
        o AS (SELECT s.*, b.build_no AS target FROM s JOIN b ON b.prev = s.build_no)
        SELECT coalesce(n.build_no, o.target)::INT AS build_no, coalesce(n.census_id, o.census_id) AS census_id, coalesce(n.ward, o.ward) AS ward,
            CASE WHEN o.target IS NULL THEN 'added' WHEN n.build_no IS NULL THEN 'removed' ELSE 'changed' END AS change_kind
        FROM n FULL JOIN o ON n.build_no = o.target AND n.census_id IS NOT DISTINCT FROM o.census_id AND n.ward IS NOT DISTINCT FROM o.ward
        WHERE o.target IS NULL OR n.build_no IS NULL OR n.m <> o.m OR n.w <> o.w OR n.r <> o.r""",
}
