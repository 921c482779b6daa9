"""Text queries over whole tables, held against SQL and brute force on rows with what is rare in the test tables."""

import hashlib
import re

import duckdb

import __spark_entry__ as entry

# Unicode's White_Space, written out one by one.
WHITE = [chr(c) for c in (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


def both(spark, tmp_path, name, table, rows, schema):
    """(rows of the query, rows of its SQL), sorted, over one made table."""
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    df = entry.queries()[name](spark, str(tmp_path))
    told = con.sql(entry.oracle_sql()[name])
    at = [told.columns.index(c) for c in df.columns]
    assert len(told.columns) == len(df.columns)
    return sorted((tuple(r) for r in df.collect()), key=repr), sorted((tuple(r[i] for i in at) for r in told.fetchall()), key=repr)


def test_normalise_all_kinds_of_blanks(spark, tmp_path):
    kept = ["​", "﻿", "\x1c", "\x1f", "᠎", "é", "选"]  # none of them is white space
    texts = [None, "", " \n", "Élu : 选举　结果", *(f"{w}a{w}{w} b{w}" for w in WHITE), *(f"a{k}b {k}" for k in kept)]
    got, told = both(spark, tmp_path, "q46_normalise_text", "documents", list(enumerate(texts)), "doc_id bigint, text string")
    want = [re.sub("[" + "".join(WHITE) + "]+", " ", x or "").strip(" ") for x in texts]
    assert got == told == sorted(((i, hashlib.md5(x.encode()).hexdigest()) for i, x in enumerate(want)), key=repr)


def test_pairs_however_written(spark, tmp_path):
    cells = ['"1&4", 3&2', "3&4\n9&6", "3&1\t4&2", " 3&4;1&2", "6&8;5&3;1&10;", "1&3／2&4；", "“1&8”; 5&6", "1 & 5", "1&2", "Wards 1, 5", "Wards 2; 3；6", "wards 1; 3&4"]
    cells += ["Wards 1-8", "Wards 1–8; 9", "Elm; Oak 2", "Ward 3", "", None]
    got, told = both(spark, tmp_path, "q36_pair_expand", "council_races", list(enumerate(cells)), "row_id bigint, districts string")
    assert got == told == sorted(((i, f"Ward {n}") for i, c in enumerate(cells[:12]) for n in re.findall("[0-9]+", c)), key=repr)


def test_ward_labels_in_the_order_of_names(spark, tmp_path):
    order = ["Écluse", "elm", "Elm", "Ward 1", "Ward 10", "Ward 2", "Zone", "99"]
    rows = [("1", w) for w in reversed(order)] * 2 + [("2", "99"), ("2", "a")]
    got, told = both(spark, tmp_path, "q41_ward_label_order", "served_entry", rows, "census_id string, ward string")
    assert got == told == sorted([("1", w, i) for i, w in enumerate(order, 1)] + [("2", "a", 1), ("2", "99", 2)], key=repr)


def test_served_names_and_newest_file(spark, tmp_path):
    names = ["ÉCLUSE, Zoë", "ECLUSE, Zoe", "MACKAY, B", "Mackay, A", None]
    rows = [(i, "1", "Elm", "mayor", n) for i, n in enumerate(names)] + [(9, "1", "Oak", "mayor", "ZZ, 1")]
    got, told = both(spark, tmp_path, "q40_collated_rank", "served_name", rows, "name_id bigint, census_id string, ward string, name_field string, cand_name string")
    assert got == told and dict(got) == {4: 1, 1: 2, 0: 3, 3: 4, 2: 5, 9: 1}
    files = [(f"c-2026-08-{d}-v{v}.js",) for d, v in ((17, 99), (18, 9), (18, 10), (18, 10))] + [("other.js",), (None,)]
    got, told = both(spark, tmp_path, "q53_newest_version", "served_raw", files, "file_name string")
    assert got == told and [r[0] for r in got] == ["c-2026-08-18-v10.js"]
