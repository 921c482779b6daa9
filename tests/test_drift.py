import datetime as dt
import json

from pyspark.sql import functions as F

from hustings.operators.drift import drift, fused_schema, leaves, tagged_union

SCHEMA = "record_id bigint, census_id string, build_no int, received_at timestamp, payload string"
T = dt.datetime(2026, 8, 1)


def payload(wards, shared=None, wrap=False):
    body = {"name": "x", "wards": {w: {"names": {}, "fields": f} for w, f in wards.items()}} | ({"shared": {"names": {}, "fields": shared}} if shared is not None else {})
    text = json.dumps(body)
    return f"// Version 9, built 2026-08-09.\nwindow.SERVED_LISTS = {text};\n" if wrap else text


def changes(spark, *builds, extra=()):
    rows = [(i, "c", n, T, p) for i, (n, p) in enumerate(builds)] + list(extra)
    return {tuple(r)[1:] for r in drift(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_renamed_moved_retyped(spark):
    before = payload({"W 1": {"a": 1, "m": 4, "t": 1, "gone": 3}, "W 2": {"a": 2, "m": 4, "t": 0}}, wrap=True)
    after = payload({"W 1": {"b": 1, "t": "1"}, "W 2": {"b": 2, "t": "0"}, "W 3": {"b": 9, "t": "", "new": 1}}, {"m": 4})
    assert changes(spark, (5, before), (8, after)) == {
        (8, "renamed", "wards.a", "wards.b"),
        (8, "renamed", "wards.m", "shared.m"),
        (8, "retyped", "wards.t", "wards.t"),
        (8, "removed", "wards.gone", ""),
        (8, "added", "", "wards.new"),
    }


def test_blank_null_and_missing_are_equal_and_types_are_not(spark):
    before = payload({"W 1": {"a": "", "x": 1}, "W 2": {"a": 5, "x": None}, "W 3": {"a": None}})
    after = payload({"W 1": {"b": None, "y": "1"}, "W 2": {"b": 5, "y": " "}, "W 3": {}})
    assert changes(spark, (1, before), (2, after)) == {(2, "renamed", "wards.a", "wards.b"), (2, "removed", "wards.x", ""), (2, "added", "", "wards.y")}


def test_keeps_its_name_if_several_fit(spark):
    before = payload({"W 1": {"z": 1}})
    after = payload({"W 1": {"a": 1}}, {"z": 1})
    assert changes(spark, (1, before), (2, after)) == {(2, "renamed", "wards.z", "shared.z"), (2, "added", "", "wards.a")}


def test_deliveries(spark):
    one, two = payload({"W": {"a": 1}}), payload({"W": {"b": 2}})
    later = T + dt.timedelta(days=1)
    extra = [(7, "c", 2, later, one), (8, "c", 3, later, one), (8, "c", 3, later, one), (9, None, 3, T, two), (10, "c", None, T, two), (11, "c", 4, T, None), (12, "c", 4, T, "{oops"), (13, "d", 1, T, two)]
    assert changes(spark, (1, one), (2, two), extra=extra) == set()
    assert drift(spark.createDataFrame([], SCHEMA)).collect() == []


def test_tagged_union(spark):
    rows = [(1, "c", 1, T, payload({"W": {"a": 2, "b": " x ", "e": "", "o": {"q": 1}}}, {"s": True})), (2, "c", 2, T, payload({"W": {"a": ["2"], "b": None, "l": [1, 2]}}))]
    got = tagged_union(spark.createDataFrame(rows, SCHEMA).withColumn("kind", F.lit(0)).withColumn("value", F.lit(0)))
    got = {(r["build_no"], r["half"], r["member"]): r for r in got.collect()}
    assert (got[1, "wards", "a"]["as_number"], got[1, "wards", "a"]["canonical"], got[1, "wards", "a"]["alternatives"]) == (2.0, 2, ["array", "number"])
    assert (got[2, "wards", "a"]["as_array"], got[2, "wards", "a"]["canonical"]) == ('["2"]', 2)
    assert (got[1, "shared", "s"]["as_boolean"], got[1, "shared", "s"]["canonical"]) == (True, 1)
    assert (got[1, "wards", "b"]["as_text"], got[1, "wards", "b"]["canonical"], got[1, "wards", "b"]["canonical_text"], got[2, "wards", "b"]["kind"]) == (" x ", None, "x", None)
    assert got[1, "wards", "e"]["kind"] is None and got[1, "wards", "e"]["canonical_text"] is None
    assert (got[1, "wards", "o"]["as_object"], got[2, "wards", "l"]["canonical_text"]) == ('{"q":1}', "[1,2]")
    assert got[1, "record", "name"]["as_text"] == "x"


def test_every_leaf_is_in_the_table(spark):
    def count(x):
        return sum(map(count, x.values())) if isinstance(x, dict) else 1

    docs = [
        {"name": "x", "shared": {"names": {"mayor": ["A", "B"]}, "fields": {"m": 1}}, "wards": {"W 1": {"names": {"coun_ward": []}, "fields": {"a": None, "b": ""}, "note": "late"}, "W 2": {"fields": {"a": [1]}}}, "more": 7},
        {"name": None, "wards": {"W 1": "closed", "W 2": {"fields": [1, 2]}}},
    ]
    rows = [(i, "c", i, T, json.dumps(d)) for i, d in enumerate(docs)] + [(9, "d", 1, T, "7"), (10, "d", 2, T, '{"wards": 1}'), (11, None, 1, T, json.dumps(docs[0]))]
    df = spark.createDataFrame(rows, SCHEMA)
    assert leaves(df).count() == sum(map(count, docs)) == tagged_union(df).count()
    got = {(r["half"], r["ward"], r["section"], r["member"]): r["canonical_text"] for r in tagged_union(df).filter("build_no = 1").collect()}
    assert got == {("record", None, "", "name"): None, ("wards", "W 1", "", ""): "closed", ("wards", "W 2", "fields", ""): "[1,2]"}
    kinds = {(r["member"], r["kind"]): (r["first_build"], r["last_build"]) for r in fused_schema(df).collect()}
    assert kinds["coun_ward", "array"] == (0, 0) and ("a", "array") in kinds and ("b", "string") not in kinds


def test_renamed_fields_come_under_their_common_name(spark):
    rows = []
    for m in range(4):
        values = [{"W 1": {"ward_accl": m}, "W 2": {"ward_accl": m + 1}}, {"W 1": {"accl_w": m}, "W 2": {"accl_w": m + 1}}]
        rows += [(10 * m + b, f"c{m}", b, T, payload(v)) for b, v in enumerate(values)]
    rows += [(90, "x", 1, T, payload({"W": {"ward_accl": 3}})), (91, "x", 2, T, payload({"W": {"polls": 3}}))]  # once, by chance
    df = spark.createDataFrame(rows, SCHEMA)
    common = spark.createDataFrame([("ward_accl",), ("ward",)], "member string")
    got = {r["member"]: r["canonical_member"] for r in tagged_union(df, common).filter("section = 'fields'").collect()}
    assert got == {"ward_accl": "ward_accl", "accl_w": "ward_accl", "polls": "polls"}
    assert {r["canonical_member"] for r in tagged_union(df).filter("section = 'fields'").collect()} == {"ward_accl", "accl_w", "polls"}
