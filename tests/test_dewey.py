import json

from pyspark.sql import functions as F

from hustings.operators.dewey import nodes, parent_label, record_nodes, record_tables, tables_by_path

RECORD = {
    "mayor": [{"office": "Mayor", "n_districts": "1", "max_votes": None, "districts": {"At-large": ["A, B", {"name_raw": "C"}, None]}}],
    "ward": {"office": None, "districts": [{"district": "Ward 1", "candidates": ["X"]}, {"district": "Ward 2", "candidates": []}, None]},
    "deputy mayor": None,
    "atlarge": [],
    "regional councillor": [{"districts": {"D": {"candidates": [{"name_raw": "Y", "status": {"code": "A"}}]}, "E": None}}, {"districts": None}, {}],
}
EXPECTED = {
    ("mayor", 0, -1, -1), ("mayor", 0, 0, -1), ("mayor", 0, 0, 0), ("mayor", 0, 0, 1),
    ("ward", 0, -1, -1), ("ward", 0, 0, -1), ("ward", 0, 0, 0), ("ward", 0, 1, -1),
    ("regional councillor", 0, -1, -1), ("regional councillor", 0, 0, -1), ("regional councillor", 0, 0, 0), ("regional councillor", 0, 1, -1),
    ("regional councillor", 1, -1, -1), ("regional councillor", 2, -1, -1),
}


def test_positions(spark):
    text = json.dumps(RECORD)
    rows = [(1, text), (2, json.dumps(text)), (3, None), (4, text[:-9]), (5, ""), (6, "3"), (7, "[]"), (8, '"x"'), (9, "[" * 100_000)]
    df = spark.createDataFrame(rows, "record_id bigint, races string").withColumn("label", F.lit(1)).withColumn("path", F.lit(2))
    got = [tuple(r) for r in record_nodes(df).select("record_id", "race_key", "race_pos", "district_pos", "cand_pos").collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(i, *e) for i in (1, 2) for e in EXPECTED}


def test_tables_are_linked(spark):
    df = spark.createDataFrame([(1, json.dumps(RECORD)), (2, json.dumps({"ward": RECORD["ward"]}))], "record_id bigint, races string")
    tables = record_tables(df)
    race, district, name = (tables[t].collect() for t in ("race", "district", "name"))
    assert {(d["record_id"], d["parent"]) for d in district} <= {(r["record_id"], r["node"]) for r in race}
    assert {(n["record_id"], n["parent"]) for n in name} <= {(d["record_id"], d["node"]) for d in district}
    assert len({(r["record_id"], r["node"]) for r in race}) == len(race) == 6
    assert {d["district"] for d in district} == {"At-large", "Ward 1", "Ward 2", "D", "E"}
    assert sorted(n["name_raw"] for n in name) == ["A, B", "C", "X", "X", "Y"]
    mayor = next(r for r in race if r["race_key"] == "mayor")
    assert (mayor["office"], mayor["n_districts"], mayor["max_votes"]) == ("Mayor", 1, None)


def test_labels_of_any_document(spark):
    df = spark.createDataFrame([("k", '{"a": {"b": [1, {"c": true}]}, "d": "\\ud800x"}')], "id string, doc string")
    got = {r["path"]: (list(r["label"]), r["kind"], r["value"], r["parent"]) for r in nodes(df, "id", "doc").withColumn("parent", parent_label(F.col("label"))).collect()}
    assert got["a.b[]"][0] in ([0, 0, 0], [0, 0, 1])
    assert got["a.b[].c"] == ([0, 0, 1, 0], "boolean", "true", [0, 0, 1])
    assert got["a"][3] is None
    assert got["d"][1] == "string"


def test_repeated_member_and_empty_table(spark):
    df = spark.createDataFrame([(1, '{"a": [{}], "b": [{}], "a": [{}, {}]}')], "record_id bigint, races string")
    assert sorted((r["race_key"], r["race_pos"]) for r in record_nodes(df).collect()) == [("a", 0), ("a", 1), ("b", 0)]
    assert record_nodes(df.limit(0)).collect() == []


def test_tables_of_any_document(spark):
    docs = [
        {"title": "a", "meta": {"by": {"name": "x", "year": 2026}}, "items": [{"n": 1, "tags": ["p", "q"], "deep": {"er": True}}, {"n": "two"}, 7, None], "groups": {"k 1": {"n": 5}, "k 2": {"n": None, "list": [[1, 2], []]}}},
        {"title": None, "items": {"odd": 1}, "node": "taken"},
        [1, {"z": 2}],
    ]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)] + [(7, None), (8, "{oops"), (9, "5")], "doc bigint, body string").withColumn("path", F.lit(0))
    tables = tables_by_path(df, "doc", "body", keyed=["groups"])
    rows = {name: [r.asDict() for r in t.collect()] for name, t in tables.items()}
    assert set(rows) == {"document", "items_item", "items_item_tags_item", "groups_each", "groups_each_list_item", "groups_each_list_item_item", "item"}
    first = next(r for r in rows["document"] if r["doc"] == 0)
    assert (first["title"], first["meta_by_name"], first["meta_by_year"]) == ("a", "x", "2026")
    second = next(r for r in rows["document"] if r["doc"] == 1)
    assert (second["title"], second["items_odd"], second["node_2"]) == (None, "1", "taken")
    items = {r["pos"]: r for r in rows["items_item"]}
    assert (items[0]["n"], items[0]["n_kind"], items[0]["deep_er"], items[1]["n_kind"], items[2]["value"], items[3]["kind"]) == ("1", "number", "true", "string", "7", "null")
    assert {(r["value"], r["parent"]) for r in rows["items_item_tags_item"]} == {("p", items[0]["node"]), ("q", items[0]["node"])}
    groups = {r["key"]: r for r in rows["groups_each"]}
    assert groups["k 1"]["n"] == "5" and {r["parent"] for r in rows["groups_each_list_item"]} == {groups["k 2"]["node"]}
    # Links lead to rows, and no scalar of a document is lost.
    for r in (r for name, t in rows.items() if name != "document" for r in t):
        assert r["parent"] in {p["node"] for p in rows[r["parent_table"]] if p["doc"] == r["doc"]}
    fixed = ("doc", "node", "parent", "parent_table", "pos", "key", "kind")
    held = sum(v is not None for t in rows.values() for r in t for c, v in r.items() if c not in fixed and not c.endswith("_kind"))

    def scalars(x):
        return sum(map(scalars, x.values() if isinstance(x, dict) else x)) if isinstance(x, (dict, list)) else x is not None

    assert held == sum(map(scalars, docs))
    assert {n: t.count() for n, t in tables_by_path(df.limit(0), "doc", "body").items()} == {"document": 0}
