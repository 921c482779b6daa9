import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from hustings.functions import names as N
from hustings.operators import constraints as K
from hustings.operators.dewey import record_tables
from hustings.plans import contests as C
from hustings.sources import readers, writers
from hustings.streaming import deliveries

DOC = {"census_id": "7", "csdname": "É", "name_format": "last_first", "candidate_list_url": "u", "notes": {}, "races": {"mayor": [{"office": "Mayor", "scope": "At-large", "n_districts": 1, "seats": 1, "max_votes": None, "block_vote": False, "districts": {"At-large": ["DOE, J"]}}], "ward": [{"office": "C", "scope": "Ward-pair", "n_districts": 1, "seats": 2, "max_votes": 2, "districts": {"Wards 1, 5": ["B, A", "Á, A"]}}]}}


def test_json_documents_keep_key_order(spark, tmp_path):
    for i, key in enumerate(("z", "a")):
        doc = DOC | {"census_id": str(i), "races": {"ward": [{"districts": {key: [], "m": ["x"]}}]}}
        (tmp_path / f"{i}.json").write_text(json.dumps(doc, indent=1))
    docs = readers.json_documents(spark, f"{tmp_path}/*.json").orderBy("file_name").select("file_name", F.map_keys(F.col("races")["ward"][0]["districts"]).alias("keys"))
    assert [tuple(r) for r in docs.collect()] == [("0.json", ["z", "m"]), ("1.json", ["a", "m"])]
    with pytest.raises(readers.SourceError):
        readers.json_documents(spark, f"{tmp_path}/*.nothing")


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,office,n,flag\n1,"Councillor, ""City""",2,TRUE\n2,N/A,NA,\n')
    got = readers.csv(spark, f"{tmp_path}/a.csv", "id string, office string, n int, flag boolean")
    assert [tuple(r) for r in got.collect()] == [("1", 'Councillor, "City"', 2, True), ("2", "N/A", None, None)]
    (tmp_path / "b.csv").write_text("id,n\n1,2\n2,3,4\n")
    loose = readers.csv(spark, f"{tmp_path}/b.csv", "id string, n int", strict=False).cache()
    assert readers.parse_problems(loose).count() == 1
    with pytest.raises(readers.SourceError, match="x"):
        readers.require_columns(got, ["id", "x"])


def test_texts_scripts_and_versions(spark, tmp_path):
    (tmp_path / "version.txt").write_text(" 10 \n\n")
    assert readers.scalar_text(spark, f"{tmp_path}/version.txt") == "10"
    text = writers.script_text({"meta": {"n": 1}, "m": {"7": {"names": {"mayor": ["É"]}}}}, "LISTS", ["Version 10, É"])
    assert text.isascii()
    writers.write_text(spark, text, f"{tmp_path}/x.js")
    assert readers.served_script(spark, f"{tmp_path}/x.js", "meta struct<n: int>, m map<string, struct<names: map<string, array<string>>>>").first()["m"]["7"]["names"]["mayor"] == ["É"]
    files = spark.createDataFrame([("c-2026-08-18-v9.js",), (writers.version_name("c", dt.date(2026, 8, 18), 10),), ("x",)], "file_name string")
    assert readers.newest(files).first()["version"] == 10
    assert readers.newest(files.limit(0)).collect() == []


def test_sinks_write_all_or_nothing(spark, tmp_path):
    df = spark.createDataFrame([(2, "b", True, None), (1, "a,\"x\"", None, ["u", "v"])], "k int, s string, f boolean, l array<string>")
    target = f"{tmp_path}/out"
    for _ in range(2):
        writers.write_all([K.unique("u", df, "k")], [(writers.write_csv, df, target, ["k", "s", "f", "l"], ["k"])])
    assert [tuple(r) for r in readers.csv(spark, target, "k int, s string, f boolean, l string").orderBy("k").collect()] == [(1, 'a,"x"', None, "u; v"), (2, "b", True, None)]
    assert sorted(os.listdir(tmp_path)) == ["out"]
    with pytest.raises(K.ConstraintError):
        writers.write_all([K.unique("u", df.union(df), "k")], [(writers.write_parquet, df, f"{tmp_path}/never")])
    assert not (tmp_path / "never").exists()
    nested = writers.nested_map(df, [], "s", "k", "k", "m").select(F.lit("z").alias("id"), "m")
    writers.write_json_document(nested, f"{tmp_path}/d.json", "id", "m", {"built": "x"})
    assert json.loads((tmp_path / "d.json").read_text()) == {"_meta": {"built": "x"}, "z": {'a,"x"': 1, "b": 2}}
    assert [r["key"] for r in readers.keyed_documents(spark, f"{tmp_path}/d.json", "map<string, int>").collect()] == ["z"]
    assert writers.csv_in_script(df.filter("k = 1"), "X", ["k", "s"]) == 'window.X = `k,s\n1,"a,""x"""`;\n'


def test_contests_are_served(spark):
    rows = [(1, "7", "É", "last_first", dt.datetime(2026, 8, 1), json.dumps(DOC["races"])), (2, "7", "É", "last_first", dt.datetime(2026, 8, 2), "{bad"), (3, "8", "X", None, dt.datetime(2026, 8, 1), None)]
    records = C.latest_records(spark.createDataFrame(rows, "record_id bigint, census_id string, csdname string, name_format string, received_at timestamp, races string"))
    contest = C.contests(records)
    assert [(r["race_key"], r["district"], r["n"], r["place"]) for r in C.contest_counts(contest).orderBy("place").collect()] == [("ward", "Wards 1, 5", 2, 1), ("mayor", "At-large", 1, 2)]
    fields = {(r["ward"], r["stem"]): (r["served"], r["accl"], r["max_votes"]) for r in C.served_fields(contest).collect()}
    assert len(fields) == 15
    assert fields["Ward 5", "ward"] == (1, 1, 2) and fields["99", "ward"] == (0, None, None) and fields["99", "mayor"] == (None, 1, None)  # no flag for the offices with a single vote
    names = {(r["ward"], r["name_field"], r["rank"]): r["name"] for r in C.served_names(contest, record_tables(records)).collect()}
    assert names["Ward 1", "coun_ward", 1] == "Á, A" and names["Ward 1", "coun_ward", 2] == "B, A" and names["99", "mayor", 1] == "DOE, J"
    broken = {r["rule_id"]: r["n"] for r in K.summary(C.rules(contest, records)).collect()}
    assert broken["seats given"] == 1 and broken["ward held once in a race"] == 0 and broken["municipality known"] == 0


def test_names_with_nulls_and_oddities(spark):
    df = spark.createDataFrame([(None,), ("",), ("  ",), ("Jr.",), ("-, DOE",), ("a" * 20_000,)], "raw string")
    for how in (N.split_last_first, N.split_caps_surname, N.split_first_last):
        assert df.select(how(F.col("raw"))).count() == 6
    got = [r["c"] for r in df.select(N.candidate(F.lit("last_first"), F.col("raw")).alias("c")).collect()]
    assert got[0]["last_name"] == "" and got[0]["name_raw"] == ""
    assert [r[0] for r in df.select(N.is_well_formed(F.col("raw"))).collect()] == [False, False, False, True, True, True]


def test_stream(spark, tmp_path):
    schema = "id bigint, received_at timestamp"
    spark.createDataFrame([(1, dt.datetime(2026, 8, 1)), (1, dt.datetime(2026, 8, 2)), (2, dt.datetime(2026, 8, 1))], schema).write.parquet(f"{tmp_path}/in")
    stream = deliveries.without_repeats(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), ["id"], "received_at")
    deliveries.apply_batches(stream, lambda b: b.select("id"), f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 2]
