import datetime as dt

from pyspark.sql import functions as F

from hustings.operators.snapshots import changed_values, served_index, snapshot_changes

SCHEMA = "entry_id bigint, build_no int, census_id string, ward string, mayor array<string>, coun_ward array<string>, coun_reg array<string>, received_at timestamp"
T = dt.datetime(2026, 8, 1)
H = dt.timedelta(hours=1)


def test_changes(spark):
    rows = [
        (1, 5, "c", "W 1", ["a", "b"], None, ["x"], T),
        (2, 5, "c", "W 2", ["a"], ["q"], None, T),
        (3, 5, "c", None, ["n"], None, None, T),
        (4, 6, "c", "W 1", ["b", "a", "a"], [], ["x", None], T),  # the same as a set
        (5, 6, "c", "W 3", [], [], [], T),
        (6, 6, "c", None, ["n"], None, None, T),
        (7, 7, "c", "W 1", ["a"], ["b"], ["x"], T),
        (8, 7, "c", "W 1", ["a", "b"], [], ["x"], T + H),  # corrected
        (9, 7, "c", "W 3", None, ["É"], None, T),
        (9, 7, "c", "W 3", None, ["É"], None, T),
        (10, 7, "c", None, None, None, None, None),
        (11, None, "c", "W 9", ["a"], None, None, T),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("k0", F.lit(1)).withColumn("change_kind", F.lit(1))
    got = snapshot_changes(df)
    assert got.columns == ["build_no", "census_id", "ward", "change_kind"]
    assert {tuple(r) for r in got.collect()} == {(6, "c", "W 2", "removed"), (6, "c", "W 3", "added"), (7, "c", "W 3", "changed"), (7, "c", None, "changed")}
    assert {(r["ward"], r["coun_ward_came"], r["mayor_went"]) for r in changed_values(df).collect()} == {("W 3", "É", ""), (None, "", "n")}


def test_values_between_lists_and_composition(spark):
    rows = [(1, 1, "c", "W", ["a"], ["b"], [], T), (2, 2, "c", "W", ["a", "b"], [], [], T), (3, 3, "c", "W", ["a", "b"], [], [], T), (4, 1, "d", "W", ["É"], None, None, T), (5, 2, "d", "W", ["É"], None, None, T)]
    assert {tuple(r) for r in snapshot_changes(spark.createDataFrame(rows, SCHEMA)).collect()} == {(2, "c", "W", "changed"), (2, "d", "W", "changed"), (3, "d", "W", "removed")}


def test_ties_one_build_and_nothing(spark):
    rows = [(1, 1, "c", "W", ["a"], None, None, T), (2, 1, "c", "W", ["b"], None, None, T), (3, 2, "c", "W", ["b"], None, None, T)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert snapshot_changes(df).collect() == []
    assert snapshot_changes(df.filter("build_no = 1")).collect() == []
    assert snapshot_changes(df.limit(0)).collect() == []


def test_a_later_run_indexes_only_what_is_new(spark, tmp_path):
    path = str(tmp_path / "index")
    rows = [(10 * b + i, b, "c", f"W {i}", ["a"], [f"x{b if i == b else 0}"], None, T) for b in (1, 2, 3) for i in range(1, 5) if i != b + 1]
    df = spark.createDataFrame(rows, SCHEMA)
    tables = len(spark.catalog.listTables())
    first = {tuple(r) for r in snapshot_changes(df.filter("build_no < 3"), path).collect()}
    read = []
    index = served_index(spark, path)
    assert index.last == 2
    written, index._write = index._write, lambda part: (read.append(part.select("snapshot").distinct().collect()), written(part))[1]
    second = {tuple(r)[:4] for r in index.load(df).collect()}
    assert [[r[0] for r in x] for x in read] == [[3]]
    assert first | second == {tuple(r) for r in snapshot_changes(df).collect()}
    # Only the last index is kept, in one folder; the catalog holds no table.
    assert len(list((tmp_path / "index").glob("load-*/snapshot=*"))) == 1 and index.last == 3
    assert len(spark.catalog.listTables()) == tables
    assert index.load(df).collect() == []
    again = served_index(spark, path)
    assert (again.last, again.buckets) == (3, 1)


def test_the_probe_shuffles_nothing(spark, tmp_path):
    rows = [(10 * b + i, b, "c", f"W {i}", ["a"], [f"x{b}"], None, T) for b in (1, 2) for i in range(50)]
    index = served_index(spark, str(tmp_path / "index"), buckets=4)
    plans, probe = [], index._probe
    index._probe = lambda *a: plans.append(probe(*a)) or plans[-1]
    assert index.load(spark.createDataFrame(rows, SCHEMA)).count() == 50
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plans[0].select("change_kind")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan and "Join" in plan
