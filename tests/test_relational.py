import pytest
from pyspark.sql import functions as F

from hustings.operators import constraints as K
from hustings.operators import relational as R


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_unnest_and_renest(spark):
    df = spark.createDataFrame([(1, ["b", "a"]), (2, []), (3, None)], "k int, names array<string>")
    flat = R.unnest(df, "names", "pos", "name")
    assert rows(flat) == [(1, 0, "b"), (1, 1, "a")]
    assert R.unnest(df, "names", "pos", "name", outer=True).count() == 4
    back = R.renest(flat.orderBy(F.desc("pos")), ["k"], ["pos"], ["name"], "names").first()
    assert [r["name"] for r in back["names"]] == ["b", "a"]


def test_exclusion_with_nulls_and_bounds(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, "a")], "k int, s string")
    out = spark.createDataFrame([(1, "a"), (1, "a"), (9, "z"), (2, None)], "k int, s string")
    assert rows(R.exclude(df, out, ["k", "s"])) == [(2, None), (None, "a")]
    assert rows(R.exclusion_counts(df, out.distinct(), ["k", "s"])) == [(1, "a", 2), (2, None, 0), (9, "z", 0)]
    assert "broadcast" in R.control(out)._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in R.control(out, rows=2)._jdf.queryExecution().analyzed().toString().lower()


def test_coverage_is_null_safe(spark):
    a, b = spark.createDataFrame([(1,), (2,), (None,)], "k int"), spark.createDataFrame([(2,), (3,), (None,)], "k int")
    assert rows(R.coverage(a, b, ["k"])) == [(1, "left"), (3, "right")]


def test_overlay(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, None, 6), (3, "c", 7)], "k int, s string, n int")
    over = spark.createDataFrame([(1, "s", "a", "A"), (1, "n", "9", "1"), (2, "s", None, "B"), (4, "s", "x", "y")], "key int, column string, old_value string, new_value string")
    assert rows(R.overlay(df, over, "k", ["s", "n"])) == [(1, "A", 5), (2, "B", 6), (3, "c", 7)]
    assert rows(R.overlay_faults(df, over, "k", ["s", "n"])) == [(1, "n", "stale"), (4, "s", "target")]
    twice = df.union(df.filter("k = 1"))
    assert (1, "s", "target") in rows(R.overlay_faults(twice, over, "k", ["s", "n"]))


def test_remap(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    remap = spark.createDataFrame([(1, 2), (2, 3)], "old_key int, new_key int")
    assert rows(R.remap_keys(df, remap, "k")) == [(2,), (3,), (None,)]
    assert [r["old_key"] for r in R.remap_chains(remap).collect()] == [1]


def test_serve_equals_the_condition(spark):
    facts = spark.createDataFrame([("c", None, "m"), ("c", "W 1", "x"), ("c", "W 2", "y"), ("d", "W 1", "z")], "area string, part string, name string")
    own, wide = facts.filter("part IS NOT NULL"), facts.filter("part IS NULL").drop("part")
    domain = R.part_domain(own, "area", "part", "99")
    served = R.serve(wide, own, domain, "area", "part")
    slow = domain.alias("d").join(facts.alias("f"), F.expr("d.area = f.area AND (f.part IS NULL OR f.part = d.part)")).select("d.area", "d.part", "f.name")
    assert rows(served.select("area", "part", "name")) == rows(slow)


def test_dense_and_lookup(spark):
    domain = spark.createDataFrame([("c", "W"), ("d", "W")], "area string, part string")
    facts = spark.createDataFrame([("c", "W", "a", 1)], "area string, part string, stem string, n int")
    cells = R.dense(domain, {"stem": ["a", "b"]}, facts, ["area", "part", "stem"])
    assert cells.count() == 4 and cells.filter("n IS NOT NULL").count() == 1
    asked = spark.createDataFrame([("c", None), ("c", "W"), ("x", "W")], "area string, part string")
    assert [r["n"] for r in R.lookup(asked, facts.drop("stem"), ["area", "part"], {"part": "99"}).orderBy(F.desc_nulls_last("n")).collect()] == [1, None, None]


def test_groups_and_bags(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", None), (2, "a", "x"), (2, "a", None), (3, "", "b"), (3, "b", "")], "k int, s string, t string")
    assert rows(R.varying_groups(df, ["k"], ["s", "t"])) == [(2,), (3,)]
    assert rows(R.repeated_keys(df, ["k", "s"])) == [(1, "a", 2), (2, "a", 2)]
    assert R.bag_difference(df, df).collect() == []
    assert rows(R.bag_difference(df, df.distinct())) == [(1, "a", None, "left")]
    assert R.numbered(df, ["k"], "s", ["s", "t"], "s", 2).columns == ["k", "s1", "s2"]
    assert [r[0] for r in spark.createDataFrame([("b",), ("z",), (None,)], "s string").select(R.enum_rank("s", ["a", "b"])).collect()] == [2, 3, 3]


def test_constraints(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, None, 2), (2, "z", None)], "k int, s string, n int")
    rules = [K.unique("u", df, "k"), K.not_null("n", df, "n", "k", "warn"), K.known("known", df, "s", ["a"], "k"), K.holds("h", df, "n > 0", "k"), K.covered("c", df, df, "k"), K.same_rows("s", df, df.union(df))]
    assert {r["rule_id"]: r["n"] for r in K.summary(rules).collect()} == {"u": 1, "n": 1, "known": 2, "h": 1, "c": 0, "s": 1}
    assert {(r["rule_id"], r["key"]) for r in K.report(rules[:2]).collect()} == {("u", "1"), ("n", "2")}
    with pytest.raises(K.ConstraintError, match="u: 1 rows"):
        K.enforce(rules)
    assert K.enforce([rules[1], rules[4]]).count() == 2


def test_positions(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"), F.lit("x").alias("_own_name"))
    got = R.positions(df, [F.desc("k")], "place").collect()
    assert all(r["place"] == 1000 - r["k"] for r in got) and len(got) == 1000
    assert R.positions(df.limit(0), [F.asc("k")], "place").collect() == []


def test_positions_within_groups(spark):
    """A third of all rows in one group, which spreads over ranges; nulls are a group; ties lie where they lie."""
    rows = [("hot" if i % 3 == 0 else f"g{i % 11}" if i % 7 else None, i * 37 % 1000) for i in range(1000)]
    df = spark.createDataFrame(rows, "g string, k int").repartition(5)
    got = [tuple(r) for r in R.positions(df.withColumn("_range", F.lit("kept")).drop("_range"), [F.asc("k")], "place", by=["g"]).select("g", "k", "place").collect()]
    want = {(g, k, sum(h == g and j <= k for h, j in rows)) for g, k in rows}
    assert set(got) == want and len(got) == 1000
    assert R.positions(df.limit(0), [F.asc("k")], "place", by=["g"]).collect() == []
    tied = R.positions(spark.createDataFrame([("a", 1)] * 5, "g string, k int"), [F.asc("k")], "place", by=["g"]).collect()
    assert sorted(r["place"] for r in tied) == [1, 2, 3, 4, 5]
