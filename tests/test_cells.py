import random

import pytest
from pyspark.sql import functions as F

from hustings.operators.cells import resolve_list, skeletons, split_cells

LISTS = [
    ("Old Mill;Écluse;Foundry, East", 3, ["Old Mill", "Écluse", "Foundry, East"]),
    ("Copper Row; Priory, Saddleback", 3, ["Copper Row", "Priory", "Saddleback"]),
    ('"The ""Beacon"" Lands", “Rosedene/Flats”, Market,', None, ['The "Beacon" Lands', "Rosedene/Flats", "Market"]),
    ("Canal,Lakeview/Heights,Market", 3, ["Canal", "Lakeview/Heights", "Market"]),
    ("Wards 1; 3, 4；10", 4, ["Wards 1", "3", "4", "10"]),
    ("10&1;2&4;;8&7;", 3, ["10&1", "2&4", "8&7"]),
    ('["Wards 1", "7", "The \\"X\\" Lands"]', 3, ["Wards 1", "7", 'The "X" Lands']),
    ("Wards 1-8", 8, ["Wards 1-8"]),
    (" Station\nCanal;Millrace, South", 3, ["Station", "Canal", "Millrace, South"]),
    ('"unbalanced;b', None, ['"unbalanced', "b"]),
    ("", 2, []),
    (" \t\n", 2, []),
    (None, 2, []),
    (";;,", None, []),
    ('"A" "B; C";D', None, ['"A" "B; C"', "D"]),
    ("a" * 50_000 + ";b", None, ["a" * 50_000, "b"]),
]
SOURCES = [
    ("https://a.example/x;v=3; https://b.example/list;a,b,http://c.example/y", ["https://a.example/x;v=3", "https://b.example/list;a,b", "http://c.example/y"]),
    ("https://a.example/x?a=1&b=x|y|https://b.example", ["https://a.example/x?a=1&b=x|y", "https://b.example"]),
    ("http://a.example/1 and http://b.example/2", ["http://a.example/1", "http://b.example/2"]),
    ("https://a.example/?u=https://m.example/9", ["https://a.example/?u=https://m.example/9"]),
    ("Clerk's email of 2026-05-10;By-law 2010-090", ["Clerk's email of 2026-05-10", "By-law 2010-090"]),
    ('SOURCES.md section 3; "https://a.example/b,2019"', ["SOURCES.md section 3", "https://a.example/b,2019"]),
    ('https://a.example "https://b.example/x"', ["https://a.example", "https://b.example/x"]),
    ("https://a.example/1, and https://b.example/2", ["https://a.example/1", "https://b.example/2"]),
    ("By-law 7,https://a.example/1,x y", ["By-law 7", "https://a.example/1,x y"]),
    ("https://a.example/en;", ["https://a.example/en"]),
    ("https://a.example/map(ward,5).pdf\nhttps://b.example", ["https://a.example/map(ward,5).pdf", "https://b.example"]),
]


def values(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["row_id"], r["pos"])):
        out.setdefault(r["row_id"], []).append(r["val"])
    return out


@pytest.mark.parametrize("broadcast", [1 << 20, -1])
def test_lists(spark, broadcast):
    rows = [(i, cell, n) for i, (cell, n, _) in enumerate(LISTS)]
    df = spark.createDataFrame(rows, "row_id bigint, districts string, n int")
    got = split_cells(df, "row_id", "districts", "list", count="n", broadcast_bytes=broadcast)
    assert values(got) == {i: v for i, (_, _, v) in enumerate(LISTS) if v}
    assert {(r["row_id"], r["n_values"]) for r in got.collect()} == {(i, len(v)) for i, (_, _, v) in enumerate(LISTS) if v}


def test_sources(spark):
    df = spark.createDataFrame([(i, cell) for i, (cell, _) in enumerate(SOURCES)], "row_id bigint, cell string")
    assert values(split_cells(df, "row_id", "cell", "source")) == {i: v for i, (_, v) in enumerate(SOURCES)}


def test_repeats_clashes_and_nothing(spark):
    df = spark.createDataFrame([(1, "a;b"), (1, "a;b"), (None, "c;d")], "row_id bigint, cell string")
    clashing = df.withColumns({c: F.lit("x") for c in ("tokens", "skeleton", "n", "json", "spans", "val", "pos")})
    got = split_cells(clashing, "row_id", "cell", "list")
    assert got.count() == 6
    assert got.columns == ["row_id", "n_values", "pos", "val"]
    assert split_cells(df.limit(0), "row_id", "cell", "list").collect() == []


def test_many_kinds_of_separators_fit_the_number(spark):
    seps = ["\n", "\t", ";", "；", "|", "•", "·", ",", "，", "/", "\n ", "; ", "； ", ", "]
    cell = "a" + "".join(sep + "a" for sep in seps)
    # Every kind of separator there is, twice.  The weakest is left out first.
    every = [c + b for c in "\n\t;；|•·,，/" for b in ("", " ")]
    twice = "a" + "".join(sep + "a" for sep in every * 2)
    rows = [(-1, cell, None)] + [(n, cell, n) for n in range(1, 16)] + [(100 + n, twice, n) for n in (39, 21, 40)]
    got = values(split_cells(spark.createDataFrame(rows, "row_id bigint, cell string, n int"), "row_id", "cell", "list", count="n"))
    assert {k: len(v) for k, v in got.items()} == {-1: 15, **{n: n for n in range(1, 16)}, 139: 39, 121: 21, 140: 41}  # no choice gives 40
    assert "a/a" in got[139]


def test_left_out_kinds_equal_brute_force():
    from itertools import combinations

    rng = random.Random(2)
    for _ in range(300):
        kinds = {f"0{c}{rng.randint(0, 1)}": rng.randint(1, 5) for c in rng.sample("abcdefghij", rng.randint(1, 7))}
        excess = rng.randint(1, 12)
        weakest = sorted(kinds, reverse=True)
        fits = (set(x) for k in range(1, len(weakest) + 1) for x in combinations(weakest, k) if sum(kinds[y] for y in x) == excess)
        assert set(resolve_list(" ".join(f"{k}*{n}" for k, n in kinds.items()), excess)) == next(fits, set())


def test_rules_are_few(spark):
    """The number of values isn't part of a rule unless a choice has to meet it."""
    rows = [(i, "; ".join(f"Ward {j}" for j in range(1, i + 2)), i + 1) for i in range(60)] + [(100 + i, ",".join(map(str, range(i + 2))), None) for i in range(60)]
    df = spark.createDataFrame(rows, "row_id bigint, cell string, n int").withColumn("json", F.lit(None).cast("array<string>"))
    assert skeletons(df, "list").filter("skeleton IS NOT NULL").select("skeleton", "excess").distinct().count() == 2
