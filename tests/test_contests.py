"""The contest pipeline on written records: each rule kept, and each broken."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from hustings.operators import constraints as K
from hustings.operators.dewey import record_tables
from hustings.plans import contests as C
from hustings.session import materialise
from hustings.sources.writers import write_all, write_parquet

T = dt.datetime(2026, 8, 1)
SCHEMA = "record_id bigint, census_id string, csdname string, name_format string, notes map<string,string>, received_at timestamp, races string"


def race(office, scope, districts, n=None, seats=1, votes=1):
    return {"office": office, "scope": scope, "n_districts": len(districts) if n is None else n, "seats": seats, "max_votes": votes, "districts": districts}


def healthy():
    return {
        "mayor": [race("Mayor", "At-large", {"At-large": ["Jane Doe", "Jo Bo"]})],
        "ward": [race("Councillor", "Ward", {"Ward 1": ["Ann Lee"], "Ward 2": ["Al Roy", "Ed Day"]})],
        "regional councillor": [race("Regional Councillor", "Ward-pair", {"Wards 1 and 2": ["Cy Fox", "Di May", "Bo Ash"]}, seats=2, votes=2)],
    }


def flow(spark, docs, formats=None):
    rows = [(i, f"c{i}", f"Town {i}", (formats or {}).get(i), None, T, json.dumps(d)) for i, d in enumerate(docs)]
    records = C.latest_records(spark.createDataFrame(rows, SCHEMA))
    tables = record_tables(records)
    return records, tables, materialise(C.contests(records, tables))


def broken(spark, docs, formats=None, excluded=(("c0", "None"),), structure=(("c0", "Mayor"),), names=False, municipalities=None):
    _, tables, contest = flow(spark, docs, formats)
    known = spark.createDataFrame([(m,) for m in municipalities or [f"c{i}" for i in range(len(docs))]], "census_id string")
    told = spark.createDataFrame(list(structure), "census_id string, office string")
    shown = C.served_names(contest, tables) if names else None
    return {r["rule_id"]: r["n"] for r in K.summary(C.rules(contest, known, told, C.excluded_races(spark, excluded), shown)).collect() if r["n"]}


def test_all_rules_kept(spark):
    docs = [healthy() | {"atlarge": [race("Councillor, At-large", "At-large", {"At-large": ["Jo Bo"]})]}, healthy()]
    assert broken(spark, docs, excluded=(("c0", "Councillor, At-large"),), names=True) == {}


BREAKS = [
    ("name format known", lambda d: d, {"formats": {0: "backwards"}}),
    ("race key known", lambda d: d | {"reeve": [race("Reeve", "At-large", {"At-large": ["Jo Bo"]})]}, {}),
    ("no withdrawn name", lambda d: d | {"mayor": [race("Mayor", "At-large", {"At-large": ["Jane Doe", "Jo Bo (WITHDRAWN)"]})]}, {}),
    ("district has names", lambda d: d | {"mayor": [race("Mayor", "At-large", {"At-large": []})]}, {}),
    ("districts as told", lambda d: d | {"mayor": [race("Mayor", "At-large", {"At-large": ["Jo Bo"]}, n=2)]}, {}),
    ("seats given", lambda d: d | {"mayor": [race("Mayor", "At-large", {"At-large": ["Jo Bo"]}, seats=None)]}, {}),
    ("single vote", lambda d: d | {"mayor": [race("Mayor", "At-large", {"At-large": ["Jo Bo"]}, votes=2)]}, {}),
    ("pair splits", lambda d: d | {"regional councillor": [race("Regional Councillor", "Ward-pair", {"North and South": ["Cy Fox"]})]}, {}),
    ("ward held once in a race", lambda d: d | {"regional councillor": [race("Regional Councillor", "Ward-pair", {"Wards 1, 2": ["Cy Fox"], "Wards 2, 3": ["Di May"]})]}, {}),
    ("ward in one race of a stem", lambda d: d | {"ward": [*d["ward"], race("Councillor, Second Tier", "Ward", {"Ward 2": ["Di May"]})]}, {}),
    ("scope fits the stem", lambda d: d | {"atlarge": [race("Councillor, At-large", "Ward", {"Ward 1": ["Di May"]})]}, {}),
    ("contest key unique", lambda d: d | {"atlarge": [race("Mayor", "At-large", {"At-large": ["Di May"]})]}, {}),
    ("mayor stands", lambda d: {k: v for k, v in d.items() if k != "mayor"}, {"structure": ()}),
    ("a council race", lambda d: {k: v for k, v in d.items() if k != "ward"}, {}),
    ("municipality known", lambda d: d, {"municipalities": ["c1"]}),
    ("municipality collected", lambda d: d, {"municipalities": ["c0", "c1", "c9"]}),
    ("office collected", lambda d: d, {"structure": (("c0", "Mayor"), ("c0", "Reeve"))}),
    ("exclusion unique", lambda d: d, {"excluded": (("c0", "Councillor, At-large"),) * 2}),
    ("exclusion removes", lambda d: d, {"excluded": (("c0", "Councillor, At-large"), ("c0", "Reeve"))}),
    ("surname given", lambda d: d | {"mayor": [race("Mayor", "At-large", {"At-large": [", Jo", "Jane Doe"]})]}, {"formats": {0: "last_first"}, "names": True}),
    ("ranked characters only", lambda d: d | {"mayor": [race("Mayor", "At-large", {"At-large": ["Jo B*o"]})]}, {"names": True}),
]


def test_each_rule_broken(spark):
    """Every break in a municipality of its own, so that one run tells them all."""
    docs, formats, structure, excluded, missing = [healthy() | {"atlarge": [race("Councillor, At-large", "At-large", {"At-large": ["Jo Bo"]})]}], {}, [], [("c0", "Councillor, At-large")] * 2 + [("c0", "Reeve")], []
    for i, (rule, change, options) in enumerate(BREAKS, 1):
        docs.append(change(healthy()))
        formats |= {i: f for f in options.get("formats", {}).values()}
        structure += [(f"c{i}", office) for _, office in options.get("structure", ()) if office != "Mayor"]
        missing += [f"c{i}"] if rule == "municipality known" else []
    known = [f"c{i}" for i in range(len(docs)) if f"c{i}" not in missing] + ["c999"]
    got = broken(spark, docs, formats, tuple(excluded), tuple(structure), True, known)
    # What breaks one rule breaks some others: the at-large contest of a ward differs from ward to ward, and a name without surname isn't well formed.
    assert set(got) == {rule for rule, _, _ in BREAKS} | {"shared half the same in all wards", "name well formed"}
    assert all(got[rule] == 1 for rule in ("name format known", "race key known", "no withdrawn name", "single vote", "pair splits", "municipality known", "municipality collected", "office collected", "exclusion unique", "mayor stands"))


def test_general_rules(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 1), ("b", "x", 1), ("b", "x", 2)], "g string, m string, v int")
    rules = [K.invariant("same", df, ["g"], ["v"]), K.same_members("members", df, ["g"], "m", ["x", "y"]), K.disjoint("apart", df.filter("g = 'a'"), df.filter("g = 'b'"), "m"), K.claimed_once("once", df, ["g", "m"])]
    assert {(r["rule_id"], r["key"]) for r in K.report(rules).collect()} == {("same", "b"), ("members", "b"), ("apart", "x"), ("once", "b|x")}


def test_fields_are_blank_where_something_is_unknown(spark):
    docs = [healthy() | {"regional councillor": [race("R1", "At-large", {"At-large": ["A B", "C D"]}, seats=2, votes=2), race("R2", "At-large", {"At-large": ["E F"]}, seats=None, votes=None)]}]
    got = {(r["ward"], r["stem"]): (r["served"], r["accl"], r["max_votes"]) for r in C.served_fields(flow(spark, docs)[2]).collect()}
    assert len(got) == 15
    assert got["Ward 1", "reg_coun"] == (1, None, None)
    assert got["Ward 1", "ward"] == (1, 1, 1) and got["99", "ward"] == (0, None, None)
    # Neither flag nor votes for the offices with a single vote.
    assert got["Ward 1", "mayor"] == (None, 0, None) and got["99", "dep_mayor"] == (None, None, None)


def test_pairs_that_cannot_be_split_are_served_to_no_ward(spark):
    docs = [healthy() | {"regional councillor": [race("R", "Ward-pair", {"North and South": ["Cy Fox"], "Wards 1, 5": ["Di May"]})]}]
    got = {(r["ward"], r["stem"]) for r in C.served_fields(flow(spark, docs)[2]).filter("served = 1").collect()}
    assert {w for w, s in got if s == "reg_coun"} == {"Ward 1", "Ward 5"}


def test_order_of_counts_and_ballot(spark):
    docs = [healthy() | {"atlarge": [race("Councillor, At-large", "At-large", {"At-large": ["A B", "C D"]})], "deputy mayor": [race("Deputy", "At-large", {"At-large": ["E F", "G H"]})]}]
    rows = C.contest_counts(flow(spark, docs)[2]).orderBy("place").collect()
    assert [r["race_key"] for r in rows] == ["regional councillor", "mayor", "deputy mayor", "atlarge", "ward", "ward"]
    assert rows[0]["retrieved"] == C.RETRIEVED


def test_structure_rows_tie_break_and_fallback(spark):
    docs = [{"regional councillor": [race("R", "Ward", {"Ward 1": ["A B"], "Ward 2": ["C D"]}, votes=2), race("R", "Ward", {"Ward 3": ["E F"]}, votes=1), race("S", "Ward", {"Ward 4": ["G H"]}), race("R", "Ward", {"Ward 5": ["G H"]}, n=9)]}]
    structure = [(1, "c0", "R", 1, 1, "u1; v1;", None), (2, "c0", "R", 2, 2, "u2", "m2"), (3, "c0", "R", 2, 2, "u3", None)]
    told = spark.createDataFrame(structure, "row_id bigint, census_id string, office string, n_districts int, max_votes int, district_source_url string, max_votes_source string")
    got = {r["race_pos"]: r for r in C.structure_rows(flow(spark, docs)[2], told).collect()}
    assert [got[i]["row_id"] for i in range(4)] == [2, 1, None, 1] and [got[i]["agrees"] for i in range(4)] == [True, True, False, False]
    assert got[1]["district_source_url"] == ["u1", "v1"] and got[2]["not_in_structure"]


def test_names_report_and_judgement_calls(spark):
    docs = [healthy() | {"mayor": [race("Mayor", "At-large", {"At-large": ["Marianne Meed Ward", "Ann (Nan) Taylor Etreni", "Jo Bo (withdrawn)"]})]}]
    records, tables, contest = flow(spark, docs)
    ranks = spark.createDataFrame([("Meed", None, 40), ("meed", None, 90), ("Taylor", 98, 5)], "token string, given_rank int, surname_rank int")
    names = {r["name"] for r in C.served_names(contest, tables, ranks).filter("name_field = 'mayor'").collect()}
    assert names == {"MEED WARD, Marianne", "ETRENI, Ann Taylor (Nan)"}
    assert {(r["token"], r["surname_like"]) for r in C.judgement_calls(tables, records, ranks).collect()} == {("Meed", True), ("Taylor", False)}
    report = {(r["section"], r["item"]): r["n"] for r in C.run_report(contest, C.excluded_races(spark, [("c0", "Councillor"), ("c0", "Reeve")])).collect()}
    assert report["totals", "candidates"] == 5 and report["excluded", "c0 Councillor"] == 3 and report["excluded", "c0 Reeve"] == 0
    assert report["widest", "coun_reg c0 Ward 1"] == 3


def test_nothing_is_written_while_a_rule_is_broken(spark, tmp_path):
    _, _, contest = flow(spark, [healthy() | {"mayor": [race("Mayor", "At-large", {"At-large": []})]}])
    known = spark.createDataFrame([("c0",)], "census_id string")
    with pytest.raises(K.ConstraintError, match="district has names"):
        write_all(C.rules(contest, known), [(write_parquet, C.served_fields(contest), str(tmp_path / "out"))])
    assert not (tmp_path / "out").exists()


def test_empty(spark):
    _, _, contest = flow(spark, [healthy()])
    none = contest.filter(F.lit(False))
    assert C.contest_counts(none).collect() == [] and C.served_fields(none).collect() == []
