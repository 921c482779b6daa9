"""Names on written-out cases, among them those that are rare or missing in the test tables."""

import pytest
from pyspark.sql import functions as F

from hustings.functions import names as N

LAST_FIRST = [("RAMOS, JR., Ana", "RAMOS, JR.", "Ana"), ("DOE, Jane", "DOE", "Jane"), ("Madonna", "Madonna", ""), ("LEE , Bo , Q", "LEE", "Bo, Q"), ("X, ii., Y", "X, ii.", "Y"), ("A, B, iii", "A", "B, iii"), ("A,,B", "A", ", B"), ("A,", "A", "")]
CAPS = [
    ("Jane VAN DER BERG", "VAN DER BERG", "Jane"), ("Jane Q. DOE", "Q. DOE", "Jane"), ("JANE DOE", "DOE", "JANE"), ("José ÁLVAREZ", "ÁLVAREZ", "José"), ("Jane Doe", "Doe", "Jane"),
    ("DOE Jane", "DOE Jane", ""), ("JANE Marie DOE", "JANE Marie DOE", ""), ("J. DOE", "DOE", "J."),
]
FIRST_LAST = [
    ("Jane Doe", "Doe", "Jane"), ("Jane Q. Doe Jr.", "Doe Jr.", "Jane Q."), ("Jan van der Berg", "van der Berg", "Jan"), ("Cher", "Cher", ""), ("Ana de la Cruz", "de la Cruz", "Ana"), ("Ann  Lee", "Lee", "Ann"),
    ("Jane Doe (JJ)", "Doe", "Jane (JJ)"), ('Jane "JJ" Marie Doe', "Doe", "Jane Marie (JJ)"), ("Ed Spinks, Jr.", "Spinks Jr.", "Ed"), ("", "", ""),
]
RANKS = {"meed": (None, 40), "taylor": (98, 5), "harrison": (372, 48), "lee": (200, 90), "rare": (1500, 4000), "elizabeth": (10, None), "ray": (400, 90)}
#: Middle names join the surname from the right until one doesn't.
VOTES = [
    ("Marianne Meed Ward", "Meed Ward", "Marianne"), ("Kasey Taylor Etreni", "Etreni", "Kasey Taylor"), ("Ann Harrison McIntyre", "Harrison McIntyre", "Ann"), ("Ann Elizabeth Thornton", "Thornton", "Ann Elizabeth"),
    ("Ann Meed Taylor Ward", "Ward", "Ann Meed Taylor"), ("Ann Taylor Meed Ward", "Meed Ward", "Ann Taylor"), ("Ann Q. Meed Rare Ward", "Meed Rare Ward", "Ann Q."), ("Ann Meed, Ward (Nan)", "Meed Ward", "Ann (Nan)"), ("Ann Meed de Wit jr", "Meed de Wit jr", "Ann"),
]


def split(spark, rows, how):
    df = spark.createDataFrame([(r[0],) for r in rows], "raw string").select("raw", how(F.col("raw")).alias("s"))
    return [(r["raw"], r["s"]["last"], r["s"]["first"]) for r in df.collect()]


def ranks():
    entry = lambda g, s: F.struct(F.lit(g).cast("int").alias("given_rank"), F.lit(s).cast("int").alias("surname_rank"))
    return F.create_map(*(x for k, (g, s) in RANKS.items() for x in (F.lit(k), entry(g, s))))


@pytest.mark.parametrize("rows,how", [(LAST_FIRST, N.split_last_first), (CAPS, N.split_caps_surname), (FIRST_LAST, N.split_first_last)])
def test_splits(spark, rows, how):
    assert split(spark, rows, how) == rows


def test_middle_names_are_voted_on(spark):
    assert split(spark, VOTES, lambda c: N.split_first_last(c, ranks())) == VOTES
    # Without ranks none joins.
    assert split(spark, VOTES[:1], N.split_first_last) == [("Marianne Meed Ward", "Ward", "Marianne Meed")]


def test_close_calls(spark):
    df = spark.createDataFrame([(v[0],) for v in VOTES], "raw string").select("raw", F.explode(N.close_calls(F.col("raw"), ranks())).alias("c"))
    got = {(r["raw"], r["c"]["token"], r["c"]["surname_like"]) for r in df.collect()}
    assert {("Marianne Meed Ward", "Meed", True), ("Kasey Taylor Etreni", "Taylor", False), ("Ann Harrison McIntyre", "Harrison", True)} <= got
    assert not [r for r in got if r[0] == "Ann Elizabeth Thornton"] and ("Ann Meed Taylor Ward", "Meed", True) not in got


def test_initials(spark):
    rows = [("J.", True), ("C", True), ("R.E.S.", True), ("É.", True), ("5.", False), ("Jo", False), ("J.E", False), ("", False)]
    assert [(r[0], r[1]) for r in spark.createDataFrame([(t,) for t, _ in rows], "t string").select("t", N.is_initial(F.col("t"))).collect()] == rows


def test_formats(spark):
    rows = [("last_first", "DOE, -", "DOE", ""), ("pre_split", "Doe, Jane", "DOE", "Jane"), ("first_last", "Jane  Doe, she/her", "DOE", "Jane"), ("caps_surname", "José VAN DYK", "VAN DYK", "José"), (None, "Jo Bo", "BO", "Jo"), ("last_first", None, "", "")]
    df = spark.createDataFrame([r[:2] for r in rows], "f string, raw string")
    got = df.select("f", "raw", N.candidate(F.col("f"), F.col("raw")).alias("c")).collect()
    assert [(r["f"], r["raw"], r["c"]["last_name"], r["c"]["first_name"]) for r in got] == rows
    with pytest.raises(Exception, match="unknown name format: backwards"):
        spark.createDataFrame([("backwards", "Jo Bo")], "f string, raw string").select(N.candidate(F.col("f"), F.col("raw"))).collect()


def test_tails_counts_and_literals(spark):
    one = lambda c, v: spark.createDataFrame([(v,)], "v string").select(c(F.col("v"))).first()[0]
    assert one(N.without_pronouns, "Sam ROY,THEY/them ") == "Sam ROY" and one(N.without_pronouns, "Al, Bo") == "Al, Bo"
    assert one(N.is_withdrawn, "Al Bo (Withdrawn)") and not one(N.is_withdrawn, "Al")
    assert [one(N.positive_count, v) for v in ("1", " 12 ", "0", "-1", "1.0", "", None)] == [1, 12, None, None, None, None, None]
    assert one(N.script_literal, "Roy (Ann) 'x'") == "Roy \\(Ann\\) \\'x\\'"
    assert one(N.odd_characters, "O'BOY-Roy, A. (B)’;*") == ";*"
