import random
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hustings.llm.canonical import canonical_text, lookalike_classes, lookalike_pairs, reference_form, splice

POOL = [chr(c) for c in [*range(0x20, 0x250), *range(0x370, 0x600), *range(0x1100, 0x1200), *range(0x2000, 0x2200), *range(0xAC00, 0xAC40), *range(0xFB00, 0xFB07), *range(0xFF00, 0xFFF0)] if unicodedata.category(chr(c)) != "Cn"]
POOL += list("̣́̈​͏ e⁣") * 40


@given(st.text(st.sampled_from(POOL), max_size=16))
@settings(max_examples=600, deadline=None)
def test_splicing_equals_normalising_the_whole(text):
    form = splice(text)
    assert form == reference_form(text)
    assert splice(form) == form
    kept = splice(text, letters=False)
    assert kept == reference_form(text, letters=False) and splice(kept, letters=False) == kept
    # Both forms compare alike.
    assert splice(kept) == form


def test_forms(spark):
    cases = {
        "ＤＵＸ，　Ｊｏｓｅ́": "DUX, José",
        "Dai⁣thí": "Daithí",
        "​О’ВОУ­, Anne‑Marie": "O’BOY, Anne-Marie",
        "Eﬃcia Ⅿiⅼes": "Efficia Miles",
        "БОЙЧЕЙ": "БOЙЧEЙ",
        " a   b　": "a b",
        "a\tb": "a b",
        "x²": "x²",
        "": "",
        "plain": "plain",
        "é" * 30_000: "é" * 30_000,
    }
    df = spark.createDataFrame([(k,) for k in [*cases, None]], "t string")
    got = {r["t"]: r["c"] for r in df.select("t", canonical_text(F.col("t"), single_line=True).alias("c")).collect()}
    assert got == {**cases, None: None}


def test_text_form_keeps_words_of_other_scripts(spark):
    cases = {"БОЙЧЕЙ": "БОЙЧЕЙ", "Ко́т и пес": "Ко́т и пес", "O’ВОУ, Ｊо": "O’BOY, Jo", "Ελλάς": "Ελλάς", "Wаrd 1": "Ward 1", "a–b": "a-b"}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r["t"]: r["c"] for r in df.select("t", canonical_text(F.col("t"), single_line=True, key=False).alias("c")).collect()} == cases


def look(s):
    return " ".join(reference_form(s).replace("\t", " ").split())


def test_pairs_equal_brute_force(spark):
    rng = random.Random(5)
    writings = ["DUX, Jo", "DUX, Jo", "ＤＵＸ, Jo", "DÚX, Jo", "DÚX, Jo", "DUX,Jo", "dux, Jo", "DUХ, Jo", None]
    wards = ["Ward 1", "Ｗard 1", "Ward 2", "Ward 1", None]
    rows = [(i, rng.choice(["c", "d", None]), rng.choice(["mayor", "ward"]), rng.choice(wards), rng.choice(writings)) for i in range(160)]
    rows += rows[:5]
    want = set()
    for a in rows:
        for b in rows:
            if a[0] < b[0] and None not in a and None not in b and a[1:3] == b[1:3] and a[3:] != b[3:] and look(a[3]) == look(b[3]) and look(a[4]) == look(b[4]):
                want.add((a[0], b[0]))
    df = spark.createDataFrame(rows, "name_id bigint, census_id string, name_field string, ward string, cand_name string").withColumn("id", F.lit(0)).withColumn("c0", F.lit(0))
    for together in (2_000, 3):  # classes whole, and split over several tasks
        got = [tuple(r) for r in lookalike_pairs(df, "name_id", ["census_id", "name_field"], ["ward", "cand_name"], together).collect()]
        assert len(got) == len(set(got)) and set(got) == want and want
    classes = [tuple(r) for r in lookalike_classes(df, "name_id", ["census_id", "name_field"], ["ward", "cand_name"]).collect()]
    assert {(a[1], b[1]) for a in classes for b in classes if a[0] == b[0] and a[2] != b[2] and a[1] < b[1]} == want
    assert lookalike_classes(df.limit(0), "name_id", ["census_id", "name_field"], ["ward", "cand_name"]).collect() == []
    assert lookalike_pairs(df.limit(0), "name_id", ["census_id", "name_field"], ["ward", "cand_name"]).collect() == []
