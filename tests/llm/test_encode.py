import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hustings.llm import encode as E

pytestmark = pytest.mark.skipif(not os.path.exists(os.path.join(E.TOKENIZERS, E.RANK_FILE)), reason="no tokenizer files")

TEXTS = [None, "", " ", "a", "It's <|endoftext|> here.\r\n\r\n", "的" * 9_000 + "，的", "word " * 20_000, "x" * 50_000, " " * 20_000, "^" * 20_000, "\u0000é\U0001f600", "1234 a1b2 'sabc 'S"]


def test_parts_give_the_ids_of_the_whole():
    enc = E.encoding(E.read_ranks())

    @given(st.text(st.sampled_from("ab'sdT 1２,.;的，\n\t é!—l<|>_"), max_size=120), st.integers(1, 20))
    @settings(max_examples=500, deadline=None)
    def run(text, size):
        parts = list(E.safe_parts(text, size))
        assert "".join(parts) == text
        assert [i for p in parts for i in enc.encode_ordinary(p)] == enc.encode_ordinary(text)

    run()


def test_ids_equal_the_other_library_and_round_trip(spark):
    tokenizers = pytest.importorskip("tokenizers")
    other = tokenizers.Tokenizer.from_file(os.path.join(E.TOKENIZERS, "byte_bpe_50k.json"))
    other.encode_special_tokens = True
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string").withColumn("ids", F.lit("x")).withColumn("n_tokens", F.lit(1))
    got = {r["doc_id"]: list(r["ids"]) for r in E.encode(df).collect()}
    assert got == {i: other.encode(t, add_special_tokens=False).ids if t else [] for i, t in enumerate(TEXTS)}
    raw = {r["doc_id"]: bytes(r["raw"]).decode() for r in E.decode(E.encode(df)).collect()}
    assert raw == {i: t or "" for i, t in enumerate(TEXTS)}
    assert {r["doc_id"]: r["n_tokens"] for r in E.token_counts(df).collect()} == {i: len(x) for i, x in got.items()}


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id bigint, text string")
    assert E.encode(df).count() == 3
    assert E.encode(df.limit(0)).collect() == []
    assert E.encode(df).schema.simpleString() == "struct<doc_id:bigint,ids:array<int>>"
