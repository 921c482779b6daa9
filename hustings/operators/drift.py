"""Schemas that drift between deliveries: one consistent table, and a report of each change.

Method: *tagged-union inference*.  The schemas of all deliveries are fused into
one in which every path keeps each alternative type it was seen with; a value is
held in the branch of its type beside one canonical form.  What appears, goes,
moves or changes type between a delivery and the one before is reported.

Everything runs on Spark's VARIANT type.  Fields gone and fields come are
compared by an order-free signature of their values, so no pairs are formed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hustings.operators.relational import control
from hustings.session import materialise, spread

PAYLOAD = "struct<name: string, shared: struct<fields: map<string, variant>>, wards: map<string, struct<fields: map<string, variant>>>>"
#: The alternative types of a path; a set of them is the sum of their numbers.
KIND_BITS = {"number": 1, "string": 2, "boolean": 4, "array": 8, "object": 16}


def json_body(payload: Column) -> Column:
    """The JSON of a served file, with or without its script wrapping: comment lines, ``window.X =``, a closing semicolon."""
    return F.regexp_replace(F.regexp_replace(payload, r"^﻿?\s*(?:(?://[^\n]*\n|/\*(?s:.*?)\*/)\s*)*(?:(?:window\.|var |const |let )[\w.]*\s*=\s*)?", ""), r"\s*;?\s*$", "")


def value_kind(v: Column) -> Column:
    """number, string, boolean, array or object; blank, null and missing values have none."""
    t = F.schema_of_variant(v)
    text = F.try_variant_get(v, "$", "string")
    return (
        F.when(v.isNull() | (t == "VOID"), None)
        .when(t == "STRING", F.when(F.trim(text) != "", "string"))
        .when(t == "BOOLEAN", "boolean")
        .when(t.startswith("ARRAY"), "array")
        .when(t.startswith("OBJECT"), "object")
        .otherwise("number")
    )


def deliveries(df: DataFrame) -> DataFrame:
    """(census_id, build_no, body): of each municipality and build the readable delivery received last.

    At equal times the highest record_id counts.  Rows without census_id or build_no are left out; so are unreadable
    payloads, which are no delivery.  Taking the first of a ranking is limited before the shuffle, so a build
    delivered again and again gathers in no task.
    """
    body = F.from_json(json_body(F.col("payload")), PAYLOAD)
    read = spread(df.select("record_id", "census_id", "build_no", "received_at", "payload")).select("record_id", "census_id", "build_no", "received_at", body.alias("body")).filter(
        F.col("census_id").isNotNull() & F.col("build_no").isNotNull() & (F.col("body.wards").isNotNull() | F.col("body.shared").isNotNull())
    )
    last = Window.partitionBy("census_id", "build_no").orderBy(F.desc_nulls_last("received_at"), F.desc_nulls_last("record_id"))
    return read.withColumn("rank", F.row_number().over(last)).filter("rank = 1").select("census_id", "build_no", "body")


def _signature(rows: DataFrame, by: list[str]) -> DataFrame:
    """An order-free signature of (ward, value) pairs: their number, the sum and the exclusive or of their hashes."""
    h = F.xxhash64("ward", "value")
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(38,0)")).alias("total"), F.bit_xor(F.xxhash64("value", F.lit("#"), "ward")).alias("mix"))


def drift(df: DataFrame) -> DataFrame:
    """(census_id, build_no, change_kind, old_field, new_field): changes between each delivered build and the one before.

    A field is ``wards.X`` or ``shared.X``.  ``renamed``: the old field goes, the new one comes, and their values agree in every
    ward of both builds, a shared value counting for every ward and blank, null and missing values being equal.  Of several that
    fit, the one that keeps X is taken, then they are matched in order of their names, each once.  Else ``removed``, ``added``;
    ``retyped`` if the JSON types of the non-blank values differ, both builds having some.
    """
    delivered = materialise(deliveries(df))
    # Keys and changes are joined to the payloads, so that the payloads aren't shuffled while the others are few; their number is counted.
    builds = delivered.select("census_id", "build_no").withColumn("next", F.lead("build_no").over(Window.partitionBy("census_id").orderBy("build_no")))
    builds = materialise(builds.withColumn("first", F.row_number().over(Window.partitionBy("census_id").orderBy("build_no")) == 1))
    # Each build's rows take part twice: as the later side of one comparison and as the older side of the next.
    sides = F.explode(
        F.filter(
            F.array(
                F.when(~F.col("first"), F.struct(F.col("build_no").alias("target"), F.lit(True).alias("later"))),
                F.when(F.col("next").isNotNull(), F.struct(F.col("next").alias("target"), F.lit(False).alias("later"))),
            ),
            lambda x: x.isNotNull(),
        )
    )
    sided = delivered.join(control(builds), ["census_id", "build_no"]).select("census_id", "body", sides.alias("side")).select("census_id", F.col("side.target").alias("build_no"), F.col("side.later").alias("later"), "body")
    key = ["census_id", "build_no"]

    parted = lambda d: d.select(*key, "later", F.lit("shared").alias("half"), F.lit(None).cast("string").alias("ward"), F.explode("body.shared.fields").alias("member", "v")).unionByName(
        d.select(*key, "later", F.explode("body.wards").alias("ward", "entry")).select(*key, "later", F.lit("wards").alias("half"), "ward", F.explode("entry.fields").alias("member", "v"))
    )
    kind = value_kind(F.col("v"))
    bits = F.coalesce(F.create_map(*(F.lit(x) for kv in KIND_BITS.items() for x in kv))[F.col("kind")], F.lit(0))
    values = parted(sided).select(*key, "later", "half", "member", "ward", kind.alias("kind"), F.to_json("v").alias("value"))
    fields = values.groupBy(*key, "half", "member").agg(
        F.bool_or("later").alias("is_new"),
        F.bool_or(~F.col("later")).alias("is_old"),
        F.bit_or(F.when(F.col("later"), bits).otherwise(0)).alias("new_bits"),
        F.bit_or(F.when(F.col("later"), F.lit(0)).otherwise(bits)).alias("old_bits"),
    )
    fields = materialise(fields.filter("is_new <> is_old OR (new_bits <> old_bits AND new_bits <> 0 AND old_bits <> 0)"))
    field = F.concat_ws(".", "half", "member")
    retyped = fields.filter("is_new AND is_old").select(*key, F.lit("retyped").alias("change_kind"), field.alias("old_field"), field.alias("new_field"))
    moved = fields.filter("is_new <> is_old").select(*key, "half", "member", F.col("is_new").alias("later"))

    # Values matter only where in one comparison fields go as well as come, and only in the wards of both builds.
    both = moved.groupBy(*key).agg(F.bool_or("later").alias("comes"), F.bool_or(~F.col("later")).alias("goes")).filter("comes AND goes").select(*key)
    both = control(materialise(both))
    compared = sided.join(both, key, "left_semi")
    common = (
        compared.select(*key, "later", F.explode(F.map_keys("body.wards")).alias("ward"))
        .groupBy(*key, "ward").agg(F.bool_or("later").alias("a"), F.bool_or(~F.col("later")).alias("b")).filter("a AND b").select(*key, "ward")
    )
    common = materialise(common)
    full = parted(compared).select(*key, "later", "half", "member", "ward", kind.alias("kind"), F.to_json("v").alias("value")).filter("kind IS NOT NULL")
    full = full.join(control(moved), [*key, "half", "member", "later"], "left_semi")
    own = full.filter("half = 'wards'").join(control(common), [*key, "ward"], "left_semi")
    shared = full.filter("half = 'shared'").drop("ward").join(control(common), key).select(own.columns)
    signed = moved.join(both, key, "left_semi").join(_signature(own.unionByName(shared), [*key, "half", "member", "later"]), [*key, "half", "member", "later"], "left")
    signed = signed.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n", "total", "mix")})
    alike = [*key, "n", "total", "mix"]

    # The same X in the other half fits first: at most one of each goes and comes.
    kept = Window.partitionBy(*alike, "member")
    signed = signed.withColumn("keeps", F.max(F.col("later").cast("int")).over(kept) - F.min(F.col("later").cast("int")).over(kept) == 1)
    order = Window.partitionBy(*alike, "later", "keeps").orderBy(F.when(F.col("keeps"), F.col("member")), "half", "member")
    slot = F.when(F.col("keeps"), F.concat(F.lit("="), "member")).otherwise(F.row_number().over(order).cast("string"))
    paired = (
        signed.withColumn("slot", slot).withColumn("field", field)
        .groupBy(*alike, "keeps", "slot").agg(F.max(F.when(~F.col("later"), F.col("field"))).alias("old_field"), F.max(F.when(F.col("later"), F.col("field"))).alias("new_field"))
    )
    alone = moved.join(both, key, "left_anti").select(*key, F.when(~F.col("later"), field).alias("old_field"), F.when(F.col("later"), field).alias("new_field"))
    told = paired.select(*key, "old_field", "new_field").unionByName(alone)
    change = F.when(F.col("old_field").isNull(), "added").when(F.col("new_field").isNull(), "removed").otherwise("renamed")
    told = told.select(*key, change.alias("change_kind"), F.coalesce("old_field", F.lit("")).alias("old_field"), F.coalesce("new_field", F.lit("")).alias("new_field"))
    return told.unionByName(retyped)


def _entries(v: Column) -> Column:
    """The members of an object; anything else is a leaf, held under the empty name."""
    return F.coalesce(F.try_variant_get(v, "$", "map<string, variant>"), F.create_map(F.lit(""), v))


def leaves(df: DataFrame) -> DataFrame:
    """(census_id, build_no, half, ward, section, member, v): every leaf of the delivery received last of each municipality and build.

    ``half`` is ``shared``, ``wards`` or, for other members of the payload, ``record``; ``section`` is ``fields``, ``names`` or whatever else
    an entry holds.  What isn't an object where one is expected is a leaf with an empty ``section`` or ``member``.
    """
    doc = F.try_parse_json(json_body(F.col("payload")))
    read = spread(df.select("record_id", "census_id", "build_no", "received_at", "payload")).select("record_id", "census_id", "build_no", "received_at", doc.alias("doc"))
    part = lambda name: F.try_variant_get("doc", f"$.{name}", "map<string, variant>")
    read = read.filter(F.col("census_id").isNotNull() & F.col("build_no").isNotNull() & (part("wards").isNotNull() | part("shared").isNotNull()))
    last = Window.partitionBy("census_id", "build_no").orderBy(F.desc_nulls_last("received_at"), F.desc_nulls_last("record_id"))
    read = read.withColumn("rank", F.row_number().over(last)).filter("rank = 1")
    key = ["census_id", "build_no"]
    top = read.select(*key, F.explode(_entries(F.col("doc"))).alias("half", "held"))
    # Labels of wards are data; the shared half has none.
    in_wards = F.transform(F.map_entries(_entries(F.col("held"))), lambda e: F.struct(e["key"].alias("ward"), e["value"].alias("entry")))
    entry = F.when(F.col("half") == "wards", in_wards).otherwise(F.array(F.struct(F.lit(None).cast("string").alias("ward"), F.col("held").alias("entry"))))
    entries = top.select(*key, "half", F.explode(entry).alias("e")).select(*key, "half", "e.ward", "e.entry")
    halved = F.col("half").isin("shared", "wards")
    sections = entries.select(*key, "half", "ward", F.explode(F.when(halved, _entries(F.col("entry"))).otherwise(F.create_map("half", "entry"))).alias("section", "held"))
    members = sections.select(*key, "half", "ward", "section", F.explode(F.when(halved, _entries(F.col("held"))).otherwise(F.create_map("section", "held"))).alias("member", "v"))
    return members.select(*key, F.when(halved, F.col("half")).otherwise("record").alias("half"), "ward", F.when(halved, F.col("section")).otherwise("").alias("section"), "member", "v")


def fused_schema(df: DataFrame) -> DataFrame:
    """(half, section, member, kind, n, first_build, last_build): the schema inferred from all deliveries, each alternative type of a path with when it appears."""
    rows = leaves(df).withColumn("kind", value_kind(F.col("v"))).filter("kind IS NOT NULL")
    return rows.groupBy("half", "section", "member", "kind").agg(F.count(F.lit(1)).alias("n"), F.min("build_no").alias("first_build"), F.max("build_no").alias("last_build"))


#: A name is another form of a common one if at least so many renames, and more than this share of all it takes part in, are to or from that one.
LEAST_RENAMES, RENAME_SHARE = 2, 0.5


def aliases(changes: DataFrame, common: DataFrame) -> DataFrame:
    """(member, canonical_member): other names of the common fields, by the renames found between all builds.

    ``changes`` as ``drift`` gives them, ``common`` (member).  A rename that fits by chance links names once; names that a
    municipality really uses for a field are renamed to and from it again and again, so the field with most of a name's renames is taken.
    """
    bare = lambda c: F.regexp_replace(c, r"^(?:wards|shared)\.", "")
    pairs = changes.filter("change_kind = 'renamed'").select(bare("old_field").alias("a"), bare("new_field").alias("b")).filter("a <> b")
    both = pairs.union(pairs.select("b", "a")).groupBy(F.col("a").alias("member"), F.col("b").alias("other")).agg(F.count(F.lit(1)).alias("n"))
    known = common.select(F.col("member").alias("other")).distinct()
    total = both.groupBy("member").agg(F.sum("n").alias("total"))
    best = both.join(known, "other", "left_semi").groupBy("member").agg(F.max(F.struct("n", F.col("other"))).alias("best"))
    fits = best.join(total, "member").filter((F.col("best.n") >= LEAST_RENAMES) & (F.col("best.n") > RENAME_SHARE * F.col("total")))
    return fits.join(common.select("member").distinct(), "member", "left_anti").select("member", F.col("best.other").alias("canonical_member"))


def tagged_union(df: DataFrame, common: DataFrame | None = None) -> DataFrame:
    """The consistent table: one row per leaf of every payload, with a branch for each type, and one canonical form.

    ``as_number``, ``as_text``, ``as_boolean``, ``as_array`` and ``as_object`` hold the value in the branch of its own type; blank, null and missing
    values are in none.  ``canonical_text`` is what all types of a field come to: ``true`` is ``1``, ``2.0``, ``"2"`` and ``["2"]`` are
    ``2``, other texts without blanks at their ends, other arrays and objects their JSON; ``canonical`` is the integer it stands for, null
    where it stands for none.  ``alternatives`` names the types that the path was seen with in any delivery.  ``canonical_member`` is the
    common name of a field that was renamed (``common``: (member), the common fields; without it names stay).
    """
    rows = leaves(df).withColumn("kind", value_kind(F.col("v")))
    kinds = fused_schema(df).groupBy("half", "section", "member").agg(F.array_sort(F.collect_set("kind")).alias("alternatives"))
    named = aliases(drift(df), common) if common is not None else None
    tagged = rows.join(control(materialise(kinds)), ["half", "section", "member"], "left")
    if named is not None:
        tagged = tagged.join(control(materialise(named.select(F.lit("fields").alias("section"), "member", "canonical_member"))), ["section", "member"], "left")
    else:
        tagged = tagged.withColumn("canonical_member", F.lit(None).cast("string"))
    scalar = F.try_variant_get("v", "$", "string")
    only = F.try_variant_get("v", "$", "array<string>")
    one = F.when((F.col("kind") == "array") & (F.size(only) == 1), F.get(only, F.lit(0))).when(F.col("kind").isin("array", "object"), F.to_json("v")).otherwise(scalar)
    text = F.trim(one)
    text = F.when(F.lower(text) == "true", "1").when(F.lower(text) == "false", "0").otherwise(F.regexp_replace(text, r"^([+-]?[0-9]+)\.0+$", "$1"))
    branch = lambda kind, c: F.when(F.col("kind") == kind, c)
    return tagged.withColumn("canonical_text", F.when(F.col("kind").isNotNull(), text)).select(
        "census_id", "build_no", "half", "ward", "section", "member", F.coalesce("canonical_member", "member").alias("canonical_member"), "kind",
        branch("number", F.try_variant_get("v", "$", "double")).alias("as_number"),
        branch("string", scalar).alias("as_text"),
        branch("boolean", F.try_variant_get("v", "$", "boolean")).alias("as_boolean"),
        branch("array", F.to_json("v")).alias("as_array"),
        branch("object", F.to_json("v")).alias("as_object"),
        F.when(F.col("canonical_text").rlike("^[+-]?[0-9]{1,10}$"), F.col("canonical_text").try_cast("int")).alias("canonical"),
        "canonical_text",
        F.coalesce("alternatives", F.array().cast("array<string>")).alias("alternatives"),
    )
