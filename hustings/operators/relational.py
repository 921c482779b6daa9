"""Relational operators over any DataFrames: unnesting, keyed exclusion, overlays, completion, serving, order and comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hustings.session import materialise

#: A control table (exclusions, overrides, remaps) up to this many rows is broadcast; its size is counted, not assumed.
CONTROL_ROWS = 100_000


def control(df: DataFrame, rows: int = CONTROL_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most so many rows; else as it is, to be joined by a shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


# --- nesting ---------------------------------------------------------------------------------------------------------


def unnest(df: DataFrame, array: str, position: str, value: str, outer: bool = False) -> DataFrame:
    """One row per element of an array with its position from 0; ``outer`` keeps rows whose array is null or empty."""
    explode = F.posexplode_outer if outer else F.posexplode
    return df.select("*", explode(array).alias(position, value)).drop(array)


def renest(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str], name: str) -> DataFrame:
    """One row per key with its rows as an array of structs in the given order."""
    rows = F.array_sort(F.collect_list(F.struct(*order, *(F.col(v).alias(f"value_{v}") for v in values))))
    return df.groupBy(*keys).agg(F.transform(rows, lambda r: F.struct(*(r[f"value_{v}"].alias(v) for v in values))).alias(name))


def ordered_join(value: str, order: str, separator: str) -> Column:
    """An aggregate: the distinct values in order of their first place, joined to one string."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v")))), lambda r: r["v"])
    return F.array_join(F.array_distinct(ordered), separator)


# --- keyed removal and lookup ----------------------------------------------------------------------------------------


def exclude(df: DataFrame, excluded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key isn't excluded; null keys are never excluded."""
    return df.join(control(excluded.select(*keys).distinct()), list(keys), "left_anti")


def exclusion_counts(df: DataFrame, excluded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each exclusion with the number of rows that it removes, 0 included."""
    hit = df.join(control(excluded.select(*keys).distinct()), list(keys), "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("n_dropped"))
    return excluded.select(*keys).join(hit, list(keys), "left").withColumn("n_dropped", F.coalesce("n_dropped", F.lit(0)))


def coverage(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that only one side has, with that side's name; null keys count as equal."""
    a = left.select(*keys).distinct().withColumn("in_left", F.lit(True))
    b = right.select(*keys).distinct().withColumn("in_right", F.lit(True))
    on = reduce(lambda x, y: x & y, (a[k].eqNullSafe(b[k]) for k in keys))
    both = a.join(b, on, "full_outer").filter("in_left IS NULL OR in_right IS NULL")
    return both.select(*(F.when(F.col("in_left"), a[k]).otherwise(b[k]).alias(k) for k in keys), F.when(F.col("in_left"), "left").otherwise("right").alias("side"))


def ranked_pick(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group in the given order, which should name every row's place."""
    return df.withColumn("_pick", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter("_pick = 1").drop("_pick")


def first_of(df: DataFrame, by: Sequence[str], order: Column) -> DataFrame:
    """(by, first): the least value of ``order``, a struct, of each group; aggregated before the shuffle, so a hot group gathers nowhere."""
    return df.groupBy(*by).agg(F.min(order).alias("first"))


def lookup(asked: DataFrame, served: DataFrame, keys: Sequence[str], sentinel: Mapping[str, str]) -> DataFrame:
    """Asked rows with what is served for them; a missing key part reads as its sentinel, an unknown one stays unmatched."""
    filled = asked.withColumns({k: F.coalesce(k, F.lit(v)) for k, v in sentinel.items()})
    return filled.join(served, list(keys), "left")


def serve(at_large: DataFrame, own: DataFrame, domain: DataFrame, area: str, part: str) -> DataFrame:
    """What each part of an area gets: all of the area's rows, and those of the part itself.

    Written as the union of two equi-joins, which is what the condition "at large, or the same part" comes to.
    """
    wide = domain.join(at_large, [area])
    return wide.unionByName(domain.join(own, [area, part]).select(*wide.columns))


def part_domain(df: DataFrame, area: str, part: str, sentinel: str) -> DataFrame:
    """Every (area, part) that occurs, and for each area the part that stands for none."""
    return df.select(area, part).distinct().union(df.select(area, F.lit(sentinel)).distinct()).distinct()


def dense(domain: DataFrame, axis: Mapping[str, Sequence], facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row of ``domain`` with every value of a stated short list, and the facts of that cell or nulls.

    ``axis``: {column: values}; the list is part of the plan, so nothing is collected.
    """
    ((name, values),) = axis.items()
    cells = domain.withColumn(name, F.explode(F.array(*map(F.lit, values))))
    return cells.join(facts, list(keys), "left")


# --- overlays --------------------------------------------------------------------------------------------------------


def remap_keys(df: DataFrame, remap: DataFrame, key: str) -> DataFrame:
    """``df`` with keys replaced after ``remap`` (old_key, new_key); others stay."""
    new = control(remap.select(F.col("old_key").alias(key), "new_key"))
    return df.join(new, key, "left").withColumn(key, F.coalesce("new_key", key)).select(*df.columns)


def remap_chains(remap: DataFrame) -> DataFrame:
    """Rows of a remap whose target is remapped again: one join doesn't follow chains, so they are faults."""
    again = remap.select(F.col("old_key").alias("new_key")).distinct()
    return remap.join(again, "new_key", "left_semi")


def overlay(df: DataFrame, overrides: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``df`` with cells overwritten by ``overrides`` (key, column, old_value, new_value) where the cell is what it says it was.

    Old values are compared as strings, nulls being equal; new values are cast to the column's type.
    """
    wanted = overrides.filter(F.col("column").isin(*columns))
    cells = wanted.groupBy(F.col("key").alias(key)).agg(F.map_from_entries(F.collect_list(F.struct("column", F.struct("old_value", "new_value")))).alias("_over"))
    joined = df.join(control(cells), key, "left")
    cell = lambda c: F.try_element_at("_over", F.lit(c))
    fits = lambda c: cell(c).isNotNull() & F.col(c).cast("string").eqNullSafe(cell(c)["old_value"])
    return joined.withColumns({c: F.when(fits(c), cell(c)["new_value"].cast(df.schema[c].dataType)).otherwise(F.col(c)) for c in columns}).select(*df.columns)


def overlay_faults(df: DataFrame, overrides: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, column, fault): overrides that meet no row or several (``target``), or another value than they say (``stale``)."""
    long = df.select(F.col(key).alias("key"), F.explode(F.create_map(*(x for c in columns for x in (F.lit(c), F.col(c).cast("string"))))).alias("column", "current"))
    met = overrides.join(long, ["key", "column"], "left").groupBy("key", "column", "old_value").agg(
        F.count(F.when(F.col("current").isNotNull() | F.col("old_value").isNull(), 1)).alias("n"),
        F.bool_or(~F.col("current").eqNullSafe(F.col("old_value"))).alias("differs"),
        F.count("current").alias("found"),
    )
    rows = df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    met = met.join(rows, "key", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    fault = F.when(F.col("rows") != 1, "target").when(F.col("differs"), "stale")
    return met.select("key", "column", fault.alias("fault")).filter("fault IS NOT NULL")


# --- groups ----------------------------------------------------------------------------------------------------------


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that stand more than once, with their number."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def varying_groups(df: DataFrame, by: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """Groups in which the attributes aren't the same in every row, nulls being a value."""
    hashed = F.xxhash64(*(x for i, a in enumerate(attributes) for x in (F.lit(i), F.col(a).isNull(), F.col(a))))
    return df.groupBy(*by).agg(F.min(hashed).alias("_a"), F.max(hashed).alias("_b")).filter("_a <> _b").select(*by)


def split_shared(df: DataFrame, area: str, part: str, shared: Sequence[str], own: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The half that is the same in every part of an area, once for each area, and the half of each part."""
    return df.select(area, *shared).distinct(), df.select(area, part, *own)


def join_shared(shared: DataFrame, own: DataFrame, area: str) -> DataFrame:
    """The two halves as one again."""
    return own.join(shared, area)


def numbered(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str], name: str, most: int) -> DataFrame:
    """Values as columns name1..nameN in order; N is given, so the columns don't depend on the data."""
    ranked = df.withColumn("_at", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_at") <= most)
    return ranked.groupBy(*keys).agg(*(F.max(F.when(F.col("_at") == i, F.col(value))).alias(f"{name}{i}") for i in range(1, most + 1)))


def positions(df: DataFrame, order: Sequence[Column], name: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows with their place from 1 in one order over the whole table, or over each group of ``by``, without one task that holds table or group.

    The table is parted by ranges of group and order, places are counted within each and moved by the sizes of those before it.  Null
    groups are a group.  A group that lies in one range needs no more than that range.
    """
    ranged = materialise(df.repartitionByRange(*map(F.col, by), *order).withColumn("_range", F.spark_partition_id()))
    keys = [F.col(b).alias(f"_by{i}") for i, b in enumerate(by)]
    sizes = ranged.groupBy("_range", *keys).count()
    # One row for each range that a group lies in.
    before = (Window.partitionBy(*(f"_by{i}" for i in range(len(by)))) if by else Window.partitionBy(F.lit(0))).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("count").over(before), F.lit(0))).filter("_before > 0").drop("count").withColumnRenamed("_range", "_in")
    own = F.row_number().over(Window.partitionBy("_range", *by).orderBy(*order))
    on = reduce(lambda x, y: x & y, (F.col(b).eqNullSafe(F.col(f"_by{i}")) for i, b in enumerate(by)), F.col("_range") == F.col("_in"))
    placed = ranged.withColumn("_own", own).join(control(offsets), on, "left")
    return placed.withColumn(name, (F.col("_own") + F.coalesce("_before", F.lit(0))).cast("bigint")).drop("_range", "_in", "_own", "_before", *(f"_by{i}" for i in range(len(by))))


def bag_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either table that the other lacks, counting repeats, nulls being equal; none if both hold the same."""
    b = b.select(*a.columns)
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def collated(value: str | Column, collation: str = "UNICODE") -> Column:
    """A sort key: the collation's order; the result's type carries it, so cast to string before writing."""
    return F.collate(value if isinstance(value, Column) else F.col(value), collation)


def in_order(marks: str, collation: str = "UNICODE") -> Column:
    """An array of places: where the collation puts each of the marks, between two letters, among all of them."""
    held = F.array(*(F.collate(F.lit(f"A{m}A"), collation) for m in marks))
    return F.transform(held, lambda x: F.size(F.filter(held, lambda y: y <= x)))


def enum_rank(value: str, order: Sequence[str]) -> Column:
    """The place of a value in a list from 1; what isn't in it comes after."""
    at = F.array_position(F.array(*map(F.lit, order)), F.col(value))
    return F.coalesce(F.nullif(at, F.lit(0)), F.lit(len(order) + 1)).cast("bigint")
