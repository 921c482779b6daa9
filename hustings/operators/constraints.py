"""Integrity constraints: each is a query of the rows that break it, all are told together, and nothing is written until none is left."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hustings.operators.relational import varying_groups


class ConstraintError(ValueError):
    """Some constraint doesn't hold; the message names each with examples."""


@dataclass(frozen=True)
class Rule:
    """``violations`` gives the breaking rows of its input; ``key`` names one of them."""

    rule_id: str
    violations: Callable[[], DataFrame]
    key: Column
    severity: str = "error"


def not_null(rule_id: str, df: DataFrame, column: str, key: str, severity: str = "error") -> Rule:
    return Rule(rule_id, lambda: df.filter(F.col(column).isNull()), F.col(key).cast("string"), severity)


def holds(rule_id: str, df: DataFrame, condition: str, key: str, severity: str = "error") -> Rule:
    """The condition holds in every row; a null outcome breaks it."""
    return Rule(rule_id, lambda: df.filter(~F.coalesce(F.expr(condition), F.lit(False))), F.col(key).cast("string"), severity)


def unique(rule_id: str, df: DataFrame, *keys: str) -> Rule:
    return Rule(rule_id, lambda: df.groupBy(*keys).count().filter("count > 1"), F.concat_ws("|", *(F.col(k).cast("string") for k in keys)))


def known(rule_id: str, df: DataFrame, column: str, values: Iterable[str], key: str) -> Rule:
    return Rule(rule_id, lambda: df.filter(~F.coalesce(F.col(column).isin(*values), F.lit(False))), F.col(key).cast("string"))


def covered(rule_id: str, df: DataFrame, other: DataFrame, *keys: str) -> Rule:
    """Every key of ``df`` is in ``other``."""
    return Rule(rule_id, lambda: df.select(*keys).distinct().join(other.select(*keys).distinct(), list(keys), "left_anti"), F.concat_ws("|", *(F.col(k).cast("string") for k in keys)))


def claimed_once(rule_id: str, df: DataFrame, keys: list[str]) -> Rule:
    """No key is claimed by several rows."""
    return unique(rule_id, df, *keys)


def invariant(rule_id: str, df: DataFrame, by: list[str], attributes: list[str]) -> Rule:
    """The attributes are the same in every row of a group, nulls being a value."""
    return Rule(rule_id, lambda: varying_groups(df, by, attributes), F.concat_ws("|", *(F.col(k).cast("string") for k in by)))


def same_members(rule_id: str, df: DataFrame, by: list[str], member: str, expected: Iterable[str]) -> Rule:
    """Every group has exactly the expected members."""
    wanted = F.array(*(F.lit(x) for x in sorted(expected)))

    def differ() -> DataFrame:
        return df.groupBy(*by).agg(F.array_sort(F.collect_set(member)).alias("members")).filter(F.col("members") != wanted)

    return Rule(rule_id, differ, F.concat_ws("|", *(F.col(k).cast("string") for k in by)))


def disjoint(rule_id: str, left: DataFrame, right: DataFrame, *keys: str) -> Rule:
    """No key is on both sides."""
    return Rule(rule_id, lambda: left.select(*keys).intersect(right.select(*keys)), F.concat_ws("|", *(F.col(k).cast("string") for k in keys)))


def empty(rule_id: str, violations: Callable[[], DataFrame], key: str) -> Rule:
    """A query expected to give nothing."""
    return Rule(rule_id, violations, F.col(key).cast("string"))


def same_rows(rule_id: str, before: DataFrame, after: DataFrame) -> Rule:
    """A join has neither lost nor multiplied rows."""

    def differ() -> DataFrame:
        n = before.agg(F.count(F.lit(1)).alias("a")).crossJoin(after.agg(F.count(F.lit(1)).alias("b")))  # one row each
        return n.filter("a <> b").select(F.concat_ws(" rows, then ", "a", "b").alias("told"))

    return Rule(rule_id, differ, F.col("told"))


def report(rules: Iterable[Rule]) -> DataFrame:
    """(rule_id, severity, key): every violation of every rule."""
    return reduce(DataFrame.unionByName, (r.violations().select(F.lit(r.rule_id).alias("rule_id"), F.lit(r.severity).alias("severity"), r.key.alias("key")) for r in rules))


def summary(rules: Iterable[Rule]) -> DataFrame:
    """(rule_id, severity, n): the number of violations of each rule, 0 included."""
    counts = (r.violations().agg(F.count(F.lit(1)).alias("n")).select(F.lit(r.rule_id).alias("rule_id"), F.lit(r.severity).alias("severity"), "n") for r in rules)
    return reduce(DataFrame.unionByName, counts)


def enforce(rules: Iterable[Rule], examples: int = 5) -> DataFrame:
    """Raises if a rule of severity error is broken, naming all that are; returns the summary, warnings in it."""
    rules = list(rules)
    told = summary(rules).collect()
    broken = {r["rule_id"]: r["n"] for r in told if r["n"] and r["severity"] == "error"}
    if broken:
        some = {r.rule_id: [x[0] for x in r.violations().select(r.key).limit(examples).collect()] for r in rules if r.rule_id in broken}
        raise ConstraintError("; ".join(f"{k}: {n} rows, such as {some[k]}" for k, n in broken.items()))
    return summary(rules)
