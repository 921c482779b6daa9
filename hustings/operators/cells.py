"""Several values packed in one cell: one row per value, position kept.

Method: *delimiter skeletons*.  Every cell is cut into tokens by one regular
expression: values, and the separators between them, a run of which counts as
one of the strongest kind in it.  Ordinary characters are masked, so that what
remains is the skeleton of separators.  The splitting rule is resolved once per
distinct skeleton (not per row).  The rules are joined back - broadcast while
their measured size is under a bound, shuffled beyond it - and the values are
cut out by position with built-in array expressions, so no Python runs per cell.

Two kinds of cell are known:

``list``
    A list of labels.  Where the number of values is given, kinds of separators
    are left out so that this number comes out: as few kinds as can be, the
    weakest first; else, and where no choice gives it, every separator
    separates.  Which kinds a rule leaves out depends only on how often each
    kind stands in the cell, so skeletons are kinds and, where the number has to
    be met, their counts: runs of value and separator are collapsed.
``source``
    Addresses and citations.  A separator separates if a blank, a line end or
    a new address follows, or if the value before it isn't an address.  A blank
    before a new address separates too, with or without the word ``and``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hustings.session import materialise

#: Separators of lists, strongest first, and of sources.
LIST_SEPARATORS = "\n\t;；|•·,，/"
SOURCE_SEPARATORS = "\n\t;；|,，"
#: A word that says where a place lies; after a comma it often belongs to the name before it.
DIRECTIONS = ("north", "south", "east", "west", "centre", "center", "nord", "sud", "est", "ouest")
#: Rules up to this many bytes are broadcast; more of them are joined by a shuffle.
RULE_BROADCAST_BYTES = 16 << 20

_BLANK = " \u00a0\u2002\u2003\u2009\u202f\u3000\r"
_ADDRESS = r"(?:https?://|www\.)"
_TRIM = rf"^[{_BLANK}\n\t]+|[{_BLANK}\n\t]+$"


def _parts(kind: str) -> dict[str, str]:
    """The pieces of the token pattern: separators, quoted values, separator runs and values."""
    s = "".join("\\" + c if c in "|/" else c for c in (LIST_SEPARATORS if kind == "list" else SOURCE_SEPARATORS))
    b = _BLANK
    opening = rf"[\"“]?{_ADDRESS}"
    ends = rf"[{s}]|$" if kind == "list" else rf"[{s}]|$|(?:and[{b}]+)?{_ADDRESS}"
    # Quotes protect what stands in them if they open where a value can start and close before its end.
    quoted = rf"(?:\"(?:[^\"]|\"\")*+\"|“[^”]*+”)(?=[{b}]*(?:{ends}))"
    run = rf"[{b}]*[{s}](?:[{b}]*[{s}])*[{b}]*"
    go_on = rf"(?!{quoted})"
    if kind == "source":
        run = rf"{run}(?:and[{b}]+(?={opening}))?|[{b}]+(?:and[{b}]+)?(?={opening})"
        go_on = rf"(?!{opening}|and[{b}]+{opening}|{quoted})"
    value = rf"[^{s}{b}]+(?:[{b}]++{go_on}[^{s}{b}]+)*+"
    return {"run": run, "quoted": rf"(?=[\"“])(?<=^|[{s}{b}]){quoted}", "value": value, "any": s}


def _token_pattern(kind: str) -> str:
    p = _parts(kind)
    return rf"{p['quoted']}|{p['run']}|{p['value']}|[{_BLANK}]+"


def tokens(cell: Column, kind: str) -> Column:
    """The cell as an array of tokens; joined again they give the cell."""
    return F.regexp_extract_all(cell, F.lit(_token_pattern(kind)), F.lit(0))


def _separates(token: Column, kind: str) -> Column:
    """Whether a token is a run of separators; a quoted value isn't, nor are blanks alone.  Values begin with neither."""
    first = F.substring(token, 1, 1)
    held = F.lit(LIST_SEPARATORS if kind == "list" else SOURCE_SEPARATORS)
    return F.when(held.contains(first), F.lit(True)).when(F.lit(_BLANK).contains(first), F.translate(token, _BLANK, "") != "").otherwise(False)


def _cuts(token: Column, after: Column, kind: str) -> Column:
    """Whether a token may cut: a run of separators or, in sources, a blank before a new address."""
    if kind == "list":
        return _separates(token, kind)
    return _separates(token, kind) | F.when(F.lit(_BLANK).contains(F.substring(token, 1, 1)), F.coalesce(after.rlike(rf'^["“]?{_ADDRESS}'), F.lit(False))).otherwise(False)


def _list_kind(token: Column, after: Column) -> Column:
    """A separator's kind; kinds sort from the strongest to the weakest.

    A direction after a comma and a slash without blanks are the weakest.
    """
    spaced = F.lit(_BLANK).contains(F.substring(token, -1, 1))
    place = F.lit(len(LIST_SEPARATORS))
    for i, c in reversed(list(enumerate(LIST_SEPARATORS))):
        place = F.when(token.contains(c), F.lit(i)).otherwise(place)
    commas = tuple(LIST_SEPARATORS.index(c) for c in ",，")
    slash = LIST_SEPARATORS.index("/")
    weak = F.when(place.isin(*commas) & F.lower(after).isin(*DIRECTIONS), "2").when((place == slash) & ~spaced, "2").otherwise("0")
    return F.concat(weak, F.substring(F.lit("abcdefghijklmnop"), place + 1, F.lit(1)), F.when(spaced, "1").otherwise("0"))


def _tight(token: Column, after: Column) -> Column:
    """Whether a separator that cuts may yet belong to an address: neither a blank, a line end nor a new address follows."""
    return ~F.lit(_BLANK).contains(F.substring(token, -1, 1)) & ~token.contains("\n") & ~token.contains("\t") & F.coalesce(~after.rlike(rf'^["“]?{_ADDRESS}'), F.lit(False))


def _source_mask(token: Column, after: Column) -> Column:
    """One character a token: U an address, a another value, s a separator that is sure to separate, t one that may belong to an address."""
    return F.when(_cuts(token, after, "source"), F.when(_tight(token, after), "t").otherwise("s")).when(token.rlike(rf'^["“]?{_ADDRESS}'), "U").otherwise("a")


def resolve_list(skeleton: str, excess: int) -> list[str]:
    """The kinds of separators to leave out so that ``excess`` values fewer come out: as few kinds as can be, the weakest first.

    ``skeleton``: the kinds with their counts, such as ``0c1*3 2h1*2``.  Exact for any number of kinds; nothing if no choice fits.
    """
    kinds = sorted(((k, int(n)) for k, n in (x.split("*") for x in skeleton.split(" ") if "*" in x)), reverse=True)
    # The best choice among the kinds from each on, for every number of values left out; the strongest kinds come in first.
    best: dict[int, tuple[str, ...]] = {0: ()}
    for k, n in reversed(kinds):
        with_it = {left + n: (k, *chosen) for left, chosen in best.items() if left + n <= excess}
        for left, chosen in with_it.items():
            if left not in best or len(chosen) <= len(best[left]):
                best[left] = chosen
    return list(best.get(excess, ()))


def resolve_source(skeleton: str) -> list[int]:
    """The places, from 1, of the separators that separate."""
    cuts, head = [], ""
    for i, c in enumerate(skeleton, 1):
        if c == "s" or c == "t" and head != "U":
            cuts.append(i)
            head = ""
        elif not head:
            head = c
    return cuts


def _resolved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        lists = pdf["kind"] == "list"
        pdf["left_out"] = [resolve_list(s, int(n)) if known and n else [] for known, s, n in zip(lists, pdf["skeleton"], pdf["excess"])]
        # Where nothing is in doubt every separator separates, and no places are needed.
        pdf["cuts"] = [resolve_source(s) if not known and "t" in s else None for known, s in zip(lists, pdf["skeleton"])]
        yield pdf[["kind", "skeleton", "excess", "left_out", "cuts"]]


def split_rules(skeletons: DataFrame) -> DataFrame:
    """The rule of each distinct (kind, skeleton, excess): the kinds of separators left out, or the places of those that separate."""
    return skeletons.mapInPandas(_resolved, "kind string, skeleton string, excess int, left_out array<string>, cuts array<int>")


def skeletons(df: DataFrame, kind: str) -> DataFrame:
    """(row_id, cell, n) with ``several`` (whether something separates), ``tokens``, ``cut`` (whether each may cut), ``kinds`` (of separators), ``skeleton`` and ``excess``; null where nothing separates.

    Where nothing is in doubt the skeleton is the separators that occur, each once; else, in lists, the kinds of separators with
    their counts, and in sources the mask of the whole cell.
    """
    p = _parts(kind)
    opening = rf"[{_BLANK}][\"“]?{_ADDRESS}"
    # A separator at the end of a cell belongs to no value.
    bare = F.regexp_replace("cell", rf"^[{p['any']}{_BLANK}]+|[{p['any']}{_BLANK}]+$", "")
    several = F.col("bare").rlike(rf"[{p['any']}]" if kind == "list" else rf"[{p['any']}]|{opening}") & F.col("json").isNull()
    out = df.withColumn("bare", bare).withColumn("several", several).withColumn("tokens", F.when(F.col("several"), tokens(F.col("bare"), kind)))
    after = lambda i: F.get("tokens", i + 1)
    out = out.withColumn("cut", F.transform("tokens", lambda t, i: _cuts(t, after(i), kind)))
    separators = F.array_distinct(F.filter("tokens", lambda t, i: F.get("cut", i)))
    plain = F.array_join(F.array_sort(separators), "·")
    if kind == "source":
        doubt = F.exists(F.filter(F.transform("tokens", lambda t, i: F.when(F.get("cut", i), _tight(t, after(i)))), lambda x: x.isNotNull()), lambda x: x)
        masked = F.array_join(F.transform("tokens", lambda t, i: _source_mask(t, after(i))), "")
        return out.withColumn("skeleton", F.when(doubt, masked).otherwise(F.regexp_replace(plain, "t", ""))).withColumn("excess", F.lit(0)).withColumn("kinds", F.lit(None).cast("array<string>"))
    values = F.size(F.filter("cut", lambda c: c)) + 1 - F.size(F.filter("tokens", lambda t: t.isin('""', "“”")))
    out = out.withColumn("excess", F.when(F.col("n") >= 1, F.greatest(F.lit(0), values - F.col("n"))).otherwise(0))
    out = out.withColumn("kinds", F.when(F.col("excess") > 0, F.transform("tokens", lambda t, i: F.when(F.get("cut", i), _list_kind(t, after(i))))))
    present = F.array_compact("kinds")
    counted = F.transform(F.array_sort(F.array_distinct(present)), lambda k: F.concat(k, F.lit("*"), F.size(F.filter("kinds", lambda x: x == k)).cast("string")))
    return out.withColumn("skeleton", F.when(F.col("excess") > 0, F.array_join(counted, " ")).otherwise(plain))


def _unquoted(v: Column) -> Column:
    """A value, which has no blanks at its ends, without the quotes around it; blanks at the ends of what they hold go too."""
    plain = v.rlike(r'^"(?:[^"]|"")*+"$')
    curly = v.rlike("^“[^”]*+”$")
    inner = F.substring(v, F.lit(2), F.length(v) - 2)
    held = F.when(plain, F.replace(inner, F.lit('""'), F.lit('"'))).when(curly, inner).otherwise(v)
    return F.when(F.substring(v, 1, 1).isin('"', "“"), F.regexp_replace(held, _TRIM, "")).otherwise(v)


def split_cells(df: DataFrame, row_id: str, cell: str, kind: str, count: str | None = None, broadcast_bytes: int = RULE_BROADCAST_BYTES) -> DataFrame:
    """(row_id, n_values, pos, val): the values of ``df[cell]`` with their position from 1 over the non-empty ones.

    Null and blank cells give no rows; a cell without separator gives one.  A cell that is a JSON array of
    strings is split as one.  Rows repeated in ``df`` are split each on their own; other columns, whatever
    their names, are left out.  Unbalanced quotes count as ordinary characters.
    """
    if kind not in ("list", "source"):
        raise ValueError(f"unknown kind of cell: {kind}")
    n = F.coalesce(F.col(count).cast("int"), F.lit(-1)) if count else F.lit(-1)
    cells = (
        df.select(F.col(row_id).alias("row_id"), F.col(cell).alias("cell"), n.alias("n"))
        .filter(F.col("cell").rlike(rf"[^{_BLANK}\n\t]"))
        .withColumn("json", F.when(F.col("cell").rlike(r'(?s)^\s*\[\s*(".*")?\s*\]\s*$'), F.from_json("cell", "array<string>", {"mode": "PERMISSIVE"})))
    )
    cells = skeletons(cells, kind)
    # Filtered by what is cheap: a filter on the skeleton would be pushed below and work it out once more.
    distinct = cells.filter("several").select(F.lit(kind).alias("kind"), "skeleton", "excess").distinct()
    rules = materialise(split_rules(distinct)).select(F.col("skeleton").alias("rule_skeleton"), F.col("excess").alias("rule_excess"), "left_out", "cuts")
    size = rules.agg(F.sum(F.length("rule_skeleton") * 4 + F.size("left_out") * 16 + F.coalesce(F.size("cuts"), F.lit(0)) * 8 + 96)).first()[0] or 0
    rules = F.broadcast(rules) if size <= broadcast_bytes else rules
    ruled = cells.join(rules, (F.col("skeleton") == F.col("rule_skeleton")) & (F.col("excess") == F.col("rule_excess")), "left")
    every = F.filter(F.sequence(F.lit(1), F.size("tokens")), lambda i: F.get("cut", i - 1))
    left = F.filter(every, lambda i: ~F.array_contains("left_out", F.get("kinds", i - 1)))
    chosen = F.when(F.col("cuts").isNotNull(), F.col("cuts")).when(F.size("left_out") > 0, left).otherwise(every)
    ruled = ruled.withColumn("at", F.concat(F.array(F.lit(0)), chosen, F.array(F.size("tokens") + 1)))
    spans = F.zip_with(F.slice("at", 1, F.size("at") - 1), F.slice("at", 2, F.size("at") - 1), lambda a, b: F.array_join(F.slice("tokens", a + 1, b - a - 1), ""))
    # Values and separators in turn, all of which separate: the values are what is left without them.
    in_turn = F.col("cuts").isNull() & (F.size("left_out") == 0) & (F.size("tokens") == 2 * F.size(F.filter("cut", lambda c: c)) + 1)
    spans = F.when(in_turn, F.filter("tokens", lambda t, i: ~F.get("cut", i))).otherwise(spans)
    split = F.when(F.col("tokens").isNull(), F.array("bare")).otherwise(spans)
    by_position = F.transform(F.when(F.col("json").isNull(), split), lambda v: _unquoted(v))
    values = F.filter(F.coalesce(F.transform("json", lambda v: F.regexp_replace(F.coalesce(v, F.lit("")), _TRIM, "")), by_position), lambda v: v != "")
    return (
        ruled.select("row_id", values.alias("values"))
        .select("row_id", F.size("values").cast("int").alias("n_values"), F.posexplode("values").alias("pos", "val"))
        .select(F.col("row_id").alias(row_id), "n_values", (F.col("pos") + 1).alias("pos"), "val")
    )
