"""Deeply nested records as related flat tables.

Method: *Dewey labelling*.  Every node of a document gets the path of ordinals
that leads to it (``[1, 0, 3]``: the fourth child of the first child of the
second child of the root) and a schema path in which data keys and array places
are wildcards.  A node's parent is its label without the last ordinal, so the
parent-child links need no join and no generated keys; the nodes of one schema
path form one table.

JSON texts differ in shape from record to record, so they are walked by one
Arrow pass over the partitions; what follows is built-in expressions.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hustings.session import materialise, spread

NODE_FIELDS = "label array<int>, path string, keys array<string>, kind string, value string"
_ARROW = pa.schema([("label", pa.list_(pa.int32())), ("path", pa.string()), ("keys", pa.list_(pa.string())), ("kind", pa.string()), ("value", pa.string())])
_BATCH = 20_000


def _clean(s: str) -> str:
    """Without lone surrogates, which UTF-8 can't hold."""
    return s.encode("utf-16", "surrogatepass").decode("utf-16", "replace") if any("\ud800" <= c <= "\udfff" for c in s) else s


def read_text(text: str | None):
    """The document of a JSON text, or None; JSON wrapped once more as a JSON string is read too."""
    if text is None:
        return None
    try:
        doc = json.loads(text.lstrip("﻿"))
        return json.loads(doc) if isinstance(doc, str) else doc
    except (ValueError, RecursionError):
        return None


def walk(doc, keyed: frozenset[str]) -> Iterator[tuple[list[int], str, list[str | None], str, str | None]]:
    """Nodes below the root in document order: label, schema path, keys on the way, kind, scalar value.

    ``keyed``: schema paths of objects whose member names are data (written ``{}``), not schema.
    A repeated member counts once, at its first place with its last value.
    """
    stack = [([], "", [], doc)]
    while stack:
        label, path, keys, x = stack.pop()
        if label:
            if isinstance(x, dict):
                yield label, path, keys, "object", None
            elif isinstance(x, list):
                yield label, path, keys, "array", None
            elif x is None:
                yield label, path, keys, "null", None
            elif isinstance(x, bool):
                yield label, path, keys, "boolean", "true" if x else "false"
            elif isinstance(x, str):
                yield label, path, keys, "string", _clean(x)
            else:
                yield label, path, keys, "number", repr(x)
        if isinstance(x, dict):
            if path in keyed:
                children = [([*label, i], path + "{}", [*keys, _clean(k)], v) for i, (k, v) in enumerate(x.items())]
            else:
                children = [([*label, i], f"{path}.{k}" if path else k, [*keys, _clean(k)], v) for i, (k, v) in enumerate(x.items())]
        elif isinstance(x, list):
            children = [([*label, i], path + "[]", [*keys, None], v) for i, v in enumerate(x)]
        else:
            continue
        stack.extend(reversed(children))


def nodes(df: DataFrame, row_id: str, text: str, keyed: Iterable[str] = (), keep: str | None = None, kinds: Iterable[str] | None = None) -> DataFrame:
    """(row_id, label, path, keys, kind, value): the labelled nodes of each row's document.

    ``keep``: a regular expression that the whole schema path of a returned node matches.
    Null, blank and unreadable texts and bare scalars give no rows; equal rows are labelled each on their own;
    other columns of ``df`` are left out, so their names cannot clash.
    """
    keyed, matches, kinds = frozenset(keyed), re.compile(keep).fullmatch if keep else None, frozenset(kinds) if kinds else None
    source = df.select(F.col(row_id).alias("row_id"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
    id_type = source.schema["row_id"].dataType

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, bool] = {}
        for batch in batches:
            ids, rows, at = batch.column(0), [], []

            def flush():
                taken = ids.take(pa.array(at, pa.int32()))
                columns = list(zip(*rows)) if rows else [[], [], [], [], []]
                return pa.RecordBatch.from_arrays([taken, *(pa.array(c, f.type) for c, f in zip(columns, _ARROW))], names=["row_id", *_ARROW.names])

            for k, value in enumerate(batch.column(1)):
                doc = read_text(value.as_py())
                if not isinstance(doc, (dict, list)):
                    continue
                for node in walk(doc, keyed):
                    if kinds is not None and node[3] not in kinds:
                        continue
                    if matches is not None:
                        ok = known.get(node[1])
                        if ok is None:
                            ok = matches(node[1]) is not None
                            if len(known) < 10_000:
                                known[node[1]] = ok
                        if not ok:
                            continue
                    rows.append((node[0], _clean(node[1]), node[2], node[3], node[4]))
                    at.append(k)
                if len(rows) >= _BATCH:
                    yield flush()
                    rows, at = [], []
            if rows:
                yield flush()

    return spread(source).mapInArrow(label, f"row_id {id_type.simpleString()}, {NODE_FIELDS}").withColumnRenamed("row_id", row_id)


def parent_label(label):
    """A node's parent by truncation; null for a member of the root."""
    size = F.size(label)
    return F.when(size > 1, F.slice(label, F.lit(1), F.greatest(size - 1, F.lit(1))))


#: Schema paths of an election record: race key -> races -> districts -> names, each of them in several shapes.
RECORD_KEYED = ("", "{}.districts", "{}[].districts")
_RACE, _DISTRICT = r"\{\}(?:\[\])?", r"\.districts(?:\{\}|\[\])"
RECORD_PATHS = {"race": _RACE, "district": _RACE + _DISTRICT, "name": _RACE + _DISTRICT + r"(?:\.candidates)?\[\]"}
_MEMBERS = ("office", "scope", "n_districts", "seats", "max_votes", "block_vote")
_MEMBER = rf"{_RACE}\.(?:{'|'.join(_MEMBERS)})"
_NAMED = _RACE + r"\.districts\[\]\.district"
_RAW = RECORD_PATHS["name"] + r"\.name_raw"


def _placed(found: DataFrame) -> DataFrame:
    """The races, districts and names among the nodes, with their table and positions."""
    within = lambda name: F.col("path").rlike(f"^{RECORD_PATHS[name]}$")
    table = F.when(within("race"), "race").when(within("district"), "district").when(within("name"), "name")
    listed = F.col("path").startswith("{}[]")
    depth = F.when(listed, 2).otherwise(1)
    # A race is an object.  A district given by its key may be null or anything else, one given as an array's element not null; nor may a name.
    real = (
        ((F.col("table") == "race") & (F.col("kind") == "object"))
        | ((F.col("table") == "district") & (F.col("path").endswith("{}") | (F.col("kind") != "null")))
        | ((F.col("table") == "name") & (F.col("kind") != "null"))
    )
    return (
        found.withColumn("table", table)
        .filter(real)
        .withColumn("race_key", F.col("keys")[0])
        .withColumn("race_pos", F.when(listed, F.col("label")[1]).otherwise(0))
        .withColumn("district_pos", F.when(F.col("table") != "race", F.get("label", depth + 1)).otherwise(-1))
        .withColumn("cand_pos", F.when(F.col("table") == "name", F.element_at("label", -1)).otherwise(-1))
    )


def record_nodes(df: DataFrame, row_id: str = "record_id", text: str = "races") -> DataFrame:
    """The nodes of election records that are a race, a district or a name, with the table they belong to."""
    return _placed(nodes(df, row_id, text, RECORD_KEYED, "|".join(RECORD_PATHS.values())))


def record_tables(df: DataFrame, row_id: str = "record_id", text: str = "races") -> dict[str, DataFrame]:
    """The flat tables race, district and name of election records.

    ``node`` is a row's label, ``parent`` the label of the row it belongs to, got by truncation: a district's is its race's
    node, a name's its district's.  (row_id, node) is a key, and (row_id, parent) refers to it.
    """
    # The records are walked once; what the tables need of them is kept in the shared folder.
    every = materialise(nodes(df, row_id, text, RECORD_KEYED, "|".join([*RECORD_PATHS.values(), _MEMBER, _NAMED, _RAW])))
    label = lambda a: F.array_join(F.transform(a, lambda i: i.cast("string")), ".")
    listed = F.col("path").startswith("{}[]")
    depth = F.when(listed, 2).otherwise(1)
    at = lambda n: label(F.slice("label", F.lit(1), n))
    flat = _placed(every)
    race = flat.filter("table = 'race'").select(row_id, at(depth).alias("node"), "race_key", "race_pos")
    member = every.filter(F.col("path").rlike(f"^{_MEMBER}$") & F.col("kind").isin("string", "number", "boolean"))
    member = member.select(row_id, at(depth).alias("node"), F.regexp_extract("path", r"([a-z_]+)$", 1).alias("member"), "value")
    attributes = member.groupBy(row_id, "node").pivot("member", list(_MEMBERS)).agg(F.first("value"))
    race = race.join(attributes, [row_id, "node"], "left").select(
        row_id, "node", "race_key", "race_pos", "office", "scope",
        *(F.expr(f"try_cast(trim({c}) AS int)").alias(c) for c in ("n_districts", "seats", "max_votes")),
        F.expr("try_cast(block_vote AS boolean)").alias("block_vote"),
    )
    district_name = every.filter(F.col("path").rlike(f"^{_NAMED}$") & (F.col("kind") == "string")).select(row_id, at(F.size("label") - 1).alias("node"), F.col("value").alias("named"))
    district = (
        flat.filter("table = 'district'")
        .select(row_id, at(depth + 2).alias("node"), at(depth).alias("parent"), "district_pos", F.when(F.col("path").endswith("{}"), F.element_at("keys", -1)).alias("keyed"))
        .join(district_name, [row_id, "node"], "left")
        .select(row_id, "node", "parent", "district_pos", F.coalesce("keyed", "named").alias("district"))
    )
    raw = every.filter(F.col("path").rlike(f"^{_RAW}$") & (F.col("kind") == "string")).select(row_id, at(F.size("label") - 1).alias("node"), F.col("value").alias("raw"))
    name = (
        flat.filter("table = 'name'")
        .select(row_id, label(F.col("label")).alias("node"), at(depth + 2).alias("parent"), "cand_pos", F.when(F.col("kind") == "string", F.col("value")).alias("text"))
        .join(raw, [row_id, "node"], "left")
        .select(row_id, "node", "parent", "cand_pos", F.coalesce("text", "raw").alias("name_raw"))
    )
    return {"race": race, "district": district, "name": name}


# --- tables by schema path -------------------------------------------------------------------------------------------


def table_name(path: str) -> str:
    """A schema path as a name: ``{}[].districts{}`` is ``each_item_districts_each``, the root ``document``."""
    words = re.sub(r"[^0-9A-Za-z]+", "_", path.replace("{}", ".each.").replace("[]", ".item.")).strip("_").lower()
    return words or "document"


def schema_paths(labelled: DataFrame) -> DataFrame:
    """(path, kind, n, depth): the schema of all documents, each path with every kind of value it was seen with."""
    return labelled.groupBy("path", "kind").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("label")).alias("depth"))


def tables_by_path(df: DataFrame, row_id: str, text: str, keyed: Iterable[str] = (), most_paths: int = 10_000) -> dict[str, DataFrame]:
    """A flat table for every schema path whose nodes are rows, of documents of any shape; nothing of a document is lost.

    Rows are what repeats: the elements of arrays and the members of objects with data keys (``keyed``), and the document itself.  A
    table has ``node`` (the label, a key beside the row's id), ``parent`` (the node of the nearest row above, got by truncating the label),
    ``parent_table``, ``pos`` (its place among its siblings), ``key`` (its data key), ``kind``, ``value`` (of a scalar element) and a column
    for every scalar below it that doesn't repeat, named by the path to it; objects between are folded into those names.  Values stay text,
    with a column ``..._kind`` where a path holds several kinds.  Two paths that differ only in other than letters and digits get numbers.

    A document without any member gives no row.  The documents are walked once.  Only the schema - paths and kinds, at most ``most_paths`` - reaches the driver.
    """
    every = materialise(nodes(df, row_id, text, keyed))
    seen = schema_paths(every).limit(most_paths + 1).collect()
    if len(seen) > most_paths:
        raise ValueError(f"more than {most_paths} schema paths: name the objects whose member names are data as keyed")
    kinds: dict[str, set[str]] = {}
    depths = {"": 0}
    for r in seen:
        kinds.setdefault(r["path"], set()).add(r["kind"])
        depths[r["path"]] = r["depth"]
    repeats = lambda p: p.endswith("[]") or p.endswith("{}")
    # The document is the row of the root, whose label is empty.
    row_paths = ["", *sorted(p for p in kinds if repeats(p))]
    names: dict[str, str] = {}
    for p in row_paths:
        base = name = table_name(p)
        n = 1
        while name in names.values():
            n += 1
            name = f"{base}_{n}"
        names[p] = name

    def row_above(path: str) -> str:
        return max((p for p in row_paths if path.startswith(p) and path != p and (p == "" or path[len(p)] in ".{[")), key=len)

    text_label = lambda a: F.array_join(F.transform(a, lambda i: i.cast("string")), ".")
    columns: dict[str, dict[str, str]] = {p: {} for p in row_paths}
    for path, found in sorted(kinds.items()):
        if not repeats(path) and found - {"object", "array"}:
            above = row_above(path)
            base = name = table_name(path[len(above) :].lstrip("."))
            n = 1
            while name in columns[above] or f"{name}_kind" in columns[above] or name in (row_id, "node", "parent", "parent_table", "pos", "key", "kind", "value"):
                n += 1
                name = f"{base}_{n}"
            columns[above][name] = path
    out = {}
    for path, name in names.items():
        depth = depths[path]
        node = text_label(F.slice("label", 1, depth)) if depth else F.lit("")
        of_row = [*columns[path].values(), *([path] if path else [])]
        rows = every.filter(F.col("path").isin(of_row)) if path else every.filter(F.col("path").isin(of_row) | (F.size("label") == 1))
        own = F.col("path") == path
        # A scalar member of an element and the element itself meet by the element's label; an element's own node makes the row.
        scalars = []
        for column, at in columns[path].items():
            here = F.col("path") == at
            scalars.append(F.max(F.when(here, F.col("value"))).alias(column))
            if len(kinds[at]) > 1:
                scalars.append(F.max(F.when(here, F.col("kind"))).alias(f"{column}_kind"))
        if path:
            above = row_above(path)
            about = [F.max(F.when(own, F.col("label"))).alias("_label"), F.max(F.when(own, F.element_at("keys", -1))).alias("key"), F.max(F.when(own, F.col("kind"))).alias("kind"), F.max(F.when(own, F.col("value"))).alias("value")]
            grouped = rows.groupBy(row_id, node.alias("node")).agg(*about, *scalars)
            parent = text_label(F.slice("_label", 1, depths[above])) if above else F.lit("")
            out[name] = grouped.select(row_id, "node", parent.alias("parent"), F.lit(names[above]).alias("parent_table"), F.element_at("_label", -1).alias("pos"), "key", "kind", "value", *columns_of(grouped, 6))
        else:
            grouped = rows.groupBy(row_id).agg(F.lit(None).alias("_none"), *scalars).drop("_none")
            out[name] = grouped.select(row_id, F.lit("").alias("node"), *columns_of(grouped, 1))
    return out


def columns_of(df: DataFrame, after: int) -> list[str]:
    """The columns after so many, quoted."""
    return [f"`{c}`" for c in df.columns[after:]]
