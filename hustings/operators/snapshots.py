"""What changed between full snapshots.

Method: a *bucketed key-to-hash index* of the last snapshot, kept in a folder.
Of each key of a new snapshot the delivery received last counts; its key and two
hashes of the compared values are written bucketed by key, and probe the index
of the last snapshot.  Both are bucketed alike, so the probe shuffles nothing.
Then the two are swapped: one file names the index that is the last one, and is
replaced at once; what it named before is removed.  Values are fetched by row id,
only for what changed.

A history of several snapshots is read once and replayed in turn; a later run
with the same folder indexes only the snapshots after the kept one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.operators.relational import control
from hustings.session import materialise, scratch_path
from hustings.sources.writers import file_system, read_text_file, write_text

#: So many comparisons are planned together; the results of more are written in turn.
PLANNED_TOGETHER = 24
#: Keys in a bucket of the index, on which the number of buckets depends.
BUCKET_KEYS = 1_000_000
NAMED = "last.json"


def as_set(names: Column) -> Column:
    """A list of names as a set: without order, repeats and nulls; null is the empty one."""
    return F.coalesce(F.array_sort(F.array_distinct(F.filter(names, lambda x: x.isNotNull()))), F.array().cast("array<string>"))


def _encoded(c: str) -> Column:
    """A key column that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))


def _decoded(c: str, kind: str) -> Column:
    return F.when(F.col(c) != "", F.substring(F.col(c), F.lit(2), F.length(c))).cast(kind).alias(c)


class SnapshotIndex:
    """The index of the last snapshot, kept in a folder; ``load`` brings in the ones after it.

    ``snapshot`` numbers the deliveries, ``keys`` name an entry within one, ``sets`` are the compared lists.  Of rows with one
    key in one snapshot the one received last counts, at equal times the one with the highest ``tie``.  Null keys are
    keys of their own; rows without snapshot number belong to none and are left out.
    """

    def __init__(self, spark: SparkSession, path: str, snapshot: str, keys: Sequence[str], sets: Sequence[str], received: str, tie: str, buckets: int | None = None):
        self.spark, self.path, self.snapshot, self.keys, self.sets, self.received, self.tie = spark, path.rstrip("/"), snapshot, list(keys), list(sets), received, tie
        self.k = [f"k{i}" for i in range(len(self.keys))]
        text = read_text_file(spark, f"{self.path}/{NAMED}")
        kept = json.loads(text) if text else {}
        if kept and (kept["keys"], kept["sets"]) != (self.keys, self.sets):
            raise ValueError(f"the index in {path} is of other columns: {kept['keys']}, {kept['sets']}")
        self.last: int | None = kept.get("last")
        self.folder: str | None = kept.get("folder")
        #: Fixed with the first load, so that later ones are bucketed alike.
        self.buckets: int | None = kept.get("buckets", buckets)

    def _rows(self, df: DataFrame) -> DataFrame:
        """(snapshot, keys, hashes, row id): one row per key of each snapshot."""
        values = [as_set(F.col(c)) for c in self.sets]
        apart = [x for i, v in enumerate(values) for x in (v, F.lit(i))]
        row = F.struct(F.col(self.received).alias("at"), F.col(self.tie).alias("tie"), F.xxhash64(*apart).alias("h1"), F.xxhash64(F.lit("#"), *reversed(apart)).alias("h2"))
        narrow = df.select(F.col(self.snapshot).cast("int").alias("snapshot"), *(_encoded(c).alias(k) for c, k in zip(self.keys, self.k)), row.alias("row"))
        return narrow.groupBy("snapshot", *self.k).agg(F.max("row").alias("row")).select("snapshot", *self.k, "row.h1", "row.h2", F.col("row.tie").alias("tie"))

    def _table(self, folder: str, schema: str) -> DataFrame:
        """A bucketed table over a folder; the catalog knows it only while the frame is made."""
        name, by = f"snapshot_index_{uuid.uuid4().hex}", ", ".join(self.k)
        self.spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{folder}'")
        try:
            return self.spark.table(name)
        finally:
            self.spark.sql(f"DROP TABLE {name}")

    def _write(self, rows: DataFrame) -> str:
        """Writes the index of each snapshot to a folder of its own, ``snapshot=N``."""
        name, load = f"snapshot_index_{uuid.uuid4().hex}", f"{self.path}/load-{uuid.uuid4().hex}"
        rows.repartition(self.buckets, *self.k).write.partitionBy("snapshot").bucketBy(self.buckets, *self.k).sortBy(*self.k).option("path", load).format("parquet").saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")
        return load

    def _probe(self, number: int, new: DataFrame, old: DataFrame) -> DataFrame:
        """The changes from one snapshot to the next, with the ids of the rows that hold the old and the new values."""
        new = new.select(*self.k, F.col("h1").alias("n1"), F.col("h2").alias("n2"), F.col("tie").alias("new_row"))
        old = old.select(*self.k, F.col("h1").alias("o1"), F.col("h2").alias("o2"), F.col("tie").alias("old_row"))
        kind = F.when(F.col("o1").isNull(), "added").when(F.col("n1").isNull(), "removed").when((F.col("o1") != F.col("n1")) | (F.col("o2") != F.col("n2")), "changed")
        return new.join(old, self.k, "full_outer").withColumn("change_kind", kind).filter("change_kind IS NOT NULL").select(F.lit(number).alias("snapshot"), *self.k, "change_kind", "old_row", "new_row")

    def _swap(self, number: int, folder: str) -> None:
        """The loaded snapshot becomes the last one, at once; then what else the folder holds is removed."""
        kept = {"last": number, "folder": folder, "buckets": self.buckets, "keys": self.keys, "sets": self.sets}
        write_text(self.spark, json.dumps(kept), f"{self.path}/{NAMED}")
        self.last, self.folder = number, folder
        fs, root = file_system(self.spark, self.path)
        for load in fs.listStatus(root):
            if load.getPath().getName().startswith("load-"):
                for part in fs.listStatus(load.getPath()):
                    if not part.getPath().toString().endswith(folder.split("/", 3)[-1]):
                        fs.delete(part.getPath(), True)
                if not fs.listStatus(load.getPath()):
                    fs.delete(load.getPath(), True)

    def load(self, df: DataFrame) -> DataFrame:
        """(snapshot, keys, change_kind, old_row, new_row): the changes of every snapshot of ``df`` after the kept one.

        The first snapshot ever gives none.  Rows of the kept snapshot and of those before it are left out, so what comes late for
        them needs a load of the history into a new folder.  The number of snapshots, not of rows, bounds what reaches the driver.
        """
        types = {c: df.schema[c].dataType.simpleString() for c in self.keys} | {"tie": df.schema[self.tie].dataType.simpleString()}
        new = df.filter(F.col(self.snapshot).isNotNull() if self.last is None else F.col(self.snapshot) > self.last)
        sizes = {r[0]: r[1] for r in new.groupBy(F.col(self.snapshot).cast("int")).count().collect()}
        if not sizes:
            names = ", ".join(f"`{k}` {'string'}" for k in self.k)
            return self._named(self.spark.createDataFrame([], f"snapshot int, {names}, change_kind string, old_row {types['tie']}, new_row {types['tie']}"), types)
        self.buckets = self.buckets or -(-max(sizes.values()) // BUCKET_KEYS)
        schema = ", ".join(f"{k} STRING" for k in self.k) + f", h1 BIGINT, h2 BIGINT, tie {types['tie']}"
        load = self._write(self._rows(new))
        steps, done, old = [], [], self._table(self.folder, schema) if self.folder else None
        for number in sorted(sizes):
            folder = f"{load}/snapshot={number}"
            probing = self._table(folder, schema)
            if old is not None:
                steps.append(self._probe(number, probing, old))
            old = probing
            if len(steps) == PLANNED_TOGETHER:
                done.append(materialise(reduce(DataFrame.unionByName, steps)))
                steps = []
        if steps:
            done.append(materialise(reduce(DataFrame.unionByName, steps)))
        self._swap(number, folder)
        if not done:
            done = [self._probe(number, old, old).limit(0)]
        return self._named(reduce(DataFrame.unionByName, done), types)

    def _named(self, changes: DataFrame, types: dict[str, str]) -> DataFrame:
        named = changes.select("snapshot", *(_decoded(k, types[c]) for k, c in zip(self.k, self.keys)), "change_kind", "old_row", "new_row")
        return named.withColumnsRenamed(dict(zip(self.k, self.keys)))

    def drop(self) -> None:
        """Removes the kept index."""
        fs, root = file_system(self.spark, self.path)
        fs.delete(root, True)


LISTS = ["mayor", "coun_ward", "coun_reg"]


def served_index(spark: SparkSession, path: str, buckets: int | None = None) -> SnapshotIndex:
    """The index of served entries in a folder; names are compared as sets, character by character."""
    return SnapshotIndex(spark, path, "build_no", ["census_id", "ward"], LISTS, "received_at", "entry_id", buckets)


def _replayed(df: DataFrame, path: str | None) -> DataFrame:
    index = served_index(df.sparkSession, path or scratch_path(df.sparkSession, "snapshot-index"))
    changes = index.load(df)
    if path is None:
        index.drop()
    return changes


def snapshot_changes(df: DataFrame, path: str | None = None) -> DataFrame:
    """(build_no, census_id, ward, change_kind) of served entries.

    ``path``: the folder of a kept index, so that only builds after it are taken; without it all builds are replayed.
    """
    kind = df.schema["build_no"].dataType.simpleString()
    return _replayed(df, path).select(F.col("snapshot").cast(kind).alias("build_no"), "census_id", "ward", "change_kind")


def changed_values(df: DataFrame, path: str | None = None) -> DataFrame:
    """The changes with the names that came and went in each list; values are fetched by row id, for changed entries only.

    The table is gone over once for old and new values alike; it isn't shuffled while the changed rows are few, which is counted.
    """
    changes = _replayed(df, path).filter("change_kind = 'changed'")
    sides = F.explode(F.array(*(F.struct(F.col(f"{side}_row").alias("entry_id"), F.lit(side).alias("side")) for side in ("old", "new"))))
    wanted = changes.select("snapshot", "census_id", "ward", sides.alias("s")).select("snapshot", F.col("census_id").alias("cid"), F.col("ward").alias("w"), "s.entry_id", "s.side")
    rows = df.select("entry_id", *(as_set(F.col(c)).alias(c) for c in LISTS)).join(control(wanted), "entry_id")
    # A row repeated under one id is one row; both sides of a change meet again by its key.
    pick = lambda side: (F.max(F.when(F.col("side") == side, F.struct(*LISTS))).alias(side))
    both = rows.groupBy("snapshot", "cid", "w").agg(pick("old"), pick("new"))
    return both.select(
        F.col("snapshot").alias("build_no"), F.col("cid").alias("census_id"), F.col("w").alias("ward"),
        *(F.array_join(F.array_except(f"new.{c}", f"old.{c}"), "; ").alias(f"{c}_came") for c in LISTS),
        *(F.array_join(F.array_except(f"old.{c}", f"new.{c}"), "; ").alias(f"{c}_went") for c in LISTS),
    )
