"""From nested election records to contests, counts and the served lookup table.

Flat frames all the way: records are unnested by their labels, joined by
(record, parent), and nested again only at a sink.  Every rule that has to hold
before anything is served is a query; ``write_all`` writes nothing while one is
broken.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hustings.functions import names as N
from hustings.operators import constraints as K
from hustings.operators import relational as R
from hustings.operators.dewey import record_tables
from hustings.session import materialise, table

# The stem and the name field of each race key, the order of race keys on a ballot and on output, the stems shared by all wards,
# those with a flag of being served, those with a single vote, and the day lists were retrieved where a record doesn't tell.
STEM = {"mayor": "mayor", "ward": "ward", "atlarge": "atlarge", "regional councillor": "reg_coun", "deputy mayor": "dep_mayor"}
FIELD = {"mayor": "mayor", "ward": "coun_ward", "atlarge": "coun_atlarge", "reg_coun": "coun_reg", "dep_mayor": "dep_mayor"}
BALLOT = ("mayor", "deputy mayor", "atlarge", "regional councillor", "ward")
RACE_KEYS = ("mayor", "atlarge", "ward", "regional councillor", "deputy mayor")
SHARED = ("mayor", "atlarge", "dep_mayor")
FLAGGED = ("ward", "atlarge", "reg_coun")
SINGLE_VOTE = ("mayor", "dep_mayor")
RETRIEVED = "2026-08-11"
NO_WARD = "99"
#: Contests left out of the test tables, as a control table would name them; the last is stale.
EXCLUDED = (("1000007", "Councillor, At-large"), ("1100077", "Mayor"), ("0000000", "Mayor"))


def _mapped(pairs: dict[str, str], c: str):
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in pairs.items() for x in kv)), F.col(c))


def latest_records(df: DataFrame) -> DataFrame:
    """Of each municipality the readable record received last; at equal times the one with the highest id.

    Ranked on the key, time and id alone; the records themselves are picked by a join of the winners' ids.
    """
    read = df.filter(F.col("census_id").isNotNull() & F.try_parse_json("races").isNotNull())
    last = read.groupBy("census_id").agg(F.max(F.struct("received_at", "record_id")).alias("last")).select(F.col("last.record_id").alias("record_id"))
    # A record repeated under its id is one record.
    return read.join(R.control(last), "record_id", "left_semi").dropDuplicates(["record_id"])


def excluded_races(spark: SparkSession, rows: Sequence[tuple[str, str]] = EXCLUDED) -> DataFrame:
    return spark.createDataFrame(list(rows), "census_id string, office string")


def contests(records: DataFrame, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """One row per district of a race: its municipality, race, position, seats, and the number of names that weren't withdrawn."""
    tables = tables or record_tables(records)
    withdrawn = F.coalesce(N.is_withdrawn(F.col("name_raw")), F.lit(False))
    count = tables["name"].groupBy("record_id", F.col("parent").alias("node")).agg(F.count_if(~withdrawn).alias("n"), F.count_if(withdrawn).alias("n_withdrawn"))
    race = tables["race"].withColumnsRenamed({"node": "parent", "n_districts": "told_districts"})
    joined = tables["district"].join(race, ["record_id", "parent"]).join(count, ["record_id", "node"], "left")
    told = F.try_element_at("notes", F.lit("retrieved")) if "notes" in records.columns else F.lit(None)
    retrieved = F.coalesce(told, F.lit(RETRIEVED))
    about = records.select("record_id", "census_id", "csdname", "name_format", retrieved.alias("retrieved"))
    filled = {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("n", "n_withdrawn")}
    filled["scope"] = F.coalesce("scope", F.when(F.col("race_key") == "ward", "Ward").otherwise("At-large"))
    return joined.join(about, "record_id").withColumns(filled).withColumn("stem", _mapped(STEM, "race_key"))


def kept_contests(contest: DataFrame, excluded: DataFrame) -> DataFrame:
    """The contests that aren't excluded by (municipality, office)."""
    return R.exclude(contest, excluded, ["census_id", "office"])


def excluded_counts(contest: DataFrame, excluded: DataFrame) -> DataFrame:
    """Each exclusion with the number of names it removes; 0 tells a stale one."""
    hit = contest.join(R.control(excluded), ["census_id", "office"], "left_semi").groupBy("census_id", "office").agg(F.sum("n").alias("n_dropped"))
    return excluded.join(hit, ["census_id", "office"], "left").withColumn("n_dropped", F.coalesce("n_dropped", F.lit(0)))


def structure_rows(contest: DataFrame, structure: DataFrame) -> DataFrame:
    """Each race with its row of the structure table: of several rows for an office the one that agrees in districts and votes, else the first.

    Both picks are taken from the structure table before they are joined, so no race meets several rows.
    """
    race = contest.select("census_id", "record_id", "race_key", "race_pos", "office", "told_districts", "max_votes").distinct()
    at = F.struct("row_id", "district_source_url", "max_votes_source")
    exact = structure.groupBy("census_id", "office", F.col("n_districts").alias("told_districts"), "max_votes").agg(F.min(at).alias("exact"))
    first = structure.groupBy("census_id", "office").agg(F.min(at).alias("first"))
    joined = race.join(exact, ["census_id", "office", "told_districts", "max_votes"], "left").join(first, ["census_id", "office"], "left")
    row = F.coalesce("exact", "first")
    return joined.select(
        "record_id", "race_key", "race_pos", "census_id", "office", row["row_id"].alias("row_id"), F.col("exact").isNotNull().alias("agrees"),
        N.url_list(row["district_source_url"]).alias("district_source_url"), N.url_list(row["max_votes_source"]).alias("max_votes_source"),
        (row.isNull() & (F.coalesce("office", F.lit("")) != "Mayor")).alias("not_in_structure"),
    )


def contest_counts(contest: DataFrame) -> DataFrame:
    """The counts with each contest's place over all: most names first, then municipality, the ballot's order, office, districts and position."""
    rows = contest.select("census_id", "csdname", "race_key", "office", "scope", "district", "n", "retrieved", "told_districts", "race_pos", "district_pos")
    order = [F.desc("n"), F.asc_nulls_last("csdname"), R.enum_rank("race_key", BALLOT).asc(), F.asc_nulls_last("office"), F.asc_nulls_last("told_districts"), F.asc("district_pos"), F.asc("census_id"), F.asc("race_key"), F.asc("race_pos")]
    return R.positions(rows, order, "place").drop("told_districts", "race_pos", "district_pos")


def by_ward(contest: DataFrame) -> DataFrame:
    """Contests with the ward they are held in: joint labels as one row for each of their wards, null for the whole municipality.

    A joint label without a number can't be split and has no ward; a rule tells it.
    """
    ward = F.when(F.col("scope") == "At-large", F.array(F.lit(None).cast("string"))).when(F.col("scope") == "Ward-pair", N.label_parts(F.col("district"))).otherwise(F.array("district"))
    return contest.withColumn("ward", F.explode(ward))


def served_contests(contest: DataFrame) -> DataFrame:
    """What an elector of each ward is served: the contests of the whole municipality and those of the ward; ward 99 stands for none."""
    placed = by_ward(contest).filter("stem IS NOT NULL")
    domain = R.part_domain(placed.filter("ward IS NOT NULL"), "census_id", "ward", NO_WARD).union(placed.select("census_id", F.lit(NO_WARD))).distinct()
    whole = placed.filter("ward IS NULL").drop("ward")
    return R.serve(whole, placed.filter("ward IS NOT NULL"), domain, "census_id", "ward")


def served_fields(contest: DataFrame) -> DataFrame:
    """Every ward with every stem: served (for the stems with that flag), all elected without a vote, votes (for those with several).

    Blank where no contest is, and where the seats or votes of one of them aren't known.
    """
    served = served_contests(contest)
    known = lambda c, value: F.when(F.count(c) == F.count(F.lit(1)), value)
    facts = served.groupBy("census_id", "ward", "stem").agg(
        known("seats", F.min((F.col("n") <= F.col("seats")).cast("int"))).alias("accl"), known("max_votes", F.sum("max_votes")).cast("int").alias("max_votes"), F.count(F.lit(1)).alias("k")
    )
    cells = R.dense(served.select("census_id", "ward").distinct(), {"stem": list(FIELD)}, facts, ["census_id", "ward", "stem"])
    half = F.when(F.col("stem").isin(*SHARED), "shared").otherwise("ward")
    flag = F.when(F.col("stem").isin(*FLAGGED), F.col("k").isNotNull().cast("int"))
    votes = F.when(~F.col("stem").isin(*SINGLE_VOTE), F.col("max_votes"))
    return cells.select("census_id", "ward", "stem", half.alias("half"), flag.alias("served"), "accl", votes.alias("max_votes"))


def served_names(contest: DataFrame, tables: dict[str, DataFrame], ranks: DataFrame | None = None) -> DataFrame:
    """Every served name with its place in its list, by the collation of names; withdrawn ones are left out.

    ``ranks`` (token, given_rank, surname_rank) decides on middle names, a lower rank being commoner; of a token told twice the best
    ranks count.  It is aggregated to the tokens that occur, so a corpus of any size is joined by a shuffle of tokens, not held.
    """
    name = tables["name"].select("record_id", F.col("parent").alias("node"), "cand_pos", "name_raw").filter(F.col("name_raw").isNotNull() & ~N.is_withdrawn(F.col("name_raw")))
    formatted = contest.filter(F.coalesce("name_format", F.lit("first_last")).isin(*N.FORMATS))
    served = served_contests(formatted).select("census_id", "ward", "stem", "record_id", "node", "name_format")
    named = name
    if ranks is not None:
        known = ranks.groupBy(N.rank_token(F.col("token")).alias("token")).agg(F.min("given_rank").cast("int").alias("given_rank"), F.min("surname_rank").cast("int").alias("surname_rank"))
        tokens = name.select("record_id", "node", "cand_pos", F.explode(F.array_distinct(F.transform(F.split(N.norm(F.col("name_raw")), " "), N.rank_token))).alias("token"))
        held = tokens.join(known, "token").groupBy("record_id", "node", "cand_pos").agg(F.map_from_entries(F.collect_list(F.struct("token", F.struct("given_rank", "surname_rank")))).alias("ranks"))
        named = name.join(held, ["record_id", "node", "cand_pos"], "left")
    candidate = N.candidate(F.col("name_format"), F.col("name_raw"), F.col("ranks") if ranks is not None else None)
    shown = served.join(named, ["record_id", "node"]).withColumn("c", candidate).withColumn("name", N.display_name(F.col("c.last_name"), F.col("c.first_name")))
    # Ranked within a list, which belongs to one ward of one municipality.
    rank = F.row_number().over(Window.partitionBy("census_id", "ward", "stem").orderBy(R.collated("name"), "name", "name_raw"))
    return shown.select("census_id", "ward", _mapped(FIELD, "stem").alias("name_field"), rank.alias("rank"), "name")


def rules(contest: DataFrame, municipality: DataFrame, structure: DataFrame | None = None, excluded: DataFrame | None = None, names: DataFrame | None = None) -> list[K.Rule]:
    """What has to hold before anything is served; all are told together.

    ``contest`` are the contests kept; with ``excluded`` those before the exclusion are to be given as ``contest``, and they are
    excluded here.  ``names``: the served names.
    """
    kept = kept_contests(contest, excluded) if excluded is not None else contest
    place = F.concat_ws("|", "census_id", "race_key", "race_pos", "district_pos")
    race = F.concat_ws("|", "census_id", "race_key", "race_pos")
    own = by_ward(kept).filter("ward IS NOT NULL AND stem IS NOT NULL")
    races = kept.groupBy("record_id", "census_id", "race_key", "race_pos", "stem", "scope", "told_districts").agg(F.count(F.lit(1)).alias("districts"))
    stems = kept.groupBy("census_id").agg(F.collect_set("stem").alias("stems"))
    fields = served_fields(kept)
    lacks = lambda *wanted: ~F.arrays_overlap("stems", F.array(*map(F.lit, wanted)))
    out = [
        K.known("name format known", kept.withColumn("told", F.coalesce("name_format", F.lit("first_last"))).select("census_id", "told").distinct(), "told", N.FORMATS, "census_id"),
        K.Rule("race key known", lambda: kept.filter("stem IS NULL"), place),
        K.Rule("no withdrawn name", lambda: kept.filter("n_withdrawn > 0"), place),
        K.Rule("district has names", lambda: kept.filter("n = 0"), place),
        K.Rule("districts as told", lambda: races.filter("districts <> told_districts"), race),
        K.Rule("seats given", lambda: kept.filter("seats IS NULL OR max_votes IS NULL"), place),
        K.Rule("single vote", lambda: kept.filter(F.col("stem").isin(*SINGLE_VOTE) & (F.col("max_votes") != 1)), place),
        K.Rule("pair splits", lambda: kept.filter((F.col("scope") == "Ward-pair") & (F.coalesce(F.size(N.integers(F.col("district"))), F.lit(0)) <= 0)), place),
        K.claimed_once("ward held once in a race", own, ["census_id", "race_key", "race_pos", "ward"]),
        K.claimed_once("ward in one race of a stem", own.select("census_id", "stem", "ward", "race_key", "race_pos").distinct(), ["census_id", "stem", "ward"]),
        K.Rule("scope fits the stem", lambda: kept.filter("stem = 'ward' AND scope = 'At-large' OR stem = 'atlarge' AND scope <> 'At-large'"), place),
        K.unique("contest key unique", kept, "census_id", "office", "district"),
        K.Rule("mayor stands", lambda: stems.filter(lacks("mayor")), F.col("census_id")),
        K.Rule("a council race", lambda: stems.filter(lacks("ward", "atlarge")), F.col("census_id")),
        K.covered("municipality known", kept, municipality, "census_id"),
        K.covered("municipality collected", municipality, kept, "census_id"),
        K.invariant("shared half the same in all wards", fields.filter("half = 'shared'"), ["census_id", "stem"], ["served", "accl", "max_votes"]),
        K.same_members("same stems everywhere", fields, ["census_id", "ward"], "stem", list(FIELD)),
        K.disjoint("halves disjoint", fields.filter("half = 'shared'").select("stem"), fields.filter("half = 'ward'").select("stem"), "stem"),
    ]
    if structure is not None:
        told = kept_contests(structure, excluded) if excluded is not None else structure
        told = told.filter("office IS NOT NULL").select("census_id", "office").distinct().join(kept.select("census_id").distinct(), "census_id", "left_semi")
        out.append(K.covered("office collected", told, kept, "census_id", "office"))
    if excluded is not None:
        out += [K.unique("exclusion unique", excluded, "census_id", "office"), K.Rule("exclusion removes", lambda: excluded_counts(contest, excluded).filter("n_dropped = 0"), F.concat_ws("|", "census_id", "office"))]
    if names is not None:
        shown = F.concat_ws("|", "census_id", "ward", "name_field", "rank")
        out += [
            K.Rule("surname given", lambda: names.filter("name = '' OR name LIKE ',%'"), shown),
            K.Rule("name well formed", lambda: names.filter(~N.is_well_formed(F.col("name"))), shown),
            K.Rule("ranked characters only", lambda: names.filter(N.odd_characters(F.col("name")) != ""), shown),
        ]
    return out


def run_report(contest: DataFrame, excluded: DataFrame) -> DataFrame:
    """(section, item, n): totals, what each exclusion removed, and the widest list of each field with where it is; first wins."""
    kept = kept_contests(contest, excluded)
    totals = kept.agg(F.count_distinct("census_id").alias("municipalities"), F.count_distinct("record_id", "race_key", "race_pos").alias("races"), F.count(F.lit(1)).alias("contests"), F.coalesce(F.sum("n"), F.lit(0)).alias("candidates"))
    rows = totals.unpivot([], totals.columns, "item", "n").select(F.lit("totals").alias("section"), "item", "n")
    gone = excluded_counts(contest, excluded).select(F.lit("excluded").alias("section"), F.concat_ws(" ", "census_id", "office").alias("item"), "n_dropped")
    lists = served_contests(kept).groupBy("stem", "census_id", "ward").agg(F.sum("n").alias("n"))
    widest = R.first_of(lists, ["stem"], F.struct((-F.col("n")).alias("less"), "census_id", (F.col("ward") == NO_WARD).alias("none"), "ward"))
    shown = widest.select(F.lit("widest").alias("section"), F.concat_ws(" ", _mapped(FIELD, "stem"), "first.census_id", "first.ward").alias("item"), (-F.col("first.less")).alias("n"))
    return rows.unionByName(gone.toDF("section", "item", "n")).unionByName(shown)


def judgement_calls(tables: dict[str, DataFrame], records: DataFrame, ranks: DataFrame) -> DataFrame:
    """(record_id, name_raw, token, surname_like, why): middle names whose call was close, of lists published given name first."""
    known = ranks.groupBy(N.rank_token(F.col("token")).alias("token")).agg(F.min("given_rank").cast("int").alias("given_rank"), F.min("surname_rank").cast("int").alias("surname_rank"))
    first_last = records.filter("coalesce(name_format, 'first_last') = 'first_last'").select("record_id")
    name = tables["name"].join(first_last, "record_id", "left_semi").filter("name_raw IS NOT NULL").select("record_id", "name_raw").distinct()
    clean = F.trim(N.without_pronouns(N.norm(F.col("name_raw"))))
    tokens = name.select("record_id", "name_raw", F.explode(F.array_distinct(F.transform(F.split(clean, " "), N.rank_token))).alias("token"))
    held = tokens.join(known, "token").groupBy("record_id", "name_raw").agg(F.map_from_entries(F.collect_list(F.struct("token", F.struct("given_rank", "surname_rank")))).alias("ranks"))
    calls = held.select("record_id", "name_raw", F.explode(N.close_calls(clean, F.col("ranks"))).alias("call"))
    return calls.select("record_id", "name_raw", "call.token", "call.surname_like", "call.why")


def flow(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, DataFrame], DataFrame]:
    """The newest records, their tables, and their contests, which are asked several times over and kept: one row per district."""
    records = latest_records(table(spark, sf_dir, "municipality_doc"))
    tables = record_tables(records)
    return records, tables, materialise(contests(records, tables))


def d1_contest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of the contests that aren't excluded, in order over all of them."""
    return contest_counts(kept_contests(flow(spark, sf_dir)[2], excluded_races(spark)))


def d2_served_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each ward is served."""
    return served_fields(kept_contests(flow(spark, sf_dir)[2], excluded_races(spark)))


def d3_served_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The names each ward is served, in order."""
    _, tables, contest = flow(spark, sf_dir)
    return served_names(kept_contests(contest, excluded_races(spark)), tables)


def d4_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each rule is broken."""
    contest = flow(spark, sf_dir)[2]
    return K.summary(rules(contest, table(spark, sf_dir, "municipality_type"), table(spark, sf_dir, "election_structure"), excluded_races(spark)))


def d5_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each exclusion removes."""
    return excluded_counts(flow(spark, sf_dir)[2], excluded_races(spark))


def d6_structure_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each race with its row of the structure table and the sources told there."""
    contest, excluded = flow(spark, sf_dir)[2], excluded_races(spark)
    rows = structure_rows(kept_contests(contest, excluded), kept_contests(table(spark, sf_dir, "election_structure"), excluded))
    return rows.withColumns({c: F.array_join(c, " ") for c in ("district_source_url", "max_votes_source")})


def d7_run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals, exclusions and widest lists of a run."""
    return run_report(flow(spark, sf_dir)[2], excluded_races(spark))


QUERIES = {f.__name__: f for f in (d1_contest_counts, d2_served_fields, d3_served_names, d4_violations, d5_exclusions, d6_structure_rows, d7_run_report)}
