"""Queries of the relational and nested operators, each with the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.operators import relational as R
from hustings.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query with its SQL; ``t`` in it reads a table by name."""

    def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(spark, lambda table_name: table(spark, sf_dir, table_name))

        run.__doc__ = f.__doc__
        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return f

    return add


def money(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def count(c: Column | None = None) -> Column:
    return F.count(F.lit(1) if c is None else c)


@query(
    "q01_contest_counts",
    """SELECT n_name, c_mktsegment, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, n_name, c_mktsegment) AS position
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name, c_mktsegment""",
)
def contest_counts(spark, t):
    """Counts per contest in their order."""
    counts = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name", "c_mktsegment").agg(count().alias("n"))
    return R.positions(counts, [F.desc("n"), F.asc("n_name"), F.asc("c_mktsegment")], "position")


@query("q02_unnest_ordinal", "SELECT vec_id, (i - 1)::BIGINT AS pos, embedding[i] AS x FROM (SELECT vec_id, embedding, unnest(generate_series(1, len(embedding))) AS i FROM embeddings)")
def unnest_ordinal(spark, t):
    return R.unnest(t("embeddings").select("vec_id", "embedding"), "embedding", "pos", "x").withColumn("pos", F.col("pos").cast("bigint"))


@query("q03_renest", "SELECT o_custkey, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderdate, o_orderkey) AS orders FROM orders GROUP BY o_custkey")
def renest(spark, t):
    nested = R.renest(t("orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey"], "nested")
    return nested.select("o_custkey", F.array_join(F.transform("nested", lambda o: o["o_orderkey"].cast("string")), ",").alias("orders"))


@query("q04_json_scan", "SELECT event_type, count(*) AS n, sum(CAST(props->>'$.k' AS BIGINT))::BIGINT AS total FROM events GROUP BY event_type")
def json_scan(spark, t):
    k = F.from_json("props", "k bigint")["k"]
    return t("events").groupBy("event_type").agg(count().alias("n"), F.sum(k).alias("total"))


EXCLUDED = [(1, "BUILDING"), (7, "MACHINERY"), (24, "AUTOMOBILE"), (99, "NONE")]
EXCLUDED_SQL = "(VALUES " + ", ".join(f"({k}, '{s}')" for k, s in EXCLUDED) + ") AS x(c_nationkey, c_mktsegment)"


def excluded(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(EXCLUDED, "c_nationkey int, c_mktsegment string")


@query("q05_exclude_anti", f"SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS (SELECT 1 FROM {EXCLUDED_SQL} WHERE x.c_nationkey = c.c_nationkey AND x.c_mktsegment = c.c_mktsegment)")
def exclude_anti(spark, t):
    return R.exclude(t("customer"), excluded(spark), ["c_nationkey", "c_mktsegment"]).select("c_custkey", "c_name")


@query("q06_exclude_dropcounts", f"SELECT x.c_nationkey, x.c_mktsegment, count(c_custkey) AS n_dropped FROM {EXCLUDED_SQL} LEFT JOIN customer c ON x.c_nationkey = c.c_nationkey AND x.c_mktsegment = c.c_mktsegment GROUP BY ALL")
def exclude_dropcounts(spark, t):
    return R.exclusion_counts(t("customer"), excluded(spark), ["c_nationkey", "c_mktsegment"])


@query("q07_semi_in", "SELECT n_nationkey, n_name FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9900)")
def semi_in(spark, t):
    rich = t("customer").filter("c_acctbal > 9900").select(F.col("c_nationkey").alias("n_nationkey"))
    return t("nation").join(rich, "n_nationkey", "left_semi").select("n_nationkey", "n_name")


@query("q08_not_in_exceptions", "SELECT c_nationkey, count(*) AS n FROM customer WHERE c_nationkey NOT IN (0, 5, 12) GROUP BY c_nationkey")
def not_in_exceptions(spark, t):
    exceptions = spark.createDataFrame([(0,), (5,), (12,)], "c_nationkey int")
    return R.exclude(t("customer").groupBy("c_nationkey").agg(count().alias("n")), exceptions, ["c_nationkey"])


@query("q09_overlap_probe", "SELECT DISTINCT a.c_nationkey, a.c_mktsegment FROM customer a JOIN customer b ON a.c_nationkey = b.c_nationkey AND a.c_mktsegment = b.c_mktsegment WHERE a.c_acctbal > 9000 AND b.c_acctbal < -900")
def overlap_probe(spark, t):
    keys = ["c_nationkey", "c_mktsegment"]
    return t("customer").filter("c_acctbal > 9000").select(*keys).intersect(t("customer").filter("c_acctbal < -900").select(*keys))


@query(
    "q10_seat_reconcile",
    """SELECT o_orderkey, o_totalprice::DECIMAL(18,2) AS told, total, total - o_totalprice::DECIMAL(18,2) AS delta FROM orders JOIN
    (SELECT l_orderkey, sum(l_extendedprice::DECIMAL(18,2))::DECIMAL(18,2) AS total FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey WHERE total <> o_totalprice::DECIMAL(18,2)""",
)
def seat_reconcile(spark, t):
    total = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(money("l_extendedprice")).cast("decimal(18,2)").alias("total"))
    joined = t("orders").join(total, "o_orderkey").select("o_orderkey", money("o_totalprice").alias("told"), "total")
    return joined.withColumn("delta", (F.col("total") - F.col("told")).cast("decimal(19,2)")).filter("delta <> 0")


@query(
    "q11_enrich_left3",
    """SELECT n_nationkey, coalesce(label, n_name) AS name, coalesce(c.n, 0) AS n_customers, coalesce(s.n, 0) AS n_suppliers FROM nation
    LEFT JOIN (SELECT c_nationkey, count(*) n FROM customer WHERE c_acctbal > 9990 GROUP BY 1) c ON c_nationkey = n_nationkey
    LEFT JOIN (SELECT s_nationkey, count(*) n FROM supplier WHERE s_acctbal > 8000 GROUP BY 1) s ON s_nationkey = n_nationkey
    LEFT JOIN (VALUES (3, 'Third'), (77, 'None')) AS o(k, label) ON k = n_nationkey""",
)
def enrich_left3(spark, t):
    c = t("customer").filter("c_acctbal > 9990").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(count().alias("n_customers"))
    s = t("supplier").filter("s_acctbal > 8000").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(count().alias("n_suppliers"))
    labels = R.control(spark.createDataFrame([(3, "Third"), (77, "None")], "n_nationkey int, label string"))
    joined = t("nation").join(c, "n_nationkey", "left").join(s, "n_nationkey", "left").join(labels, "n_nationkey", "left")
    return joined.select("n_nationkey", F.coalesce("label", "n_name").alias("name"), F.coalesce("n_customers", F.lit(0)).alias("n_customers"), F.coalesce("n_suppliers", F.lit(0)).alias("n_suppliers"))


@query("q12_name_agreement", "SELECT DISTINCT r.census_id, r.csdname AS told, m.csdname AS name FROM council_races r JOIN municipality_type m USING (census_id) WHERE r.csdname <> m.csdname")
def name_agreement(spark, t):
    told = t("council_races").select("census_id", F.col("csdname").alias("told")).distinct()
    return told.join(t("municipality_type").select("census_id", F.col("csdname").alias("name")), "census_id").filter("told <> name")


@query("q13_denorm_guard", "SELECT (SELECT count(*) FROM orders) AS n_before, count(*) AS n_after, count(c_custkey) AS n_matched FROM orders LEFT JOIN customer ON c_custkey = o_custkey")
def denorm_guard(spark, t):
    wide = t("orders").join(t("customer").withColumnRenamed("c_custkey", "o_custkey"), "o_custkey", "left")
    after = wide.agg(count().alias("n_after"), count(F.col("c_name")).alias("n_matched"))
    return t("orders").agg(count().alias("n_before")).crossJoin(after)  # one row each


@query(
    "q14_positional_order",
    """WITH d AS (SELECT census_id, row_number() OVER (ORDER BY csdname NULLS LAST, census_id) AS pos FROM municipality_type)
    SELECT row_id, r.census_id, pos, row_number() OVER (PARTITION BY r.census_id ORDER BY row_id) AS place FROM council_races r LEFT JOIN d USING (census_id)""",
)
def positional_order(spark, t):
    """Rows in the order of their municipality's position, their own order kept within."""
    position = R.positions(t("municipality_type").select("census_id", "csdname"), [F.asc_nulls_last("csdname"), F.asc("census_id")], "pos").drop("csdname")
    placed = R.positions(t("council_races").select("row_id", "census_id"), [F.asc("row_id")], "place", by=["census_id"])
    return placed.join(R.control(position), "census_id", "left")


@query(
    "q15_roundtrip_except",
    """WITH back AS (SELECT DISTINCT n.* FROM nation n JOIN customer ON c_nationkey = n_nationkey) SELECT (SELECT count(*) FROM (SELECT * FROM nation EXCEPT ALL SELECT * FROM back)) AS n_lost,
    (SELECT count(*) FROM (SELECT * FROM back EXCEPT ALL SELECT * FROM nation)) AS n_made, (SELECT count(*) FROM nation) AS n_rows""",
)
def roundtrip_except(spark, t):
    """Nations denormalised to customers and collapsed again equal the nations that have any."""
    nation = t("nation")
    wide = t("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    differ = R.bag_difference(nation, wide.select(*nation.columns).distinct())
    counts = differ.agg(count(F.when(F.col("side") == "left", 1)).alias("n_lost"), count(F.when(F.col("side") == "right", 1)).alias("n_made"))
    return counts.crossJoin(nation.agg(count().alias("n_rows")))  # one row each


@query(
    "q16_serve_union",
    """WITH d AS (SELECT DISTINCT c_nationkey AS area, c_mktsegment AS part FROM customer UNION SELECT DISTINCT c_nationkey, '99' FROM customer),
    f AS (SELECT s_nationkey AS area, NULL AS part, s_name AS name FROM supplier UNION ALL SELECT c_nationkey, c_mktsegment, c_name FROM customer WHERE c_acctbal > 5000)
    SELECT d.area, d.part, count(*) AS n, min(name) AS least, max(name) AS most FROM d JOIN f ON f.area = d.area AND (f.part IS NULL OR f.part = d.part) GROUP BY ALL""",
)
def serve_union(spark, t):
    c = t("customer").select(F.col("c_nationkey").alias("area"), F.col("c_mktsegment").alias("part"), F.col("c_name").alias("name"), "c_acctbal")
    wide = t("supplier").select(F.col("s_nationkey").alias("area"), F.col("s_name").alias("name"))
    served = R.serve(wide, c.filter("c_acctbal > 5000").drop("c_acctbal"), R.part_domain(c, "area", "part", "99"), "area", "part")
    return served.groupBy("area", "part").agg(count().alias("n"), F.min("name").alias("least"), F.max("name").alias("most"))


@query(
    "q17_serve_fields",
    """WITH f AS (SELECT c_nationkey AS area, c_mktsegment AS stem, max((c_acctbal <= 9990)::INT) AS flag, min((c_acctbal <= 9990)::INT) AS accl, sum(1) AS votes FROM customer WHERE c_acctbal > 9900 GROUP BY ALL)
    SELECT n_nationkey AS area, s.stem, coalesce(flag, 0)::BIGINT AS served, accl::BIGINT AS accl, votes::BIGINT AS votes FROM nation CROSS JOIN
    (VALUES ('AUTOMOBILE'), ('BUILDING'), ('NONE')) AS s(stem) LEFT JOIN f ON f.area = n_nationkey AND f.stem = s.stem""",
)
def serve_fields(spark, t):
    """Every area with every stem: flag 0 and blanks where there is nothing."""
    low = (F.col("c_acctbal") <= 9990).cast("bigint")
    facts = t("customer").filter("c_acctbal > 9900").groupBy(F.col("c_nationkey").alias("area"), F.col("c_mktsegment").alias("stem")).agg(F.max(low).alias("flag"), F.min(low).alias("accl"), count().alias("votes"))
    stems = {"stem": ["AUTOMOBILE", "BUILDING", "NONE"]}
    cells = R.dense(t("nation").select(F.col("n_nationkey").alias("area")), stems, facts, ["area", "stem"])
    return cells.select("area", "stem", F.coalesce("flag", F.lit(0)).alias("served"), "accl", "votes")


@query("q18_key_coverage", "SELECT coalesce(c_custkey, o_custkey) AS k, CASE WHEN o_custkey IS NULL THEN 'left' ELSE 'right' END AS side FROM (SELECT DISTINCT c_custkey FROM customer WHERE c_acctbal > 5000) FULL JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 400000) ON c_custkey = o_custkey WHERE c_custkey IS NULL OR o_custkey IS NULL")
def key_coverage(spark, t):
    a = t("customer").filter("c_acctbal > 5000").select(F.col("c_custkey").alias("k"))
    return R.coverage(a, t("orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("k")), ["k"])


ASKED = [(1, "1000007", "Ward 1"), (2, "1000007", None), (3, "1000007", "Ward 999"), (4, "0", "99")]


@query(
    "q19_point_lookup",
    """WITH s AS (SELECT census_id, ward, count(*) AS n FROM served_name WHERE name_field = 'mayor' OR name_field = 'coun_ward' GROUP BY ALL)
    SELECT id, q.census_id, coalesce(q.ward, '99') AS ward, n FROM (VALUES (1, '1000007', 'Ward 1'), (2, '1000007', NULL), (3, '1000007', 'Ward 999'), (4, '0', '99')) AS q(id, census_id, ward) LEFT JOIN s ON s.census_id = q.census_id AND s.ward = coalesce(q.ward, '99')""",
)
def point_lookup(spark, t):
    served = t("served_name").filter("name_field IN ('mayor', 'coun_ward')").groupBy("census_id", "ward").agg(count().alias("n"))
    return R.lookup(spark.createDataFrame(ASKED, "id int, census_id string, ward string"), served, ["census_id", "ward"], {"ward": "99"})


@query(
    "q20_token_dim_lookup",
    """WITH d AS (SELECT token, min(rank) AS rank FROM (SELECT lower(split_part(p_name, ' ', 1)) AS token, p_size AS rank FROM part) GROUP BY token)
    SELECT p_partkey, u.token, rank::BIGINT AS rank FROM (SELECT p_partkey, unnest(string_split(lower(p_name), ' ')) AS token FROM part) u LEFT JOIN d ON d.token = u.token""",
)
def token_dim_lookup(spark, t):
    dim = t("part").groupBy(F.lower(F.element_at(F.split("p_name", " "), 1)).alias("token")).agg(F.min("p_size").cast("bigint").alias("rank"))
    return t("part").select("p_partkey", F.explode(F.split(F.lower("p_name"), " ")).alias("token")).join(dim, "token", "left").select("p_partkey", "token", "rank")


@query("q21_coverage_anti", "SELECT n_nationkey, s.segment FROM nation CROSS JOIN (VALUES ('BUILDING'), ('MACHINERY'), ('TRAVEL')) AS s(segment) WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_nationkey = n_nationkey AND c_mktsegment = segment AND c_acctbal > 9000)")
def coverage_anti(spark, t):
    wanted = t("nation").select("n_nationkey", F.explode(F.array(*map(F.lit, ("BUILDING", "MACHINERY", "TRAVEL")))).alias("segment"))
    have = t("customer").filter("c_acctbal > 9000").select(F.col("c_nationkey").alias("n_nationkey"), F.col("c_mktsegment").alias("segment")).distinct()
    return wanted.join(have, ["n_nationkey", "segment"], "left_anti")


@query(
    "q22_ranked_pick",
    """SELECT c_custkey, s_suppkey, exact FROM (SELECT c_custkey, s_suppkey, (round(s_acctbal / 1000) = round(c_acctbal / 1000)) AS exact,
    row_number() OVER (PARTITION BY c_custkey ORDER BY (round(s_acctbal / 1000) = round(c_acctbal / 1000)) DESC NULLS LAST, s_suppkey) AS rn FROM customer LEFT JOIN supplier ON s_nationkey = c_nationkey) WHERE rn = 1""",
)
def ranked_pick(spark, t):
    """Of the suppliers of a customer's nation the first with the same rounded balance, else the first: both are picked before the join, so no pairs meet."""
    rounded = lambda c: F.round(F.col(c) / 1000)
    supplier = t("supplier").select(F.col("s_nationkey").alias("c_nationkey"), rounded("s_acctbal").alias("about"), "s_suppkey")
    exact = supplier.groupBy("c_nationkey", "about").agg(F.min("s_suppkey").alias("exact_key"))
    # With a null outcome a supplier comes last, so it is picked only where no other is.
    first = supplier.groupBy("c_nationkey").agg(F.min(F.when(F.col("about").isNotNull(), F.col("s_suppkey"))).alias("first_key"), F.min("s_suppkey").alias("any_key"))
    c = t("customer").select("c_custkey", "c_nationkey", rounded("c_acctbal").alias("about")).join(exact, ["c_nationkey", "about"], "left").join(first, "c_nationkey", "left")
    told = F.when(F.col("about").isNotNull(), F.coalesce("exact_key", "first_key", "any_key")).otherwise(F.col("any_key"))
    known = F.col("about").isNotNull() & F.coalesce("exact_key", "first_key").isNotNull()
    return c.select("c_custkey", told.alias("s_suppkey"), F.when(known, F.col("exact_key").isNotNull()).alias("exact"))


@query("q23_any_max", "SELECT census_id, bool_or(max_votes > 1) AS block_vote, max(max_votes)::BIGINT AS max_votes_max FROM council_races GROUP BY census_id")
def any_max(spark, t):
    return t("council_races").groupBy("census_id").agg(F.bool_or(F.col("max_votes") > 1).alias("block_vote"), F.max("max_votes").cast("bigint").alias("max_votes_max"))


@query(
    "q24_unique_paste",
    """SELECT census_id, string_agg(office, ' | ' ORDER BY first_at) AS offices FROM (SELECT census_id, office, min(row_id) AS first_at FROM council_races WHERE office IS NOT NULL GROUP BY ALL) GROUP BY census_id""",
)
def unique_paste(spark, t):
    first = t("council_races").filter("office IS NOT NULL").groupBy("census_id", "office").agg(F.min("row_id").alias("at"))
    return first.groupBy("census_id").agg(R.ordered_join("office", "at", " | ").alias("offices"))


@query("q25_global_totals", "SELECT count(*) AS n, count(DISTINCT o_custkey) AS n_customers, sum(o_totalprice::DECIMAL(18,2))::DECIMAL(28,2) AS total FROM orders")
def global_totals(spark, t):
    return t("orders").agg(count().alias("n"), F.count_distinct("o_custkey").alias("n_customers"), F.sum(money("o_totalprice")).alias("total"))


@query("q26_count_distinct", "SELECT l_returnflag, count(*) AS n FROM (SELECT DISTINCT l_returnflag, l_suppkey, l_linenumber, l_linestatus FROM lineitem) GROUP BY l_returnflag")
def count_distinct(spark, t):
    return t("lineitem").groupBy("l_returnflag").agg(F.count_distinct("l_suppkey", "l_linenumber", "l_linestatus").alias("n"))


@query(
    "q27_argmax_first",
    """SELECT name_field, census_id, ward, n FROM (SELECT name_field, census_id, ward, count(*) AS n, row_number() OVER (PARTITION BY name_field ORDER BY count(*) DESC, census_id, ward) AS rn
    FROM served_name GROUP BY name_field, census_id, ward) WHERE rn = 1""",
)
def argmax_first(spark, t):
    lists = t("served_name").groupBy("name_field", "census_id", "ward").agg(count().alias("n"))
    return R.ranked_pick(lists, ["name_field"], [F.desc("n"), F.asc_nulls_last("census_id"), F.asc_nulls_last("ward")])


@query("q28_max_list_len", "SELECT build_no, max(len(mayor))::BIGINT AS mayor, max(len(coun_ward))::BIGINT AS coun_ward, max(len(coun_reg))::BIGINT AS coun_reg FROM served_entry GROUP BY build_no")
def max_list_len(spark, t):
    longest = (F.max(F.size(c)).cast("bigint").alias(c) for c in ("mayor", "coun_ward", "coun_reg"))
    return t("served_entry").groupBy("build_no").agg(*longest)


@query("q29_invariance", "SELECT census_id FROM election_structure GROUP BY census_id HAVING count(DISTINCT coalesce(provider, '?') || '|' || coalesce(pop_2021::VARCHAR, '?') || '|' || coalesce(election_type, '?')) > 1")
def invariance(spark, t):
    return R.varying_groups(t("election_structure"), ["census_id"], ["provider", "pop_2021", "election_type"])


@query("q30_distinct_first", "SELECT election_type, count(*) AS n, sum(pop_2021)::BIGINT AS pop FROM (SELECT * FROM election_structure QUALIFY row_number() OVER (PARTITION BY census_id ORDER BY row_id) = 1) GROUP BY election_type")
def distinct_first(spark, t):
    """One row per municipality before its population is summed."""
    return R.ranked_pick(t("election_structure"), ["census_id"], [F.col("row_id")]).groupBy("election_type").agg(count().alias("n"), F.sum("pop_2021").alias("pop"))


@query("q31_dup_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def dup_keys(spark, t):
    return R.repeated_keys(t("lineitem"), ["l_orderkey", "l_linenumber"])


@query("q32_charset", "SELECT ch, count(*) AS n FROM (SELECT unnest(string_split(csdname, '')) AS ch FROM municipality_type) WHERE ch <> '' GROUP BY ch")
def charset(spark, t):
    return t("municipality_type").select(F.explode(F.split("csdname", "")).alias("ch")).filter("ch <> ''").groupBy("ch").agg(count().alias("n"))


@query(
    "q33_magnitude_rollup",
    """SELECT census_id, office, sum(n_districts * seats_per_district)::BIGINT AS seats, count(*) AS n, grouping(office)::BIGINT AS rolled FROM council_races
    WHERE office IS NOT NULL GROUP BY GROUPING SETS ((census_id, office), (census_id))""",
)
def magnitude_rollup(spark, t):
    races = t("council_races").filter("office IS NOT NULL").withColumn("seats", (F.col("n_districts") * F.col("seats_per_district")).cast("bigint"))
    fine = races.groupBy("census_id", "office").agg(F.sum("seats").alias("seats"), count().alias("n"))
    # The coarser grain follows from the finer one, so the rows are aggregated once.
    coarse = fine.groupBy("census_id").agg(F.sum("seats").alias("seats"), F.sum("n").alias("n"))
    return fine.withColumn("rolled", F.lit(0).cast("bigint")).unionByName(coarse.select("census_id", F.lit(None).cast("string").alias("office"), "seats", "n", F.lit(1).cast("bigint").alias("rolled")))


OVERRIDES = [("1", "o_orderstatus", None, "X"), ("2", "o_orderstatus", "F", "X"), ("2", "o_orderpriority", "1-URGENT", "9"), ("3", "o_orderstatus", "O", "X"), ("4", "o_orderstatus", "P", "X"), ("-1", "o_orderstatus", "F", "X")]
OVERRIDES_SQL = "(VALUES " + ", ".join("(" + ", ".join("NULL" if v is None else f"'{v}'" for v in r) + ")" for r in OVERRIDES) + ") AS v(key, col, old_value, new_value)"


@query(
    "q34_overlay_update",
    f"""SELECT o_orderkey, coalesce(a.new_value, o_orderstatus) AS o_orderstatus, coalesce(b.new_value, o_orderpriority) AS o_orderpriority FROM orders
    LEFT JOIN {OVERRIDES_SQL.replace(') AS v(', ') AS a(')} ON a.key = o_orderkey::VARCHAR AND a.col = 'o_orderstatus' AND a.old_value IS NOT DISTINCT FROM o_orderstatus
    LEFT JOIN {OVERRIDES_SQL.replace(') AS v(', ') AS b(')} ON b.key = o_orderkey::VARCHAR AND b.col = 'o_orderpriority' AND b.old_value IS NOT DISTINCT FROM o_orderpriority""",
)
def overlay_update(spark, t):
    overrides = spark.createDataFrame(OVERRIDES, "key string, column string, old_value string, new_value string").withColumn("key", F.col("key").cast("bigint"))
    return R.overlay(t("orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), overrides, "o_orderkey", ["o_orderstatus", "o_orderpriority"])


@query(
    "q34_overlay_faults",
    f"""SELECT v.key::BIGINT AS key, col AS column_name, CASE WHEN o_orderkey IS NULL THEN 'target' ELSE 'stale' END AS fault FROM {OVERRIDES_SQL} LEFT JOIN orders ON o_orderkey::VARCHAR = v.key
    WHERE o_orderkey IS NULL OR old_value IS DISTINCT FROM CASE col WHEN 'o_orderstatus' THEN o_orderstatus ELSE o_orderpriority END""",
)
def overlay_faults(spark, t):
    overrides = spark.createDataFrame(OVERRIDES, "key string, column string, old_value string, new_value string").withColumn("key", F.col("key").cast("bigint"))
    return R.overlay_faults(t("orders"), overrides, "o_orderkey", ["o_orderstatus", "o_orderpriority"]).withColumnRenamed("column", "column_name")


@query("q35_key_remap", "SELECT coalesce(new_key, c_nationkey) AS c_nationkey, count(*) AS n FROM customer LEFT JOIN (VALUES (1, 2), (7, 30), (40, 41)) AS r(old_key, new_key) ON old_key = c_nationkey WHERE coalesce(new_key, c_nationkey) IN (2, 3, 30) GROUP BY 1")
def key_remap(spark, t):
    remap = spark.createDataFrame([(1, 2), (7, 30), (40, 41)], "old_key int, new_key int")
    kept = spark.createDataFrame([(2,), (3,), (30,)], "c_nationkey int")
    return R.remap_keys(t("customer").select("c_custkey", "c_nationkey"), remap, "c_nationkey").join(R.control(kept), "c_nationkey", "left_semi").groupBy("c_nationkey").agg(count().alias("n"))
