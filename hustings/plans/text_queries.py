"""Queries of label, name, order, set and constraint operators, each with the same in SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from hustings.functions import names as N
from hustings.operators import constraints as K
from hustings.operators import relational as R
from hustings.plans.relational_queries import QUERIES, count, query  # noqa: F401


#: Cells that hold a pair (`1&5`), and joint labels (`Wards 1, 5`); the ends of a range (`Wards 1-8`) aren't all of its labels.
PAIR, JOINT, RANGE = r"[0-9]\s*&\s*[0-9]", r"(?i)^\W*wards\W+[0-9]", r"[0-9]\s*[-\x{2010}-\x{2015}\x{2212}]\s*[0-9]"


@query(
    "q36_pair_expand",
    f"""SELECT row_id, 'Ward ' || n AS ward FROM (SELECT row_id, unnest(regexp_extract_all(districts, '\\d+')) AS n FROM council_races
    WHERE regexp_matches(districts, '{PAIR}') OR regexp_matches(districts, '{JOINT}') AND NOT regexp_matches(districts, '{RANGE}'))""",
)
def pair_expand(spark, t):
    """Every cell of pairs or joint labels, however its parts are separated or quoted."""
    cell = F.col("districts")
    joint = t("council_races").filter(cell.rlike(PAIR) | cell.rlike(JOINT) & ~cell.rlike(RANGE))
    return joint.select("row_id", F.explode(N.label_parts(cell)).alias("ward"))


STEMS = {"mayor": "mayor", "ward": "coun_ward", "atlarge": "coun_atlarge", "regional councillor": "coun_reg", "deputy mayor": "dep_mayor"}


@query(
    "q37_atlarge_collapse",
    """SELECT row_id, CASE WHEN district_scope = 'At-large' THEN '99' ELSE districts END AS label, CASE district_scope WHEN 'At-large' THEN 'atlarge' WHEN 'Ward' THEN 'ward' WHEN 'Ward-pair' THEN 'ward' END AS stem,
    district_scope IS NULL OR district_scope NOT IN ('At-large', 'Ward', 'Ward-pair') AS unmatched FROM council_races""",
)
def atlarge_collapse(spark, t):
    stems = F.create_map(*map(F.lit, ("At-large", "atlarge", "Ward", "ward", "Ward-pair", "ward")))
    stem = F.try_element_at(stems, F.col("district_scope"))
    label = F.when(F.col("district_scope") == "At-large", "99").otherwise(F.col("districts"))
    return t("council_races").select("row_id", label.alias("label"), stem.alias("stem"), stem.isNull().alias("unmatched"))


@query(
    "q38_shared_split",
    """WITH wide AS (SELECT c_nationkey, c_custkey, c_name, n_name, n_regionkey FROM customer JOIN nation ON n_nationkey = c_nationkey),
    shared AS (SELECT DISTINCT c_nationkey, n_name, n_regionkey FROM wide), own AS (SELECT c_nationkey, c_custkey, c_name FROM wide), again AS (SELECT c_nationkey, c_custkey, c_name, n_name, n_regionkey FROM own JOIN shared USING (c_nationkey))
    SELECT (SELECT count(*) FROM shared) AS n_shared, (SELECT count(*) FROM own) AS n_own,
    (SELECT count(*) FROM (SELECT * FROM wide EXCEPT ALL SELECT * FROM again)) + (SELECT count(*) FROM (SELECT * FROM again EXCEPT ALL SELECT * FROM wide)) AS n_differ""",
)
def shared_split(spark, t):
    """An invariant half split off and joined back gives the same rows."""
    wide = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_nationkey", "c_custkey", "c_name", "n_name", "n_regionkey")
    shared, own = R.split_shared(wide, "c_nationkey", "c_custkey", ["n_name", "n_regionkey"], ["c_name"])
    differ = R.bag_difference(wide, R.join_shared(shared, own, "c_nationkey"))
    return shared.agg(count().alias("n_shared")).crossJoin(own.agg(count().alias("n_own"))).crossJoin(differ.agg(count().alias("n_differ")))  # one row each


@query(
    "q39_pivot_numbered",
    """SELECT c_nationkey, max(c_name) FILTER (place = 1) AS name1, max(c_name) FILTER (place = 2) AS name2, max(c_name) FILTER (place = 3) AS name3 FROM
    (SELECT c_nationkey, c_name, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS place FROM customer) GROUP BY c_nationkey""",
)
def pivot_numbered(spark, t):
    return R.numbered(t("customer").withColumn("low", -F.col("c_acctbal")), ["c_nationkey"], "c_name", ["low", "c_custkey"], "name", 3)


@query(
    "q40_collated_rank",
    """SELECT name_id, row_number() OVER (PARTITION BY census_id, ward, name_field ORDER BY cand_name COLLATE en NULLS FIRST, cand_name NULLS FIRST, name_id) AS rank FROM served_name""",
)
def collated_rank(spark, t):
    """The rank of every served name within its list."""
    order = Window.partitionBy("census_id", "ward", "name_field").orderBy(R.collated("cand_name"), "cand_name", "name_id")
    return t("served_name").select("name_id", F.row_number().over(order).cast("bigint").alias("rank"))


@query(
    "q41_ward_label_order",
    """SELECT census_id, ward, row_number() OVER (PARTITION BY census_id ORDER BY ward = '99', ward COLLATE en, ward) AS place FROM (SELECT DISTINCT census_id, ward FROM served_entry)""",
)
def ward_label_order(spark, t):
    """Ward labels in the order of names, the sentinel last."""
    order = Window.partitionBy("census_id").orderBy(F.col("ward") == "99", R.collated("ward"), "ward")
    return t("served_entry").select("census_id", "ward").distinct().withColumn("place", F.row_number().over(order).cast("bigint"))


@query(
    "q42_set_ops",
    """WITH a AS (SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 9950), b AS (SELECT s_nationkey AS k FROM supplier WHERE s_acctbal > 5000)
    SELECT 'both' AS op, k FROM (SELECT k FROM a INTERSECT SELECT k FROM b) UNION ALL SELECT 'left', k FROM (SELECT k FROM a EXCEPT SELECT k FROM b)
    UNION ALL SELECT 'either', k FROM (SELECT k FROM a UNION SELECT k FROM b) UNION ALL SELECT 'bag', k FROM (SELECT k FROM a UNION ALL SELECT k FROM b)
    UNION ALL SELECT 'one', k FROM ((SELECT k FROM a EXCEPT SELECT k FROM b) UNION (SELECT k FROM b EXCEPT SELECT k FROM a))""",
)
def set_ops(spark, t):
    a = t("customer").filter("c_acctbal > 9950").select(F.col("c_nationkey").alias("k"))
    b = t("supplier").filter("s_acctbal > 5000").select(F.col("s_nationkey").alias("k"))
    parts = {"both": a.intersect(b), "left": a.subtract(b), "either": a.union(b).distinct(), "bag": a.union(b), "one": a.subtract(b).union(b.subtract(a)).distinct()}
    out = None
    for op, df in parts.items():
        part = df.select(F.lit(op).alias("op"), "k")
        out = part if out is None else out.unionByName(part)
    return out


#: The characters of Unicode's White_Space, as a class of DuckDB's expressions, whose \\s knows those of ASCII only.
BLANKS = r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
SUFFIX_LIST, PARTICLE_LIST = (", ".join(f"'{x}'" for x in words) for words in (N.SUFFIXES, N.PARTICLES))
#: `raw`: every served name given name first, as such lists are published.
FLIPPED = r"regexp_replace(cand_name, '^([^,]*), (.*)$', '\2 \1')"
MARK = r"(?:\(([^()]*)\)|\"([^\"]*)\"|“([^”]*)”)"
NORM = lambda c: f"trim(regexp_replace(coalesce({c}, ''), '{BLANKS}+', ' ', 'g'), ' ')"
IS_SUFFIX = lambda t: f"coalesce(regexp_replace(lower({t}), '^\\.+|\\.+$', '', 'g') IN ({SUFFIX_LIST}), false)"
#: t: the tokens of a name given name first; f: its surname and given name without a vote on middle names.
FIRST_LAST = f"""t AS (SELECT *, list_filter(string_split(regexp_replace({NORM(f"regexp_replace(raw, '{MARK}', ' ', 'g')")}, '{BLANKS}*,{BLANKS}*', ' ', 'g'), ' '), lambda x: x <> '') AS tokens,
        trim(regexp_extract(raw, '{MARK}', 1) || regexp_extract(raw, '{MARK}', 2) || regexp_extract(raw, '{MARK}', 3), ' ') AS nick FROM n),
    u AS (SELECT *, len(tokens) - (len(tokens) > 2 AND {IS_SUFFIX("tokens[-1]")})::INT AS core FROM t),
    v AS (SELECT *, coalesce(list_min(list_filter(range(2, core), lambda i: lower(tokens[i]) IN ({PARTICLE_LIST}))), core) AS begins FROM u),
    f AS (SELECT *, CASE WHEN len(tokens) = 0 THEN {NORM("raw")} WHEN len(tokens) = 1 THEN tokens[1] ELSE trim(array_to_string(tokens[begins:core], ' ') || CASE WHEN core < len(tokens) THEN ' ' || tokens[-1] ELSE '' END, ' ') END AS fl_last,
        CASE WHEN len(tokens) = 0 THEN '' ELSE trim(CASE WHEN len(tokens) = 1 THEN '' ELSE array_to_string(tokens[1:begins - 1], ' ') END || CASE WHEN nick <> '' THEN ' (' || nick || ')' ELSE '' END, ' ') END AS fl_first FROM v)"""


def in_capitals(c: str) -> str:
    """``upper`` with the letters that become several, which DuckDB leaves alone."""
    for small, large in (("ß", "SS"), ("ﬀ", "FF"), ("ﬁ", "FI"), ("ﬂ", "FL"), ("ﬃ", "FFI"), ("ﬄ", "FFL"), ("ﬅ", "ST"), ("ﬆ", "ST")):
        c = f"replace({c}, '{small}', '{large}')"
    return f"upper({c})"


def flipped(t):
    return t("served_name").select("name_id", F.regexp_replace("cand_name", "^([^,]*), (.*)$", "$2 $1").alias("raw"))


@query(
    "q43_split_last_first",
    f"""SELECT name_id, CASE WHEN s THEN p[1] || ', ' || p[2] ELSE p[1] END AS last, array_to_string(p[CASE WHEN s THEN 3 ELSE 2 END:], ', ') AS first FROM
    (SELECT name_id, p, len(p) >= 3 AND {IS_SUFFIX("p[2]")} AS s FROM (SELECT name_id, list_transform(string_split(cand_name, ','), lambda x: trim(x, ' ')) AS p FROM served_name))""",
)
def split_last_first(spark, t):
    split = N.split_last_first(F.col("cand_name"))
    return t("served_name").select("name_id", split["last"].alias("last"), split["first"].alias("first"))


@query(
    "q44_split_caps_surname",
    f"""WITH n AS (SELECT name_id, {FLIPPED} AS raw FROM served_name), {FIRST_LAST},
    c AS (SELECT *, string_split({NORM("raw")}, ' ') AS w FROM f), d AS (SELECT *, list_transform(w, lambda x: length(x) > 1 AND x = upper(x) AND regexp_matches(x, '[A-ZÀ-Þ]')) AS caps FROM c),
    e AS (SELECT *, list_position(caps, true) AS spot FROM d)
    SELECT name_id, CASE WHEN raw IS NULL THEN '' WHEN spot > 0 AND list_position(caps, false) > 0 THEN array_to_string(w[spot:], ' ') ELSE fl_last END AS last, CASE WHEN raw IS NULL THEN '' WHEN spot > 0 AND list_position(caps, false) > 0 THEN array_to_string(w[1:spot - 1], ' ') ELSE fl_first END AS first FROM e""",
)
def split_caps_surname(spark, t):
    split = N.split_caps_surname(F.col("raw"))
    return flipped(t).select("name_id", F.coalesce(split["last"], F.lit("")).alias("last"), F.coalesce(split["first"], F.lit("")).alias("first"))


@query("q45_split_first_last", f"WITH n AS (SELECT name_id, {FLIPPED} AS raw FROM served_name), {FIRST_LAST} SELECT name_id, coalesce(fl_last, '') AS last, coalesce(fl_first, '') AS first FROM f")
def split_first_last(spark, t):
    split = N.split_first_last(F.col("raw"))
    return flipped(t).select("name_id", F.coalesce(split["last"], F.lit("")).alias("last"), F.coalesce(split["first"], F.lit("")).alias("first"))


@query(
    "q45_middle_verdict",
    f"""WITH r AS (SELECT p_partkey, split_part(p_name, ' ', 2) AS token, CASE WHEN p_partkey % 7 > 0 THEN p_size * 40 END AS g, CASE WHEN p_partkey % 5 > 0 THEN p_partkey % 90 END AS s FROM part)
    SELECT p_partkey, s IS NOT NULL AND (g IS NULL OR g > {N.GIVEN_RARE} OR g > {N.GIVEN_UNCOMMON} AND s * {N.SURNAME_TIMES} < g) AND NOT i AS surname_like,
    CASE WHEN i THEN 'initial' WHEN s IS NULL THEN 'no surname' WHEN g IS NULL THEN 'no given name' WHEN g > {N.GIVEN_RARE} THEN 'rare given name' WHEN g > {N.GIVEN_UNCOMMON} AND s * {N.SURNAME_TIMES} < g THEN 'commoner surname' ELSE 'given name' END AS why,
    NOT i AND s IS NOT NULL AND (g IS NULL OR g > {N.GIVEN_RARE} OR g > {N.GIVEN_UNCOMMON} AND s * {N.SURNAME_TIMES} < g OR s <= g) AS close FROM (SELECT *, regexp_matches(token, '{N.INITIAL}') AS i FROM r)""",
)
def middle_verdict(spark, t):
    key = F.col("p_partkey")
    rows = t("part").select("p_partkey", F.element_at(F.split("p_name", " "), 2).alias("token"), F.when(key % 7 > 0, F.col("p_size") * 40).alias("g"), F.when(key % 5 > 0, key % 90).alias("s"))
    return rows.select("p_partkey", N.middle_verdict(F.col("token"), F.col("g"), F.col("s")).alias("v")).select("p_partkey", "v.surname_like", "v.why", "v.close")


@query("q46_normalise_text", f"SELECT doc_id, md5({NORM('text')}) AS digest FROM documents")
def normalise_text(spark, t):
    """White space of all texts, of every kind that Unicode knows."""
    return t("documents").select("doc_id", F.md5(N.norm(F.col("text"))).alias("digest"))


@query(
    "q46_name_tails",
    r"""WITH n AS (SELECT name_id, cand_name || CASE collector WHEN 'clerk' THEN ', She/her ' ELSE ' (Withdrawn)' END AS raw FROM served_name)
    SELECT name_id, regexp_replace(raw, '(?i),\s*(she|he|they|ze)/\w+\s*$', '') AS kept, regexp_matches(raw, '(?i)withdraw') AS withdrawn FROM n""",
)
def name_tails(spark, t):
    raw = F.concat("cand_name", F.when(F.col("collector") == "clerk", ", She/her ").otherwise(" (Withdrawn)"))
    return t("served_name").select("name_id", N.without_pronouns(raw).alias("kept"), N.is_withdrawn(raw).alias("withdrawn"))


@query(
    "q47_display_wellformed",
    f"""WITH n AS (SELECT name_id, {NORM("cand_name")} AS c FROM served_name), p AS (SELECT name_id, c, list_transform(string_split(c, ','), lambda x: trim(x, ' ')) AS p FROM n), s AS (SELECT *, len(p) >= 3 AND {IS_SUFFIX("p[2]")} AS s FROM p),
    l AS (SELECT name_id, c AS name_raw, {in_capitals("CASE WHEN s THEN p[1] || ', ' || p[2] ELSE p[1] END")} AS last_name, array_to_string(p[CASE WHEN s THEN 3 ELSE 2 END:], ', ') AS f FROM s),
    d AS (SELECT name_id, name_raw, last_name, CASE WHEN regexp_matches(f, '[\\p{{L}}\\p{{N}}\\p{{M}}_]') THEN f ELSE '' END AS first_name FROM l), e AS (SELECT *, CASE WHEN first_name <> '' THEN last_name || ', ' || first_name ELSE last_name END AS display FROM d)
    SELECT *, display <> '' AND display = trim(display, ' ') AND NOT regexp_matches(display, '^,|,$') AS well_formed, regexp_replace(display, '[\\p{{L}}\\p{{N}}\\p{{M}} \\-,.''’()]', '', 'g') AS odd FROM e""",
)
def display_wellformed(spark, t):
    rows = t("served_name").select("name_id", N.candidate(F.lit("last_first"), F.col("cand_name")).alias("c"))
    rows = rows.select("name_id", "c.name_raw", "c.last_name", "c.first_name", N.display_name(F.col("c.last_name"), F.col("c.first_name")).alias("display"))
    return rows.select("*", N.is_well_formed(F.col("display")).alias("well_formed"), N.odd_characters(F.col("display")).alias("odd"))


@query("q48_url_split", "SELECT row_id, url FROM (SELECT row_id, trim(unnest(string_split(source_url, ';')), ' ') AS url FROM council_races) WHERE url <> ''")
def url_split(spark, t):
    return t("council_races").select("row_id", F.explode(N.url_list(F.col("source_url"))).alias("url"))


@query("q49_count_parse", "SELECT row_id, CASE WHEN regexp_matches(trim(districts, ' '), '^[0-9]+$') THEN nullif(trim(districts, ' ')::BIGINT, 0) END AS n FROM council_races")
def count_parse(spark, t):
    return t("council_races").select("row_id", N.positive_count(F.col("districts")).alias("n"))


@query("q50_enum_rank", "SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '3-MEDIUM' THEN 2 WHEN '2-HIGH' THEN 3 ELSE 4 END::BIGINT AS rank FROM orders")
def enum_rank(spark, t):
    return t("orders").select("o_orderkey", R.enum_rank("o_orderpriority", ["1-URGENT", "3-MEDIUM", "2-HIGH"]).alias("rank"))


@query("q51_null_eq", "SELECT row_id, n_districts IS NOT DISTINCT FROM max_votes AS same, n_districts = max_votes AS equal FROM council_races")
def null_eq(spark, t):
    a, b = F.col("n_districts"), F.col("max_votes")
    return t("council_races").select("row_id", a.eqNullSafe(b).alias("same"), (a == b).alias("equal"))


@query(
    "q52_constraint_report",
    """SELECT 'no null provider' AS rule_id, 'warn' AS severity, count(*) AS n FROM municipality_type WHERE provider IS NULL
    UNION ALL SELECT 'one row per municipality', 'error', count(*) FROM (SELECT census_id FROM municipality_type GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'known scope', 'error', count(*) FROM council_races WHERE coalesce(district_scope NOT IN ('At-large', 'Ward', 'Ward-pair'), true)
    UNION ALL SELECT 'votes at most seats', 'error', count(*) FROM council_races WHERE NOT coalesce(max_votes <= seats_per_district, false)
    UNION ALL SELECT 'municipality known', 'error', count(*) FROM (SELECT DISTINCT census_id FROM council_races) WHERE census_id NOT IN (SELECT census_id FROM municipality_type)
    UNION ALL SELECT 'rows kept', 'error', count(*) FROM (SELECT (SELECT count(*) FROM council_races) AS a, (SELECT count(*) FROM council_races LEFT JOIN municipality_type USING (census_id)) AS b) WHERE a <> b
    UNION ALL SELECT 'several votes are cited', 'error', count(*) FROM council_races WHERE max_votes > 1 AND coalesce(trim(max_votes_source), '') = ''""",
)
def constraint_report(spark, t):
    m, c = t("municipality_type"), t("council_races")
    wide = c.join(m.select("census_id", "pop_2021"), "census_id", "left")
    return K.summary([
        K.not_null("no null provider", m, "provider", "census_id", "warn"),
        K.unique("one row per municipality", m, "census_id"),
        K.known("known scope", c, "district_scope", ["At-large", "Ward", "Ward-pair"], "row_id"),
        K.holds("votes at most seats", c, "max_votes <= seats_per_district", "row_id"),
        K.covered("municipality known", c, m, "census_id"),
        K.same_rows("rows kept", c, wide),
        K.empty("several votes are cited", lambda: c.filter("max_votes > 1 AND coalesce(trim(max_votes_source), '') = ''"), "row_id"),
    ])


@query(
    "q53_newest_version",
    r"""SELECT file_name, built, version FROM (SELECT file_name, regexp_extract(file_name, '-(\d{4}-\d{2}-\d{2})-v\d+\.js$', 1)::DATE AS built, regexp_extract(file_name, '-v(\d+)\.js$', 1)::BIGINT AS version
    FROM (SELECT DISTINCT file_name FROM served_raw WHERE regexp_matches(file_name, '-\d{4}-\d{2}-\d{2}-v\d+\.js$'))) ORDER BY built DESC, version DESC, file_name DESC LIMIT 1""",
)
def newest_version(spark, t):
    from hustings.sources.readers import newest

    return newest(t("served_raw"))


@query("q54_js_literal_escape", "SELECT doc_id, md5(replace(replace(replace(text, '(', '\\('), ')', '\\)'), chr(39), '\\' || chr(39))) AS digest FROM documents")
def js_literal_escape(spark, t):
    return t("documents").select("doc_id", F.md5(N.script_literal(F.col("text"))).alias("digest"))


@query(
    "q55_basic_shape",
    """SELECT o_custkey AS customer, coalesce(n_name_override, c_name) AS name, count(*) AS n_large, min(o_orderkey) AS first_order FROM orders JOIN customer ON c_custkey = o_custkey
    LEFT JOIN (VALUES (1, 'First')) AS o(k, n_name_override) ON k = c_custkey WHERE o_totalprice * 2 > 600000 GROUP BY 1, 2""",
)
def basic_shape(spark, t):
    """Project, cast, compute, filter, rename, override a name, drop what became empty."""
    large = t("orders").withColumn("twice", F.col("o_totalprice") * 2).filter("twice > 600000").drop("twice").groupBy(F.col("o_custkey").alias("customer")).agg(count().alias("n_large"), F.min("o_orderkey").alias("first_order"))
    names = t("customer").select(F.col("c_custkey").alias("customer"), "c_name").join(R.control(spark.createDataFrame([(1, "First")], "customer bigint, told string")), "customer", "left")
    return large.join(names.select("customer", F.coalesce("told", "c_name").alias("name")), "customer").select("customer", "name", "n_large", "first_order")


@query(
    "q56_expected_empty",
    """WITH x AS (SELECT * FROM (VALUES (1, 'BUILDING'), (7, 'MACHINERY')) AS x(k, s)), kept AS (SELECT * FROM customer WHERE NOT EXISTS (SELECT 1 FROM x WHERE k = c_nationkey AND s = c_mktsegment)), sorted AS (SELECT * FROM nation ORDER BY n_name DESC)
    SELECT (SELECT count(*) FROM kept JOIN x ON k = c_nationkey AND s = c_mktsegment) AS n_excluded_served, (SELECT count(*) FROM served_entry WHERE len(list_intersect(coalesce(coun_ward, []), coalesce(coun_atlarge, []))) > 0) AS n_overlapping,
    (SELECT count(*) FROM (SELECT * FROM nation EXCEPT ALL SELECT * FROM sorted)) + (SELECT count(*) FROM (SELECT * FROM sorted EXCEPT ALL SELECT * FROM nation)) AS n_differ""",
)
def expected_empty(spark, t):
    excluded = spark.createDataFrame([(1, "BUILDING"), (7, "MACHINERY")], "c_nationkey int, c_mktsegment string")
    kept = R.exclude(t("customer"), excluded, ["c_nationkey", "c_mktsegment"])
    served = kept.join(R.control(excluded), ["c_nationkey", "c_mktsegment"]).agg(count().alias("n_excluded_served"))
    overlap = t("served_entry").agg(count(F.when(F.arrays_overlap("coun_ward", "coun_atlarge"), 1)).alias("n_overlapping"))
    differ = R.bag_difference(t("nation"), t("nation").orderBy(F.desc("n_name"))).agg(count().alias("n_differ"))
    return served.crossJoin(overlap).crossJoin(differ)  # one row each


@query(
    "q57_ordered_keys",
    """SELECT file_name, census_id, row_number() OVER (ORDER BY file_name, census_id, record_id) AS by_file, row_number() OVER (PARTITION BY census_id ORDER BY build_no DESC, record_id) AS newest FROM served_raw""",
)
def ordered_keys(spark, t):
    rows = R.positions(t("served_raw").select("file_name", "census_id", "record_id", "build_no"), [F.asc("file_name"), F.asc("census_id"), F.asc("record_id")], "by_file")
    rows = R.positions(rows, [F.desc("build_no"), F.asc("record_id")], "newest", by=["census_id"])
    return rows.select("file_name", "census_id", "by_file", "newest")


@query(
    "q58_collections",
    """SELECT vec_id, len(embedding)::BIGINT AS n, embedding[1] AS first, list_contains(embedding, embedding[2]) AS has_second, list_position(embedding, embedding[3])::BIGINT AS at_third,
    len(list_filter(embedding, lambda x: x > 0))::BIGINT AS n_positive, len(list_filter(embedding, lambda x: x > 100)) > 0 AS any_large, len(list_distinct(embedding[1:4] || embedding[1:2]))::BIGINT AS n_distinct, label::BIGINT AS looked_up FROM embeddings""",
)
def collections(spark, t):
    e = F.col("embedding")
    held = F.map_from_arrays(F.array(F.lit("id"), F.lit("label")), F.array(F.col("vec_id"), F.col("label").cast("bigint")))
    return t("embeddings").select(
        "vec_id", F.size(e).cast("bigint").alias("n"), e[0].alias("first"), F.array_contains(e, e[1]).alias("has_second"), F.array_position(e, e[2]).alias("at_third"),
        F.size(F.filter(e, lambda x: x > 0)).cast("bigint").alias("n_positive"), F.exists(e, lambda x: x > 100).alias("any_large"),
        F.size(F.array_distinct(F.concat(F.slice(e, 1, 4), F.slice(e, 1, 2)))).cast("bigint").alias("n_distinct"), F.element_at(held, "label").alias("looked_up"),
    )


@query(
    "q59_assemble_text",
    """SELECT row_id, concat_ws(' - ', csdname, CASE WHEN max_votes > 1 THEN 'up to ' || max_votes || ' votes' WHEN max_votes = 1 THEN 'one vote' ELSE 'votes unknown' END, 'built 2026-08-18') AS line FROM council_races""",
)
def assemble_text(spark, t):
    votes = F.when(F.col("max_votes") > 1, F.concat(F.lit("up to "), F.col("max_votes").cast("string"), F.lit(" votes"))).when(F.col("max_votes") == 1, "one vote").otherwise("votes unknown")
    built = F.concat(F.lit("built "), F.date_format(F.lit("2026-08-18").cast("date"), "yyyy-MM-dd"))
    return t("council_races").select("row_id", F.concat_ws(" - ", "csdname", votes, built).alias("line"))


@query(
    "q60_map_union",
    """SELECT entry_id, cardinality(m)::BIGINT AS n, len(m['mayor'])::BIGINT AS n_mayor, len(m['coun_ward'])::BIGINT AS n_ward, list_sort(map_keys(m))[1] AS least FROM
    (SELECT entry_id, map_concat(map {'mayor': coalesce(mayor, []), 'dep_mayor': coalesce(dep_mayor, [])}, map {'coun_ward': coalesce(coun_ward, []), 'coun_reg': coalesce(coun_reg, [])}) AS m FROM served_entry)""",
)
def map_union(spark, t):
    """The shared half and the ward's own as one map."""
    held = lambda c: (F.lit(c), F.coalesce(F.col(c), F.array().cast("array<string>")))
    m = F.map_concat(F.create_map(*held("mayor"), *held("dep_mayor")), F.create_map(*held("coun_ward"), *held("coun_reg")))
    size = lambda c: F.size(F.element_at(m, F.lit(c))).cast("bigint")
    return t("served_entry").select("entry_id", F.size(m).cast("bigint").alias("n"), size("mayor").alias("n_mayor"), size("coun_ward").alias("n_ward"), F.array_sort(F.map_keys(m))[0].alias("least"))


@query(
    "q61_punctuation_probe",
    """SELECT mark, row_number() OVER (ORDER BY 'A' || mark || 'A' COLLATE en)::BIGINT AS place FROM (SELECT unnest([' ', '-', ',', '.', chr(39), '’', '(', ')']) AS mark)""",
)
def punctuation_probe(spark, t):
    """Where the collation of names puts each mark that a name may hold: the order they are listed in."""
    marks = F.array(*map(F.lit, N.PUNCTUATION))
    return spark.range(1).select(F.explode(F.arrays_zip(marks.alias("mark"), R.in_order(N.PUNCTUATION).alias("place"))).alias("m")).select("m.mark", F.col("m.place").cast("bigint").alias("place"))
