"""The contest queries in SQL, read from the same JSON texts."""

from __future__ import annotations

from hustings.plans import contests as C


def values(rows, names: str) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join("NULL" if v is None else f"'{v}'" for v in r) + ")" for r in rows) + f") AS {names}"


def case(c: str, pairs) -> str:
    return f"CASE {c} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs) + " END"


def rank(c: str, order) -> str:
    return f"CASE {c} " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(order)) + f" ELSE {len(order)} END"


def _parts(known: str, newest: str) -> str:
    """latest: the records; race, district, name: their parts."""
    return f"""
    readable AS (SELECT *, CASE WHEN json_valid(ltrim(races, chr(65279))) THEN CASE WHEN json_type(ltrim(races, chr(65279))) = 'VARCHAR' THEN ltrim(races, chr(65279))::JSON->>'$' ELSE ltrim(races, chr(65279)) END END AS body
        FROM municipality_doc WHERE {known}races IS NOT NULL),
    latest AS (SELECT record_id, census_id, csdname, name_format, coalesce(notes['retrieved'], '{C.RETRIEVED}') AS retrieved, CASE WHEN json_valid(body) THEN body::JSON END AS doc FROM readable WHERE body IS NOT NULL
        {newest}),
    keyed AS (SELECT record_id, e.key AS race_key, e.value AS v FROM (SELECT * FROM latest WHERE json_type(doc) = 'OBJECT'), json_each(doc) e),
    races AS (SELECT record_id, race_key, 0 AS race_pos, v AS j FROM keyed WHERE json_type(v) = 'OBJECT'
        UNION ALL SELECT record_id, race_key, e.rowid, e.value FROM (SELECT * FROM keyed WHERE json_type(v) = 'ARRAY'), json_each(v) e WHERE json_type(e.value) = 'OBJECT'),
    race AS (SELECT record_id, race_key, race_pos, j->'districts' AS d,
        CASE WHEN json_type(j->'office') NOT IN ('OBJECT', 'ARRAY', 'NULL') THEN j->>'office' END AS office, CASE WHEN json_type(j->'scope') NOT IN ('OBJECT', 'ARRAY', 'NULL') THEN j->>'scope' END AS told_scope,
        {", ".join(f"CASE WHEN regexp_matches(trim(j->>'{a}'), '^[+-]?[0-9]+$') THEN TRY_CAST(trim(j->>'{a}') AS INT) END AS {b}" for a, b in (("n_districts", "told_districts"), ("seats", "seats"), ("max_votes", "max_votes")))} FROM races),
    district AS (SELECT record_id, race_key, race_pos, row_number() OVER (PARTITION BY record_id, race_key, race_pos ORDER BY e.id) - 1 AS district_pos, e.key AS district, e.value AS v
            FROM (SELECT * FROM race WHERE json_type(d) = 'OBJECT'), json_each(d) e
        UNION ALL SELECT record_id, race_key, race_pos, e.rowid, CASE WHEN json_type(e.value->'district') = 'VARCHAR' THEN e.value->>'district' END, e.value
            FROM (SELECT * FROM race WHERE json_type(d) = 'ARRAY'), json_each(d) e WHERE json_type(e.value) <> 'NULL'),
    listed AS (SELECT *, CASE json_type(v) WHEN 'ARRAY' THEN v WHEN 'OBJECT' THEN v->'candidates' END AS l FROM district),
    name AS (SELECT record_id, race_key, race_pos, district_pos, e.rowid AS cand_pos, CASE json_type(e.value) WHEN 'VARCHAR' THEN e.value->>'$' WHEN 'OBJECT' THEN CASE WHEN json_type(e.value->'name_raw') = 'VARCHAR' THEN e.value->>'name_raw' END END AS name_raw
        FROM (SELECT * FROM listed WHERE json_type(l) = 'ARRAY'), json_each(l) e WHERE json_type(e.value) <> 'NULL')"""


#: contest: one row per district of the newest record of each municipality; kept: without the excluded ones.
CONTEST = f"""{_parts("census_id IS NOT NULL AND ", "QUALIFY row_number() OVER (PARTITION BY census_id ORDER BY received_at DESC NULLS LAST, record_id DESC NULLS LAST) = 1")},
    counted AS (SELECT record_id, race_key, race_pos, district_pos, count(*) FILTER (WHERE NOT coalesce(regexp_matches(name_raw, '(?i)withdraw'), false)) AS n, count(*) FILTER (WHERE regexp_matches(name_raw, '(?i)withdraw')) AS n_withdrawn FROM name GROUP BY ALL),
    contest AS (SELECT census_id, csdname, name_format, retrieved, record_id, race_key, race_pos, district_pos, office, coalesce(told_scope, CASE race_key WHEN 'ward' THEN 'Ward' ELSE 'At-large' END) AS scope, told_districts, seats, max_votes, district,
        coalesce(n, 0) AS n, coalesce(n_withdrawn, 0) AS n_withdrawn, {case("race_key", C.STEM.items())} AS stem
        FROM district JOIN race USING (record_id, race_key, race_pos) JOIN latest USING (record_id) LEFT JOIN counted USING (record_id, race_key, race_pos, district_pos)),
    excluded AS (SELECT * FROM {values(C.EXCLUDED, "x(census_id, office)")}),
    kept AS (SELECT * FROM contest c WHERE NOT EXISTS (SELECT 1 FROM excluded x WHERE x.census_id = c.census_id AND x.office = c.office)),
    placed AS (SELECT *, CASE WHEN scope = 'At-large' THEN [NULL] WHEN scope = 'Ward-pair' THEN list_transform(regexp_extract_all(district, '\\d+'), lambda x: 'Ward ' || x) ELSE [district] END AS wards FROM kept),
    own AS (SELECT * EXCLUDE wards, unnest(wards) AS ward FROM placed)"""
SERVED = f"""
    domain AS (SELECT census_id, ward FROM own WHERE ward IS NOT NULL AND stem IS NOT NULL UNION SELECT census_id, '{C.NO_WARD}' FROM own WHERE stem IS NOT NULL),
    served AS (SELECT o.* EXCLUDE ward, d.ward FROM domain d JOIN own o ON o.census_id = d.census_id AND (o.ward IS NULL AND o.scope = 'At-large' OR o.ward = d.ward) WHERE o.stem IS NOT NULL)"""
_LIST = ", ".join(f"('{s}')" for s in C.FIELD)
_IN = lambda names: "(" + ", ".join(f"'{n}'" for n in names) + ")"
FIELDS = f"""
    facts AS (SELECT census_id, ward, stem, CASE WHEN count(seats) = count(*) THEN min((n <= seats)::INT) END AS accl, CASE WHEN count(max_votes) = count(*) THEN sum(max_votes)::INT END AS votes, count(*) AS k FROM served GROUP BY ALL),
    fields AS (SELECT d.census_id, d.ward, s.stem, CASE WHEN s.stem IN {_IN(C.SHARED)} THEN 'shared' ELSE 'ward' END AS half, CASE WHEN s.stem IN {_IN(C.FLAGGED)} THEN (k IS NOT NULL)::INT END AS served, accl,
        CASE WHEN s.stem NOT IN {_IN(C.SINGLE_VOTE)} THEN votes END AS max_votes FROM (SELECT DISTINCT census_id, ward FROM served) d CROSS JOIN (VALUES {_LIST}) AS s(stem) LEFT JOIN facts f ON f.census_id = d.census_id AND f.ward = d.ward AND f.stem = s.stem)"""


def _count(rule: str, query: str) -> str:
    return f"SELECT '{rule}' AS rule_id, 'error' AS severity, count(*) AS n FROM ({query})"


_RULES = {
    "name format known": f"SELECT DISTINCT census_id, name_format FROM kept WHERE name_format NOT IN {_IN(('first_last', 'last_first', 'caps_surname', 'pre_split'))}",
    "race key known": "SELECT 1 FROM kept WHERE stem IS NULL",
    "no withdrawn name": "SELECT 1 FROM kept WHERE n_withdrawn > 0",
    "district has names": "SELECT 1 FROM kept WHERE n = 0",
    "districts as told": "SELECT record_id, race_key, race_pos FROM kept GROUP BY record_id, race_key, race_pos HAVING count(*) <> max(told_districts)",
    "seats given": "SELECT 1 FROM kept WHERE seats IS NULL OR max_votes IS NULL",
    "single vote": f"SELECT 1 FROM kept WHERE stem IN {_IN(C.SINGLE_VOTE)} AND max_votes <> 1",
    "pair splits": "SELECT 1 FROM kept WHERE scope = 'Ward-pair' AND NOT coalesce(regexp_matches(district, '\\d'), false)",
    "ward held once in a race": "SELECT 1 FROM own WHERE ward IS NOT NULL AND stem IS NOT NULL GROUP BY census_id, race_key, race_pos, ward HAVING count(*) > 1",
    "ward in one race of a stem": "SELECT 1 FROM own WHERE ward IS NOT NULL AND stem IS NOT NULL GROUP BY census_id, stem, ward HAVING count(DISTINCT (race_key, race_pos)) > 1",
    "scope fits the stem": "SELECT 1 FROM kept WHERE stem = 'ward' AND scope = 'At-large' OR stem = 'atlarge' AND scope <> 'At-large'",
    "contest key unique": "SELECT 1 FROM kept GROUP BY census_id, office, district HAVING count(*) > 1",
    "mayor stands": "SELECT census_id FROM kept GROUP BY census_id HAVING NOT coalesce(bool_or(stem = 'mayor'), false)",
    "a council race": "SELECT census_id FROM kept GROUP BY census_id HAVING NOT coalesce(bool_or(stem IN ('ward', 'atlarge')), false)",
    "municipality known": "SELECT DISTINCT census_id FROM kept WHERE census_id NOT IN (SELECT census_id FROM municipality_type)",
    "municipality collected": "SELECT DISTINCT census_id FROM municipality_type WHERE census_id NOT IN (SELECT census_id FROM kept)",
    "shared half the same in all wards": "SELECT census_id, stem FROM fields WHERE half = 'shared' GROUP BY census_id, stem HAVING count(DISTINCT coalesce(served::VARCHAR, '?') || '|' || coalesce(accl::VARCHAR, '?') || '|' || coalesce(max_votes::VARCHAR, '?')) > 1",
    "same stems everywhere": f"SELECT census_id, ward FROM fields GROUP BY census_id, ward HAVING count(DISTINCT stem) <> {len(C.FIELD)}",
    "halves disjoint": "SELECT stem FROM fields WHERE half = 'shared' INTERSECT SELECT stem FROM fields WHERE half = 'ward'",
    "office collected": """SELECT DISTINCT s.census_id, s.office FROM election_structure s WHERE s.office IS NOT NULL AND s.census_id IN (SELECT census_id FROM kept) AND NOT EXISTS (SELECT 1 FROM excluded x WHERE x.census_id = s.census_id AND x.office = s.office)
        AND NOT EXISTS (SELECT 1 FROM kept k WHERE k.census_id = s.census_id AND k.office = s.office)""",
    "exclusion unique": "SELECT 1 FROM excluded GROUP BY census_id, office HAVING count(*) > 1",
    "exclusion removes": "SELECT x.census_id FROM excluded x LEFT JOIN contest c ON c.census_id = x.census_id AND c.office = x.office GROUP BY x.census_id, x.office HAVING coalesce(sum(c.n), 0) = 0",
}

ORACLE = {
    "p3_found": f"""WITH {_parts("", "")} SELECT record_id, race_key, race_pos, -1 AS district_pos, -1 AS cand_pos FROM races UNION ALL SELECT record_id, race_key, race_pos, district_pos, -1 FROM district
        UNION ALL SELECT record_id, race_key, race_pos, district_pos, cand_pos FROM name""",
    "d1_contest_counts": f"""WITH {CONTEST} SELECT census_id, csdname, race_key, office, scope, district, n, retrieved,
        row_number() OVER (ORDER BY n DESC, csdname NULLS LAST, {rank("race_key", C.BALLOT)}, office NULLS LAST, told_districts NULLS LAST, district_pos, census_id, race_key, race_pos) AS place FROM kept""",
    "d2_served_fields": f"WITH {CONTEST}, {SERVED}, {FIELDS} SELECT census_id, ward, stem, half, served, accl, max_votes FROM fields",
    "d4_violations": f"WITH {CONTEST}, {SERVED}, {FIELDS} " + " UNION ALL ".join(_count(rule, q) for rule, q in _RULES.items()),
    "d5_exclusions": f"WITH {CONTEST} SELECT x.census_id, x.office, coalesce(sum(c.n), 0)::BIGINT AS n_dropped FROM excluded x LEFT JOIN contest c ON c.census_id = x.census_id AND c.office = x.office GROUP BY x.census_id, x.office",
    "d6_structure_rows": f"""WITH {CONTEST}, told AS (SELECT * FROM election_structure s WHERE NOT EXISTS (SELECT 1 FROM excluded x WHERE x.census_id = s.census_id AND x.office = s.office)),
        r AS (SELECT DISTINCT record_id, race_key, race_pos, census_id, office, told_districts, max_votes FROM kept),
        m AS (SELECT r.*, s.row_id, coalesce(s.n_districts = r.told_districts AND s.max_votes = r.max_votes, false) AS agrees, s.district_source_url AS d, s.max_votes_source AS v FROM r LEFT JOIN told s ON s.census_id = r.census_id AND s.office = r.office
            QUALIFY row_number() OVER (PARTITION BY r.record_id, r.race_key, r.race_pos ORDER BY agrees DESC, s.row_id) = 1)
        SELECT record_id, race_key, race_pos, census_id, office, row_id, agrees, array_to_string(list_filter(list_transform(string_split(coalesce(d, ''), ';'), lambda x: trim(x, ' ')), lambda x: x <> ''), ' ') AS district_source_url,
            array_to_string(list_filter(list_transform(string_split(coalesce(v, ''), ';'), lambda x: trim(x, ' ')), lambda x: x <> ''), ' ') AS max_votes_source, row_id IS NULL AND coalesce(office, '') <> 'Mayor' AS not_in_structure FROM m""",
    "d7_run_report": f"""WITH {CONTEST}, {SERVED}, lists AS (SELECT stem, census_id, ward, sum(n)::BIGINT AS n FROM served GROUP BY ALL),
        widest AS (SELECT * FROM lists QUALIFY row_number() OVER (PARTITION BY stem ORDER BY n DESC, census_id, ward = '{C.NO_WARD}', ward) = 1)
        SELECT 'totals' AS section, item, n FROM (SELECT count(DISTINCT census_id) AS municipalities, count(DISTINCT (record_id, race_key, race_pos)) AS races, count(*) AS contests, coalesce(sum(n), 0)::BIGINT AS candidates FROM kept) UNPIVOT (n FOR item IN (municipalities, races, contests, candidates))
        UNION ALL SELECT 'excluded', x.census_id || ' ' || x.office, coalesce(sum(c.n), 0)::BIGINT FROM excluded x LEFT JOIN contest c ON c.census_id = x.census_id AND c.office = x.office GROUP BY x.census_id, x.office
        UNION ALL SELECT 'widest', {case("stem", C.FIELD.items())} || ' ' || census_id || ' ' || ward, n FROM widest""",
}
