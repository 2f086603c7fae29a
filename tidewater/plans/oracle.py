"""Independent ANSI/DuckDB SQL for every registered query (the correctness oracle).

Written from the operator *semantics*, not generated from the Spark plans: stand-in
mappings, cleansing, rules, SCD2 and star loads are re-stated here as plain SQL over the
driver's views (region nation customer supplier part orders lineitem ...).
"""

from __future__ import annotations

import datetime as dt

from tidewater.plans import standin as S


def HK(exprs: list[str]) -> str:  # noqa: N802
    """A surrogate key: md5 of the values, each '=length:value' or '~' for NULL, with '|' between."""
    parts = " || '|' || ".join(
        f"(CASE WHEN ({e}) IS NULL THEN '~' ELSE '=' || length(CAST(({e}) AS VARCHAR)) || ':' || CAST(({e}) AS VARCHAR) END)"
        for e in exprs)
    return f"md5({parts})"


def _d(day) -> str:
    return f"DATE '{day.isoformat()}'"


def _nk(c: str, width: int = 2) -> str:
    return f"lpad(CAST({c} AS VARCHAR), {width}, '0')"


def _nb(c: str) -> str:
    return f"({c} IS NOT NULL AND {c} <> '')"


# ---- stand-in silver ------------------------------------------------------------------

SILVER = f"""
north_insp AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS inspection_id, c.c_name AS restaurant_name, CAST(NULL AS VARCHAR) AS aka_name,
         CAST(c.c_custkey AS VARCHAR) AS license_number, c.c_mktsegment AS facility_type,
         'Risk ' || substr(o.o_orderpriority, 1, 1) AS risk_category,
         n.n_name || ' AVE' AS address, n.n_name AS city, 'N' AS state, '606' || {_nk('c.c_nationkey')} AS zip,
         CAST(c.c_nationkey AS DOUBLE) / 100 + 41 AS latitude, -87 - CAST(c.c_nationkey AS DOUBLE) / 100 AS longitude,
         CAST(o.o_orderdate AS DATE) AS inspection_date, substr(o.o_orderpriority, 3) AS inspection_type,
         CASE o.o_orderstatus WHEN 'F' THEN 'Pass' WHEN 'P' THEN 'Pass w/ Conditions' ELSE 'Fail' END AS inspection_result,
         CASE o.o_orderstatus WHEN 'F' THEN 90 WHEN 'P' THEN 80 ELSE 70 END AS inspection_score,
         'north' AS source_city
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
south_grp AS (
  SELECT l_orderkey, l_suppkey, CAST(max(l_quantity) AS INTEGER) * 2 AS score, max(l_shipdate) AS ship,
         max(l_linestatus) AS ls
  FROM lineitem GROUP BY l_orderkey, l_suppkey),
south_insp AS (
  SELECT {HK(['g.l_orderkey', 'g.l_suppkey'])} AS inspection_id, s.s_name AS restaurant_name,
         CAST(NULL AS VARCHAR) AS aka_name, CAST(NULL AS VARCHAR) AS license_number,
         CAST(NULL AS VARCHAR) AS facility_type, CAST(NULL AS VARCHAR) AS risk_category,
         n.n_name || ' ST' AS address, n.n_name AS city, 'S' AS state, '752' || {_nk('s.s_nationkey')} AS zip,
         CAST(s.s_nationkey AS DOUBLE) / 100 + 32 AS latitude, -96 - CAST(s.s_nationkey AS DOUBLE) / 100 AS longitude,
         CAST(g.ship AS DATE) AS inspection_date,
         CASE WHEN g.ls = 'F' THEN 'Routine' ELSE 'Follow-up' END AS inspection_type,
         CASE WHEN g.score >= 90 THEN 'Pass' WHEN g.score >= 80 THEN 'Pass w/ Conditions'
              WHEN g.score IS NOT NULL THEN 'Fail' END AS inspection_result,
         g.score AS inspection_score, 'south' AS source_city
  FROM south_grp g JOIN supplier s ON g.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey),
insp AS (SELECT * FROM north_insp UNION ALL SELECT * FROM south_insp),
viol_all AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) AS inspection_id, substr(p.p_brand, 7) AS violation_code, p.p_type AS violation_description,
         l.l_returnflag || l.l_linestatus AS violation_comments, CAST(NULL AS INTEGER) AS violation_points,
         'north' AS source_city
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  UNION ALL
  SELECT {HK(['l.l_orderkey', 'l.l_suppkey'])}, substr(p.p_brand, 7), p.p_type, CAST(NULL AS VARCHAR),
         CAST(p.p_size AS INTEGER), 'south'
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
viol AS (
  SELECT inspection_id, violation_code, violation_description, violation_comments, violation_points, source_city
  FROM (SELECT *, row_number() OVER (PARTITION BY inspection_id, violation_code, violation_description, source_city
                                     ORDER BY violation_comments ASC NULLS FIRST, violation_points ASC NULLS FIRST) AS rn
        FROM viol_all) WHERE rn = 1)"""


def staging_sql(name: str, where: str = "TRUE", insp: str = "insp") -> str:
    return f"""
{name} AS (
  SELECT restaurant_name, aka_name, license_number, facility_type, risk_category, source_city
  FROM (SELECT *, row_number() OVER (PARTITION BY restaurant_name, source_city, license_number
                                     ORDER BY inspection_date DESC, inspection_id DESC) AS rn
        FROM (SELECT * REPLACE (nullif(license_number, '') AS license_number) FROM {insp} WHERE {where})) WHERE rn = 1)"""


def _version_key(prefix: str, as_of, job: str, before: str) -> str:
    p = prefix
    return HK([f"{p}restaurant_name", f"{p}source_city", f"coalesce({p}license_number, '')",
               f"{p}facility_type", f"{p}risk_category", f"{p}aka_name", _d(as_of), f"'{job}'", before])


STG_COLS = "restaurant_name, aka_name, license_number, facility_type, risk_category, source_city"
DIM_COLS = STG_COLS + ", restaurant_key, effective_start_date, effective_end_date, is_current, etl_job_id"


def initial_sql(name: str, stg: str, as_of, job: str) -> str:
    return f"""
{name} AS (
  SELECT {STG_COLS}, {_version_key('', as_of, job, 'CAST(NULL AS VARCHAR)')} AS restaurant_key, {_d(as_of)} AS effective_start_date,
         DATE '9999-12-31' AS effective_end_date, TRUE AS is_current, '{job}' AS etl_job_id
  FROM {stg})"""


def merge_sql(name: str, dim: str, stg: str, as_of, job: str) -> str:
    tcols = ", ".join(f"t.{c} AS t_{c}" for c in DIM_COLS.split(", "))
    scols = ", ".join(f"s.{c} AS s_{c}" for c in STG_COLS.split(", "))
    changed = " OR ".join(f"coalesce(t_{a}, '') <> coalesce(s_{a}, '')" for a in S.TRACKED)
    old = ", ".join(
        f"CASE WHEN chg THEN {_d(as_of)} ELSE t_effective_end_date END" if c == "effective_end_date" else
        "CASE WHEN chg THEN FALSE ELSE t_is_current END" if c == "is_current" else f"t_{c}"
        for c in DIM_COLS.split(", "))
    new = ", ".join(f"s_{c}" for c in STG_COLS.split(", "))
    return f"""
{name}_j AS (
  SELECT {tcols}, {scols}, t.restaurant_key IS NOT NULL AS t_p, s.source_city IS NOT NULL AS s_p
  FROM (SELECT * FROM {dim} WHERE is_current) t FULL OUTER JOIN {stg} s
    ON t.restaurant_name = s.restaurant_name AND t.source_city = s.source_city
   AND coalesce(t.license_number, '') = coalesce(s.license_number, '')),
{name}_c AS (SELECT *, (t_p AND s_p AND ({changed})) AS chg FROM {name}_j),
{name} AS (
  SELECT {DIM_COLS} FROM {dim} WHERE NOT is_current
  UNION ALL
  SELECT {old} FROM {name}_c WHERE t_p
  UNION ALL
  SELECT {new}, {_version_key('s_', as_of, job, 't_restaurant_key')}, {_d(as_of)}, DATE '9999-12-31', TRUE, '{job}'
  FROM {name}_c WHERE s_p AND (NOT t_p OR chg))"""


SCD2 = (staging_sql("stg1", f"inspection_date < {_d(S.SCD2_CUTOFF)}") + "," + staging_sql("stg2") + ","
        + initial_sql("dim1", "stg1", S.SCD2_AS_OF_1, S.SCD2_JOB_1) + ","
        + merge_sql("dim2", "dim1", "stg2", S.SCD2_AS_OF_2, S.SCD2_JOB_2))

def _snapshot_dims() -> tuple[str, str]:
    """CTEs that merge the yearly snapshots one after the other, and the name of the last dimension."""
    parts, before = [], None
    for y in S.SNAPSHOT_YEARS:
        as_of, name = dt.date(y + 1, 1, 1), f"snapdim{y}"
        parts.append(staging_sql(f"snap{y}", f"year(inspection_date) = {y}"))
        parts.append(initial_sql(name, f"snap{y}", as_of, f"year-{y}") if before is None else
                     merge_sql(name, before, f"snap{y}", as_of, f"year-{y}"))
        before = name
    return ",".join(parts), before


SNAPSHOT_DIMS, SNAPSHOT_LAST = _snapshot_dims()


def as_of_sql(name: str, dim: str) -> str:
    """Facts with the version of their date; before a business's first version, that one."""
    key = "i.restaurant_name = r.restaurant_name AND i.source_city = r.source_city AND coalesce(i.license_number, '') = coalesce(r.license_number, '')"
    return f"""
{name}_first AS (SELECT *, row_number() OVER (PARTITION BY restaurant_name, source_city, coalesce(license_number, '')
                        ORDER BY effective_start_date, effective_end_date) AS rn
                 FROM {dim} WHERE is_current OR effective_start_date < effective_end_date),
{name} AS (
  SELECT i.inspection_id, i.source_city, i.inspection_date, i.inspection_result,
         {HK(['i.source_city', 'i.inspection_id'])} AS inspection_key, r.restaurant_key, r.facility_type, r.risk_category
  FROM insp i LEFT JOIN {name}_first r ON {key}
   AND (i.inspection_date >= r.effective_start_date OR r.rn = 1)
   AND (i.inspection_date < r.effective_end_date OR r.is_current))"""


DATE_KEY = "CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"

STAR = f"""
loc AS (
  SELECT address, city, state, zip, source_city, latitude, longitude,
         {HK(['source_city', 'address', 'city', 'state', 'zip'])} AS location_key
  FROM (SELECT address, city, state, zip, source_city, latitude, longitude,
               row_number() OVER (PARTITION BY address, city, state, zip, source_city
                                  ORDER BY latitude DESC NULLS LAST, longitude DESC NULLS LAST) AS rn
        FROM insp) WHERE rn = 1),
typ AS (
  SELECT inspection_type_name, source_city, {HK(['source_city', 'inspection_type_name'])} AS inspection_type_key
  FROM (SELECT DISTINCT inspection_type AS inspection_type_name, source_city FROM insp)),
dimv AS (
  SELECT violation_code, violation_description, source_city, max(violation_points) AS violation_points,
         {HK(['source_city', 'violation_code', 'violation_description'])} AS violation_key
  FROM viol GROUP BY violation_code, violation_description, source_city),
dimdate AS (
  SELECT full_date, {DATE_KEY.format(d='full_date')} AS date_key, day(full_date) AS day, month(full_date) AS month,
         strftime(full_date, '%B') AS month_name, quarter(full_date) AS quarter, year(full_date) AS year,
         dayofweek(full_date) + 1 AS day_of_week, strftime(full_date, '%A') AS day_name
  FROM (SELECT CAST(unnest(generate_series(min(inspection_date), max(inspection_date), INTERVAL 1 DAY)) AS DATE)
               AS full_date FROM insp)),
fact AS (
  SELECT i.inspection_id, r.restaurant_key, l.location_key, t.inspection_type_key,
         {DATE_KEY.format(d='i.inspection_date')} AS date_key,
         i.inspection_result, i.inspection_score, i.source_city,
         {HK(['i.source_city', 'i.inspection_id'])} AS inspection_key
  FROM insp i
  LEFT JOIN (SELECT * FROM dim2 WHERE is_current) r
    ON i.restaurant_name = r.restaurant_name AND i.source_city = r.source_city
   AND coalesce(i.license_number, '') = coalesce(r.license_number, '')
  LEFT JOIN loc l ON i.source_city IS NOT DISTINCT FROM l.source_city AND i.address IS NOT DISTINCT FROM l.address
   AND i.city IS NOT DISTINCT FROM l.city AND i.state IS NOT DISTINCT FROM l.state AND i.zip IS NOT DISTINCT FROM l.zip
  LEFT JOIN typ t ON i.inspection_type IS NOT DISTINCT FROM t.inspection_type_name
   AND i.source_city IS NOT DISTINCT FROM t.source_city),
bridge AS (
  SELECT f.inspection_key, dv.violation_key, v.violation_comments
  FROM viol v
  JOIN fact f ON v.inspection_id = f.inspection_id AND v.source_city = f.source_city
  JOIN dimv dv ON v.violation_code IS NOT DISTINCT FROM dv.violation_code
   AND v.violation_description IS NOT DISTINCT FROM dv.violation_description AND v.source_city = dv.source_city)"""

ALL = "WITH " + SILVER + "," + SCD2 + "," + STAR + "\n"


# ---- raw (bronze-like) frames and their cleansing ----------------------------------------

RAW_NORTH = f"""
raw_north AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS "Inspection ID",
         CASE WHEN o.o_orderpriority = '5-LOW' AND o.o_orderstatus = 'P' THEN '' ELSE ' "' || c.c_name || '" ' END AS "DBA Name",
         CAST(NULL AS VARCHAR) AS "AKA Name",
         CAST(c.c_custkey AS VARCHAR) AS "License #",
         ' ' || c.c_mktsegment AS "Facility Type",
         'Risk ' || substr(o.o_orderpriority, 1, 1) AS "Risk",
         ' ' || n.n_name || ' AVE ' AS "Address",
         lower(n.n_name) AS "City",
         ' il' AS "State",
         CASE WHEN c.c_mktsegment = 'MACHINERY' THEN '606' || {_nk('c.c_nationkey')} || '-1234'
              ELSE CAST(c.c_nationkey * 2500 + 6000 AS VARCHAR) || '.0' END AS "Zip",
         CASE WHEN o.o_orderpriority = '4-NOT SPECIFIED' AND o.o_orderstatus = 'P' THEN 'not a date'
              ELSE strftime(o.o_orderdate, '%m/%d/%Y') END AS "Inspection Date",
         ' ' || substr(o.o_orderpriority, 3) AS "Inspection Type",
         CASE o.o_orderstatus WHEN 'F' THEN 'Pass' WHEN 'P' THEN 'Pass w/ Conditions' ELSE 'Fail' END AS "Results",
         CASE WHEN o.o_orderpriority = '3-MEDIUM' THEN ''
              ELSE substr(o.o_orderpriority, 1, 1) || '. ' || substr(o.o_orderpriority, 3) || ' - Comments: '
                   || c.c_mktsegment || ' | 9. OTHER' END AS "Violations",
         CASE WHEN c.c_mktsegment = 'HOUSEHOLD' THEN ' RODENTS' ELSE '41.' || {_nk('c.c_nationkey')} END AS "Latitude",
         '-87.' || {_nk('c.c_nationkey')} AS "Longitude"
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

NORTH_CLEAN = r"""
north_clean AS (
  SELECT Inspection_ID, DBA_Name, AKA_Name, License, Facility_Type, Risk, Address, City, State,
         CASE WHEN length(z) = 4 THEN '0' || z ELSE z END AS Zip,
         Inspection_Date, Inspection_Type, Results, Violations, Latitude, Longitude, source_city,
         CASE Results WHEN 'Pass' THEN 90 WHEN 'Pass w/ Conditions' THEN 80 WHEN 'Fail' THEN 70
                      WHEN 'No Entry' THEN 0 END AS Inspection_Score
  FROM (SELECT "Inspection ID" AS Inspection_ID, trim(replace("DBA Name", '"', '')) AS DBA_Name,
               trim(replace("AKA Name", '"', '')) AS AKA_Name, "License #" AS License,
               trim("Facility Type") AS Facility_Type, trim("Risk") AS Risk, trim("Address") AS Address,
               trim(upper("City")) AS City, trim(upper("State")) AS State,
               regexp_replace("Zip", '\.0$', '') AS z,
               CAST(try_strptime("Inspection Date", '%m/%d/%Y') AS DATE) AS Inspection_Date,
               trim("Inspection Type") AS Inspection_Type, trim("Results") AS Results, "Violations" AS Violations,
               try_cast("Latitude" AS DOUBLE) AS Latitude, try_cast("Longitude" AS DOUBLE) AS Longitude,
               'north' AS source_city
        FROM raw_north))"""

NORTH_RULES = [
    ("name_not_blank", _nb("DBA_Name")),
    ("date_not_null", "Inspection_Date IS NOT NULL"),
    ("type_not_blank", _nb("Inspection_Type")),
    ("zip_valid", r"(Zip IS NOT NULL AND regexp_matches(Zip, '^\d{5}$'))"),
    ("result_not_blank", _nb("Results")),
    ("has_violation", _nb("Violations")),
    ("pass_without_urgent", "NOT (upper(Results) = 'PASS' AND regexp_matches(Violations, '(?i)(urgent|critical)'))"),
]

SLOTS = [1, 2, 3, 4]
SLOT_FIELDS = ["Description", "Points", "Detail", "Memo"]
RAW_SOUTH_COLS = (["Order Key", "Line Number", "Restaurant Name", "Inspection Type", "Inspection Date",
                   "Inspection Score", "Street Address", "Zip Code", "Lat Long Location"]
                  + [f"Violation {f} - {i}" for i in SLOTS for f in SLOT_FIELDS])

RAW_SOUTH = f"""
raw_south AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) AS "Order Key", CAST(l.l_linenumber AS VARCHAR) AS "Line Number",
         ' ' || s.s_name AS "Restaurant Name",
         CASE WHEN l.l_linestatus = 'O' THEN 'Follow-up' ELSE 'Routine' END AS "Inspection Type",
         strftime(l.l_shipdate, '%m/%d/%Y') AS "Inspection Date",
         CASE WHEN l.l_discount = 0 THEN 'N/A' ELSE CAST(CAST(l.l_quantity AS INTEGER) * 2 - 4 AS VARCHAR) END
           AS "Inspection Score",
         CASE WHEN l.l_linenumber < 7 THEN ' ' || n.n_name || ' ST ' END AS "Street Address",
         '75' || {_nk('s.s_nationkey', 3)} || CASE WHEN l.l_linestatus = 'O' THEN '-3007' ELSE '' END AS "Zip Code",
         n.n_name || ' ST (32.' || {_nk('s.s_nationkey')} || ', -96.' || {_nk('s.s_nationkey')} || ')'
           AS "Lat Long Location",
         '*' || CAST(l.l_linenumber AS VARCHAR) || ' Line check' AS "Violation Description - 1",
         CAST(l.l_linenumber AS VARCHAR) AS "Violation Points - 1",
         'detail' AS "Violation Detail - 1", CAST(NULL AS VARCHAR) AS "Violation Memo - 1",
         'Flag ' || l.l_returnflag AS "Violation Description - 2", '3' AS "Violation Points - 2",
         CAST(NULL AS VARCHAR) AS "Violation Detail - 2", 'memo ' || l.l_linestatus AS "Violation Memo - 2",
         CASE WHEN l.l_returnflag = 'R' THEN '' ELSE '*' || CAST(CAST(l.l_quantity AS INTEGER) + 10 AS VARCHAR)
              || ' Quantity' END AS "Violation Description - 3",
         CASE WHEN l.l_returnflag = 'R' THEN '' ELSE 'x2' END AS "Violation Points - 3",
         CAST(NULL AS VARCHAR) AS "Violation Detail - 3", CAST(NULL AS VARCHAR) AS "Violation Memo - 3",
         CASE WHEN l.l_linestatus = 'O' THEN '*' || CAST(l.l_suppkey AS VARCHAR) || ' Open line' END
           AS "Violation Description - 4",
         '1' AS "Violation Points - 4", CAST(NULL AS VARCHAR) AS "Violation Detail - 4",
         CAST(NULL AS VARCHAR) AS "Violation Memo - 4"
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey)"""


def _san(c: str) -> str:
    return c.replace(" - ", "_").replace(" ", "_")


_slot_cols = ", ".join(f'"{c}" AS {_san(c)}' for c in RAW_SOUTH_COLS[9:])
_all_raw = ", ".join(f'"{c}"' for c in RAW_SOUTH_COLS)
_desc_cols = [f"Violation_Description_{i}" for i in SLOTS]
_vcount = " + ".join(f"CASE WHEN {_nb(c)} THEN 1 ELSE 0 END" for c in _desc_cols)

SOUTH_CLEAN = rf"""
south_clean AS (
  SELECT *, CASE WHEN Inspection_Score >= 90 THEN 'Pass' WHEN Inspection_Score >= 80 THEN 'Pass w/ Conditions'
                 WHEN Inspection_Score IS NOT NULL THEN 'Fail' END AS Results,
         {_vcount} AS violation_count
  FROM (SELECT {HK([f'"{c}"' for c in RAW_SOUTH_COLS] + ['copy'])} AS Inspection_ID,
               "Order Key" AS Order_Key, "Line Number" AS Line_Number,
               trim("Restaurant Name") AS Restaurant_Name, trim("Inspection Type") AS Inspection_Type,
               coalesce(CAST(try_strptime("Inspection Date", '%m/%d/%Y') AS DATE),
                        try_cast("Inspection Date" AS DATE)) AS Inspection_Date,
               try_cast("Inspection Score" AS INTEGER) AS Inspection_Score,
               nullif(regexp_extract(regexp_replace("Zip Code", '\.0$', ''), '^(\d{{5}})', 1), '') AS Zip_Code,
               "Lat Long Location" AS Lat_Long_Location, trim("Street Address") AS Street_Address,
               try_cast(regexp_extract("Lat Long Location", '\(([^,]+),', 1) AS DOUBLE) AS Latitude,
               try_cast(regexp_extract("Lat Long Location", ',\s*([^)]+)\)', 1) AS DOUBLE) AS Longitude,
               'SOUTH' AS City, 'SS' AS State, 'south' AS source_city, {_slot_cols}
        FROM (SELECT *, row_number() OVER (PARTITION BY {_all_raw}) AS copy FROM raw_south)))"""

SOUTH_RULES = [
    ("name_not_blank", _nb("Restaurant_Name")),
    ("date_not_null", "Inspection_Date IS NOT NULL"),
    ("type_not_blank", _nb("Inspection_Type")),
    ("zip_valid", r"(Zip_Code IS NOT NULL AND regexp_matches(Zip_Code, '^\d{5}$'))"),
    ("score_in_range", "(Inspection_Score IS NULL OR (Inspection_Score >= 0 AND Inspection_Score <= 100))"),
    ("has_violation", "violation_count >= 1"),
    ("high_score_few_violations", "NOT (Inspection_Score >= 90 AND violation_count > 3)"),
]


def rules_where(rules) -> str:
    return " AND ".join(f"({p})" for _, p in rules)


RAW = ("WITH " + RAW_NORTH + "," + NORTH_CLEAN + "," + RAW_SOUTH + "," + SOUTH_CLEAN + ",\n"
       + f"north_ok AS (SELECT * FROM north_clean WHERE {rules_where(NORTH_RULES)}),\n"
       + f"south_ok AS (SELECT * FROM south_clean WHERE {rules_where(SOUTH_RULES)})\n")


def audit_sql(table: str, rules) -> str:
    first = "CASE " + " ".join(f"WHEN NOT coalesce({p}, FALSE) THEN {i + 1}" for i, (_, p) in enumerate(rules)) \
            + " ELSE 0 END"
    fails = ", ".join(f"NOT coalesce({p}, FALSE) AS f{i}" for i, (_, p) in enumerate(rules))
    aggs = ", ".join(f"count_if(first = {i + 1}) AS d{i}, count_if(f{i}) AS a{i}" for i in range(len(rules)))
    rows = " UNION ALL ".join(
        f"SELECT {i + 1} AS rule_order, '{n}' AS rule_name, d{i} AS dropped, a{i} AS failed, rows_before, rows_after "
        f"FROM t" for i, (n, _) in enumerate(rules))
    return (f", flagged AS (SELECT {first} AS first, {fails} FROM {table}),\n"
            f"t AS (SELECT count(*) AS rows_before, count_if(first = 0) AS rows_after, {aggs} FROM flagged)\n"
            f"{rows}")


def north_violations_sql() -> str:
    return r"""
, frag AS (
  SELECT Inspection_ID, source_city,
         unnest(list_filter(list_transform(string_split_regex(Violations, '\|'), lambda x: trim(x)),
                            lambda x: x <> '')) AS raw
  FROM north_ok),
parsed AS (
  SELECT Inspection_ID, source_city,
         nullif(regexp_extract(raw, '^(\d+)\.', 1), '') AS violation_code,
         CASE WHEN trim(regexp_extract(raw, '^\d+\.\s*(.+?)(?:\s*-\s*Comments:.*)?$', 1)) = ''
              THEN trim(regexp_replace(raw, '^\d+\.\s*', ''))
              ELSE trim(regexp_extract(raw, '^\d+\.\s*(.+?)(?:\s*-\s*Comments:.*)?$', 1)) END AS violation_description,
         trim(regexp_extract(raw, '-\s*Comments:\s*(.*)', 1)) AS violation_comments,
         CAST(NULL AS INTEGER) AS violation_points
  FROM frag)
SELECT Inspection_ID, violation_code, violation_description, violation_comments, violation_points, source_city
FROM (SELECT *, row_number() OVER (PARTITION BY Inspection_ID, violation_code, violation_description
        ORDER BY violation_comments ASC NULLS FIRST, violation_points ASC NULLS FIRST, source_city ASC NULLS FIRST) rn
      FROM parsed) WHERE rn = 1"""


def south_long_sql() -> str:
    parts = []
    for i in SLOTS:
        d = f"Violation_Description_{i}"
        parts.append(
            f"SELECT Inspection_ID, source_city, {i} AS violation_num, {d} AS violation_description_raw, "
            f"try_cast(Violation_Points_{i} AS INTEGER) AS violation_points, Violation_Detail_{i} AS violation_detail, "
            f"Violation_Memo_{i} AS violation_comments FROM south_ok WHERE {_nb(d)}")
    return ", south_long AS (" + " UNION ALL ".join(parts) + ")"


def south_violations_sql() -> str:
    return south_long_sql() + r""",
parsed AS (
  SELECT Inspection_ID, source_city, violation_comments, violation_points,
         nullif(regexp_extract(violation_description_raw, '\*?(\d+)\s', 1), '') AS violation_code,
         CASE WHEN trim(regexp_extract(violation_description_raw, '\*?\d+\s+(.*)', 1)) = ''
              THEN trim(violation_description_raw)
              ELSE trim(regexp_extract(violation_description_raw, '\*?\d+\s+(.*)', 1)) END AS violation_description
  FROM south_long)
SELECT Inspection_ID, violation_code, violation_description, violation_comments, violation_points, source_city
FROM (SELECT *, row_number() OVER (PARTITION BY Inspection_ID, violation_code, violation_description
        ORDER BY violation_comments ASC NULLS FIRST, violation_points ASC NULLS FIRST, source_city ASC NULLS FIRST) rn
      FROM parsed) WHERE rn = 1"""


NORTH_RAW_SANITIZED = ["Inspection_ID", "DBA_Name", "AKA_Name", "License", "Facility_Type", "Risk", "Address",
                       "City", "State", "Zip", "Inspection_Date", "Inspection_Type", "Results", "Violations",
                       "Latitude", "Longitude"]
NORTH_RAW_NAMES = ["Inspection ID", "DBA Name", "AKA Name", "License #", "Facility Type", "Risk", "Address",
                   "City", "State", "Zip", "Inspection Date", "Inspection Type", "Results", "Violations",
                   "Latitude", "Longitude"]

# column checks of the two sources: (name, column), by what a failure means
NORTH_ERRORS = [("id_not_null", "Inspection_ID"), ("name_not_null", "DBA_Name"), ("date_not_null", "Inspection_Date"),
                ("results_not_null", "Results")]
NORTH_WARNINGS = [("type_not_null", "Inspection_Type"), ("zip_not_null", "Zip"), ("city_not_null", "City"),
                  ("license_not_null", "License")]
SOUTH_ERRORS = [("name_not_null", "Restaurant_Name"), ("date_not_null", "Inspection_Date"), ("type_not_null", "Inspection_Type")]
SOUTH_WARNINGS = [("zip_not_null", "Zip_Code"), ("score_not_null", "Inspection_Score"), ("address_not_null", "Street_Address")]
