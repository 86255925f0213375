"""The answers in SQL, worked out another way where there is one.

Islands here come from a running count of open intervals, picks from ranking all pairs, previous
values and ids from plain windows. Shapes of the proxy tables are those of ``frames.py``.
"""

from __future__ import annotations

import re

from pyspark.sql import types as T

from wardspan.schemas import CDM, SOURCE, VOCABULARY

_SQL_TYPE = {
    T.LongType: "BIGINT",
    T.IntegerType: "INTEGER",
    T.StringType: "VARCHAR",
    T.DateType: "DATE",
    T.TimestampNTZType: "TIMESTAMP",
    T.DoubleType: "DOUBLE",
}


def _sql_type(kind: T.DataType) -> str:
    if isinstance(kind, T.DecimalType):
        return f"DECIMAL({kind.precision},{kind.scale})"
    return _SQL_TYPE[type(kind)]


def _fit(schema: T.StructType, given: dict[str, str], rest: str) -> str:
    """SELECT list of a layout: the given expressions cast to its types, typed NULLs elsewhere."""
    unknown = set(given) - {f.name for f in schema.fields}
    if unknown:
        raise ValueError(f"not in the layout: {unknown}")
    columns = ", ".join(
        f"CAST({given.get(f.name, 'NULL')} AS {_sql_type(f.dataType)}) AS \"{f.name}\""
        for f in schema.fields
    )
    return f"SELECT {columns} {rest}"


_DEF: dict[str, str] = {}


def _with(sql: str) -> str:
    """Prefix a query with the definitions it needs, in order of definition."""
    needed, todo = set(), [sql]
    while todo:
        for name in set(re.findall(r"\bx_\w+", todo.pop())) - needed:
            needed.add(name)
            todo.append(_DEF[name])
    parts = [f"{name} AS MATERIALIZED ({body})" for name, body in _DEF.items() if name in needed]
    return f"WITH {', '.join(parts)} {sql}" if parts else sql


# --- source tables -------------------------------------------------------------------------------

_DOCTOR = "(o_orderkey % (SELECT count(*) + count(*) // 5 FROM supplier))"

_DEF["x_patients"] = """
SELECT 'p' || c_custkey AS id, DATE '1930-01-01' + CAST(c_custkey * 97 % 30000 AS INTEGER) AS birthdate,
  CASE WHEN c_custkey % 10 = 9 THEN NULL WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'f' END AS gender,
  CASE c_custkey % 5 WHEN 0 THEN 'white' WHEN 1 THEN 'black' WHEN 2 THEN 'asian' WHEN 3 THEN 'native'
    ELSE 'White' END AS race,
  CASE c_nationkey % 3 WHEN 0 THEN 'hispanic' WHEN 1 THEN 'nonhispanic' END AS ethnicity
FROM customer"""

_DEF["x_providers"] = """
SELECT 'd' || s_suppkey AS id, s_name AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
  'GENERAL PRACTICE' AS speciality FROM supplier"""

_DEF["x_encounters"] = f"""
SELECT 'e' || o_orderkey AS id, o_orderdate AS start,
  CASE WHEN o_orderkey % 500 <> 7 THEN o_orderdate + to_days(CAST(o_orderkey % 120 AS INTEGER)) END AS stop,
  'p' || o_custkey AS patient, 'd' || {_DOCTOR} AS provider, 'pay' || (o_orderkey % 26) AS payer,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'emergency' WHEN '2' THEN 'inpatient'
    WHEN '3' THEN 'ambulatory' WHEN '4' THEN 'wellness' WHEN '5' THEN 'outpatient' END AS encounterclass,
  CASE WHEN o_orderkey % 50 = 0 THEN '308646001' ELSE '185345009' END AS code,
  CAST(o_orderkey * 7 % (SELECT count(*) FROM part) AS VARCHAR) AS reasoncode,
  CAST(o_totalprice AS DECIMAL(18,3)) AS total_claim_cost,
  CAST(o_orderkey % 1000 AS DECIMAL(18,3)) AS payer_coverage
FROM orders"""

_DEF["x_lines"] = """
SELECT l_shipdate AS at, CAST(l_shipdate AS DATE) AS at_day,
  CASE WHEN l_returnflag <> 'N' THEN l_shipdate + to_days(CAST(l_quantity AS INTEGER)) END AS stop,
  'p' || o_custkey AS patient, 'e' || l_orderkey AS encounter, CAST(CASE WHEN l_suppkey % 3 = 0 THEN 100 ELSE l_partkey END AS VARCHAR) AS code,
  CAST(l_extendedprice AS DECIMAL(18,3)) AS base_cost, 'udi' || l_suppkey AS udi
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

_DEF["x_allergies"] = """
SELECT o_orderdate AS at, 'p' || o_custkey AS patient, 'e' || o_orderkey AS encounter,
  CAST(o_orderkey * 3 % (SELECT count(*) FROM part) AS VARCHAR) AS code FROM orders"""

_DEF["x_observations"] = """
SELECT event_id, ts AS at, 'p' || user_id AS patient, 'e' || event_id AS encounter,
  CAST(event_id % 50 * 4 + 2 AS VARCHAR) AS code,
  CASE event_id % 5 WHEN 0 THEN CAST(CAST(value AS DECIMAL(18,3)) AS VARCHAR) WHEN 1 THEN '-5'
    WHEN 2 THEN props WHEN 3 THEN '.5' ELSE 'mv' || (event_id % 8) END AS value,
  'unit' || (event_id % 30) AS units
FROM events"""

_DEF["x_transitions"] = """
SELECT 'p' || c_custkey AS patient, 'pay' || ((c_custkey + i) % 26) AS payer,
  DATE '1995-01-01' + CAST(c_custkey % 200 + i * 800 AS INTEGER) AS start_year,
  DATE '1995-01-01' + CAST(c_custkey % 200 + i * 800
    + CASE WHEN c_custkey % 3 = 0 THEN 900 ELSE 799 END AS INTEGER) AS end_year
FROM customer CROSS JOIN (SELECT 0 AS i UNION ALL SELECT 1 UNION ALL SELECT 2) AS spans"""

_DEF["x_claims"] = f"""
SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS claim,
  'p' || o_custkey AS patient, 'e' || o_orderkey AS encounter, 'd' || {_DOCTOR} AS provider,
  'pay' || (o_orderkey % 26) AS payer, CAST(CASE WHEN l_suppkey % 3 = 0 THEN 100 ELSE l_partkey END AS VARCHAR) AS code, l_shipdate AS onset,
  o_orderdate AS served, CAST(l_extendedprice AS DECIMAL(18,3)) AS charged,
  CAST(l_quantity AS DECIMAL(18,3)) AS shared
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

# --- vocabulary ----------------------------------------------------------------------------------

_DEF["x_concept"] = """
SELECT CAST(p_partkey AS INTEGER) AS concept_id, p_name AS concept_name,
  CASE WHEN p_partkey % 4 = 0 THEN CASE p_partkey // 4 % 5 WHEN 0 THEN 'Condition' WHEN 1 THEN 'Procedure'
      WHEN 2 THEN 'Device' WHEN 3 THEN 'Observation' ELSE 'Measurement' END
    WHEN p_partkey % 4 = 2 THEN CASE WHEN p_partkey // 4 % 2 = 0 THEN 'Observation' ELSE 'Measurement' END
    ELSE 'Drug' END AS domain_id,
  CASE p_partkey % 4 WHEN 0 THEN 'SNOMED' WHEN 1 THEN 'RxNorm' WHEN 2 THEN 'LOINC' ELSE 'CVX' END AS vocabulary_id,
  CASE WHEN p_partkey % 40 = 1 THEN 'Ingredient' ELSE 'Clinical' END AS concept_class_id,
  CASE WHEN p_size % 3 <> 0 THEN 'S' END AS standard_concept, CAST(p_partkey AS VARCHAR) AS concept_code,
  DATE '1970-01-01' AS valid_start_date, DATE '2099-12-31' AS valid_end_date,
  CASE WHEN p_size = 50 THEN 'D' END AS invalid_reason
FROM part
UNION ALL
SELECT CAST(n_nationkey + 100000000 AS INTEGER), n_name, 'Unit', 'UCUM', 'Value', 'S', 'unit' || n_nationkey,
  DATE '1970-01-01', DATE '2099-12-31', NULL FROM nation
UNION ALL
SELECT CAST(r_regionkey + 200000000 AS INTEGER), r_name, 'Meas value', 'SNOMED', 'Value', 'S', 'mv' || r_regionkey,
  DATE '1970-01-01', DATE '2099-12-31', NULL FROM region"""

_DEF["x_link"] = """
SELECT p_partkey AS origin, CASE WHEN p_size % 3 <> 0 THEN p_partkey ELSE p_partkey + 20 END AS goal
FROM part WHERE p_size % 11 <> 0
UNION ALL SELECT p_partkey, p_partkey + 40 FROM part WHERE p_size % 7 = 0 AND p_size % 11 <> 0
UNION ALL SELECT n_nationkey + 100000000, n_nationkey + 100000000 FROM nation
UNION ALL SELECT r_regionkey + 200000000, r_regionkey + 200000000 FROM region"""

_DEF["x_custom"] = """
SELECT CAST(m.s_suppkey * 3 AS VARCHAR) AS source_code, CAST(m.origin AS INTEGER) AS source_concept_id,
  m.s_name AS source_code_description, 'SNOMED' AS source_vocabulary_id, a.domain_id AS source_domain_id,
  b.concept_class_id AS source_concept_class_id, a.valid_start_date AS source_valid_start_date,
  a.valid_end_date AS source_valid_end_date, CAST(NULL AS VARCHAR) AS source_invalid_reason,
  CAST(m.s_suppkey * 4 AS INTEGER) AS target_concept_id, b.concept_name AS target_concept_name,
  'SNOMED' AS target_vocabulary_id, b.domain_id AS target_domain_id,
  b.concept_class_id AS target_concept_class_id, b.invalid_reason AS target_invalid_reason,
  b.standard_concept AS target_standard_concept
FROM (SELECT *, CASE WHEN s_suppkey % 2 = 0 THEN 0 ELSE s_suppkey * 3 END AS origin FROM supplier
      WHERE s_suppkey % 5 <> 0) m
LEFT JOIN x_concept a ON a.concept_id = m.origin
LEFT JOIN x_concept b ON b.concept_id = m.s_suppkey * 4"""

_ORIGIN = """a.concept_code AS source_code, a.concept_id AS source_concept_id,
  a.concept_name AS source_code_description, a.vocabulary_id AS source_vocabulary_id,
  a.domain_id AS source_domain_id, a.concept_class_id AS source_concept_class_id,
  a.valid_start_date AS source_valid_start_date, a.valid_end_date AS source_valid_end_date,
  a.invalid_reason AS source_invalid_reason, b.concept_id AS target_concept_id,
  b.concept_name AS target_concept_name, b.vocabulary_id AS target_vocabulary_id,
  b.domain_id AS target_domain_id, b.concept_class_id AS target_concept_class_id,
  b.invalid_reason AS target_invalid_reason, b.standard_concept AS target_standard_concept"""

_DEF["x_standard"] = f"""
SELECT {_ORIGIN} FROM x_link JOIN x_concept a ON a.concept_id = origin
JOIN x_concept b ON b.concept_id = goal WHERE b.invalid_reason IS NULL
UNION SELECT * FROM x_custom"""

_DEF["x_own"] = f"""
SELECT {_ORIGIN} FROM x_concept a JOIN x_concept b ON a.concept_id = b.concept_id
UNION SELECT * FROM x_custom"""

_DEF["x_map"] = """
SELECT source_code AS code, source_concept_id, source_vocabulary_id AS vocabulary, source_domain_id AS origin_domain,
  target_concept_id, target_vocabulary_id AS goal, target_domain_id AS domain
FROM x_standard WHERE target_standard_concept = 'S' AND target_invalid_reason IS NULL"""

_DEF["x_closure"] = """
SELECT DISTINCT c.descendant, c.ancestor FROM (
  SELECT p_partkey AS descendant, CASE WHEN p_partkey % 4 = 1 THEN p_partkey - p_partkey % 40 + 1 ELSE p_partkey END AS ancestor
  FROM part
  UNION ALL SELECT p_partkey, p_partkey - p_partkey % 40 + 41 FROM part WHERE p_partkey % 4 = 1 AND p_size % 5 = 0) c
JOIN x_concept i ON i.concept_id = c.ancestor
WHERE i.vocabulary_id = 'RxNorm' AND i.concept_class_id = 'Ingredient'"""

# --- people --------------------------------------------------------------------------------------

_DEF["x_person"] = _fit(
    CDM["person"],
    {
        "person_id": "row_number() OVER (ORDER BY id)",
        "gender_concept_id": "CASE upper(gender) WHEN 'M' THEN 8507 WHEN 'F' THEN 8532 END",
        "year_of_birth": "year(birthdate)",
        "month_of_birth": "month(birthdate)",
        "day_of_birth": "day(birthdate)",
        "birth_datetime": "birthdate",
        "race_concept_id": "CASE lower(race) WHEN 'white' THEN 8527 WHEN 'black' THEN 8516 WHEN 'asian' THEN 8515 ELSE 0 END",
        "ethnicity_concept_id": "CASE ethnicity WHEN 'hispanic' THEN 38003563 WHEN 'nonhispanic' THEN 38003564 ELSE 0 END",
        "person_source_value": "id",
        "gender_source_value": "gender",
        "gender_source_concept_id": "0",
        "race_source_value": "race",
        "race_source_concept_id": "0",
        "ethnicity_source_value": "ethnicity",
        "ethnicity_source_concept_id": "0",
    },
    "FROM x_patients WHERE gender IS NOT NULL",
)

_DEF["x_who"] = "SELECT person_id, person_source_value AS patient FROM x_person"

_DEF["x_provider"] = _fit(
    CDM["provider"],
    {
        "provider_id": "row_number() OVER (ORDER BY id)",
        "provider_name": "name",
        "specialty_concept_id": "38004446",
        "gender_concept_id": "CASE gender WHEN 'M' THEN 8507 ELSE 8532 END",
        "provider_source_value": "id",
        "specialty_source_value": "speciality",
        "specialty_source_concept_id": "38004446",
        "gender_source_value": "gender",
        "gender_source_concept_id": "CASE gender WHEN 'M' THEN 8507 ELSE 8532 END",
    },
    "FROM x_providers",
)

_PERIOD = _fit(
    CDM["observation_period"],
    {
        "observation_period_id": "row_number() OVER (ORDER BY person_id)",
        "person_id": "person_id",
        "observation_period_start_date": "lo",
        "observation_period_end_date": "hi",
        "period_type_concept_id": "44814724",
    },
    """FROM (SELECT person_id, min(start) AS lo, max(stop) AS hi FROM x_who JOIN x_encounters USING (patient)
      GROUP BY person_id) p""",
)


# --- islands -------------------------------------------------------------------------------------


def _islands(name: str, source: str, keys: str, gap: str) -> None:
    """Rows of ``source`` with the start and the end of their island: an island opens at a start that
    no earlier row of the key reaches, and takes all rows up to the next such start. Rows that end
    before they start neither open nor reach; they are in an island that covers them, or nowhere."""
    same = " AND ".join(f"r.{k} = s.{k}" for k in keys.split(", "))
    _DEF[f"{name}_opens"] = f"""
SELECT DISTINCT {keys}, lo AS opening FROM {source} s WHERE hi >= lo AND NOT EXISTS (
  SELECT 1 FROM {source} r WHERE {same} AND r.hi >= r.lo AND r.lo < s.lo AND r.hi + {gap} >= s.lo)"""
    _DEF[name] = f"""
SELECT * FROM (
  SELECT s.*, r.opening, max(CASE WHEN s.hi >= s.lo THEN s.hi END)
    OVER (PARTITION BY {", ".join(f"s.{k}" for k in keys.split(", "))}, r.opening) AS island_end
  FROM {source} s ASOF JOIN {name}_opens r ON {same} AND s.lo >= r.opening) placed
WHERE lo <= island_end"""


_DEF["x_episodes"] = """
SELECT row_number() OVER () AS rid, o_custkey, l_partkey % 5 AS family, CAST(l_shipdate AS DATE) AS lo,
  CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) - 4 AS hi, CAST(l_quantity AS BIGINT) AS quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


_DEF["x_moments"] = """
SELECT CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS weekday, o_orderdate + to_hours(o_orderkey % 24) AS lo,
  o_orderdate + to_hours(o_orderkey % 24 + o_orderkey % 9 - 1) AS hi FROM orders"""
_islands("x_moment_islands", "x_moments", "weekday", "INTERVAL 0 DAY")


def _merged(gap: int) -> str:
    _islands(f"x_episodes{gap}", "x_episodes", "o_custkey, family", str(gap))
    return f"""SELECT o_custkey, family, opening AS "start", island_end AS "end", CAST(count(*) AS BIGINT) AS n,
  CAST(sum(quantity) AS BIGINT) AS quantity
FROM x_episodes{gap} GROUP BY o_custkey, family, opening, island_end"""


# --- visits --------------------------------------------------------------------------------------

_DEF["x_stays"] = """
SELECT id AS rid, id, patient, encounterclass, start AS lo, coalesce(stop, TIMESTAMP '9999-01-01 00:00:00') AS hi
FROM x_encounters WHERE encounterclass = 'inpatient'"""
_islands("x_stay_islands", "x_stays", "patient", "INTERVAL 1 DAY")

_DEF["x_ip"] = """
SELECT min(id) AS encounter_id, patient, encounterclass, lo AS visit_start_date, island_end AS visit_end_date
FROM x_stay_islands WHERE island_end < TIMESTAMP '9999-01-01 00:00:00'
GROUP BY patient, encounterclass, lo, island_end"""

for _name, _classes in (("x_er", "'emergency', 'urgent'"), ("x_op", "'ambulatory', 'wellness', 'outpatient'")):
    _DEF[_name] = f"""
SELECT min(id) AS encounter_id, patient, encounterclass, start AS visit_start_date, max(stop) AS visit_end_date
FROM x_encounters WHERE encounterclass IN ({_classes}) GROUP BY patient, encounterclass, start"""

_DEF["x_visits"] = """
SELECT v.*, row_number() OVER (ORDER BY patient, visit_start_date, encounterclass, encounter_id) AS visit_occurrence_id
FROM (SELECT * FROM x_ip UNION ALL SELECT * FROM x_er UNION ALL SELECT * FROM x_op) v"""

_ER = "IN ('emergency', 'urgent')"
_OP = "IN ('ambulatory', 'wellness', 'outpatient')"
_DEF["x_candidates"] = f"""
SELECT e.id AS encounter_id, e.patient AS person_source_value, e.start AS date_service, e.stop AS date_service_end,
  e.encounterclass, v.encounterclass AS visit_type, v.visit_start_date, v.visit_end_date, v.visit_occurrence_id,
  CASE WHEN (v.encounterclass = 'inpatient' AND (e.encounterclass = 'inpatient' OR e.encounterclass {_OP}
      OR (e.encounterclass {_ER} AND e.start <> v.visit_start_date)))
    OR (v.encounterclass {_ER} AND e.encounterclass {_ER} AND e.start = v.visit_start_date)
    OR (v.encounterclass {_OP} AND e.encounterclass {_OP})
  THEN v.visit_occurrence_id END AS visit_occurrence_id_new
FROM x_encounters e JOIN x_visits v
  ON e.patient = v.patient AND e.start BETWEEN v.visit_start_date AND v.visit_end_date"""

_DEF["x_final"] = """
SELECT encounter_id, visit_occurrence_id_new FROM (
  SELECT *, row_number() OVER (PARTITION BY encounter_id ORDER BY
    CASE WHEN visit_occurrence_id_new IS NULL THEN 99 WHEN visit_type = 'inpatient' THEN 1 ELSE 2 END,
    visit_start_date, visit_occurrence_id) AS place FROM x_candidates) ranked WHERE place = 1"""

_DEF["x_context"] = """
SELECT e.id AS encounter, e.patient AS context_patient, f.visit_occurrence_id_new AS visit_occurrence_id,
  d.provider_id
FROM x_encounters e LEFT JOIN x_final f ON f.encounter_id = e.id
LEFT JOIN x_provider d ON d.provider_source_value = e.provider"""

_DEF["x_linked"] = """
SELECT v.*, w.person_id, d.provider_id, lag(v.visit_occurrence_id) OVER (PARTITION BY w.person_id
  ORDER BY v.visit_start_date, v.visit_occurrence_id) AS preceding
FROM x_visits v JOIN x_who w ON w.patient = v.patient
JOIN x_encounters e ON e.id = v.encounter_id AND e.patient = v.patient
JOIN x_provider d ON d.provider_source_value = e.provider
WHERE v.visit_occurrence_id IN (SELECT visit_occurrence_id_new FROM x_final WHERE visit_occurrence_id_new IS NOT NULL)"""

_VISIT_CONCEPT = """CASE encounterclass WHEN 'emergency' THEN 9203 WHEN 'urgentcare' THEN 9203
  WHEN 'inpatient' THEN 9201 WHEN 'ambulatory' THEN 9202 WHEN 'wellness' THEN 9202
  WHEN 'outpatient' THEN 9202 ELSE 0 END"""

_DEF["x_visit"] = _fit(
    CDM["visit_occurrence"],
    {
        "visit_occurrence_id": "visit_occurrence_id",
        "person_id": "person_id",
        "visit_concept_id": _VISIT_CONCEPT,
        "visit_start_date": "visit_start_date",
        "visit_start_datetime": "visit_start_date",
        "visit_end_date": "visit_end_date",
        "visit_end_datetime": "visit_end_date",
        "visit_type_concept_id": "44818517",
        "provider_id": "provider_id",
        "visit_source_value": "encounter_id",
        "visit_source_concept_id": "0",
        "admitting_source_concept_id": "0",
        "discharge_to_concept_id": "0",
        "preceding_visit_occurrence_id": "preceding",
    },
    "FROM x_linked",
)

_DETAIL = _fit(
    CDM["visit_detail"],
    {
        "visit_detail_id": "visit_occurrence_id + 1000000",
        "person_id": "person_id",
        "visit_detail_concept_id": _VISIT_CONCEPT,
        "visit_detail_start_date": "visit_start_date",
        "visit_detail_start_datetime": "visit_start_date",
        "visit_detail_end_date": "visit_end_date",
        "visit_detail_end_datetime": "visit_end_date",
        "visit_detail_type_concept_id": "44818517",
        "provider_id": "provider_id",
        "visit_detail_source_value": "encounter_id",
        "visit_detail_source_concept_id": "0",
        "admitting_source_concept_id": "0",
        "discharge_to_concept_id": "0",
        "preceding_visit_detail_id": "preceding + 1000000",
        "visit_occurrence_id": "visit_occurrence_id",
    },
    "FROM x_linked",
)

# --- events --------------------------------------------------------------------------------------

_LEAD = "person_id, r.at, code, encounter, target_concept_id, source_concept_id"


def _leg(facts: str, code_map: str, extra: str = "", joins: str = "") -> str:
    return f"""
SELECT w.person_id, f.encounter, f.code, m.target_concept_id, m.source_concept_id, c.visit_occurrence_id,
  CASE WHEN c.context_patient = f.patient THEN c.provider_id END AS provider_id {extra}
FROM {facts} f JOIN ({code_map}) m ON m.code = f.code JOIN x_who w ON w.patient = f.patient
LEFT JOIN x_context c ON c.encounter = f.encounter {joins}"""


def _both(standard: str, own: str, how: str = "") -> str:
    return f"""SELECT t.code, t.target_concept_id, o.source_concept_id FROM x_map t
  {how} JOIN x_own o ON o.source_code = t.code AND {own} WHERE {standard}"""


def _event(table: str, prefix: str, given: dict[str, str], rows: str, order: str) -> str:
    shared = {
        f"{table}_id": f"row_number() OVER (ORDER BY {order} NULLS LAST)",
        "person_id": "person_id",
        f"{prefix}_concept_id": "target_concept_id",
        f"{prefix}_source_value": "code",
        f"{prefix}_source_concept_id": "source_concept_id",
        "visit_occurrence_id": "visit_occurrence_id",
        "visit_detail_id": "visit_occurrence_id + 1000000",
        "provider_id": "provider_id",
    }
    return _fit(CDM[table], shared | given, f"FROM ({rows}) r")


def _order(*extra: str) -> str:
    return " NULLS LAST, ".join([*_LEAD.split(", "), *extra])


_DEF["x_condition_map"] = """SELECT code, target_concept_id, source_concept_id FROM x_map
WHERE domain = 'Condition' AND goal = 'SNOMED' AND vocabulary = 'SNOMED'"""

_DEF["x_condition"] = _event(
    "condition_occurrence",
    "condition",
    {
        "provider_id": "NULL",
        "condition_start_date": "r.at",
        "condition_start_datetime": "r.at",
        "condition_end_date": "hi",
        "condition_end_datetime": "hi",
        "condition_type_concept_id": "38000175",
        "condition_status_concept_id": "0",
    },
    _leg(
        "x_lines",
        "SELECT * FROM x_condition_map",
        ", f.at_day AS at, coalesce(CAST(f.stop AS DATE), f.at_day) AS hi",
    ),
    _order("hi"),
)


def _seen(facts: str, vocabulary: str, at: str) -> str:
    mapping = _both(
        f"t.domain = 'Observation' AND t.goal = '{vocabulary}'",
        f"o.source_vocabulary_id = '{vocabulary}' AND o.source_domain_id = 'Observation'",
    )
    return _leg(facts, mapping, f", {at} AS at")


_DEF["x_observation"] = _event(
    "observation",
    "observation",
    {
        "observation_date": "r.at",
        "observation_datetime": "r.at",
        "observation_type_concept_id": "38000280",
        "value_as_concept_id": "0",
        "qualifier_concept_id": "0",
        "unit_concept_id": "0",
    },
    _seen("x_allergies", "SNOMED", "f.at")
    + " UNION ALL "
    + _seen("x_lines", "SNOMED", "f.at")
    + " UNION ALL "
    + _seen("x_observations", "LOINC", "f.at"),
    _order("visit_occurrence_id", "provider_id"),
)

# Fixed value: which texts are numbers.
_NUMBER = "CASE WHEN regexp_full_match({0}, '([0-9]+\\.?[0-9]*|\\.[0-9]+)') THEN TRY_CAST({0} AS DECIMAL(18,3)) END"

_DEF["x_measurement"] = _event(
    "measurement",
    "measurement",
    {
        "measurement_date": "r.at",
        "measurement_datetime": "r.at",
        "measurement_time": "strftime(r.at, '%Y-%m-%d %H:%M:%S')",
        "measurement_type_concept_id": "38000267",
        "operator_concept_id": "0",
        "value_as_number": "number",
        "value_as_concept_id": "value_concept",
        "unit_concept_id": "unit_concept",
        "unit_source_value": "unit_text",
        "value_source_value": "value_text",
    },
    _leg(
        "x_lines",
        _both(
            "t.domain = 'Measurement' AND t.vocabulary = 'SNOMED'", "o.source_vocabulary_id = 'SNOMED'"
        ),
        """, f.at, CAST(NULL AS DECIMAL(18,3)) AS number, 0 AS value_concept, 0 AS unit_concept,
  CAST(NULL AS VARCHAR) AS unit_text, CAST(NULL AS VARCHAR) AS value_text""",
    )
    + " UNION ALL "
    + _leg(
        "x_observations",
        "SELECT code, target_concept_id, coalesce(source_concept_id, 0) AS source_concept_id FROM ("
        + _both(
            "t.domain = 'Measurement' AND t.vocabulary = 'LOINC'",
            "o.source_vocabulary_id = 'LOINC'",
            "LEFT",
        )
        + ") q",
        f""", f.at, {_NUMBER.format("f.value")}, coalesce(v.target_concept_id, 0), coalesce(u.target_concept_id, 0),
  f.units, f.value""",
        """LEFT JOIN x_map u ON u.code = f.units AND u.goal = 'UCUM' AND u.vocabulary = 'UCUM'
LEFT JOIN x_map v ON v.code = f.value AND v.domain = 'Meas value'""",
    ),
    _order("value_text", "unit_text", "value_concept", "unit_concept", "visit_occurrence_id", "provider_id"),
)

_DEF["x_procedure"] = _event(
    "procedure_occurrence",
    "procedure",
    {
        "procedure_date": "r.at",
        "procedure_datetime": "r.at",
        "procedure_type_concept_id": "38000267",
        "modifier_concept_id": "0",
    },
    _leg(
        "x_lines",
        _both(
            "t.domain = 'Procedure' AND t.goal = 'SNOMED' AND t.vocabulary = 'SNOMED'",
            "o.source_vocabulary_id = 'SNOMED'",
        ),
        ", f.at",
    ),
    _order(),
)

_DEF["x_device"] = _event(
    "device_exposure",
    "device",
    {
        "device_exposure_start_date": "r.at",
        "device_exposure_start_datetime": "r.at",
        "device_exposure_end_date": "stop",
        "device_exposure_end_datetime": "stop",
        "device_type_concept_id": "38000267",
        "unique_device_id": "udi",
    },
    _leg(
        "x_lines",
        _both(
            "t.domain = 'Device' AND t.goal = 'SNOMED' AND t.vocabulary = 'SNOMED'",
            "o.source_vocabulary_id = 'SNOMED'",
        ),
        ", f.at, f.stop, f.udi",
    ),
    _order("stop", "udi"),
)


def _drugs(vocabulary: str, stop: str) -> str:
    mapping = _both(
        f"t.domain = 'Drug' AND t.goal = '{vocabulary}'", f"o.source_vocabulary_id = '{vocabulary}'"
    )
    return _leg("x_lines", mapping, f", f.at, {stop} AS stop")


_DEF["x_drug"] = _event(
    "drug_exposure",
    "drug",
    {
        "drug_exposure_start_date": "r.at",
        "drug_exposure_start_datetime": "r.at",
        "drug_exposure_end_date": "coalesce(stop, r.at)",
        "drug_exposure_end_datetime": "coalesce(stop, r.at)",
        "verbatim_end_date": "stop",
        "drug_type_concept_id": "32869",
        "refills": "0",
        "quantity": "0",
        "days_supply": "coalesce(date_diff('day', CAST(r.at AS DATE), CAST(stop AS DATE)), 0)",
        "route_concept_id": "0",
        "lot_number": "'0'",
    },
    _drugs("RxNorm", "f.stop") + " UNION ALL " + _drugs("CVX", "f.at"),
    _order("stop", "visit_occurrence_id", "provider_id"),
)

_DEF["x_death"] = _fit(
    CDM["death"],
    {
        "person_id": "w.person_id",
        "death_date": "e.start",
        "death_datetime": "e.start",
        "death_type_concept_id": "38003566",
        "cause_concept_id": "m.target_concept_id",
        "cause_source_value": "e.reasoncode",
        "cause_source_concept_id": "m.source_concept_id",
    },
    """FROM x_encounters e JOIN x_map m ON m.code = e.reasoncode AND m.domain = 'Condition'
  AND m.origin_domain = 'Condition' AND m.goal = 'SNOMED' AND m.vocabulary = 'SNOMED'
JOIN x_who w ON w.patient = e.patient WHERE e.code = '308646001'""",
)

# --- eras ----------------------------------------------------------------------------------------

_DEF["x_ce_rows"] = """
SELECT condition_occurrence_id AS rid, person_id, condition_concept_id AS concept, condition_start_date AS lo,
  coalesce(condition_end_date, condition_start_date + 1) AS hi FROM x_condition"""
_islands("x_ce_islands", "x_ce_rows", "person_id, concept", "30")
_DEF["x_ce"] = """
SELECT person_id, concept, opening AS lo, island_end, count(*) AS n
FROM x_ce_islands GROUP BY person_id, concept, opening, island_end"""
_DEF["x_condition_era"] = _fit(
    CDM["condition_era"],
    {
        "condition_era_id": "row_number() OVER (ORDER BY person_id, concept, lo)",
        "person_id": "person_id",
        "condition_concept_id": "concept",
        "condition_era_start_date": "lo",
        "condition_era_end_date": "island_end",
        "condition_occurrence_count": "n",
    },
    "FROM x_ce",
)

_DEF["x_de_rows"] = """
SELECT drug_exposure_id AS rid, person_id, c.ancestor AS concept, drug_exposure_start_date AS lo,
  drug_exposure_end_date AS hi
FROM x_drug JOIN x_closure c ON c.descendant = drug_concept_id
WHERE drug_concept_id <> 0 AND days_supply >= 0"""
_islands("x_de_exposed", "x_de_rows", "person_id, concept", "0")
_DEF["x_de_stretches"] = """
SELECT person_id, concept, opening AS lo, island_end AS hi, count(*) AS n
FROM x_de_exposed GROUP BY person_id, concept, opening, island_end"""
_islands("x_de_eras", "x_de_stretches", "person_id, concept", "30")
_DEF["x_de"] = """
SELECT person_id, concept, opening AS lo, island_end, sum(n) AS n,
  date_diff('day', opening, island_end) - sum(date_diff('day', lo, hi)) AS gap
FROM x_de_eras GROUP BY person_id, concept, opening, island_end"""
_DEF["x_drug_era"] = _fit(
    CDM["drug_era"],
    {
        "drug_era_id": "row_number() OVER (ORDER BY person_id, concept, lo)",
        "person_id": "person_id",
        "drug_concept_id": "concept",
        "drug_era_start_date": "lo",
        "drug_era_end_date": "island_end",
        "drug_exposure_count": "n",
        "gap_days": "gap",
    },
    "FROM x_de",
)

# --- plans and cost ------------------------------------------------------------------------------

_DEF["x_plan"] = _fit(
    CDM["payer_plan_period"],
    {
        "payer_plan_period_id": "row_number() OVER (ORDER BY t.patient, t.start_year, t.end_year, t.payer)",
        "person_id": "w.person_id",
        "payer_plan_period_start_date": "t.start_year",
        "payer_plan_period_end_date": "t.end_year",
        "payer_source_value": "t.payer",
        "plan_source_value": "n_name",
        **{
            f"{c}_concept_id": "0"
            for c in (
                "payer",
                "payer_source",
                "plan",
                "plan_source",
                "sponsor",
                "sponsor_source",
                "stop_reason",
                "stop_reason_source",
            )
        },
    },
    "FROM x_transitions t JOIN nation ON t.payer = 'pay' || n_nationkey JOIN x_who w ON w.patient = t.patient",
)

_DEF["x_billed"] = """
SELECT e.*, e.id AS encounter, v.visit_occurrence_id, v.person_id FROM x_encounters e
JOIN x_who w ON w.patient = e.patient
JOIN x_visit v ON v.visit_source_value = e.id AND v.person_id = w.person_id"""


def _charged(domain: str, table: str, key: str, prefix: str, day: str) -> str:
    return f"""
SELECT DISTINCT t.{key} AS event, '{domain}' AS domain, t.person_id, t.{day} AS day,
  b.total_claim_cost + f.base_cost AS charge, b.payer_coverage + f.base_cost AS paid,
  b.payer_coverage AS payer, b.total_claim_cost + f.base_cost - b.payer_coverage AS patient,
  CAST(NULL AS DECIMAL(18,3)) AS primary_paid
FROM x_lines f JOIN x_billed b ON b.encounter = f.encounter AND b.patient = f.patient
JOIN {table} t ON t.{prefix}_source_value = f.code AND t.visit_occurrence_id = b.visit_occurrence_id
  AND t.person_id = b.person_id"""


_DEF["x_payments"] = """
SELECT claim, patient, encounter, provider, '1' AS kind, charged AS amount FROM x_claims
UNION ALL SELECT claim, patient, encounter, provider, 'p', shared FROM x_claims
UNION ALL SELECT claim, patient, encounter, provider, 't', charged FROM x_claims"""

_DEF["x_condition_cost"] = """
SELECT event, 'Condition' AS domain, person_id, day, payer + patient AS charge, payer + patient AS paid, payer, patient,
  payer AS primary_paid
FROM (SELECT t.condition_occurrence_id AS event, t.person_id, t.condition_start_date AS day,
    coalesce(sum(CASE WHEN y.kind = '1' THEN y.amount END), 0) AS payer,
    coalesce(sum(CASE WHEN y.kind = 'p' THEN y.amount END), 0) AS patient
  FROM x_lines f JOIN x_billed b ON b.encounter = f.encounter AND b.patient = f.patient
  JOIN x_condition t ON t.condition_source_value = f.code AND t.visit_occurrence_id = b.visit_occurrence_id
    AND t.person_id = b.person_id
  JOIN x_claims a ON a.patient = f.patient AND a.code = f.code AND a.onset = f.at_day AND a.encounter = b.id
    AND a.provider = b.provider AND a.payer = b.payer AND a.served = b.start
  JOIN x_payments y ON y.claim = a.claim AND y.patient = f.patient AND y.encounter = b.id AND y.provider = b.provider
  WHERE y.kind IN ('1', 'p')
  GROUP BY t.condition_occurrence_id, t.person_id, t.condition_start_date) summed"""

_DEF["x_priced"] = " UNION ALL ".join(
    [
        _charged("Procedure", "x_procedure", "procedure_occurrence_id", "procedure", "procedure_date"),
        _charged("Drug", "x_drug", "drug_exposure_id", "drug", "drug_exposure_start_date"),
        _charged("Drug", "x_drug", "drug_exposure_id", "drug", "drug_exposure_start_date"),
        "SELECT * FROM x_condition_cost",
    ]
)

_DEF["x_cost"] = _fit(
    CDM["cost"],
    {
        "cost_id": """row_number() OVER (ORDER BY event, domain, charge NULLS LAST, paid NULLS LAST,
  payer NULLS LAST, patient NULLS LAST, primary_paid NULLS LAST, l.payer_plan_period_id NULLS LAST)""",
        "cost_event_id": "event",
        "cost_domain_id": "domain",
        "cost_type_concept_id": "32814",
        "currency_concept_id": "44818668",
        "total_charge": "charge",
        "total_cost": "charge",
        "total_paid": "paid",
        "paid_by_payer": "payer",
        "paid_by_patient": "patient",
        "paid_by_primary": "primary_paid",
        "payer_plan_period_id": "l.payer_plan_period_id",
        "revenue_code_concept_id": "0",
        "revenue_code_source_value": "'UNKNOWN / UNKNOWN'",
        "drg_concept_id": "0",
        "drg_source_value": "'000'",
    },
    """FROM x_priced r LEFT JOIN x_plan l ON l.person_id = r.person_id
  AND r.day BETWEEN l.payer_plan_period_start_date AND l.payer_plan_period_end_date""",
)

# --- the answers ---------------------------------------------------------------------------------

_VISIT_COLUMNS = "encounter_id, patient, encounterclass, visit_start_date, visit_end_date"
_SPANS = """SELECT o_custkey, CASE WHEN o_orderkey % 2 = 0 THEN 'even' ELSE 'odd' END AS kind, o_orderkey AS id,
  o_orderdate AS lo, o_orderdate + to_days(CAST(o_orderkey % 200 AS INTEGER)) AS hi FROM orders"""
_DEF["x_spans"] = _SPANS
_DEF["x_points"] = """SELECT row_number() OVER () AS rid, o_custkey, l_orderkey, l_linenumber, l_partkey, l_suppkey,
  l_shipdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
_DEF["x_covered"] = """SELECT p.rid, s.kind, s.id, s.lo, row_number() OVER (PARTITION BY p.rid, s.kind
  ORDER BY s.lo, s.id) AS place, CASE WHEN s.lo = p.l_shipdate THEN s.id END AS exact_id
FROM x_points p JOIN x_spans s ON s.o_custkey = p.o_custkey AND p.l_shipdate BETWEEN s.lo AND s.hi"""
_DEF["x_first"] = """SELECT rid, max(CASE WHEN kind = 'even' AND place = 1 THEN id END) AS even_id,
  max(CASE WHEN kind = 'odd' AND place = 1 THEN id END) AS odd_id,
  min(CASE WHEN kind = 'odd' THEN exact_id END) AS odd_exact_id FROM x_covered GROUP BY rid"""

_REQUIRED_PERSON = [f.name for f in CDM["person"].fields if not f.nullable]

_TABLES = {
    "person": "x_person",
    "observation_period": f"({_PERIOD}) t",
    "provider": "x_provider",
    "visit_occurrence": "x_visit",
    "visit_detail": f"({_DETAIL}) t",
    "condition_occurrence": "x_condition",
    "observation": "x_observation",
    "measurement": "x_measurement",
    "procedure_occurrence": "x_procedure",
    "drug_exposure": "x_drug",
    "condition_era": "x_condition_era",
    "drug_era": "x_drug_era",
    "device_exposure": "x_device",
    "death": "x_death",
    "payer_plan_period": "x_plan",
    "cost": "x_cost",
}

_DESCRIBED = _fit(
    CDM["cdm_source"],
    {
        "cdm_source_name": "'Orders'",
        "cdm_source_abbreviation": "'ORD'",
        "cdm_holder": "''",
        "source_description": "'Orders shaped like patient records'",
        "source_documentation_reference": "'README'",
        "cdm_etl_reference": "'README'",
        "source_release_date": "DATE '2024-01-01'",
        "cdm_release_date": "DATE '2024-01-01'",
        "cdm_version": "'5.3.1'",
        "vocabulary_version": "'v5.0 ' || r_name",
    },
    "FROM region WHERE r_regionkey = 0",
)

_ANSWERS = {
    "merge_intervals_gap0": _merged(0),
    "merge_intervals_gap30": _merged(30),
    "merge_moments": """SELECT weekday, opening AS "start", island_end AS "end", count(*) AS n
FROM x_moment_islands GROUP BY weekday, opening, island_end""",
    "inpatient_islands": """SELECT patient, opening AS "start", island_end AS "stop", count(*) AS stays
FROM x_closed_islands GROUP BY patient, opening, island_end""",
    "dense_ids": """SELECT l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey,
  row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS line_id FROM lineitem""",
    "previous_value": """SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice,
  lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS previous_order FROM orders""",
    "highest_before": """SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, max(o_totalprice) OVER (
  PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  AS highest_price FROM orders""",
    "earliest_cover": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, even_id, odd_id,
  odd_exact_id FROM x_points LEFT JOIN x_first USING (rid)""",
    "containment_join": """SELECT f.patient, f.encounter, f.code, f.at_day AS at, f.udi, t.payer, t.start_year,
  t.end_year FROM x_lines f LEFT JOIN x_transitions t ON t.patient = f.patient
  AND f.at_day BETWEEN t.start_year AND t.end_year""",
    "pick_best": """SELECT l_orderkey, l_shipdate, l_linenumber, l_partkey, l_suppkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey)
  AS place FROM lineitem) ranked WHERE place = 1""",
    "parse_number": f"SELECT event_id, value AS text, {_NUMBER.format('value')} AS number FROM x_observations",
    "ancestor_rollup": """SELECT f.patient, f.at AS "start", f.encounter, CAST(f.code AS INTEGER) AS drug,
  CAST(c.ancestor AS INTEGER) AS ingredient FROM x_lines f JOIN x_closure c ON c.descendant = CAST(f.code AS INTEGER)""",
    "source_to_standard": "SELECT * FROM x_standard",
    "source_to_source": "SELECT * FROM x_own",
    "map_codes_shuffled": """SELECT patient, encounter, x_lines.at AS date, code, target_concept_id
FROM x_lines JOIN x_condition_map USING (code)""",
    "unmapped_codes": """SELECT code, count(*) AS event_count FROM x_lines
WHERE code NOT IN (SELECT code FROM x_condition_map) GROUP BY code""",
    "inpatient_visits": f"SELECT {_VISIT_COLUMNS} FROM x_ip",
    "emergency_visits": f"SELECT {_VISIT_COLUMNS} FROM x_er",
    "outpatient_visits": f"SELECT {_VISIT_COLUMNS} FROM x_op",
    "all_visits": f"SELECT {_VISIT_COLUMNS}, visit_occurrence_id FROM x_visits",
    "candidate_visits": "SELECT * FROM x_candidates",
    "picked_visits": "SELECT * FROM x_final",
    "final_visit_ids": "SELECT * FROM x_final",
    "encounter_context": "SELECT * FROM x_context",
    **{name: f"SELECT * FROM {source}" for name, source in _TABLES.items()},
    "cdm_source": _DESCRIBED,
    "not_null_report": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM x_person"
        for c in _REQUIRED_PERSON
    ),
    "unique_report": """SELECT count(*) FILTER (WHERE n > 1) AS repeated_keys, CAST(sum(n - 1) AS BIGINT) AS surplus_rows
FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) g""",
    "interval_report": """SELECT count(*) FILTER (WHERE start IS NULL) AS open_start,
  count(*) FILTER (WHERE stop IS NULL) AS open_end, count(*) FILTER (WHERE stop < start) AS inverted FROM x_encounters""",
    "repeated_deaths": """SELECT person_id, count(*) AS death_rows FROM x_death GROUP BY person_id
HAVING count(*) > 1""",
    "quality_report": " UNION ALL ".join(
        [
            *[
                f"SELECT 'missing' AS check_name, '{t}' AS table_name, '{f.name}' AS column_name,"
                f" count(*) FILTER (WHERE {f.name} IS NULL) AS row_count FROM {source}"
                for t, source in (("person", "x_person"), ("death", "x_death"))
                for f in CDM[t].fields
                if not f.nullable
            ],
            *[
                f"SELECT 'surplus', '{t}', 'id', count(*) - count(DISTINCT id) FROM x_{t}"
                for t in ("encounters", "patients")
            ],
            "SELECT 'inverted', 'encounters', 'stop', count(*) FILTER (WHERE stop < start) FROM x_encounters",
            "SELECT 'inverted', 'conditions', 'stop', count(*) FILTER (WHERE stop < x_lines.at) FROM x_lines",
            *[
                f"SELECT 'unmapped', '{t}', 'code', count(*) FROM {facts} WHERE code NOT IN (SELECT code FROM x_map)"
                for t, facts in (("conditions", "x_lines"), ("observations", "x_observations"))
            ],
            """SELECT 'repeated', 'death', 'person_id', count(*) FROM (SELECT person_id FROM x_death
  GROUP BY person_id HAVING count(*) > 1) again""",
        ]
    ),
    "exposures_by_concept": """SELECT drug_exposure_id, person_id, drug_concept_id, drug_exposure_start_date FROM x_drug
WHERE drug_concept_id IN (SELECT concept_id FROM x_concept WHERE concept_class_id = 'Ingredient')""",
    "read_source": _fit(
        SOURCE["encounters"],
        {
            c: f'"{c}"'
            for c in (
                "id",
                "start",
                "stop",
                "patient",
                "provider",
                "payer",
                "encounterclass",
                "code",
                "reasoncode",
                "total_claim_cost",
                "payer_coverage",
            )
        },
        "FROM x_encounters",
    ),
    "read_vocabulary": _fit(
        VOCABULARY["concept"], {f.name: f.name for f in VOCABULARY["concept"].fields}, "FROM x_concept"
    ),
    "read_rejects": """SELECT
  CASE WHEN o_orderkey % 7 = 0 THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d') END || ',p' || o_custkey || ',e' || o_orderkey
    AS record,
  CASE WHEN o_orderkey % 7 = 0 THEN 'start' ELSE '' END AS reason FROM orders""",
    "vocabulary_download": "SELECT * FROM x_standard",
    "write_cdm": "SELECT * FROM x_person",
    "run_etl": "SELECT * FROM x_cost",
    "table_rows": " UNION ALL ".join(
        [
            *[
                f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}"
                for name, source in _TABLES.items()
            ],
            "SELECT 'cdm_source' AS table_name, count(*) AS row_count FROM region WHERE r_regionkey = 0",
        ]
    ),
}

_DEF["x_closed"] = """SELECT patient, start AS lo, stop AS hi FROM x_encounters
WHERE encounterclass = 'inpatient' AND stop IS NOT NULL"""
_islands("x_closed_islands", "x_closed", "patient", "INTERVAL 1 DAY")

ORACLE = {name: _with(sql) for name, sql in _ANSWERS.items()}
