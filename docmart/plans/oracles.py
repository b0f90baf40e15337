"""The same results as SQL on the base tables, for checking.

The rules of :mod:`docmart.plans.clinical` are restated here independently of the
documents: these statements never see XML.
"""

# Why a document is set aside, by its fault; the intact ones have none.
MESSAGE = """CASE o_orderkey % 97 WHEN 0 THEN 'malformed XML: cut off' WHEN 1 THEN 'empty document' WHEN 2 THEN 'content after the root'
  WHEN 3 THEN 'malformed XML: bad entity' WHEN 4 THEN 'malformed XML: mismatched tag or bad character' WHEN 5 THEN 'malformed XML: bad entity'
  WHEN 6 THEN 'malformed XML: mismatched tag or bad character' WHEN 7 THEN 'malformed XML: not XML' END"""

# What a strict parse says, in the fixed words of the parser. After 40 characters a key of four digits
# has its tag complete.
CAUSE = """CASE o_orderkey % 97 WHEN 0 THEN CASE WHEN o_orderkey BETWEEN 1000 AND 9999 THEN 'no element found' ELSE 'unclosed token' END WHEN 1 THEN 'no element found' WHEN 2 THEN 'junk after document element'
  WHEN 3 THEN 'not well-formed (invalid token)' WHEN 4 THEN 'mismatched tag' WHEN 5 THEN 'undefined entity' WHEN 6 THEN 'duplicate attribute'
  WHEN 7 THEN 'syntax error' END"""
RAISED = f"""CASE WHEN o_orderkey % 97 <= 7 THEN 'ParseError: ' || {CAUSE}
  WHEN o_orderkey % 89 = 3 THEN 'ValueError: visit ' || o_orderkey || ' is closed' END"""

# Records of the intact documents, one row per (order, section, number).
RECORDS = """
WITH rec AS (
  SELECT *, o_custkey + 7 * i AS code, 'results' AS config
  FROM orders, range(1, 4) AS t(i) WHERE i <= o_orderkey % 4 AND o_orderkey % 97 > 7
  UNION ALL
  SELECT *, o_custkey + 11 * i AS code, 'vitals' AS config
  FROM orders, range(1, 4) AS t(i) WHERE i <= o_custkey % 3 AND o_orderkey % 97 > 7
  UNION ALL
  SELECT *, o_custkey + 13 * i AS code, 'medications' AS config
  FROM orders, range(1, 4) AS t(i) WHERE i <= (o_orderkey + o_custkey) % 3 AND o_orderkey % 97 > 7
), timed AS (
  SELECT *, CASE WHEN i = 3 THEN 'LOCAL' ELSE 'PART' END AS code_system,
         date_trunc('day', o_orderdate) + to_days(CAST(i AS INTEGER))
           + to_hours(i + 9) + to_minutes(30) AS ts,
         (o_orderkey + i) % 6 AS vr, (o_orderkey + i) % 7 AS tr, o_custkey + i AS base
  FROM rec
), records AS (
  SELECT config, CAST(o_orderkey AS VARCHAR) AS doc_id, o_custkey AS person_id, o_orderkey AS visit_id,
         CAST(i AS INTEGER) AS seq, code_system, CAST(code AS VARCHAR) AS source_code,
         COALESCE(CASE WHEN code_system = 'PART' AND p_partkey % 10 <> 0 THEN p_partkey + 1000000 END, 0) AS concept_id,
         CASE vr WHEN 0 THEN CAST(base AS DOUBLE) WHEN 1 THEN CAST(base AS DOUBLE)
                 WHEN 2 THEN CAST(CAST(base AS VARCHAR) || '.7' AS DOUBLE)
                 WHEN 5 THEN CAST(-10 * base AS DOUBLE) END AS value,
         CAST(CASE vr WHEN 0 THEN base WHEN 1 THEN base WHEN 2 THEN base WHEN 5 THEN -10 * base END AS BIGINT) AS value_int,
         'u' AS unit,
         CASE tr WHEN 0 THEN date_trunc('day', ts) WHEN 2 THEN ts + to_hours(5)
                 WHEN 4 THEN date_trunc('day', ts) WHEN 5 THEN NULL ELSE ts END AS measured_at,
         CASE WHEN tr <> 5 THEN CAST(ts AS DATE) END AS measured_on,
         CASE vr WHEN 0 THEN CAST(base AS VARCHAR) WHEN 1 THEN ' ' || CAST(base AS VARCHAR) || ' '
                 WHEN 2 THEN CAST(base AS VARCHAR) || '.7' WHEN 3 THEN 'abc'
                 WHEN 5 THEN '-' || CAST(base AS VARCHAR) || 'e1' END AS raw_value,
         CASE tr WHEN 0 THEN strftime(ts, '%Y%m%d') WHEN 1 THEN strftime(ts, '%Y%m%d%H%M%S')
                 WHEN 2 THEN strftime(ts, '%Y%m%d%H%M%S') || '-0500'
                 WHEN 3 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' WHEN 4 THEN strftime(ts, '%m/%d/%Y')
                 WHEN 5 THEN 'unknown' ELSE strftime(ts, '%Y%m%d%H%M') END AS raw_time
  FROM timed LEFT JOIN part ON p_partkey = code
)
"""

# Number of records of every (order, config) pair; null where there are none.
COUNTS = """
WITH per_doc AS (
  SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS doc_id, o_orderkey % 97 > 7 AS intact,
         o_orderkey % 4 AS results, o_custkey % 3 AS vitals, (o_orderkey + o_custkey) % 3 AS medications,
         CASE WHEN o_orderkey % 11 <> 0 THEN 1 ELSE 0 END AS encounter, 1 AS patient,
         CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS notes, 0 AS devices
  FROM orders
), pairs AS (
  SELECT doc_id, o_orderkey, intact, c.config, c.ordinal, c.width, c.domain, c.tbl,
         NULLIF(CASE c.config WHEN 'results' THEN results WHEN 'vitals' THEN vitals
                WHEN 'medications' THEN medications WHEN 'encounter' THEN encounter
                WHEN 'patient' THEN patient WHEN 'notes' THEN notes ELSE devices END, 0) AS n
  FROM per_doc, (VALUES
    ('results', 1, 11, 'Measurement', 'measurement'), ('vitals', 2, 11, 'Measurement', 'measurement'),
    ('medications', 3, 10, 'Drug', 'drug'), ('encounter', 4, 6, 'Visit', 'visit'),
    ('patient', 5, 2, 'Person', 'person'), ('notes', 6, 2, NULL, NULL),
    ('devices', 7, 2, 'Device', 'device')) AS c(config, ordinal, width, domain, tbl)
  WHERE intact
)
"""

_MEASUREMENT = """doc_id, person_id, visit_id, seq, source_code, concept_id, value, value_int,
  unit, measured_at, measured_on"""

# Text made from lineitem columns, in the spellings the lenient casts must read.
NUMBER_TEXTS = """
WITH texts AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
    CASE l_linenumber
      WHEN 1 THEN CAST(l_partkey AS VARCHAR)
      WHEN 2 THEN '  ' || CAST(l_partkey AS VARCHAR) || ' '
      WHEN 3 THEN '-' || CAST(l_partkey AS VARCHAR) || '.75'
      WHEN 4 THEN CAST(l_suppkey AS VARCHAR) || 'e3'
      WHEN 5 THEN CASE WHEN l_suppkey % 4 = 0 THEN 'inf' WHEN l_suppkey % 4 = 1 THEN 'NaN'
                       WHEN l_suppkey % 4 = 2 THEN CAST(l_partkey AS VARCHAR) || 'd' ELSE '' END
      WHEN 6 THEN '90071992547' || lpad(CAST(l_suppkey % 100000 AS VARCHAR), 5, '0')
      ELSE NULL END AS x
  FROM lineitem
)
"""

TIME_TEXTS = """
WITH texts AS (
  SELECT l_orderkey, l_linenumber, l_partkey, k, ts, CASE k
      WHEN 0 THEN strftime(ts, '%Y%m%d')
      WHEN 1 THEN strftime(ts, '%Y%m%d%H%M')
      WHEN 2 THEN strftime(ts, '%Y%m%d%H%M%S')
      WHEN 3 THEN strftime(ts, '%Y%m%d%H%M%S') || '-0500'
      WHEN 4 THEN strftime(ts, '%Y-%m-%d')
      WHEN 5 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z'
      WHEN 6 THEN strftime(ts, '%m/%d/%Y')
      WHEN 7 THEN strftime(ts, '%Y%m')
      WHEN 8 THEN strftime(ts, '%Y')
      WHEN 9 THEN strftime(ts, '%Y%m%d%H')
      WHEN 10 THEN 'abc'
      WHEN 11 THEN '0000'
      WHEN 12 THEN strftime(ts, '%Y%m%d%H%M') || '+0200'
      WHEN 14 THEN strftime(ts, '%b %d %Y')
      WHEN 15 THEN strftime(ts, '%d-%b-%Y')
      WHEN 16 THEN strftime(ts, '%m/%d/%y')
      WHEN 17 THEN strftime(ts, '%Y-%m-%d %I:%M %p')
      WHEN 18 THEN strftime(ts, '%m/%d/%Y %I:%M:%S %p')
      WHEN 19 THEN strftime(ts, '%Y%m%dT%H%M%S')
      WHEN 20 THEN strftime(ts, '%Y%m%d%H%M') || '-05:00' END AS x
  FROM (SELECT *, l_partkey % 21 AS k,
               l_shipdate + to_hours(CAST(l_suppkey % 24 AS INTEGER)) + to_minutes(CAST(l_linenumber AS INTEGER)) AS ts
        FROM lineitem)
)
"""

ORACLES: dict[str, str] = {
    "flagship_measurement": RECORDS + f"""
        SELECT {_MEASUREMENT} FROM records WHERE config IN ('results', 'vitals')""",
    "drug_table": RECORDS + """
        SELECT doc_id, person_id, visit_id, seq, source_code, concept_id, value AS quantity, unit, measured_at, measured_on
        FROM records WHERE config = 'medications'""",
    "visit_table": """
        SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, o_orderkey AS visit_id, o_custkey AS person_id,
               o_orderpriority AS priority, date_trunc('second', o_orderdate) AS start_at,
               CAST(o_orderdate AS DATE) AS start_on, CAST(NULL AS BIGINT) AS admitting_source_concept_id
        FROM orders WHERE o_orderkey % 97 > 7 AND o_orderkey % 11 <> 0""",
    "person_table": """
        SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, o_custkey AS person_id FROM orders WHERE o_orderkey % 97 > 7""",
    "config_records": RECORDS + """
        SELECT doc_id, CAST(person_id AS VARCHAR) AS person_id, CAST(visit_id AS VARCHAR) AS visit_id,
               CAST(seq AS VARCHAR) AS seq, source_code, raw_value AS value, raw_time AS measured_at
        FROM records WHERE config = 'results'""",
    "config_subset": RECORDS + f"""
        SELECT {_MEASUREMENT} FROM records WHERE config = 'vitals'""",
    "scan_directory": RECORDS + f"""
        SELECT {_MEASUREMENT} FROM records WHERE config = 'vitals'""",
    "rule_table": RECORDS + """
        SELECT doc_id, person_id, visit_id, seq, source_code, value, measured_at FROM records
        WHERE config IN ('results', 'vitals') AND visit_id % 89 <> 3""",
    "rule_quarantine": f"""
        SELECT doc_id, doc_id || '.xml' AS file_name, message FROM (
          SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, {RAISED} AS message FROM orders) WHERE message IS NOT NULL""",
    "rule_status": COUNTS + f"""
        SELECT 'OK' AS status, COUNT(*) AS n FROM (SELECT DISTINCT doc_id FROM pairs WHERE n > 0 AND tbl = 'measurement' AND o_orderkey % 89 <> 3)
        UNION ALL SELECT 'ERROR', COUNT({RAISED}) FROM orders""",
    "guarded_udf": """
        SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 10 > 0 THEN 1000 // (l_partkey % 10) END AS value,
               CASE WHEN l_partkey % 10 = 0 THEN 'ZeroDivisionError: key ' || l_partkey END AS error FROM lineitem""",
    "error_causes": f"""
        SELECT {CAUSE} AS cause, COUNT(*) AS n FROM orders WHERE o_orderkey % 97 <= 7 GROUP BY 1 ORDER BY n DESC, cause""",
    "error_places": f"""
        SELECT CAST(o_orderkey AS VARCHAR) || '.xml' AS file_name, {CAUSE} AS cause, 1 AS line, o_orderkey % 97 NOT IN (1, 7) AS later
        FROM orders WHERE o_orderkey % 97 <= 7 AND o_orderkey % 97 NOT IN (4, 6)""",
    # Between documents nothing counts: an empty one and one that is no XML leave no trace, and more
    # after a root none either.
    "rowtag_scan": """
        SELECT CASE WHEN error IS NULL THEN o_orderkey END AS visit_id,
               CASE WHEN error IS NULL THEN CAST(o_orderkey % 4 AS INTEGER) ELSE 0 END AS n_results,
               CASE WHEN error IS NULL THEN CAST(o_custkey % 3 AS INTEGER) ELSE 0 END AS n_vitals, error
        FROM (SELECT *, CASE WHEN o_orderkey % 97 <> 2 THEN """ + MESSAGE + """ END AS error FROM orders WHERE o_orderkey % 97 NOT IN (1, 7))""",
    "rowtag_table": RECORDS.replace("o_orderkey % 97 > 7", "(o_orderkey % 97 > 7 OR o_orderkey % 97 = 2)") + """
        SELECT doc_id, person_id, visit_id, seq, source_code, concept_id, value AS quantity, unit, measured_at, measured_on
        FROM records WHERE config = 'medications'""",
    "packed_scan": """
        SELECT CAST(o_orderkey AS VARCHAR) AS doc_id,
               """ + MESSAGE + " AS error FROM orders",
    "doc_count": """
        SELECT COUNT(DISTINCT CASE WHEN o_orderkey % 97 > 7 THEN o_orderkey // 500 END) + COUNT(CASE WHEN o_orderkey % 97 <= 7 THEN 1 END) AS n_documents
        FROM orders""",
    "scan_quarantine": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, CAST(o_orderkey AS VARCHAR) || '.xml' AS file_name, {MESSAGE} AS message
        FROM orders WHERE o_orderkey % 97 <= 7""",
    "doc_ids": """
        SELECT file_name, CASE
            WHEN o_orderkey % 6 = 2 THEN file_name
            WHEN o_orderkey % 6 = 3 THEN file_name
            ELSE substr(file_name, 1, length(file_name) - strpos(reverse(file_name), '.')) END AS doc_id
        FROM (SELECT o_orderkey, CASE o_orderkey % 6
                WHEN 0 THEN CAST(o_orderkey AS VARCHAR) || '.xml'
                WHEN 1 THEN CAST(o_orderkey AS VARCHAR) || '.v2.xml'
                WHEN 2 THEN CAST(o_orderkey AS VARCHAR)
                WHEN 3 THEN '.x' || CAST(o_orderkey AS VARCHAR)
                WHEN 4 THEN CAST(o_orderkey AS VARCHAR) || '..xml'
                ELSE '.' || CAST(o_orderkey AS VARCHAR) || '.xml' END AS file_name FROM orders)""",
    "codemap_lookup": """
        SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS code,
               COALESCE(CASE WHEN l_linenumber <> 7 AND p_partkey % 10 <> 0 THEN p_partkey + 1000000 END, 0) AS concept_id
        FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""",
    "codemap_split": """
        SELECT l_orderkey, l_linenumber, code, CASE WHEN l_linenumber < 7 AND p_partkey % 10 <> 0 THEN p_partkey + 1000000 END AS concept_id
        FROM (SELECT *, CASE WHEN l_linenumber < 3 THEN '11' WHEN l_linenumber < 7 THEN CAST(l_partkey AS VARCHAR) END AS code FROM lineitem)
        LEFT JOIN part ON CAST(p_partkey AS VARCHAR) = code""",
    "packed_loads": """
        SELECT o_orderkey, CAST(FLOOR((SUM(size) OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey) - size / 2) / 100000000) AS INTEGER) AS load
        FROM (SELECT o_orderkey, FLOOR(o_totalprice) AS size FROM orders)""",
    "codemap_misses": RECORDS + """
        SELECT code_system, source_code AS code, COUNT(*) AS n FROM records
        WHERE concept_id = 0 GROUP BY code_system, source_code""",
    "codemap_unique": """
        SELECT code_system, code, MAX(concept_id) AS concept_id FROM (
          SELECT 'PART' AS code_system, CAST(l_partkey AS VARCHAR) AS code, l_suppkey AS concept_id FROM lineitem)
        GROUP BY code_system, code""",
    "route_tables": COUNTS + """
        SELECT config, domain, tbl AS "table", CAST(COALESCE(SUM(n), 0) AS BIGINT) AS n FROM pairs
        WHERE tbl IS NOT NULL GROUP BY config, domain, tbl""",
    "route_unmapped": COUNTS + """
        SELECT config, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS n FROM pairs WHERE tbl IS NULL GROUP BY config""",
    "domain_filter": COUNTS + """
        SELECT domain, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS n FROM pairs
        WHERE domain IN ('Care_Site', 'Condition', 'Device', 'Drug', 'Location', 'Measurement', 'Person', 'Procedure', 'Provider')
          AND domain NOT IN ('Visit', 'Observation') GROUP BY domain""",
    "domain_exclude": COUNTS + """
        SELECT doc_id, tbl AS "table", CAST(SUM(n) AS BIGINT) AS n FROM pairs
        WHERE n > 0 AND domain IN ('Measurement', 'Drug', 'Person', 'Device') GROUP BY doc_id, tbl""",
    "cast_int": NUMBER_TEXTS + """
        SELECT l_orderkey, l_linenumber, l_partkey, x,
          CASE l_linenumber WHEN 3 THEN -l_partkey
            WHEN 4 THEN CAST(trunc(TRY_CAST(x AS DOUBLE)) AS BIGINT)
            WHEN 5 THEN NULL ELSE TRY_CAST(trim(x) AS BIGINT) END AS as_int64,
          CASE l_linenumber WHEN 3 THEN CAST(-l_partkey AS INTEGER)
            WHEN 4 THEN CAST(trunc(TRY_CAST(x AS DOUBLE)) AS INTEGER)
            WHEN 5 THEN NULL ELSE TRY_CAST(trim(x) AS INTEGER) END AS as_int32
        FROM texts""",
    "cast_float": NUMBER_TEXTS + """
        SELECT l_orderkey, l_linenumber, l_partkey, x,
          CASE WHEN x IN ('NaN', '') OR x LIKE '%d' THEN NULL ELSE TRY_CAST(trim(x) AS DOUBLE) END AS as_float64,
          CASE WHEN x IN ('NaN', '') OR x LIKE '%d' THEN NULL ELSE CAST(TRY_CAST(trim(x) AS FLOAT) AS DOUBLE) END AS as_float32
        FROM texts""",
    "cast_date": TIME_TEXTS + """
        SELECT l_orderkey, l_linenumber, l_partkey, x,
          CASE WHEN k IN (9, 10, 11, 13) THEN NULL WHEN k = 7 THEN CAST(date_trunc('month', ts) AS DATE)
               WHEN k = 8 THEN CAST(date_trunc('year', ts) AS DATE) ELSE CAST(ts AS DATE) END AS as_date
        FROM texts""",
    "cast_ts": TIME_TEXTS + """
        SELECT l_orderkey, l_linenumber, l_partkey, x,
          CASE WHEN k IN (9, 10, 11, 13) THEN NULL WHEN k IN (0, 4, 6, 14, 15, 16) THEN date_trunc('day', ts)
               WHEN k IN (3, 20) THEN ts + to_hours(5) WHEN k = 12 THEN ts - to_hours(2)
               WHEN k = 7 THEN date_trunc('month', ts) WHEN k = 8 THEN date_trunc('year', ts) ELSE ts END AS as_ts
        FROM texts""",
    "cast_str": """
        SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey,
          CAST(l_partkey AS VARCHAR) AS int_text,
          CASE WHEN l_linenumber = 5 THEN NULL WHEN l_partkey = 0 THEN '0.5' ELSE CAST(l_partkey AS VARCHAR) || '000000.5' END AS float_text,
          strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS ts_text,
          strftime(l_shipdate, '%Y-%m-%d') AS date_text, l_returnflag AS str_text
        FROM lineitem""",
    "null_check": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_linenumber IN (3, 5) AS value_is_null, FALSE AS nan_text_is_null,
               l_linenumber = 4 AS text_is_null FROM lineitem""",
    "coerce_table": """
        SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber,
               l_quantity AS l_quantity, CAST(l_shipdate AS DATE) AS l_shipdate,
               CAST(CAST(l_discount * 100 AS INTEGER) AS VARCHAR) AS untouched
        FROM lineitem""",
    "align_schema": """
        SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, CAST(NULL AS BIGINT) AS visit_id, o_custkey AS person_id,
               o_orderpriority AS priority, o_orderdate AS start_at, CAST(NULL AS DATE) AS start_on,
               CAST(NULL AS BIGINT) AS admitting_source_concept_id FROM orders""",
    "union_configs": RECORDS + """
        SELECT config, doc_id, source_code, CASE WHEN config <> 'medications' THEN raw_value END AS value,
               CASE WHEN config = 'medications' THEN raw_value END AS quantity, CAST(NULL AS VARCHAR) AS "text"
        FROM records
        UNION ALL
        SELECT 'notes', CAST(o_orderkey AS VARCHAR), NULL, NULL, NULL, o_orderstatus FROM orders
        WHERE o_orderkey % 5 = 0 AND o_orderkey % 97 > 7""",
    # Its corpus has the first two kinds of faults only.
    "combine_domains": RECORDS.replace("% 97 > 7", "% 97 > 1") + """
        SELECT CASE WHEN config = 'medications' THEN 'Drug' ELSE 'Measurement' END AS domain, doc_id, seq, source_code, concept_id,
               CASE WHEN config <> 'medications' THEN value_int END AS value_int,
               CASE WHEN config = 'medications' THEN value END AS quantity
        FROM records""",
    "empty_tables_skipped": COUNTS + """
        SELECT tbl AS "table", CAST(SUM(n) AS BIGINT) AS n FROM pairs
        WHERE tbl IS NOT NULL GROUP BY tbl HAVING COUNT(n) > 0""",
    "quarantine": RECORDS.replace("% 97 > 7", "% 97 BETWEEN 2 AND 6") + """
        , parts AS (
          SELECT doc_id, string_agg('<' || config || ' seq="' || CAST(seq AS VARCHAR) || '"><code code="' || source_code || '" codeSystem="' || code_system
                   || '"/><value' || COALESCE(' value="' || raw_value || '"', '') || ' unit="u"/><effectiveTime value="' || raw_time || '"/></' || config || '>', ''
                   ORDER BY list_position(['results', 'vitals', 'medications'], config), seq) AS body
          FROM records GROUP BY doc_id)
        SELECT k AS doc_id, k || '.xml' AS file_name, """ + MESSAGE + """ AS message,
               CASE o_orderkey % 97 WHEN 0 THEN substr('<ClinicalDocument><id extension="' || k || '"/><patient extension="', 1, 40) WHEN 1 THEN '' WHEN 7 THEN 'no XML'
                 ELSE '<ClinicalDocument><id extension="' || k || '"/><patient extension="' || CAST(o_custkey AS VARCHAR) || '"/>'
                   || CASE WHEN o_orderkey % 11 <> 0 THEN '<encounter priority="' || o_orderpriority || '"><effectiveTime value="'
                        || strftime(o_orderdate, '%Y%m%d%H%M%S') || '"/></encounter>' ELSE '' END
                   || COALESCE(body, '') || CASE WHEN o_orderkey % 5 = 0 THEN '<notes text="' || o_orderstatus || '"/>' ELSE '' END
                   || CASE WHEN o_orderkey % 13 = 0 THEN '<id extension="-1"/>' ELSE '' END
                   || CASE o_orderkey % 97 WHEN 3 THEN '&' WHEN 4 THEN '</patient>' WHEN 5 THEN '&unknown;' WHEN 6 THEN '<twice a="1" a="2"/>' ELSE '' END
                   || '</ClinicalDocument>' || CASE WHEN o_orderkey % 97 = 2 THEN '<more/>' ELSE '' END END AS xml
        FROM (SELECT *, CAST(o_orderkey AS VARCHAR) AS k FROM orders WHERE o_orderkey % 97 <= 7) LEFT JOIN parts ON doc_id = k""",
    "document_status": COUNTS + """
        SELECT line FROM (
          SELECT DISTINCT doc_id, tbl, 'OK: ' || doc_id || ' -> ' || tbl AS line FROM pairs WHERE n > 0 AND tbl IS NOT NULL)
        UNION ALL
        SELECT 'ERROR: ' || CAST(o_orderkey AS VARCHAR) || '.xml :: '
               || """ + MESSAGE + """
        FROM orders WHERE o_orderkey % 97 <= 7""",
    "run_status": COUNTS + """
        SELECT 'OK' AS status, COUNT(*) AS n FROM (SELECT DISTINCT doc_id, tbl FROM pairs WHERE n > 0 AND tbl IS NOT NULL)
        UNION ALL SELECT 'ERROR', COUNT(*) FROM orders WHERE o_orderkey % 97 <= 7""",
    "ok_pairs": COUNTS + """
        SELECT DISTINCT doc_id, tbl AS outcome FROM pairs WHERE n > 0 AND tbl IS NOT NULL
        UNION ALL
        SELECT CAST(o_orderkey AS VARCHAR),
               'quarantine: ' || """ + MESSAGE + """
        FROM orders WHERE o_orderkey % 97 <= 7""",
    "error_histogram": """
        SELECT """ + MESSAGE + """ AS message, COUNT(*) AS n
        FROM orders WHERE o_orderkey % 97 <= 7 GROUP BY 1 ORDER BY n DESC, message""",
    "table_row_counts": COUNTS + """
        SELECT tbl AS "table", CAST(SUM(n) AS BIGINT) AS n FROM pairs WHERE n > 0 AND tbl IS NOT NULL GROUP BY tbl""",
    "shape_log": COUNTS + """
        SELECT doc_id, config, CAST(n AS BIGINT) AS n_rows, CASE WHEN n IS NOT NULL THEN width END AS n_columns,
               CASE WHEN n IS NOT NULL THEN CAST(SUM(n) OVER w AS BIGINT) END AS running_rows,
               CASE WHEN ROW_NUMBER() OVER w = 1 THEN ordinal ELSE 7 END AS configs_seen
        FROM pairs
        WINDOW w AS (PARTITION BY config ORDER BY md5(doc_id), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "preview": RECORDS + f"""
        SELECT {_MEASUREMENT} FROM records WHERE config IN ('results', 'vitals')
        ORDER BY visit_id, source_code, seq, value LIMIT 100""",
    "column_probe": """
        SELECT 'start_at' AS "column", strftime(arg_min(o_orderdate, CAST(o_orderkey AS VARCHAR)), '%Y-%m-%d %H:%M:%S') AS first_value,
               'timestamp' AS type
        FROM orders WHERE o_orderkey % 97 > 7 AND o_orderkey % 11 <> 0""",
    "literal_rows": """
        SELECT CAST(r.a AS BIGINT) AS a, CAST(r.b AS BIGINT) AS b, r.c, COUNT(*) AS n_lines FROM lineitem
        JOIN (VALUES (3, 30, 'three'), (5, 50, 'five'), (6, 60, 'six')) AS r(a, b, c) ON l_linenumber = r.a
        GROUP BY r.a, r.b, r.c""",
    "typed_rows": """
        SELECT l_returnflag AS flag, CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS BIGINT) AS rank,
               COUNT(*) AS n FROM lineitem GROUP BY 1, 2""",
    "plus_one_udf": "SELECT l_orderkey, l_linenumber, l_partkey, l_partkey + 1 AS part_plus_one FROM lineitem",
    "parquet_roundtrip": RECORDS + f"""
        SELECT {_MEASUREMENT} FROM records WHERE config IN ('results', 'vitals')""",
    "compact_roundtrip": RECORDS + f"""
        SELECT {_MEASUREMENT} FROM records WHERE config IN ('results', 'vitals')""",
    "publish_table": RECORDS + f"""
        SELECT {_MEASUREMENT} FROM records WHERE config IN ('results', 'vitals')""",
    "publish_history": RECORDS + """
        , sizes AS (SELECT config, COUNT(*) AS n FROM records GROUP BY config)
        SELECT CAST(1 AS BIGINT) AS number, 'first' AS run, 'measurement' AS "table", 1 AS parts, n AS rows FROM sizes WHERE config = 'vitals'
        UNION ALL SELECT 2, 'second', 'measurement', 1, CAST(SUM(n) AS BIGINT) FROM sizes WHERE config IN ('results', 'vitals')
        UNION ALL SELECT v.number, v.run, 'drug', 1, n FROM sizes, (VALUES (1, 'first'), (2, 'second')) AS v(number, run) WHERE config = 'medications'""",
    "compact_parts": RECORDS + f"""
        SELECT {_MEASUREMENT} FROM records WHERE config IN ('results', 'vitals')""",
    "compact_history": RECORDS + """
        SELECT CAST(v.number AS BIGINT) AS number, 'measurement' AS "table", v.parts, COUNT(*) AS rows
        FROM records, (VALUES (1, 1, 0), (2, 2, 1), (3, 3, 2), (4, 2, 2), (5, 3, 3), (6, 4, 4), (7, 2, 4)) AS v(number, parts, pieces)
        WHERE config IN ('results', 'vitals') AND (visit_id % 1000 > 3 OR visit_id % 1000 < v.pieces) GROUP BY v.number, v.parts""",
    "csv_roundtrip": RECORDS + """
        SELECT doc_id, person_id, visit_id, seq, source_code, concept_id, value AS quantity, unit, measured_at, measured_on
        FROM records WHERE config = 'medications'""",
    "csv_per_doc": RECORDS + """
        SELECT doc_id || '.xml__results.csv' AS file_name,
          'doc_id,person_id,visit_id,seq,source_code,concept_id,value,unit,measured_at,measured_on,value_int' || chr(13) || chr(10)
          || string_agg(doc_id || ',' || CAST(person_id AS VARCHAR) || ',' || CAST(visit_id AS VARCHAR) || ','
             || CAST(seq AS VARCHAR) || ',' || source_code || ',' || CAST(concept_id AS VARCHAR) || ',' || COALESCE(raw_value, '') || ',u,' || raw_time || ','
             || raw_time || ',' || COALESCE(raw_value, ''), chr(13) || chr(10) ORDER BY seq)
          || chr(13) || chr(10) AS csv
        FROM records WHERE config = 'results' GROUP BY doc_id""",
    "document_partitions": RECORDS + """
        SELECT doc_id, seq, source_code, concept_id, quantity, measured_on FROM (
          SELECT *, value AS quantity FROM records WHERE config = 'medications')""",
    "output_files": """
        SELECT (SELECT COUNT(DISTINCT o_orderpriority) FROM orders WHERE o_orderkey % 97 > 7 AND o_orderkey % 11 <> 0)
             + (SELECT COUNT(DISTINCT o_custkey % 10) FROM orders WHERE o_orderkey % 97 > 7) AS n_files""",
    "convert_job": COUNTS + """
        SELECT tbl AS "table", CAST(SUM(n) AS BIGINT) AS n_rows, COUNT(DISTINCT doc_id) AS n_documents FROM pairs
        WHERE n > 0 AND tbl IS NOT NULL GROUP BY tbl""",
}

# The same content, whether packed as rows or as files.
ORACLES["csv_files"] = ORACLES["csv_per_doc"]
