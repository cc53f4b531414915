"""SQL oracles: per registered query, an independent ANSI-SQL statement
(DuckDB dialect) over the driver's tables that must return the same multiset
of rows with the same column names and types as the Spark query.

They restate the invoice mapping of ``plans.invoices`` in SQL and share no
code with the Spark side.
"""

from __future__ import annotations

_INVOICES = """invoices AS (
    SELECT l_orderkey AS invoice_id,
           l_linestatus AS legal_entity,
           l_suppkey AS counter_party,
           CAST(l_linenumber AS BIGINT) AS rating,
           CASE WHEN l_returnflag = 'A' THEN 'ARAP' WHEN l_returnflag = 'R' THEN 'ACCR' ELSE l_returnflag END AS status,
           CAST(l_quantity AS BIGINT) AS value
    FROM lineitem)"""

_TIERS = """tiers AS (
    SELECT s_suppkey AS counter_party, CAST(s_nationkey AS BIGINT) AS tier
    FROM supplier)"""

# The dictionary that lacks keys, for the queries about missing keys.
_PARTIAL_TIERS = """tiers AS (
    SELECT s_suppkey AS counter_party, CAST(s_nationkey AS BIGINT) AS tier
    FROM supplier WHERE s_acctbal > 5000)"""

_ENRICHED = """enriched AS (
    SELECT i.counter_party, i.invoice_id, i.legal_entity, i.rating, i.status, i.value, t.tier
    FROM invoices i JOIN tiers t ON i.counter_party = t.counter_party)"""

_WITH = f"WITH {_INVOICES},\n{_TIERS},\n{_ENRICHED}\n"

_METRICS = """MAX(rating) AS max_rating,
       CAST(COALESCE(SUM(value) FILTER (WHERE status = 'ARAP'), 0) AS BIGINT) AS sum_value_ARAP,
       CAST(COALESCE(SUM(value) FILTER (WHERE status = 'ACCR'), 0) AS BIGINT) AS sum_value_ACCR"""

_COUNT_LABELS = """CASE WHEN GROUPING(legal_entity) = 1 THEN CAST(COUNT(legal_entity) AS VARCHAR) ELSE CAST(legal_entity AS VARCHAR) END AS legal_entity,
       CASE WHEN GROUPING(counter_party) = 1 THEN CAST(COUNT(counter_party) AS VARCHAR) ELSE CAST(counter_party AS VARCHAR) END AS counter_party,
       CASE WHEN GROUPING(tier) = 1 THEN CAST(COUNT(tier) AS VARCHAR) ELSE CAST(tier AS VARCHAR) END AS tier"""

_TOTAL_LABELS = """CASE WHEN GROUPING(legal_entity) = 1 THEN 'Total' ELSE CAST(legal_entity AS VARCHAR) END AS legal_entity,
       CASE WHEN GROUPING(counter_party) = 1 THEN 'Total' ELSE CAST(counter_party AS VARCHAR) END AS counter_party,
       CASE WHEN GROUPING(tier) = 1 THEN 'Total' ELSE CAST(tier AS VARCHAR) END AS tier"""

_PAIRS = """GROUPING SETS ((legal_entity), (legal_entity, counter_party), (legal_entity, tier),
                        (counter_party), (counter_party, tier), (tier))"""

_SUPPLIER_FIRST = """d AS (
    SELECT s_nationkey AS nationkey, s_suppkey AS suppkey, s_name AS name, s_acctbal AS acctbal,
           ROW_NUMBER() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey, s_name, s_acctbal) AS rn
    FROM supplier)"""

_INVOICE_TEXT = """t AS (
    SELECT CAST(l_orderkey AS VARCHAR) AS invoice_id,
           CAST(l_suppkey AS VARCHAR) AS counter_party,
           CAST(l_linenumber AS VARCHAR) AS rating,
           CASE WHEN l_linenumber = 6 THEN NULL
                WHEN l_linenumber = 7 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || 'e'
                ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS value
    FROM lineitem),
r AS (
    SELECT *,
      CASE WHEN invoice_id IS NULL THEN 'missing value'
           WHEN NOT regexp_matches(trim(invoice_id), '^[+-]?[0-9]+$') THEN 'not an integer'
           WHEN TRY_CAST(trim(invoice_id) AS BIGINT) IS NULL THEN 'integer out of range' END AS r_invoice_id,
      CASE WHEN rating IS NULL THEN 'missing value'
           WHEN NOT regexp_matches(trim(rating), '^[+-]?[0-9]+$') THEN 'not an integer'
           WHEN TRY_CAST(trim(rating) AS BIGINT) IS NULL THEN 'integer out of range' END AS r_rating,
      CASE WHEN value IS NULL THEN 'missing value'
           WHEN NOT regexp_matches(trim(value), '^[+-]?[0-9]+$') THEN 'not an integer'
           WHEN TRY_CAST(trim(value) AS BIGINT) IS NULL THEN 'integer out of range' END AS r_value
    FROM t)"""

_WITH_NULL_ENTITY = f"""WITH {_INVOICES},
{_TIERS},
blanked AS (SELECT invoice_id, CASE WHEN rating <> 7 THEN legal_entity END AS legal_entity,
                   counter_party, rating, status, value FROM invoices),
enriched AS (
    SELECT b.counter_party, b.invoice_id, b.legal_entity, b.rating, b.status, b.value, t.tier
    FROM blanked b JOIN tiers t ON b.counter_party = t.counter_party)
"""

_ENRICH_SQL = f"WITH {_INVOICES},\n{_PARTIAL_TIERS},\n{_ENRICHED}\nSELECT * FROM enriched"
_WHOLE_ENRICH_SQL = _WITH + "SELECT * FROM enriched"
_COUNT_LABEL_SQL = _WITH + f"SELECT {_COUNT_LABELS},\n       {_METRICS}\nFROM enriched\nGROUP BY {_PAIRS}"
_CUBE_SQL = _WITH + f"SELECT {_TOTAL_LABELS},\n       {_METRICS}\nFROM enriched\nGROUP BY CUBE (legal_entity, counter_party, tier)"
_ENTITY_SQL = _WITH + """SELECT legal_entity, counter_party, COUNT(rating) AS count_rating, MAX(tier) AS max_tier,
       CAST(SUM(value) AS BIGINT) AS sum_value
FROM enriched GROUP BY legal_entity, counter_party"""

_MULTILINE = """WITH t AS (
    SELECT CAST(l_orderkey AS VARCHAR) AS invoice_id, l_linestatus AS legal_entity, CAST(l_suppkey AS VARCHAR) AS counter_party,
           CAST(l_linenumber AS VARCHAR) AS rating,
           CASE WHEN l_returnflag = 'A' THEN 'ARAP' WHEN l_returnflag = 'R' THEN 'ACCR' ELSE l_returnflag END AS status,
           CASE WHEN l_linenumber = 6 THEN NULL
                ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || CASE WHEN l_linenumber = 7 THEN 'e' ELSE '' END END AS value
    FROM lineitem)"""

_LATTICE = ("legal_entity", "status", "first_line", "large", "taxed", "discounted", "year", "quarter")

ORACLE_SQL = {
    "enrich_inner": _ENRICH_SQL,
    "enrich_broadcast": _ENRICH_SQL,
    "enrich_salted": _ENRICH_SQL,
    "enrich_lookup_dedup": f"""WITH {_SUPPLIER_FIRST}
SELECT c.c_nationkey AS nationkey, c.c_custkey AS custkey, c.c_name AS name, c.c_acctbal AS acctbal,
       d.suppkey, d.name AS supplier_name
FROM customer c JOIN d ON c.c_nationkey = d.nationkey
WHERE d.rn = 1""",
    "enrich_first_match": f"""WITH {_SUPPLIER_FIRST}
SELECT c.c_nationkey AS nationkey, c.c_custkey AS custkey, d.name, d.acctbal, d.suppkey
FROM customer c JOIN d ON c.c_nationkey = d.nationkey
WHERE d.rn = 1""",
    "enrich_null_safe": f"""WITH {_INVOICES},
{_PARTIAL_TIERS},
fact AS (SELECT CASE WHEN rating <> 7 THEN counter_party END AS counter_party,
                invoice_id, legal_entity, rating, status, value FROM invoices),
dict AS (SELECT counter_party, tier FROM tiers UNION ALL SELECT CAST(NULL AS BIGINT), CAST(-1 AS BIGINT))
SELECT f.counter_party, f.invoice_id, f.legal_entity, f.rating, f.status, f.value, d.tier
FROM fact f JOIN dict d ON f.counter_party IS NOT DISTINCT FROM d.counter_party""",
    "key_in_dictionary": f"""WITH {_INVOICES},
{_PARTIAL_TIERS}
SELECT * FROM invoices WHERE counter_party IN (SELECT counter_party FROM tiers)""",
    "key_in_dictionary_filtered": f"""WITH {_INVOICES},
{_PARTIAL_TIERS}
SELECT * FROM invoices WHERE counter_party IN (SELECT counter_party FROM tiers)""",
    "metrics_by_one_key": _WITH + f"SELECT legal_entity, {_METRICS}\nFROM enriched GROUP BY legal_entity",
    "metrics_by_two_keys": _WITH
    + f"SELECT legal_entity, counter_party, {_METRICS}\nFROM enriched GROUP BY legal_entity, counter_party",
    "metrics_by_three_keys": _WITH
    + f"SELECT legal_entity, counter_party, tier, {_METRICS}\nFROM enriched GROUP BY legal_entity, counter_party, tier",
    "entity_summary": _ENTITY_SQL,
    "totals_count_label": _COUNT_LABEL_SQL,
    "totals_singles": _WITH
    + f"SELECT {_COUNT_LABELS},\n       {_METRICS}\nFROM enriched\nGROUP BY GROUPING SETS ((legal_entity), (counter_party), (tier))",
    "totals_cube_label": _CUBE_SQL,
    "totals_rollup_label": _WITH
    + f"SELECT {_TOTAL_LABELS},\n       {_METRICS}\nFROM enriched\nGROUP BY ROLLUP (legal_entity, counter_party, tier)",
    "totals_by_status": _WITH
    + f"""SELECT CAST(legal_entity AS VARCHAR) AS legal_entity, CAST(counter_party AS VARCHAR) AS counter_party,
       CAST(tier AS VARCHAR) AS tier, status,
       COUNT(*) AS n_rows, MAX(rating) AS max_rating, CAST(SUM(value) AS BIGINT) AS sum_value,
       CAST(GROUPING(legal_entity, counter_party, tier, status) AS BIGINT) AS grouping_id
FROM enriched
WHERE status IN ('ARAP', 'ACCR')
GROUP BY GROUPING SETS ((legal_entity, status), (legal_entity, counter_party, status), (legal_entity, tier, status),
                        (counter_party, status), (counter_party, tier, status), (tier, status))""",
    "totals_after_join": _CUBE_SQL,
    "totals_from_batches": _CUBE_SQL,
    "totals_streamed": _CUBE_SQL,
    "totals_null_dims_cube": _WITH_NULL_ENTITY
    + f"""SELECT {_TOTAL_LABELS},
       {_METRICS},
       CAST(GROUPING(legal_entity, counter_party, tier) AS BIGINT) AS grouping_id
FROM enriched
GROUP BY CUBE (legal_entity, counter_party, tier)""",
    "totals_null_dims_count": _WITH_NULL_ENTITY
    + f"SELECT {_COUNT_LABELS},\n       {_METRICS}\nFROM enriched\nGROUP BY {_PAIRS}",
    "totals_sql": _COUNT_LABEL_SQL,
    "totals_union_form": _COUNT_LABEL_SQL,
    "totals_preaggregated": _CUBE_SQL,
    "validate_rows": f"""WITH {_INVOICE_TEXT}
SELECT invoice_id, counter_party, rating,
       CAST((r_invoice_id IS NOT NULL)::INTEGER + (r_rating IS NOT NULL)::INTEGER + (r_value IS NOT NULL)::INTEGER AS INTEGER) AS n_errors,
       COALESCE(r_invoice_id, r_rating, r_value) AS first_reason
FROM r
WHERE r_invoice_id IS NOT NULL OR r_rating IS NOT NULL OR r_value IS NOT NULL""",
    "validate_missing_column": f"""WITH {_INVOICE_TEXT}
SELECT invoice_id, counter_party,
       CAST(1 + (r_invoice_id IS NOT NULL)::INTEGER + (r_value IS NOT NULL)::INTEGER AS INTEGER) AS n_errors,
       COALESCE(r_invoice_id, 'missing column') AS first_reason
FROM r""",
    "reject_reasons": f"""WITH {_INVOICE_TEXT}
SELECT invoice_id, counter_party, rating, 'invoice_id' AS "column", invoice_id AS raw_value, r_invoice_id AS reason
FROM r WHERE r_invoice_id IS NOT NULL
UNION ALL
SELECT invoice_id, counter_party, rating, 'rating', rating, r_rating FROM r WHERE r_rating IS NOT NULL
UNION ALL
SELECT invoice_id, counter_party, rating, 'value', value, r_value FROM r WHERE r_value IS NOT NULL""",
    "validated_totals": f"""WITH t AS (
    SELECT CAST(l_orderkey AS VARCHAR) AS invoice_id, l_linestatus AS legal_entity,
           CAST(l_suppkey AS VARCHAR) AS counter_party, CAST(l_linenumber AS VARCHAR) AS rating,
           CASE WHEN l_returnflag = 'A' THEN 'ARAP' WHEN l_returnflag = 'R' THEN 'ACCR' ELSE l_returnflag END AS status,
           CASE WHEN l_linenumber = 6 THEN NULL
                WHEN l_linenumber = 7 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || 'e'
                ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS value
    FROM lineitem),
v AS (
    SELECT legal_entity, counter_party, CAST(trim(rating) AS BIGINT) AS rating, status, CAST(trim(value) AS BIGINT) AS value
    FROM t
    WHERE regexp_matches(trim(invoice_id), '^[+-]?[0-9]+$') AND TRY_CAST(trim(invoice_id) AS BIGINT) IS NOT NULL
      AND regexp_matches(trim(rating), '^[+-]?[0-9]+$') AND TRY_CAST(trim(rating) AS BIGINT) IS NOT NULL
      AND regexp_matches(trim(value), '^[+-]?[0-9]+$') AND TRY_CAST(trim(value) AS BIGINT) IS NOT NULL),
tiers AS (SELECT CAST(s_suppkey AS VARCHAR) AS counter_party, CAST(s_nationkey AS BIGINT) AS tier
          FROM supplier),
enriched AS (SELECT v.*, tiers.tier FROM v JOIN tiers ON v.counter_party = tiers.counter_party)
SELECT {_TOTAL_LABELS},
       {_METRICS}
FROM enriched
GROUP BY CUBE (legal_entity, counter_party, tier)""",
    "tolerant_read_rows": """WITH t AS (
    SELECT CAST(l_orderkey AS VARCHAR) AS invoice_id, l_linestatus || ', Inc' AS legal_entity,
           CAST(l_suppkey AS VARCHAR) AS counter_party, l_linenumber,
           CAST(l_linenumber AS VARCHAR) AS rating,
           CASE WHEN l_returnflag = 'A' THEN 'ARAP' WHEN l_returnflag = 'R' THEN 'ACCR' ELSE l_returnflag END AS status,
           CASE WHEN l_linenumber = 6 THEN NULL
                ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS value
    FROM lineitem)
SELECT invoice_id, legal_entity, counter_party, rating, status, value FROM t WHERE l_linenumber NOT IN (5, 7)""",
    "tolerant_read_bad_lines": """WITH t AS (
    SELECT CAST(l_orderkey AS VARCHAR) AS invoice_id, l_linestatus || ', Inc' AS legal_entity,
           CAST(l_suppkey AS VARCHAR) AS counter_party, l_linenumber,
           CAST(l_linenumber AS VARCHAR) AS rating,
           CASE WHEN l_returnflag = 'A' THEN 'ARAP' WHEN l_returnflag = 'R' THEN 'ACCR' ELSE l_returnflag END AS status,
           CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || CASE WHEN l_linenumber = 7 THEN 'e' ELSE '' END AS value
    FROM lineitem)
SELECT invoice_id, legal_entity, counter_party, rating, status, value,
       concat_ws(',', invoice_id, '"' || legal_entity || '"', counter_party, rating, status, value)
           || CASE WHEN l_linenumber = 7 THEN ',' ELSE ',1,,junk' END AS raw_line
FROM t WHERE l_linenumber IN (5, 7)""",
    "flat_cell_reshape": """SELECT l_orderkey AS invoice_id, l_linestatus AS legal_entity, CAST(l_suppkey AS VARCHAR) AS counter_party,
       CAST(l_linenumber AS BIGINT) AS rating,
       CASE WHEN l_returnflag = 'A' THEN 'ARAP' WHEN l_returnflag = 'R' THEN 'ACCR' ELSE l_returnflag END AS status,
       CAST(l_quantity AS BIGINT) AS value
FROM lineitem""",
    "format_rows": _WITH
    + """SELECT concat_ws('           ', legal_entity, CAST(counter_party AS VARCHAR), CAST(MAX(tier) AS VARCHAR),
                 CAST(MAX(rating) AS VARCHAR),
                 CAST(COALESCE(SUM(value) FILTER (WHERE status = 'ARAP'), 0) AS VARCHAR),
                 CAST(COALESCE(SUM(value) FILTER (WHERE status = 'ACCR'), 0) AS VARCHAR)) AS line
FROM enriched GROUP BY legal_entity, counter_party""",
    "sink_roundtrip_csv": _COUNT_LABEL_SQL,
    "table_roundtrip": _CUBE_SQL,
    "pipeline_run": _ENTITY_SQL,
    "validate_positions": f"""WITH {_INVOICE_TEXT},
p AS (
    SELECT CAST(row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_suppkey, l_linestatus,
               CASE WHEN l_returnflag = 'A' THEN 'ARAP' WHEN l_returnflag = 'R' THEN 'ACCR' ELSE l_returnflag END,
               CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)) AS BIGINT) AS position,
           CAST(l_orderkey AS VARCHAR) AS invoice_id, CAST(l_linenumber AS VARCHAR) AS rating, l_linenumber
    FROM lineitem)
SELECT position, invoice_id, rating, CAST(1 AS INTEGER) AS n_errors,
       CASE WHEN l_linenumber = 6 THEN 'missing value' ELSE 'not an integer' END AS first_reason
FROM p WHERE l_linenumber IN (6, 7)""",
    "flat_line_chunks": """SELECT l_orderkey AS invoice_id, l_linestatus AS legal_entity, CAST(l_suppkey AS VARCHAR) AS counter_party,
       CAST(l_linenumber AS BIGINT) AS rating,
       CASE WHEN l_returnflag = 'A' THEN 'ARAP' WHEN l_returnflag = 'R' THEN 'ACCR' ELSE l_returnflag END AS status,
       CAST(l_quantity AS BIGINT) AS value
FROM lineitem""",
    "rekeyed_rows": f"WITH {_INVOICES}\nSELECT legal_entity, counter_party, rating, status, value FROM invoices",
    "joined_to_table": _WHOLE_ENRICH_SQL,
    "catalog_table": _WHOLE_ENRICH_SQL,
    "csv_inferred_totals": _CUBE_SQL,
    "pipeline_csv_json": _ENTITY_SQL,
    "enrich_strict": _WHOLE_ENRICH_SQL,
    "cached_reuse": _WITH + f"""SELECT tier AS key, {_METRICS}, 'tier' AS level FROM enriched GROUP BY tier
UNION ALL
SELECT rating, {_METRICS}, 'rating' FROM enriched GROUP BY rating""",
    "totals_outer_join": f"""WITH {_INVOICES},
{_TIERS},
twins AS (SELECT * FROM tiers UNION ALL SELECT -counter_party - 1, tier FROM tiers),
enriched AS (
    SELECT t.counter_party, i.legal_entity, i.rating, i.status, i.value, t.tier
    FROM invoices i RIGHT JOIN twins t ON i.counter_party = t.counter_party)
SELECT {_TOTAL_LABELS},
       {_METRICS}, COUNT(*) AS n_rows, CAST(GROUPING(legal_entity, counter_party, tier) AS BIGINT) AS grouping_id
FROM enriched
GROUP BY CUBE (legal_entity, counter_party, tier)""",
    "totals_decimal": _WITH + f"""SELECT {_TOTAL_LABELS}, CAST(CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS VARCHAR) AS sum_amount
FROM enriched
GROUP BY ROLLUP (legal_entity, counter_party, tier)""",
    "tolerant_multiline": _MULTILINE + """
SELECT invoice_id, legal_entity || chr(10) || '"Inc", Ltd' AS legal_entity, counter_party, rating, status, value
FROM t WHERE rating NOT IN ('5', '7')""",
    "tolerant_multiline_bad": _MULTILINE + """
SELECT invoice_id || ',"' || legal_entity || chr(10) || '""Inc"", Ltd"' || CASE WHEN rating = '5' THEN 'x' ELSE '' END || ',' || counter_party || ','
       || rating || ',' || status || ',' || coalesce(value, '') || CASE WHEN rating = '7' THEN ',1,,junk' ELSE '' END AS raw_line
FROM t WHERE rating IN ('5', '7')""",
    "flat_endless_line": """SELECT l_orderkey AS invoice_id, l_linestatus || ', Inc' AS legal_entity, CAST(l_suppkey AS VARCHAR) AS counter_party,
       CAST(l_linenumber AS BIGINT) AS rating,
       CASE WHEN l_returnflag = 'A' THEN 'ARAP' WHEN l_returnflag = 'R' THEN 'ACCR' ELSE l_returnflag END AS status,
       CAST(l_quantity AS BIGINT) AS value
FROM lineitem""",
    "value_variance": f"""WITH {_INVOICES}
SELECT legal_entity, rating, round(var_pop(value), 4) AS variance FROM invoices GROUP BY legal_entity, rating""",
    "keyed_fan_out": _WITH + """, keyed AS (
    SELECT unnest(['0', '1', '2', '01', '02', '12']) AS level,
           unnest([legal_entity, CAST(counter_party AS VARCHAR), CAST(tier AS VARCHAR), legal_entity || '|' || counter_party,
                   legal_entity || '|' || tier, counter_party || '|' || tier]) AS key, rating, value
    FROM enriched)
SELECT level, key, COUNT(*) AS n_rows, MAX(rating) AS max_rating, CAST(SUM(value) AS BIGINT) AS sum_value FROM keyed GROUP BY level, key""",
    "totals_lattice": f"""WITH rows AS (
    SELECT l_linestatus AS legal_entity,
           CASE WHEN l_returnflag = 'A' THEN 'ARAP' WHEN l_returnflag = 'R' THEN 'ACCR' ELSE l_returnflag END AS status,
           CAST(l_linenumber = 1 AS INTEGER) AS first_line, CAST(l_quantity > 25 AS INTEGER) AS large,
           CAST(l_tax > 0 AS INTEGER) AS taxed, CAST(l_discount > 0 AS INTEGER) AS discounted,
           year(l_shipdate) AS year, quarter(l_shipdate) AS quarter, CAST(l_quantity AS BIGINT) AS value, CAST(l_linenumber AS BIGINT) AS rating
    FROM lineitem)
SELECT {", ".join(f"CASE WHEN GROUPING({c}) = 1 THEN 'Total' ELSE CAST({c} AS VARCHAR) END AS {c}" for c in _LATTICE)},
       COUNT(*) AS n_rows, MAX(rating) AS max_rating, CAST(SUM(value) AS BIGINT) AS sum_value,
       CAST(GROUPING({", ".join(_LATTICE)}) AS BIGINT) AS grouping_id
FROM rows GROUP BY CUBE ({", ".join(_LATTICE)})""",
    "run_report": f"""WITH {_PARTIAL_TIERS},
t AS (SELECT l_linenumber AS rating, l_suppkey AS counter_party FROM lineitem),
v AS (SELECT * FROM t WHERE rating NOT IN (5, 6, 7)),
counts AS (
    SELECT 1 AS one, (SELECT COUNT(*) FROM t) AS read, (SELECT COUNT(*) FROM t WHERE rating IN (5, 7)) AS too_long,
           (SELECT COUNT(*) FROM t WHERE rating = 6) AS rejected,
           (SELECT COUNT(*) FROM v WHERE counter_party NOT IN (SELECT counter_party FROM tiers)) AS unmatched,
           (SELECT COUNT(*) FROM v WHERE counter_party IN (SELECT counter_party FROM tiers)) AS written)
SELECT unnest(['read', 'too_long', 'rejected', 'unmatched', 'written']) AS step,
       CAST(unnest([read, too_long, rejected, unmatched, written]) AS BIGINT) AS n FROM counts""",
    "replayed_partition": f"""WITH {_INVOICES}
SELECT invoice_id, legal_entity, counter_party, rating, status, CASE WHEN rating = 3 THEN value + 1 ELSE value END AS value, rating AS day
FROM invoices""",
    "warehouse_table": _WITH + """SELECT * FROM enriched WHERE rating >= 2 AND value < 40 AND status IN ('ARAP', 'ACCR')""",
}
