"""Independent SQL statements of each registered query, for DuckDB.

The views ``lineitem orders part supplier nation region`` (and the other test
tables) are registered by the checker. The statements restate the test
mapping and the report rules in plain SQL; they share no code with the Spark
side. Types are cast so both engines print the same schema.
"""

from __future__ import annotations

MONEY = "CAST(SUM(CAST(sales AS DECIMAL(18,4))) AS DECIMAL(28,3))"

# The test mapping (see salesmart.plans.adapter) and the enriched table.
BASE = """
WITH txn AS (
  SELECT CASE WHEN l_suppkey % 20 = 0 THEN '9000' ELSE '' END || CAST(l_suppkey AS VARCHAR) AS store_location_key,
         CASE WHEN l_partkey % 10 = 0 THEN '9000' ELSE '' END || CAST(l_partkey AS VARCHAR) AS product_key,
         CASE WHEN o_custkey % 3 = 0 THEN '-1'
              WHEN o_custkey % 7 = 0 THEN NULL
              ELSE CAST(o_custkey AS VARCHAR) END AS collector_key,
         CAST(l_shipdate AS DATE) AS trans_dt,
         l_extendedprice AS sales,
         CAST(l_quantity AS INTEGER) AS units,
         CAST(l_orderkey AS VARCHAR) AS trans_key,
         CAST(YEAR(l_shipdate) AS INTEGER) AS trans_year,
         CAST(MONTH(l_shipdate) AS INTEGER) AS trans_month,
         l_linenumber
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
prod AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_key,
         CAST(p_size AS VARCHAR) AS sku,
         CAST(p_partkey AS VARCHAR) AS upc,
         p_name AS item_name, p_type AS item_description,
         p_brand AS department, p_name AS category
  FROM part),
loc AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS store_location_key,
         'NA' AS region, r_name AS province, n_name AS city,
         'NA' AS postal_code, s_name AS banner,
         CAST(s_suppkey AS VARCHAR) AS store_num
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey),
enriched AS (
  SELECT t.collector_key, t.trans_dt, t.sales, t.units, t.trans_key,
         t.trans_year, t.trans_month, t.product_key, p.sku, p.upc,
         p.item_name, p.item_description, p.department, p.category,
         t.store_location_key, l.region, l.province, l.city,
         l.postal_code, l.banner, l.store_num,
         p.product_key IS NOT NULL AS has_product,
         l.store_location_key IS NOT NULL AS has_location,
         CASE WHEN t.collector_key IS NULL OR t.collector_key = '-1'
              THEN 'No' ELSE 'Yes' END AS is_member
  FROM txn t LEFT JOIN prod p ON t.product_key = p.product_key
             LEFT JOIN loc l ON t.store_location_key = l.store_location_key)
"""

ENRICHED_COLUMNS = """collector_key, trans_dt, sales, units, trans_key, trans_year,
  trans_month, product_key, sku, upc, item_name, item_description, department,
  category, store_location_key, region, province, city, postal_code, banner,
  store_num"""


def _sales_by(*keys: str) -> str:
    k = ", ".join(keys)
    return f"{BASE} SELECT {k}, {MONEY} AS total_sales FROM enriched GROUP BY {k}"


def _metrics_by(key: str) -> str:
    return f"""{BASE}
SELECT {key}, {MONEY} AS total_sales,
       CAST(SUM(units) AS BIGINT) AS total_units,
       COUNT(DISTINCT trans_key) AS count_distinct_trans_key,
       COUNT(DISTINCT collector_key) AS count_distinct_collector_key
FROM enriched GROUP BY {key}"""


TOP_STORES = f"""{BASE},
s AS (SELECT province, store_num, {MONEY} AS total_sales
      FROM enriched GROUP BY province, store_num),
r AS (SELECT CAST(RANK() OVER (PARTITION BY province ORDER BY total_sales DESC) AS INTEGER)
               AS store_rank_in_provice,
             province, store_num, total_sales,
             CAST(ROUND(SUM(total_sales) OVER (PARTITION BY province)
                        / COUNT(*) OVER (PARTITION BY province), 7) AS DECIMAL(28,3))
               AS avg_store_total_sales_in_province
      FROM s)
SELECT * FROM r WHERE store_rank_in_provice <= 5"""

TOP_CATEGORIES = f"""{BASE},
s AS (SELECT department, category, {MONEY} AS total_sales
      FROM enriched GROUP BY department, category),
r AS (SELECT CAST(RANK() OVER (PARTITION BY department ORDER BY total_sales DESC) AS INTEGER)
               AS category_rank_in_department,
             department, category, total_sales
      FROM s)
SELECT * FROM r WHERE category_rank_in_department <= 10"""

SALES_BY_STORE_TOP20 = f"""{BASE}
SELECT store_num, {MONEY} AS total_sales FROM enriched GROUP BY store_num
ORDER BY total_sales DESC NULLS LAST, store_num ASC NULLS FIRST LIMIT 20"""


def _bundle_part(name: str, keys: tuple[str, ...]) -> str:
    cols = []
    for k in ("province", "store_num", "department", "category", "is_member"):
        cols.append(k if k in keys else f"CAST(NULL AS VARCHAR) AS {k}")
    group = ", ".join(keys)
    return (f"SELECT '{name}' AS report, {', '.join(cols)}, {MONEY} AS total_sales "
            f"FROM enriched GROUP BY {group}")


REPORT_BUNDLE = BASE + "\nUNION ALL\n".join(_bundle_part(n, k) for n, k in [
    ("sales_by_province", ("province",)),
    ("sales_by_store", ("store_num",)),
    ("sales_by_category", ("category",)),
    ("top_categories_by_department", ("department", "category")),
    ("top_stores_by_province", ("province", "store_num")),
    ("sales_by_loyalty_province", ("province", "is_member")),
    ("sales_by_loyalty", ("is_member",)),
])

ENRICH_TRANSACTIONS = f"{BASE} SELECT {ENRICHED_COLUMNS} FROM enriched"

ENRICH_COUNTS = f"""{BASE}
SELECT 'transactions' AS measure, COUNT(*) AS row_count FROM txn
UNION ALL SELECT 'products', COUNT(*) FROM prod
UNION ALL SELECT 'locations', COUNT(*) FROM loc
UNION ALL SELECT 'enriched', COUNT(*) FROM enriched
UNION ALL SELECT 'enriched_with_product', COUNT(*) FILTER (WHERE has_product) FROM enriched
UNION ALL SELECT 'enriched_with_location', COUNT(*) FILTER (WHERE has_location) FROM enriched"""

ORACLE_SQL: dict[str, str] = {
    "sales_by_province": _sales_by("province"),
    "sales_by_store": _sales_by("store_num"),
    "sales_by_store_top20": SALES_BY_STORE_TOP20,
    "sales_by_category": _sales_by("category"),
    "top_stores_by_province": TOP_STORES,
    "top_categories_by_department": TOP_CATEGORIES,
    "sales_by_loyalty_province": _sales_by("province", "is_member"),
    "sales_by_loyalty": _sales_by("is_member"),
    "metrics_by_year": _metrics_by("trans_year"),
    "metrics_by_loyalty": _metrics_by("is_member"),
    "report_bundle": REPORT_BUNDLE,
    "enrich_transactions": ENRICH_TRANSACTIONS,
    "enrich_transactions_salted": ENRICH_TRANSACTIONS,
    "enrich_counts": ENRICH_COUNTS,
}


# ------------------------------------------------------------ landing text

# Landing lines as text, restating the four layouts of the fixture writer.
LANDING = """
WITH src AS (
  SELECT l_linenumber % 4 AS rem,
         CAST(l_orderkey AS VARCHAR) AS k,
         CASE WHEN l_partkey % 10 = 0 THEN '9000' ELSE '' END || CAST(l_partkey AS VARCHAR) AS p,
         CASE WHEN l_suppkey % 20 = 0 THEN '9000' ELSE '' END || CAST(l_suppkey AS VARCHAR) AS s,
         CASE WHEN o_custkey % 3 = 0 THEN '-1'
              WHEN o_custkey % 7 = 0 THEN NULL
              ELSE CAST(o_custkey AS VARCHAR) END AS collector_key,
         l_shipdate, l_extendedprice, l_quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
raw AS (
  SELECT CASE rem WHEN 0 THEN 'trans_fact_5' WHEN 1 THEN 'trans_fact_4'
                  WHEN 2 THEN 'trans_fact_6' ELSE 'trans_fact_8' END AS landing_name,
         rem, k, p, s, collector_key,
         CASE WHEN rem = 0 THEN strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')
              ELSE strftime(l_shipdate, '%-m/%-d/%Y') END AS trans_dt_text,
         CASE WHEN rem = 3 THEN lpad(s, 12, '0') ELSE s END AS store_location_key_text,
         CASE WHEN rem = 1 THEN lpad(p, 12, '0') ELSE p END AS product_key_text,
         CASE WHEN rem = 3 THEN NULL ELSE CAST(l_extendedprice AS VARCHAR) END AS sales_text,
         CASE WHEN rem = 2 THEN NULL
              WHEN rem = 1 THEN CAST(CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) AS VARCHAR)
              ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS units_text,
         CASE WHEN rem = 0 THEN k
              ELSE substr(k, 1, 1) || '.' || substr(k, 2) || '0E+' || CAST(length(k) - 1 AS VARCHAR)
              END AS trans_key_text,
         CAST(l_shipdate AS DATE) AS trans_dt,
         CASE WHEN rem = 3 THEN 0.0 ELSE l_extendedprice END AS sales,
         CASE WHEN rem = 2 THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS units,
         CAST(YEAR(l_shipdate) AS INTEGER) AS trans_year,
         CAST(MONTH(l_shipdate) AS INTEGER) AS trans_month
  FROM src)
"""

CLEAN_COLUMNS = """s AS store_location_key, p AS product_key, collector_key, trans_dt,
  sales, units, k AS trans_key, trans_year, trans_month"""

CLEAN_TRANSACTIONS = f"{LANDING} SELECT {CLEAN_COLUMNS} FROM raw"

UNION_LAYOUTS = f"""{LANDING}
SELECT landing_name, COUNT(*) AS row_count,
       COUNT(collector_key) AS collector_key_values, COUNT(trans_dt_text) AS trans_dt_values,
       COUNT(store_location_key_text) AS store_location_key_values,
       COUNT(product_key_text) AS product_key_values, COUNT(sales_text) AS sales_values,
       COUNT(units_text) AS units_values, COUNT(trans_key_text) AS trans_key_values
FROM raw GROUP BY landing_name"""

NORMALIZE_TRANS_DT = f"""{LANDING}
SELECT DISTINCT landing_name, trans_dt_text, trans_dt FROM raw"""

NORMALIZE_TRANS_KEY = f"""{LANDING}
SELECT landing_name, trans_key_text, k AS trans_key FROM raw"""

CANONICAL_KEYS = f"""{LANDING}
SELECT landing_name, product_key_text, p AS product_key,
       store_location_key_text, s AS store_location_key FROM raw"""

FILL_MISSING_MEASURES = f"""{LANDING}
SELECT landing_name, COUNT(*) AS row_count,
       COUNT(*) FILTER (WHERE rem = 3) AS sales_filled,
       COUNT(*) FILTER (WHERE rem = 2) AS units_filled,
       {MONEY} AS total_sales, CAST(SUM(units) AS BIGINT) AS total_units,
       COUNT(*) FILTER (WHERE regexp_matches(k, '0{{12}}$')) AS lossy_trans_keys
FROM raw GROUP BY landing_name"""

MEMBERSHIP_FLAG = f"""{LANDING}
SELECT CASE WHEN collector_key IS NULL OR collector_key = '-1' THEN 'No' ELSE 'Yes' END
         AS is_member,
       COUNT(*) AS row_count, COUNT(collector_key) AS rows_with_collector,
       COUNT(DISTINCT collector_key) AS distinct_collectors
FROM raw GROUP BY 1"""

ARCHIVE_ROUNDTRIP = f"""{LANDING}
SELECT collector_key, trans_dt_text AS trans_dt, store_location_key_text AS store_location_key,
       product_key_text AS product_key, sales_text AS sales, units_text AS units,
       trans_key_text AS trans_key, landing_name
FROM raw"""

LANDING_NEW_FILES = f"{LANDING} SELECT {CLEAN_COLUMNS} FROM raw WHERE rem = 3"

NULL_PROFILE_BY_FILE = LANDING + "\nUNION ALL\n".join(
    f"SELECT landing_name, '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count "
    f"FROM (SELECT landing_name, {CLEAN_COLUMNS} FROM raw) GROUP BY landing_name"
    for c in ("store_location_key", "product_key", "collector_key", "trans_dt", "sales",
              "units", "trans_key", "trans_year", "trans_month"))

# ----------------------------------------------------------- quality, io

_ENRICHED_NAMES = [c.strip() for c in ENRICHED_COLUMNS.replace("\n", " ").split(",")]

NULL_PROFILE = BASE + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count FROM enriched"
    for c in _ENRICHED_NAMES)


def _dups(table: str, source: str, key: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{key}' AS key_column, {key} AS key_value, "
            f"COUNT({key}) AS row_count FROM {source} GROUP BY {key} HAVING COUNT({key}) > 1")


DUPLICATE_KEYS = BASE + "\nUNION ALL\n".join([
    _dups("product", "prod", "product_key"), _dups("product", "prod", "upc"),
    _dups("product", "prod", "category"), _dups("location", "loc", "store_num"),
    _dups("location", "loc", "store_location_key"), _dups("transactions", "txn", "trans_key")])

TXN_COLUMNS = """store_location_key, product_key, collector_key, trans_dt, sales, units,
  trans_key, trans_year, trans_month"""

ORACLE_SQL.update({
    "clean_transactions": CLEAN_TRANSACTIONS,
    "union_layouts": UNION_LAYOUTS,
    "normalize_trans_dt": NORMALIZE_TRANS_DT,
    "normalize_trans_key": NORMALIZE_TRANS_KEY,
    "canonical_keys": CANONICAL_KEYS,
    "fill_missing_measures": FILL_MISSING_MEASURES,
    "membership_flag": MEMBERSHIP_FLAG,
    "stage_locations": f"{BASE} SELECT * FROM loc",
    "stage_products": f"{BASE} SELECT * FROM prod",
    "csv_roundtrip": _sales_by("category"),
    "partitioned_roundtrip": ENRICH_TRANSACTIONS,
    "append_load": f"{BASE} SELECT {TXN_COLUMNS} FROM txn",
    "archive_roundtrip": ARCHIVE_ROUNDTRIP,
    "landing_new_files": LANDING_NEW_FILES,
    "intake_stream": CLEAN_TRANSACTIONS,
    "null_profile": NULL_PROFILE,
    "null_profile_by_file": NULL_PROFILE_BY_FILE,
    "duplicate_keys": DUPLICATE_KEYS,
    "date_range": f"""{BASE} SELECT MIN(trans_dt) AS min_date, MAX(trans_dt) AS max_date,
        COUNT(*) AS row_count, COUNT(*) FILTER (WHERE trans_dt IS NULL) AS rows_without_date
        FROM txn""",
    "daily_counts": f"{BASE} SELECT trans_dt, COUNT(*) AS row_count FROM txn GROUP BY trans_dt",
    "group_counts": f"""{BASE} SELECT province, COUNT(*) AS row_count,
        COUNT(province) AS value_count FROM enriched GROUP BY province""",
    "key_lookup": f"{BASE} SELECT {ENRICHED_COLUMNS} FROM enriched WHERE product_key = '7'",
})


# ------------------------------------------------------------ jobs end to end

# Staged landing lines joined with the staged dimensions (whose landing keys
# are zero-padded and come back canonical, i.e. equal to the clean keys).
PIPE = LANDING + """,
ptxn AS (SELECT """ + CLEAN_COLUMNS + """ FROM raw),
prod AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_key, p_brand AS department, p_name AS category
  FROM part),
loc AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS store_location_key, r_name AS province,
         CAST(s_suppkey AS VARCHAR) AS store_num
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey),
enriched AS (
  SELECT t.*, p.department, p.category, l.province, l.store_num,
         CASE WHEN t.collector_key IS NULL OR t.collector_key = '-1'
              THEN 'No' ELSE 'Yes' END AS is_member
  FROM ptxn t LEFT JOIN prod p ON t.product_key = p.product_key
              LEFT JOIN loc l ON t.store_location_key = l.store_location_key),
store_totals AS (
  SELECT province, store_num, """ + MONEY + """ AS total_sales
  FROM enriched GROUP BY province, store_num),
category_totals AS (
  SELECT department, category, """ + MONEY + """ AS total_sales
  FROM enriched GROUP BY department, category)
"""

_LINE_TYPES = [
    ("province", "VARCHAR"), ("store_num", "VARCHAR"), ("department", "VARCHAR"),
    ("category", "VARCHAR"), ("is_member", "VARCHAR"), ("trans_year", "INTEGER"),
    ("report_rank", "INTEGER"), ("total_sales", "DECIMAL(28,3)"),
    ("avg_store_total_sales_in_province", "DECIMAL(28,3)"), ("total_units", "BIGINT"),
    ("count_distinct_trans_key", "BIGINT"), ("count_distinct_collector_key", "BIGINT")]


def _line(report: str, given: dict[str, str], rest: str) -> str:
    cols = [f"CAST({given.get(c, 'NULL')} AS {t}) AS {c}" for c, t in _LINE_TYPES]
    return f"SELECT '{report}' AS report, {', '.join(cols)} {rest}"


def _line_sales(report: str, *keys: str) -> str:
    given = {k: k for k in keys}
    given["total_sales"] = MONEY
    return _line(report, given, f"FROM enriched GROUP BY {', '.join(keys)}")


def _line_metrics(report: str, key: str) -> str:
    given = {key: key, "total_sales": MONEY, "total_units": "SUM(units)",
             "count_distinct_trans_key": "COUNT(DISTINCT trans_key)",
             "count_distinct_collector_key": "COUNT(DISTINCT collector_key)"}
    return _line(report, given, f"FROM enriched GROUP BY {key}")


REPORT_RUN = PIPE + "\nUNION ALL\n".join([
    _line_sales("sales_by_province", "province"),
    _line_sales("sales_by_store", "store_num"),
    _line_sales("sales_by_category", "category"),
    _line("top_stores_by_province",
          {"province": "province", "store_num": "store_num", "total_sales": "total_sales",
           "report_rank": "r", "avg_store_total_sales_in_province": "a"},
          """FROM (SELECT *, RANK() OVER (PARTITION BY province ORDER BY total_sales DESC) AS r,
                     ROUND(SUM(total_sales) OVER (PARTITION BY province)
                           / COUNT(*) OVER (PARTITION BY province), 7) AS a
              FROM store_totals) WHERE r <= 5"""),
    _line("top_categories_by_department",
          {"department": "department", "category": "category", "total_sales": "total_sales",
           "report_rank": "r"},
          """FROM (SELECT *, RANK() OVER (PARTITION BY department ORDER BY total_sales DESC) AS r
              FROM category_totals) WHERE r <= 10"""),
    _line_sales("sales_by_loyalty_province", "province", "is_member"),
    _line_sales("sales_by_loyalty", "is_member"),
    _line_metrics("metrics_by_year", "trans_year"),
    _line_metrics("metrics_by_loyalty", "is_member"),
])

ORACLE_SQL.update({
    "stage_transactions": CLEAN_TRANSACTIONS,
    "report_run": REPORT_RUN,
})


# ------------------------------------------------- loads beyond the plain case

def _ordered(order: str, *keys: str) -> str:
    k = ", ".join(keys)
    return f"""{BASE}, totals AS (SELECT {k}, {MONEY} AS total_sales FROM enriched GROUP BY {k})
SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY {order}) AS INTEGER) AS position FROM totals"""


_ENRICHED_TYPES = {"trans_dt": "date", "sales": "double", "units": "int", "trans_year": "int", "trans_month": "int"}

ORACLE_SQL.update({
    "stage_locations_partial_redrop": f"{BASE} SELECT * FROM loc",
    "header_variants": CLEAN_TRANSACTIONS,
    "recovered_load": CLEAN_TRANSACTIONS,
    "enrich_after_dimension_change": f"""{LANDING}
SELECT r_name AS province, COUNT(*) AS row_count, COUNT(*) AS by_months
FROM raw LEFT JOIN (SELECT CAST(s_suppkey AS VARCHAR) AS store, r_name
                    FROM supplier JOIN nation ON s_nationkey = n_nationkey
                                  JOIN region ON n_regionkey = r_regionkey) ON s = store
WHERE rem = 0 GROUP BY r_name""",
    "sales_by_store_ordered": _ordered("total_sales DESC NULLS LAST, store_num NULLS FIRST", "store_num"),
    "sales_by_category_ordered": _ordered("total_sales DESC NULLS LAST, category NULLS FIRST", "category"),
    "sales_by_loyalty_province_ordered": _ordered("province NULLS FIRST, is_member NULLS FIRST", "province", "is_member"),
    "sales_by_loyalty_ordered": _ordered("is_member NULLS FIRST", "is_member"),
    "empty_landing": f"{LANDING} SELECT {CLEAN_COLUMNS} FROM raw WHERE rem IN (0, 1)",
    "schema_contract": BASE + "\nUNION ALL\n".join(
        f"SELECT CAST({i} AS INTEGER) AS place, '{c}' AS column_name, '{_ENRICHED_TYPES.get(c, 'string')}' AS column_type, "
        f"COUNT({c}) AS value_count FROM enriched"
        for i, c in enumerate(_ENRICHED_NAMES)),
})


# ------------------------------------- versions, gates, rejects, partial results

# Landing lines of which every eleventh order has a month and a day past their
# ends, and the date a lenient calendar makes of them.
SPOILED = LANDING + """,
spoiled AS (
  SELECT *, CAST(k AS BIGINT) % 11 = 0 AS bad,
         CASE WHEN CAST(k AS BIGINT) % 11 <> 0 THEN trans_dt_text
              WHEN rem = 0 THEN YEAR(trans_dt) || '-' || (MONTH(trans_dt) + 12) || '-' || (DAY(trans_dt) + 31) || ' 00:00:00'
              ELSE (MONTH(trans_dt) + 12) || '/' || (DAY(trans_dt) + 31) || '/' || YEAR(trans_dt) END AS bad_text,
         CASE WHEN CAST(k AS BIGINT) % 11 <> 0 THEN trans_dt
              ELSE CAST(make_date(YEAR(trans_dt), 1, 1) + to_months(CAST(MONTH(trans_dt) + 11 AS INTEGER))
                        + to_days(CAST(DAY(trans_dt) + 30 AS INTEGER)) AS DATE) END AS rolled
  FROM raw)
"""

REJECTED_ROWS = f"""{SPOILED}
SELECT collector_key, bad_text AS trans_dt, store_location_key_text AS store_location_key, product_key_text AS product_key,
       sales_text AS sales, units_text AS units, trans_key_text AS trans_key,
       'unparseable trans_dt' AS reject_reason, landing_name
FROM spoiled WHERE bad"""

LENIENT_DATES = f"""{SPOILED}
SELECT s AS store_location_key, p AS product_key, collector_key, rolled AS trans_dt, sales, units, k AS trans_key,
       CAST(YEAR(rolled) AS INTEGER) AS trans_year, CAST(MONTH(rolled) AS INTEGER) AS trans_month
FROM spoiled WHERE NOT bad OR rem <> 0"""

PRODUCT_VERSIONS = f"""{BASE}
SELECT product_key, sku, upc, CASE WHEN moved THEN upper(item_name) ELSE item_name END AS item_name, item_description,
       CASE WHEN moved THEN 'NEW ' || department ELSE department END AS department, category
FROM (SELECT *, CAST(product_key AS INTEGER) % 3 = 0 AS moved FROM prod)
WHERE moved OR CAST(product_key AS INTEGER) % 5 <> 4"""

GATED_LOADS = f"""{LANDING}
SELECT landing_name, CASE WHEN rem IN (2, 3) THEN 'quarantined' ELSE 'published' END AS state,
       CASE rem WHEN 2 THEN 'rows without units: ' || COUNT(*) || ' of ' || COUNT(*)
                WHEN 3 THEN 'rows without sales: ' || COUNT(*) || ' of ' || COUNT(*) END AS reason,
       COUNT(*) AS staged_rows, CASE WHEN rem IN (2, 3) THEN 0 ELSE COUNT(*) END AS seen_rows
FROM raw GROUP BY landing_name, rem"""

DISTINCT_SKETCHES = BASE + "\nUNION ALL\n".join(
    f"SELECT '{key}' AS grouping, CAST({key} AS VARCHAR) AS value, COUNT(DISTINCT trans_key) AS count_distinct_trans_key, "
    f"COUNT(DISTINCT collector_key) AS count_distinct_collector_key, TRUE AS trans_within, TRUE AS collectors_within "
    f"FROM enriched GROUP BY {key}" for key in ("trans_year", "is_member"))

ORACLE_SQL.update({
    "product_versions": PRODUCT_VERSIONS,
    "gated_loads": GATED_LOADS,
    "rejected_rows": REJECTED_ROWS,
    "lenient_dates": LENIENT_DATES,
    "distinct_sketches": DISTINCT_SKETCHES,
    "staged_lookup": f"{LANDING} SELECT {CLEAN_COLUMNS} FROM raw WHERE p = '7' UNION ALL SELECT {CLEAN_COLUMNS} FROM raw WHERE k = '7'",
    "report_run_incremental": REPORT_RUN,
})
