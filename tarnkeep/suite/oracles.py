"""For each registered query the same result in plain SQL over the same tables."""

from __future__ import annotations

ORDERS_LIKE = """
orders_like AS (
  SELECT l_orderkey AS order_id,
         CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE o_custkey END AS customer_id,
         c_name AS customer_name,
         concat(lower(replace(c_name, '#', '.')), '@example.com') AS email,
         r_name AS region,
         CAST(o_orderdate AS DATE) AS order_date,
         p_type AS product_category,
         p_name AS product_name,
         CAST(l_quantity AS INT) * CASE WHEN l_orderkey % 89 = 0 THEN 0 ELSE 1 END AS quantity,
         CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
         CAST(round(l_discount * 100) AS INT) AS discount_pct,
         CAST(CAST(l_quantity AS INT) * CAST(p_retailprice AS DECIMAL(10,2))
              + CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END AS DECIMAL(10,2)) AS total_amount,
         o_orderpriority AS sales_channel,
         l_returnflag AS payment_method,
         o_orderstatus AS order_status,
         CAST(l_shipdate AS DATE) AS ship_date,
         lpad(CAST(o_custkey % 100000 AS VARCHAR), 5, '0') AS shipping_zip
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
)"""

# the same rows as they come back from text files
ORDERS_TEXT = ORDERS_LIKE + """, orders_text AS (
  SELECT * REPLACE (CAST(order_id AS VARCHAR) AS order_id,
                    CAST(customer_id AS VARCHAR) AS customer_id)
  FROM orders_like
)"""


def _dcount(column: str, condition: str = "TRUE") -> str:
    return (
        f"(count(DISTINCT {column}) FILTER (WHERE {condition})"
        f" + CAST(count(*) FILTER (WHERE {condition} AND {column} IS NULL) > 0 AS BIGINT))"
    )


def _ratio(numerator: str, denominator: str) -> str:
    return f"CAST({numerator} AS DOUBLE) / nullif(CAST({denominator} AS DOUBLE), 0)"


_ORDERS, _CUSTOMERS = _dcount("order_id"), _dcount("customer_id")
_SHIPPED = _dcount("order_id", "lower(order_status) = 'f'")
_CANCELLED = _dcount("order_id", "lower(order_status) = 'p'")
_SALES = "CAST(sum(total_amount) AS DECIMAL(38,2)) AS total_sales"
_CORE = f"""
  {_SALES},
  CAST(sum(quantity) AS BIGINT) AS total_quantity,
  {_ORDERS} AS total_orders,
  {_CUSTOMERS} AS total_customers,
  {_ratio("sum(total_amount)", _ORDERS)} AS average_order_value,
  {_ratio("sum(quantity)", _ORDERS)} AS average_quantity_per_order,
  {_ratio("sum(unit_price)", "count(unit_price)")} AS average_unit_price,
  CAST(sum(CAST(quantity * unit_price * discount_pct * CAST(0.01 AS DECIMAL(3,2))
       AS DECIMAL(38,4))) AS DECIMAL(38,4)) AS total_discount_amount,
  {_ratio("sum(discount_pct)", "count(discount_pct)")} AS average_discount_pct,
  {_ratio(_ORDERS, _CUSTOMERS)} AS orders_per_customer"""
_STATUS = f"""
  {_SHIPPED} AS shipped_orders,
  {_CANCELLED} AS cancelled_orders,
  {_ratio(_SHIPPED, _ORDERS)} AS fulfillment_rate,
  {_ratio(_CANCELLED, _ORDERS)} AS cancel_rate"""


def _repeaters(dims: str = "") -> str:
    extra = f"{dims}, " if dims else ""
    group = f"GROUP BY {dims}" if dims else ""
    return f"""
repeaters AS (
  SELECT {extra}count(*) FILTER (WHERE orders > 1) AS repeat_customers
  FROM (SELECT {extra}customer_id, {_ORDERS} AS orders FROM orders_like
        GROUP BY {extra}customer_id) {group}
)"""


# a day may have no sale; every day from the first to the last is there
_CALENDAR = """
totals AS (
  SELECT {dims}order_date AS date, sum(total_amount) AS sales FROM orders_like
  GROUP BY {dims}order_date
), days AS (
  SELECT {dims}CAST(d AS DATE) AS date
  FROM {groups}(SELECT unnest(generate_series(
    (SELECT min(order_date) FROM orders_like), (SELECT max(order_date) FROM orders_like),
    INTERVAL 1 DAY)) AS d)
), sales_days AS (
  SELECT {d_dims}d.date, CAST(t.sales AS DECIMAL(38,2)) AS sales,
    CAST((SELECT sum(x.sales) FROM totals x WHERE {same}x.date <= d.date
          AND x.date >= date_trunc('year', d.date)) AS DECIMAL(38,2)) AS sales_ytd,
    CAST((SELECT sum(x.sales) FROM totals x WHERE {same}x.date <= d.date
          AND x.date >= date_trunc('month', d.date)) AS DECIMAL(38,2)) AS sales_mtd,
    CAST((SELECT sum(x.sales) FROM totals x WHERE {same}x.date <= d.date
          AND x.date > d.date - INTERVAL 12 MONTH) AS DECIMAL(38,2)) AS sales_last_12m,
    CAST((SELECT sum(x.sales) FROM totals x WHERE {same}x.date = d.date - INTERVAL 12 MONTH)
         AS DECIMAL(38,2)) AS sales_same_period_ly
  FROM days d LEFT JOIN totals t ON {t_same}t.date = d.date
)"""


def _calendar(columns: str, dim: str = "") -> str:
    text = _CALENDAR.format(
        dims=f"{dim}, " if dim else "",
        groups=f"(SELECT DISTINCT {dim} FROM totals), " if dim else "",
        d_dims=f"d.{dim}, " if dim else "",
        same=f"x.{dim} = d.{dim} AND " if dim else "",
        t_same=f"t.{dim} = d.{dim} AND " if dim else "",
    )
    return f"WITH {ORDERS_LIKE}, {text} SELECT {columns} FROM sales_days"


_RULES = {
    "order_id_missing": "order_id IS NULL",
    "customer_id_missing": "customer_id IS NULL",
    "order_date_missing": "order_date IS NULL",
    "product_name_missing": "product_name IS NULL",
    "quantity_missing": "quantity IS NULL",
    "unit_price_missing": "unit_price IS NULL",
    "total_amount_missing": "total_amount IS NULL",
    "quantity_not_positive": "quantity <= 0",
    "unit_price_negative": "unit_price < 0",
    "total_negative": "total_amount < 0",
    "total_inconsistent": "total_amount <> quantity * unit_price",
}
_BAD = " OR ".join(f"coalesce({test}, FALSE)" for test in _RULES.values())
_VIOLATIONS = "concat_ws(',', " + ", ".join(
    f"CASE WHEN {test} THEN '{name}' END" for name, test in _RULES.items()
) + ")"

_DEDUP_KEYS = "order_id, customer_id, order_date, product_name"
_DEDUP_ORDER = (
    "customer_name, email, region, product_category, quantity, unit_price, discount_pct, "
    "total_amount, sales_channel, payment_method, order_status, ship_date, shipping_zip"
)


def _first_per_key(source: str) -> str:
    return (
        f"SELECT * FROM {source} QUALIFY row_number() OVER "
        f"(PARTITION BY {_DEDUP_KEYS} ORDER BY {_DEDUP_ORDER}) = 1"
    )


_RAW = """
raw_lines AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_orderkey % 11 = 0 THEN 'n/a'
         WHEN l_orderkey % 13 = 0 THEN CAST(CAST(l_quantity AS INT) AS VARCHAR) || '.7'
         ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS quantity,
    CASE WHEN l_orderkey % 7 = 0 THEN 'x' || l_returnflag
         ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) END AS price,
    CASE WHEN l_orderkey % 5 = 0 THEN '2024-13-01'
         WHEN l_orderkey % 3 = 0 THEN '2024-1-2'
         ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS shipped
  FROM lineitem
)"""

_SALES_COLUMNS = (
    "transaction_id, line_number, transaction_date, store_id, sku, customer_id, promotion_id, "
    "quantity_sold"
)
_SNAPSHOTS = f"""
lines AS (
  SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
    l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1
), snapshot_1 AS MATERIALIZED (
  SELECT l_orderkey AS transaction_id, l_linenumber AS line_number,
         CAST(l_shipdate AS DATE) AS transaction_date, l_suppkey AS store_id, l_partkey AS sku,
         o_custkey AS customer_id, CAST(round(l_discount * 100) AS BIGINT) AS promotion_id,
         CAST(l_quantity AS INT) AS quantity_sold
  FROM lines
), later AS (
  SELECT * REPLACE (CAST(quantity_sold
                    + CASE WHEN transaction_id % 10 = 0 THEN 1 ELSE 0 END AS INT) AS quantity_sold)
  FROM snapshot_1 WHERE transaction_id % 25 <> 1
), snapshot_2 AS (
  SELECT * FROM later
  UNION ALL
  SELECT * REPLACE (transaction_id + 1000000000 AS transaction_id) FROM later
  WHERE transaction_id % 50 = 0
)"""
_PROMOTION_COLUMNS = (
    "promotion_id, promotion_name, promotion_type, discount_pct, start_date, end_date"
)
_PROMOTIONS = """
snapshot_1 AS (
  SELECT p_partkey AS promotion_id, p_name AS promotion_name, p_type AS promotion_type,
         CAST(p_size AS DOUBLE) AS discount_pct, DATE '2024-01-01' + p_size AS start_date,
         DATE '2024-01-01' + p_size + 30 AS end_date
  FROM part
), snapshot_2 AS (
  SELECT * REPLACE (discount_pct + CASE WHEN promotion_id % 10 = 0 THEN 5 ELSE 0 END
                    AS discount_pct) FROM snapshot_1
)"""


def _history(snapshots: str, columns: str, keys: list[str], close_missing: bool = False) -> str:
    def staged(number: int, as_of: str) -> str:
        return (
            f"staged_{number} AS MATERIALIZED (SELECT {columns}, DATE '{as_of}' AS effective_start_date, "
            f"CAST(NULL AS DATE) AS effective_end_date, TRUE AS current_flag, "
            f"md5(concat_ws('||', {columns})) AS record_hash FROM snapshot_{number})"
        )

    # a version ends where its key has another hash, or is missing
    other = ", ".join([*keys, "record_hash AS other_hash"])
    ended = f"other_hash <> record_hash{' OR other_hash IS NULL' if close_missing else ''}"
    return f"""WITH {snapshots}, {staged(1, "2024-01-01")}, {staged(2, "2024-02-01")},
changes AS (
  SELECT a.* EXCLUDE (other_hash) FROM
    (SELECT * FROM staged_2 LEFT JOIN (SELECT {other} FROM staged_1) USING ({", ".join(keys)})) a
  WHERE other_hash IS NULL OR other_hash <> record_hash
), history AS (
  SELECT a.* EXCLUDE (other_hash, ended) REPLACE (
    CASE WHEN ended THEN DATE '2024-02-01' END AS effective_end_date,
    NOT ended AS current_flag)
  FROM (SELECT *, coalesce({ended}, FALSE) AS ended
        FROM staged_1 LEFT JOIN (SELECT {other} FROM staged_2) USING ({", ".join(keys)})) a
  UNION ALL BY NAME
  SELECT * FROM changes
)"""


_SALES_HISTORY = _history(_SNAPSHOTS, _SALES_COLUMNS, ["transaction_id", "line_number"])
_PROMOTION_HISTORY = _history(_PROMOTIONS, _PROMOTION_COLUMNS, ["promotion_id"])

_CONTROL = "control AS (" + " UNION ALL ".join(
    f"SELECT '{name}' AS \"Table_name\", CAST(count(*) AS DECIMAL(18,4)) AS \"Table_count\", "
    f"TIMESTAMP '2024-03-01 06:00:00' + INTERVAL {hour} HOUR AS count_timestamp FROM {name}"
    for hour, name in enumerate(
        ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    )
) + ")"

_EVENTS = (
    "SELECT event_id, user_id, event_type, value, "
    "CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"
)

_DATES = (
    r"\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?"
)


def _profile(
    integer: str, number: str, words: str,
    sources=("orders", "lineitem", "documents", "events", "labels"),
) -> str:
    tables = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, \"column\", value FROM (UNPIVOT (SELECT "
        f"CAST(COLUMNS(*) AS VARCHAR) FROM {t}) ON COLUMNS(*) INTO NAME \"column\" VALUE value)"
        for t in sources
    )
    return f"""
tests AS (
  SELECT table_name, "column", count(*) AS filled, max(length(value)) AS longest,
    count(*) FILTER (WHERE regexp_full_match(value, '[+-]?\\d+')
                     AND try_cast(value AS {integer}) IS NOT NULL) AS whole,
    count(*) FILTER (WHERE regexp_full_match(value, '{number}')) AS numeric,
    count(*) FILTER (WHERE regexp_full_match(value, '{_DATES}')
                     AND try_cast(value AS TIMESTAMP) IS NOT NULL) AS dates,
    count(*) FILTER (WHERE lower(value) IN ({words})) AS booleans
  FROM ({tables}) WHERE value <> '' GROUP BY ALL
), profiles AS (
  SELECT table_name, "column",
    CASE WHEN whole = filled THEN 'BIGINT' WHEN numeric = filled THEN 'FLOAT'
         WHEN dates = filled THEN 'DATETIME2' WHEN booleans = filled THEN 'BIT'
         WHEN longest <= 4000 THEN 'NVARCHAR(' || longest || ')'
         ELSE 'NVARCHAR(MAX)' END AS sql_type,
    filled
  FROM tests
)"""


_LADDER_A = (
    "BIGINT", r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", "'true', 'false', '0', '1'"
)
_PROFILE_A = _profile(*_LADDER_A)
_PROFILE_B = _profile(
    "INT", r"[+-]?(\d[\d,]*\.?\d*|\.\d+)([eE][+-]?\d+)?",
    "'true', 'false', '0', '1', 'yes', 'no'",
)

_REPORT = (
    '"table", "check", "type", "column", expected, actual, passed, error, total_rows'
)


def _line_report() -> str:
    def row(check, kind, column, measure, comparison, expected):
        column = f"'{column}'" if column else "NULL"
        return (
            f"SELECT 'order_lines' AS \"table\", '{check}' AS \"check\", '{kind}' AS \"type\", "
            f"CAST({column} AS VARCHAR) AS \"column\", CAST({expected} AS DOUBLE) AS expected, "
            f"CAST({measure} AS DOUBLE) AS actual, {measure} {comparison} {expected} AS passed, "
            f"CAST(NULL AS VARCHAR) AS error, count(*) AS total_rows FROM orders_like"
        )

    def failed(check, kind, column, error):
        column = f"'{column}'" if column else "NULL"
        return (
            f"SELECT 'order_lines', '{check}', '{kind}', {column}, NULL, NULL, FALSE, '{error}', "
            f"count(*) FROM orders_like"
        )

    pairs = "count(DISTINCT (order_id, discount_pct))"

    def violations(test):
        return f"count(*) FILTER (WHERE {test})"

    rows = [
        row("not_empty", "row_count_gt", None, "count(*)", ">", 0),
        row("customer_nulls", "null_pct_lt", "customer_id",
            "CAST(count(*) FILTER (WHERE customer_id IS NULL) AS DOUBLE) / count(*) * 100.0",
            "<", 1.0),
        row("some_orders", "unique_keys", None, "count(DISTINCT order_id)", ">=", 1),
        row("some_pairs", "unique_keys", None, pairs, ">=", 1),
        row("pairs_once", "no_duplicate_keys", None, f"(count(*) - {pairs})", "=", 0),
        row("quantity_positive", "value_range", "quantity", violations("quantity < 1"), "=", 0),
        row("discount", "value_range", "discount_pct",
            violations("discount_pct < 0 OR discount_pct > 20"), "=", 0),
        row("channel", "regex", "sales_channel",
            violations("NOT regexp_matches(sales_channel, '^[1-5]-')"), "=", 0),
        row("status", "regex", "order_status",
            violations("NOT regexp_matches(order_status, '^[FO]$')"), "=", 0),
        failed("no_threshold", "null_pct_lt", "order_id", "check has no threshold"),
        failed("no_such_column", "value_range", "amount", "unknown column: amount"),
        failed("no_such_check", "freshness", None, "unknown check type"),
    ]
    return f"WITH {ORDERS_LIKE} SELECT {_REPORT} FROM (" + " UNION ALL ".join(rows) + ")"


def _config_report() -> str:
    return f"""SELECT {_REPORT} FROM (
  SELECT 'dq_customer' AS "table", 'many' AS "check", 'row_count_gt' AS "type",
    CAST(NULL AS VARCHAR) AS "column", CAST(1000000 AS DOUBLE) AS expected,
    CAST(count(*) AS DOUBLE) AS actual, count(*) > 1000000 AS passed,
    CAST(NULL AS VARCHAR) AS error, count(*) AS total_rows FROM customer
  UNION ALL
  SELECT 'dq_customer', 'no_debt', 'value_range', 'c_acctbal', 0,
    count(*) FILTER (WHERE c_acctbal < 0), count(*) FILTER (WHERE c_acctbal < 0) = 0, NULL,
    count(*) FROM customer
  UNION ALL
  SELECT 'dq_supplier', 'no_duplicate_keys', 'no_duplicate_keys', NULL, 0,
    count(*) - count(DISTINCT s_suppkey), count(*) = count(DISTINCT s_suppkey), NULL,
    count(*) FROM supplier)"""


# characters that count as white space, for the text clean-up
_SPACES = (
    r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}"
    r"\x{3000}"
)


def _trimmed(text: str) -> str:
    return f"regexp_replace(regexp_replace({text}, '^[{_SPACES}]+', ''), '[{_SPACES}]+$', '')"


_TEXT_CLEAN = f"""SELECT doc_id,
  CASE WHEN text IS NULL OR upper({_trimmed("text")}) = 'NULL' THEN ''
       ELSE {_trimmed(f"regexp_replace(text, '[^a-zA-Z0-9,.{_SPACES}-]', '', 'g')")}
  END AS cleaned_text
FROM documents"""

_LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)

_SILVER_TEXT = """SELECT order_id AS orderid, customer_id AS customerid,
  * EXCLUDE (order_id, customer_id) FROM (SELECT DISTINCT * FROM orders_text
  WHERE customer_id IS NOT NULL)"""

_LOGGED = "TIMESTAMP '2024-03-01 06:00:00'"

ORACLES: dict[str, str] = {
    "measures_core": f"WITH {ORDERS_LIKE} SELECT {_CORE} FROM orders_like",
    "measures_by_dim": (
        f"WITH {ORDERS_LIKE} SELECT region, {_CORE} FROM orders_like GROUP BY region"
    ),
    "measures_by_category": f"""WITH {ORDERS_LIKE} SELECT product_category, {_SALES},
        CAST(sum(quantity) AS BIGINT) AS total_quantity FROM orders_like GROUP BY ALL""",
    "measures_by_channel": f"""WITH {ORDERS_LIKE}, {_repeaters("sales_channel")}, main AS (
        SELECT sales_channel, {_CORE}, {_STATUS} FROM orders_like GROUP BY sales_channel)
        SELECT * FROM main JOIN repeaters USING (sales_channel)""",
    "measures_status": f"""WITH {ORDERS_LIKE} SELECT region, {_STATUS},
        {_ORDERS} AS total_orders FROM orders_like GROUP BY region""",
    "repeat_customers": f"""WITH {ORDERS_LIKE}, {_repeaters()} SELECT repeat_customers,
        (SELECT {_CUSTOMERS} FROM orders_like) AS total_customers FROM repeaters""",
    "top_products": f"""WITH {ORDERS_LIKE} SELECT product_name, {_SALES} FROM orders_like
        GROUP BY product_name ORDER BY total_sales DESC, product_name LIMIT 10""",
    "sales_ytd_mtd": _calendar("date, sales, sales_ytd, sales_mtd"),
    "sales_last_12m": _calendar("date, sales_last_12m"),
    "sales_same_period_ly": _calendar("date, sales, sales_same_period_ly"),
    "sales_calendar_by_region": _calendar(
        "region, date, sales, sales_ytd, sales_mtd, sales_last_12m, sales_same_period_ly", "region"
    ),
    "sales_calendar_by_customer": f"""WITH {ORDERS_LIKE}, totals AS (
          SELECT customer_id, order_date AS date, sum(total_amount) AS sales FROM orders_like
          WHERE order_date IS NOT NULL GROUP BY ALL)
        SELECT a.customer_id, a.date, CAST(any_value(a.sales) AS DECIMAL(38,2)) AS sales,
          CAST(sum(b.sales) FILTER (WHERE year(b.date) = year(a.date)) AS DECIMAL(38,2)) AS sales_ytd,
          CAST(sum(b.sales) FILTER (WHERE date_trunc('month', b.date) = date_trunc('month', a.date))
            AS DECIMAL(38,2)) AS sales_mtd,
          CAST(sum(b.sales) FILTER (WHERE b.date > a.date - INTERVAL 12 MONTH) AS DECIMAL(38,2))
            AS sales_last_12m,
          CAST(sum(b.sales) FILTER (WHERE b.date = a.date - INTERVAL 12 MONTH) AS DECIMAL(38,2))
            AS sales_same_period_ly
        FROM totals a JOIN totals b ON a.customer_id IS NOT DISTINCT FROM b.customer_id
          AND b.date <= a.date AND b.date >= date_trunc('year', a.date) - INTERVAL 12 MONTH
        GROUP BY a.customer_id, a.date""",
    "sales_by_quarter": f"""WITH {ORDERS_LIKE} SELECT CAST(year(order_date) AS INT) AS year,
        CAST(quarter(order_date) AS INT) AS quarter, {_SALES} FROM orders_like GROUP BY ALL""",
    "orders_good": f"WITH {ORDERS_LIKE} SELECT * FROM orders_like WHERE NOT ({_BAD})",
    "orders_bad": f"""WITH {ORDERS_LIKE} SELECT *, {_VIOLATIONS} AS violations FROM orders_like
        WHERE {_BAD}""",
    "orders_violation_counts": f"WITH {ORDERS_LIKE} " + " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {test}) AS rows FROM orders_like"
        for name, test in _RULES.items()
    ),
    "orders_total_with_discount": f"""WITH {ORDERS_LIKE} SELECT order_id, quantity, unit_price,
        discount_pct, total_amount FROM orders_like WHERE total_amount <>
        quantity * unit_price * (100 - discount_pct) * CAST(0.01 AS DECIMAL(3,2))""",
    "orders_dedup": f"WITH {ORDERS_LIKE} {_first_per_key('orders_like')}",
    "orders_distinct": f"""WITH {ORDERS_LIKE} SELECT DISTINCT order_id, customer_id, order_date,
        order_status FROM orders_like""",
    "orders_distinct_keys": f"""WITH {ORDERS_LIKE} SELECT DISTINCT order_id, discount_pct
        FROM orders_like""",
    "duplicate_rows": """SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_rows FROM (
        SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber, l_returnflag)""",
    "contract_casts": f"""WITH {_RAW} SELECT l_orderkey, l_linenumber,
        CAST(trunc(try_cast(quantity AS DOUBLE)) AS INT) AS quantity,
        try_cast(price AS DECIMAL(10,2)) AS price,
        CASE WHEN regexp_full_match(shipped, '\\d{{4}}-\\d{{2}}-\\d{{2}}')
             THEN try_cast(shipped AS DATE) END AS shipped FROM raw_lines""",
    "bronze_to_silver": f"""WITH {ORDERS_LIKE} SELECT DISTINCT order_id AS orderid,
        customer_id AS customerid, order_date, region, order_status FROM orders_like
        WHERE customer_id IS NOT NULL""",
    "clean_complete_columns": f"""WITH {ORDERS_LIKE} SELECT DISTINCT order_id AS orderid,
        customer_id AS customerid, order_date, order_status, {_LOGGED} AS "Load_Datetime"
        FROM orders_like""",
    "text_clean": _TEXT_CLEAN,
    "identifier_clean": """SELECT p_partkey, regexp_replace(concat_ws('-', p_name, p_brand),
        '[^a-zA-Z0-9_]', '_', 'g') AS identifier FROM part""",
    "regex_flag": f"""WITH {_RAW} SELECT l_orderkey, l_linenumber, shipped,
        regexp_full_match(shipped, '\\d{{4}}-\\d{{2}}-\\d{{2}}') AS matches_regex FROM raw_lines""",
    "null_pct": """SELECT CAST(count(*) FILTER (WHERE o_orderstatus = 'P') AS DOUBLE) / count(*)
        * 100.0 AS null_pct FROM orders""",
    "distinct_keys": f"""WITH {ORDERS_LIKE} SELECT count(*) AS distinct_count FROM (
        SELECT DISTINCT order_id, customer_id FROM orders_like)""",
    "range_violations": """SELECT count(*) AS violations FROM customer
        WHERE c_acctbal < 0 OR c_acctbal > 9000""",
    "regex_violations": """SELECT count(*) AS violations FROM customer
        WHERE NOT regexp_matches(c_name, '^Customer#\\d*[02468]$')""",
    "dq_report": _line_report(),
    "dq_report_states": _line_report(),
    "distinct_states": """SELECT 'pairs' AS metric, count(*) AS distinct_values
          FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)
        UNION ALL SELECT 'dates', count(DISTINCT l_shipdate) FROM lineitem
        UNION ALL SELECT 'orders', count(DISTINCT l_orderkey) FROM lineitem
        UNION ALL SELECT 'parts', count(DISTINCT l_partkey) FROM lineitem""",
    "dq_config": _config_report(),
    "column_cardinality": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_values FROM lineitem"
        for c in _LINE_COLUMNS
    ),
    "category_counts": f"""WITH {ORDERS_LIKE} SELECT product_category, count(*) AS rows
        FROM orders_like GROUP BY product_category""",
    "validation_counts": " UNION ALL ".join(
        f"SELECT 'counted_{t}' AS table_name, count(*) AS rows FROM {t}"
        for t in ("customer", "orders", "lineitem", "events")
    ),
    "scd2_first_load": _SALES_HISTORY + " SELECT * FROM staged_1",
    "scd2_second_load": _SALES_HISTORY + " SELECT * FROM history",
    "scd2_noop": _SALES_HISTORY + " SELECT * FROM staged_1",
    "scd2_close_missing": _history(
        _SNAPSHOTS, _SALES_COLUMNS, ["transaction_id", "line_number"], close_missing=True
    ) + " SELECT * FROM history",
    "scd2_changes": _SALES_HISTORY + " SELECT * FROM changes",
    "scd2_counts": _SALES_HISTORY + """ SELECT count(*) FILTER (WHERE current_flag)
        AS current_rows, count(*) AS total_rows FROM history""",
    "scd2_current": _SALES_HISTORY + " SELECT * FROM history WHERE current_flag",
    "promo_scd2": _PROMOTION_HISTORY + " SELECT * FROM history",
    "promotion_measures": _PROMOTION_HISTORY + """ SELECT
        count(DISTINCT promotion_id) FILTER (WHERE current_flag) AS active_promotions,
        sum(discount_pct) / count(discount_pct) AS promotion_discount_average,
        count(*) AS promotion_history_rows FROM history""",
    "history_measures": _SALES_HISTORY + """ SELECT count(*) FILTER (WHERE current_flag)
        AS scd2_current_rows, count(*) AS scd2_total_history_rows FROM history""",
    "etl_log": f"WITH {_CONTROL} SELECT * FROM control",
    "etl_latest": f"""WITH {_CONTROL} SELECT max(count_timestamp) AS latest_etl_run,
        count(*) AS quality_check_rows,
        (SELECT "Table_count" FROM control ORDER BY count_timestamp DESC LIMIT 1)
        AS latest_table_count FROM control""",
    "etl_top20": f"""WITH {_CONTROL} SELECT * FROM control
        ORDER BY count_timestamp DESC, "Table_name" LIMIT 20""",
    "profile_a": f"WITH {_PROFILE_A} SELECT * FROM profiles",
    "profile_csv_states": f"""WITH {_SNAPSHOTS}, {_profile(*_LADDER_A, sources=("snapshot_1",))}
        SELECT * REPLACE ('sales' AS table_name) FROM profiles""",
    "profile_b": f"WITH {_PROFILE_B} SELECT * FROM profiles",
    "json_items": _EVENTS,
    "json_items_fallback": _EVENTS,
    "json_items_inferred": """SELECT event_id, user_id, event_type, value,
        CAST(json_extract(props, '$.k') AS BIGINT) AS k,
        epoch_us(ts) AS ts_micros FROM events""",
    "json_deep_records": """WITH e AS (
          SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
        SELECT event_id AS id, user_id, event_type AS name, user_id % 3 AS code,
               k + event_id % 5 AS n, CASE WHEN event_id % 2 = 1 THEN 'odd' END AS label, value,
               event_type, CAST(1 AS BIGINT) AS keys FROM e""",
    "json_keyed_records": "SELECT 'e' || event_id AS key, user_id FROM events",
    "json_props": """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k
        FROM events""",
    "csv_contract": f"WITH {ORDERS_TEXT} SELECT * FROM orders_text",
    "medallion_job": f"WITH {ORDERS_TEXT} {_SILVER_TEXT}",
    "medallion_log": f"""WITH {ORDERS_TEXT}, counted AS (
          SELECT count(*) AS n FROM (SELECT DISTINCT * FROM orders_text))
        SELECT 'logged' AS entry, CAST(n AS DECIMAL(18,4)) AS "Table_count",
               {_LOGGED} + INTERVAL (d) DAY AS count_timestamp FROM counted, range(2) r(d)
        UNION ALL
        SELECT 'appended', CAST(2 * n AS DECIMAL(18,4)), {_LOGGED} FROM counted""",
    "cleansing_job_clean": f"""WITH {ORDERS_TEXT}, good AS (
          SELECT * FROM orders_text WHERE NOT ({_BAD}))
        SELECT *, {_LOGGED} AS ingestion_timestamp FROM ({_first_per_key("good")})""",
    "csv_mixed_headers": f"""WITH {_SNAPSHOTS} SELECT * REPLACE (
          CASE WHEN transaction_id % 3 < 2 THEN sku END AS sku,
          CASE WHEN transaction_id % 3 < 2 THEN store_id END AS store_id) FROM snapshot_1""",
    "csv_rejects": """SELECT * FROM (
        SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_orderkey AS VARCHAR)
          || CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE ',' || o_orderstatus || ',x' END
          || CASE WHEN o_orderkey % 7 = 0 THEN ',more' ELSE '' END AS line FROM orders)
        WHERE length(line) - length(replace(line, ',', '')) <> 2""",
    "json_rejects": """SELECT event_id, body FROM (
        SELECT event_id, '{"items":[{"id":' || event_id
          || CASE WHEN event_id % 7 = 0 THEN '' ELSE '}]}' END AS body FROM events)
        WHERE NOT json_valid(body)""",
    "json_large_numbers": """SELECT '12345678901234'
        || lpad(CAST(event_id % 1000000 AS VARCHAR), 6, '0') AS id FROM events""",
    "cleansing_job_bad": f"""WITH {ORDERS_TEXT} SELECT *, {_VIOLATIONS} AS violations,
        CAST(NULL AS VARCHAR) AS malformed_line,
        {_LOGGED} AS bad_record_timestamp FROM orders_text WHERE {_BAD}""",
    "sales_history_job": _SALES_HISTORY + " SELECT * FROM history",
    "sales_history_tables": _SALES_HISTORY + " SELECT * FROM history",
    "sales_history_dated": """WITH stated AS (
          SELECT l_partkey AS sku, CAST(round(l_discount * 100) AS BIGINT) AS discount_pct,
                 l_returnflag AS flag, CAST(l_shipdate AS DATE) AS effective_start_date
          FROM lineitem
          QUALIFY row_number() OVER (PARTITION BY l_partkey, CAST(l_shipdate AS DATE)
                                     ORDER BY round(l_discount * 100), l_returnflag) = 1
        ), marked AS (
          SELECT *, md5(concat_ws('||', sku, discount_pct, flag)) AS record_hash,
                 lag((discount_pct, flag)) OVER (PARTITION BY sku ORDER BY effective_start_date) AS before
          FROM stated
        ), changed AS (
          SELECT * EXCLUDE (before) FROM marked WHERE before IS NULL OR before <> (discount_pct, flag)
        )
        SELECT *, lead(effective_start_date) OVER dated AS effective_end_date,
               lead(effective_start_date) OVER dated IS NULL AS current_flag
        FROM changed WINDOW dated AS (PARTITION BY sku ORDER BY effective_start_date)""",
    "promotions_history_job": _PROMOTION_HISTORY + " SELECT * FROM history WHERE current_flag",
    "quality_job": _line_report().replace("'order_lines'", "'checked_lines'"),
}

_DDL_TYPES = {
    "BIGINT": "BIGINT", "FLOAT": "DOUBLE", "DATETIME2": "TIMESTAMP", "BIT": "BOOLEAN",
}
_TABLE_COLUMNS = {
    "orders": (
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority",
    ),
    "lineitem": _LINE_COLUMNS,
    "documents": ("doc_id", "text", "lang", "source", "n_chars"),
    "events": ("event_id", "ts", "user_id", "event_type", "value", "props"),
    "labels": ("doc_id", "quality", "toxic"),
}
_POSITIONS = ", ".join(
    f"('{t}', '{c}', {i})" for t, columns in _TABLE_COLUMNS.items() for i, c in enumerate(columns)
)
_DDL_CASE = " ".join(f"WHEN '{have}' THEN '{want}'" for have, want in _DDL_TYPES.items())


def _definitions(profiles: str, positions: str) -> str:
    return f"""WITH {profiles},
positions(table_name, "column", position) AS (VALUES {positions})
SELECT table_name, 'CREATE SCHEMA IF NOT EXISTS `landing`' AS schema_ddl,
  'CREATE TABLE `landing`.`' || table_name || '` (' || chr(10) || '  ' || string_agg(
    '`' || "column" || '` ' || CASE sql_type {_DDL_CASE} ELSE 'STRING' END,
    ',' || chr(10) || '  ' ORDER BY position) || chr(10) || ')' AS table_ddl
FROM profiles JOIN positions USING (table_name, "column") GROUP BY table_name"""


ORACLES["profile_ddl"] = _definitions(_PROFILE_A, _POSITIONS)
_MIXED = """mixed_orders AS (
  SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS padded,
    CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' ELSE CAST(o_orderkey AS VARCHAR) END AS mixed,
    CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS blanks,
    CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE '0' END AS flag FROM orders
), some_labels AS (SELECT doc_id, quality FROM labels), """
ORACLES["csv_definitions"] = _definitions(
    _MIXED + _profile(*_LADDER_A, sources=("mixed_orders", "some_labels")),
    "('mixed_orders', 'padded', 0), ('mixed_orders', 'mixed', 1), ('mixed_orders', 'blanks', 2),"
    " ('mixed_orders', 'flag', 3), ('some_labels', 'doc_id', 0), ('some_labels', 'quality', 1)",
)
ORACLES["measures_appended"] = ORACLES["measures_core"]
