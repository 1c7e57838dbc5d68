"""DuckDB SQL for every registered query, written from the tables up.

It shares no code with the library, and takes another route where there is one: monthly
history is the plain cumulative join, scores are NTILE windows, counts are DISTINCT.
"""

from __future__ import annotations

ADMIN = "('B', 'M', 'POST', 'DOT', 'BANK CHARGES')"
CALENDAR_START, CALENDAR_END = "1995-01-01", "2001-08-02"
FIRST_LOAD_BEFORE = "1998-01-01"

# Amounts of ordinary size are added exactly, all others as doubles.
SPENT = (
    "(CAST(sum(CASE WHEN abs({0}) < 1e12 THEN CAST({0} AS DECIMAL(38,8)) END) AS DOUBLE)"
    " + coalesce(sum(CASE WHEN abs({0}) >= 1e12 THEN {0} END), 0))"
)

# Common table expressions in dependency order.
TABLES = {
    "bronze": """
        SELECT
            CASE WHEN l_orderkey % 499 = 0 AND l_linenumber = 2 THEN NULL
                 ELSE CAST(l_orderkey AS VARCHAR) END AS InvoiceNo,
            CASE WHEN l_orderkey % 211 = 0 AND l_linenumber = 1 THEN NULL
                 WHEN l_partkey % 97 = 0 THEN 'POST'
                 WHEN l_partkey % 97 = 1 THEN 'M'
                 WHEN l_partkey % 97 = 2 THEN ' dot '
                 WHEN l_partkey % 97 = 3 THEN 'Bank Charges'
                 WHEN l_linenumber = 3 THEN 'sku' || l_partkey
                 WHEN l_linenumber = 5 THEN ' SKU' || l_partkey || ' '
                 ELSE 'SKU' || l_partkey END AS StockCode,
            CASE WHEN p_partkey % 73 = 8 THEN NULL ELSE '  ' || p_name || ' ' END AS Description,
            CASE WHEN l_orderkey % 101 = 7 THEN 'abc'
                 WHEN l_orderkey % 103 = 5 THEN '-1'
                 WHEN l_orderkey % 107 = 3 THEN '2.5'
                 WHEN l_orderkey % 109 = 2 THEN ' 7 '
                 WHEN l_orderkey % 113 = 4 THEN '2.49999999999'
                 WHEN l_orderkey % 113 = 5 THEN '1e2'
                 ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS Quantity,
            strftime(CASE WHEN l_linenumber = 7 THEN l_shipdate ELSE o_orderdate END,
                     '%-m/%-d/%Y') || ' ' || (9 + l_linenumber % 2) || ':30' AS InvoiceDate,
            CASE WHEN l_partkey % 89 = 6 THEN '0'
                 WHEN l_partkey % 83 = 5 THEN 'x'
                 WHEN l_partkey % 83 = 6 THEN '5d'
                 WHEN l_partkey % 83 = 7 THEN '0.00001'
                 WHEN l_partkey % 83 = 8 THEN ' 1e2 '
                 WHEN l_partkey % 79 = 4 THEN NULL
                 ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2))
                           - CAST(l_discount AS DECIMAL(18,2)) AS VARCHAR) END AS UnitPrice,
            CASE WHEN l_orderkey % 19 = 0 THEN NULL
                 ELSE CAST(o_custkey AS VARCHAR) END AS CustomerID,
            CASE WHEN l_orderkey % 37 = 0 THEN NULL ELSE ' ' || n_name END AS Country
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN nation ON n_nationkey =
            (c_nationkey + CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) % 25
        JOIN part ON l_partkey = p_partkey""",
    "countries": """
        SELECT n_nationkey AS id, lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS alpha2,
               CASE WHEN n_regionkey = 4 THEN n_name || ', Territory of' ELSE n_name END AS en
        FROM nation""",
    "silver_clean": """
        SELECT InvoiceNo AS invoice_no, StockCode AS stock_code,
               trim(Description) AS description,
               TRY_CAST(Quantity AS INTEGER) AS quantity,
               strptime(InvoiceDate, '%m/%d/%Y %H:%M') AS invoice_date,
               TRY_CAST(UnitPrice AS DOUBLE) AS unit_price,
               CustomerID AS customer_id, trim(Country) AS country,
               TRY_CAST(Quantity AS INTEGER) * TRY_CAST(UnitPrice AS DOUBLE) AS total_price
        FROM bronze
        WHERE InvoiceNo IS NOT NULL AND StockCode IS NOT NULL
          AND TRY_CAST(Quantity AS INTEGER) > 0 AND TRY_CAST(UnitPrice AS DOUBLE) > 0""",
    "silver": """
        SELECT * FROM silver_clean
        QUALIFY ROW_NUMBER() OVER (
            PARTITION BY invoice_no, stock_code
            ORDER BY invoice_date, quantity, unit_price, description, customer_id, country
        ) = 1""",
    "dim_customers": """
        SELECT customer_id, country FROM silver WHERE customer_id IS NOT NULL
        QUALIFY ROW_NUMBER() OVER (
            PARTITION BY customer_id ORDER BY invoice_date, country) = 1""",
    "dim_products": f"""
        SELECT upper(trim(stock_code)) AS stock_code, description, unit_price FROM silver
        WHERE upper(trim(stock_code)) NOT IN {ADMIN}
        QUALIFY ROW_NUMBER() OVER (
            PARTITION BY upper(trim(stock_code))
            ORDER BY invoice_date, description, unit_price) = 1""",
    "dim_date": f"""
        SELECT d AS date, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id,
               CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
               CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name,
               CAST(weekofyear(d) AS INTEGER) AS week,
               CAST(dayofweek(d) AS INTEGER) AS day_of_week, strftime(d, '%a') AS day_name,
               dayofweek(d) IN (0, 6) AS is_weekend
        FROM (SELECT CAST(x AS DATE) AS d
              FROM range(DATE '{CALENDAR_START}', DATE '{CALENDAR_END}', INTERVAL 1 DAY) t(x))""",
    "fact_sales": f"""
        SELECT md5(invoice_no || '-' || stock_code) AS sales_id, invoice_no,
               upper(trim(s.stock_code)) AS stock_code, customer_id,
               CAST(strftime(invoice_date, '%Y%m%d') AS INTEGER) AS date_id,
               quantity, unit_price, total_price
        FROM silver s
        WHERE upper(trim(s.stock_code)) NOT IN {ADMIN} AND customer_id IS NOT NULL""",
    "mart_invoices": """
        SELECT f.sales_id, f.invoice_no,
               CASE WHEN f.customer_id IS NULL THEN 'Cancelled' ELSE 'Shipped' END AS status,
               f.stock_code, p.description, p.unit_price, f.quantity, f.total_price,
               f.customer_id, c.country, co.alpha2 AS country_code, d.date AS invoice_date,
               d.month_name, d.year, d.quarter
        FROM fact_sales f
        LEFT JOIN dim_customers c ON f.customer_id = c.customer_id
        LEFT JOIN dim_products p ON f.stock_code = p.stock_code
        LEFT JOIN dim_date d ON f.date_id = d.date_id
        LEFT JOIN countries co ON c.country = co.en""",
    "dated": """
        SELECT f.*, CAST(date_trunc('month', d.date) AS DATE) AS order_month
        FROM fact_sales f LEFT JOIN dim_date d ON f.date_id = d.date_id""",
    "months": """
        SELECT DISTINCT order_month AS snapshot_month FROM dated
        WHERE customer_id IS NOT NULL AND order_month IS NOT NULL""",
    "recency_frequency": """
        SELECT f.customer_id, m.snapshot_month, max(f.date_id) AS most_recent_order,
               count(DISTINCT f.invoice_no) AS number_of_orders
        FROM dated f JOIN months m ON f.order_month <= m.snapshot_month
        WHERE f.customer_id IS NOT NULL GROUP BY ALL""",
    "monetary": f"""
        SELECT f.customer_id, m.snapshot_month,
               {SPENT.format("f.total_price")} AS total_spent
        FROM dated f JOIN months m ON f.order_month <= m.snapshot_month
        WHERE f.customer_id IS NOT NULL AND f.total_price > 0 GROUP BY ALL""",
    "rfm_base": """
        SELECT rf.*, m.total_spent FROM recency_frequency rf
        LEFT JOIN monetary m USING (customer_id, snapshot_month)""",
    "scored": """
        SELECT *,
            CAST(NTILE(5) OVER (PARTITION BY snapshot_month
                 ORDER BY most_recent_order NULLS LAST, customer_id) AS INTEGER) AS recency_score,
            CAST(NTILE(5) OVER (PARTITION BY snapshot_month
                 ORDER BY number_of_orders NULLS LAST, customer_id) AS INTEGER) AS frequency_score,
            CAST(NTILE(5) OVER (PARTITION BY snapshot_month
                 ORDER BY total_spent NULLS LAST, customer_id) AS INTEGER) AS monetary_score
        FROM rfm_base""",
    "rfm_snapshot": """
        SELECT *,
            CAST(recency_score + frequency_score + monetary_score AS INTEGER) AS rfm_total_score,
            CASE WHEN recency_score >= 4 AND frequency_score >= 4 AND monetary_score >= 4
                     THEN 'Champion'
                 WHEN recency_score >= 3 AND frequency_score >= 3 THEN 'Loyal Customer'
                 WHEN recency_score >= 4 AND frequency_score <= 2 THEN 'New Customer'
                 WHEN recency_score <= 2 AND frequency_score >= 3 THEN 'At Risk'
                 WHEN recency_score <= 2 AND frequency_score <= 2 THEN 'Lost'
                 ELSE 'Potential Loyalist' END AS customer_segment
        FROM scored""",
    "paired": """
        SELECT *,
            lag(recency_score) OVER w AS prev_recency_score,
            lag(frequency_score) OVER w AS prev_frequency_score,
            lag(monetary_score) OVER w AS prev_monetary_score,
            lag(rfm_total_score) OVER w AS prev_rfm_total_score,
            lag(customer_segment) OVER w AS prev_customer_segment,
            lag(total_spent) OVER w AS prev_total_spent
        FROM rfm_snapshot WINDOW w AS (PARTITION BY customer_id ORDER BY snapshot_month)""",
    "rfm_movement": """
        SELECT customer_id, snapshot_month, recency_score, frequency_score, monetary_score,
            rfm_total_score, customer_segment, prev_recency_score, prev_frequency_score,
            prev_monetary_score, prev_rfm_total_score, prev_customer_segment,
            recency_score - prev_recency_score AS recency_score_change,
            frequency_score - prev_frequency_score AS frequency_score_change,
            monetary_score - prev_monetary_score AS monetary_score_change,
            rfm_total_score - prev_rfm_total_score AS total_score_change,
            total_spent - prev_total_spent AS mom_spend_change,
            CASE WHEN prev_customer_segment IS NULL THEN 'New'
                 WHEN customer_segment = prev_customer_segment THEN 'Stable'
                 WHEN rfm_total_score > prev_rfm_total_score THEN 'Upgraded'
                 WHEN rfm_total_score < prev_rfm_total_score THEN 'Downgraded'
                 ELSE 'Lateral' END AS segment_movement,
            CASE WHEN prev_customer_segment IS NULL THEN 'New → ' || customer_segment
                 ELSE prev_customer_segment || ' → ' || customer_segment
                 END AS segment_transition
        FROM paired""",
    "tnf_customers": """
        SELECT customer_id, country FROM silver
        WHERE customer_id IS NOT NULL AND country IS NOT NULL
        QUALIFY ROW_NUMBER() OVER (
            PARTITION BY customer_id ORDER BY invoice_date, country) = 1""",
    "tnf_products": """
        SELECT stock_code, description, unit_price FROM silver
        QUALIFY ROW_NUMBER() OVER (
            PARTITION BY stock_code ORDER BY invoice_date, description, unit_price) = 1""",
    "tnf_orders": """
        SELECT invoice_no, customer_id, invoice_date FROM (
            SELECT invoice_no, customer_id, invoice_date FROM silver
            WHERE invoice_no IS NOT NULL AND invoice_date IS NOT NULL
            QUALIFY ROW_NUMBER() OVER (
                PARTITION BY invoice_no ORDER BY invoice_date, customer_id) = 1)
        WHERE customer_id IN (SELECT customer_id FROM tnf_customers)""",
    "tnf_order_items": """
        SELECT invoice_no, stock_code, quantity, unit_price, total_price FROM silver
        WHERE quantity IS NOT NULL
          AND invoice_no IN (SELECT invoice_no FROM tnf_orders)
          AND stock_code IN (SELECT stock_code FROM tnf_products)""",
    "stored_order_items": """
        SELECT row_number() OVER (ORDER BY invoice_no, stock_code) AS id,
               invoice_no, stock_code, quantity,
               CAST(unit_price AS DECIMAL(10,2)) AS unit_price,
               CAST(total_price AS DECIMAL(10,2)) AS total_price
        FROM tnf_order_items""",
}

_WITH = "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in TABLES.items()) + "\n"

MONEY = SPENT.format("total_price")
LATEST = "WHERE snapshot_month = (SELECT max(snapshot_month) FROM rfm_snapshot)"
BAD_CSV = "(UnitPrice IS NULL OR Quantity = 'abc')"


def _fields(*names: str) -> str:
    return " || ',' || ".join(f"coalesce({n}, '')" for n in names)


_QUERIES = {
    "silver_clean": "SELECT * FROM silver_clean",
    "silver_dedup": "SELECT * FROM silver",
    "dim_customers": "SELECT * FROM dim_customers",
    "dim_products": "SELECT * FROM dim_products",
    "dim_date": f"""
        SELECT d.*, count(f.date_id) AS lines, {MONEY} AS revenue
        FROM dim_date d LEFT JOIN fact_sales f USING (date_id) GROUP BY ALL""",
    "fact_sales": "SELECT * FROM fact_sales",
    "country_lookup": """
        SELECT customer_id, country, alpha2 AS country_code
        FROM dim_customers LEFT JOIN countries ON country = en""",
    "mart_invoices": "SELECT * FROM mart_invoices",
    "month_spine": "SELECT * FROM months",
    "rfm_base": "SELECT * FROM rfm_base",
    "rfm_snapshot": "SELECT * FROM rfm_snapshot",
    "rfm_movement": "SELECT * FROM rfm_movement",
    "tnf_customers": "SELECT * FROM tnf_customers",
    "tnf_products": "SELECT * FROM tnf_products",
    "tnf_orders": "SELECT * FROM tnf_orders",
    "tnf_order_items": "SELECT * FROM tnf_order_items",
    "stored_order_items": "SELECT * FROM stored_order_items",
    "table_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM tnf_{name}"
        for name in ("customers", "products", "orders", "order_items")
    ),
    "insert_if_absent": f"""
        SELECT stock_code, description, unit_price,
               stock_code NOT IN (SELECT stock_code FROM silver
                                  WHERE invoice_date < DATE '{FIRST_LOAD_BEFORE}') AS inserted
        FROM tnf_products""",
    "fk_violations": """
        SELECT 'fact_sales.date_id' AS foreign_key, CAST(date_id AS VARCHAR) AS value,
               count(*) AS child_rows
        FROM fact_sales WHERE date_id NOT IN (SELECT date_id FROM dim_date) GROUP BY date_id
        UNION ALL
        SELECT 'silver.invoice_no', invoice_no, count(*)
        FROM silver WHERE invoice_no NOT IN (SELECT invoice_no FROM tnf_orders)
        GROUP BY invoice_no
        UNION ALL
        SELECT 'fact_sales.stock_code', stock_code, count(*)
        FROM fact_sales WHERE stock_code NOT IN (SELECT stock_code FROM dim_products)
        GROUP BY stock_code
        UNION ALL
        SELECT 'dim_customers.country', country, count(*)
        FROM dim_customers WHERE country NOT IN (SELECT en FROM countries) GROUP BY country""",
    "dup_combinations": """
        SELECT invoice_no, stock_code, count(*) AS occurrences FROM mart_invoices
        GROUP BY invoice_no, stock_code HAVING count(*) > 1""",
    "raw_csv_rows": f"SELECT * FROM bronze WHERE NOT coalesce({BAD_CSV}, false)",
    "raw_csv_rejects": f"""
        SELECT CASE WHEN UnitPrice IS NULL
            THEN {_fields("InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate")}
            ELSE {_fields("InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate",
                          "UnitPrice", "CustomerID", "Country")} || ',extra' END AS line,
            CASE WHEN UnitPrice IS NULL THEN 'short' ELSE 'long' END AS folder,
            CAST(CASE WHEN UnitPrice IS NULL THEN 5 ELSE 9 END AS INTEGER) AS fields,
            CASE WHEN UnitPrice IS NULL THEN 'too few fields' ELSE 'too many fields' END AS reason
        FROM bronze WHERE {BAD_CSV}""",
    "raw_csv_counts": f"""
        SELECT count(*) FILTER (WHERE NOT coalesce({BAD_CSV}, false)) AS loaded,
               count(*) FILTER (WHERE {BAD_CSV}) AS rejected FROM bronze""",
    "report_headline_totals": f"""
        SELECT {MONEY} AS revenue, count(DISTINCT invoice_no) AS orders,
               count(DISTINCT customer_id) AS customers,
               {MONEY} / count(DISTINCT invoice_no) AS average_order_value
        FROM mart_invoices""",
    "report_revenue_by_month": f"""
        SELECT year, month_name, {MONEY} AS revenue FROM mart_invoices GROUP BY ALL""",
    "report_top_products": f"""
        SELECT stock_code, description, {MONEY} AS revenue FROM mart_invoices
        GROUP BY ALL ORDER BY revenue DESC, stock_code LIMIT 10""",
    "report_top_countries": f"""
        SELECT country, {MONEY} AS revenue FROM mart_invoices
        GROUP BY ALL ORDER BY revenue DESC, country LIMIT 10""",
    "report_customers_by_country": """
        SELECT country, count(DISTINCT customer_id) AS customers FROM mart_invoices
        GROUP BY ALL""",
    "report_new_and_returning": """
        SELECT m.snapshot_month,
               count(*) FILTER (WHERE first_month = m.snapshot_month) AS new_customers,
               count(*) FILTER (WHERE first_month < m.snapshot_month) AS returning_customers
        FROM months m JOIN (SELECT customer_id, min(order_month) AS first_month FROM dated
                            WHERE order_month IS NOT NULL GROUP BY customer_id) c
          ON c.first_month <= m.snapshot_month
        GROUP BY m.snapshot_month""",
    "report_segment_share": """
        SELECT snapshot_month, customer_segment, count(*) AS customers,
               count(*) * CAST(100 AS DOUBLE) / CAST(sum(count(*)) OVER
                   (PARTITION BY snapshot_month) AS BIGINT) AS share_pct
        FROM rfm_snapshot GROUP BY snapshot_month, customer_segment""",
    "report_segment_sizes": f"""
        SELECT customer_segment, count(*) AS customers, avg(rfm_total_score) AS average_score
        FROM rfm_snapshot {LATEST} GROUP BY ALL""",
    "report_score_distribution": f"""
        SELECT rfm_total_score, count(*) AS customers FROM rfm_snapshot {LATEST} GROUP BY ALL""",
    "report_score_headline": f"""
        SELECT snapshot_month, count(*) AS customers, avg(rfm_total_score) AS average_score
        FROM rfm_snapshot {LATEST} GROUP BY snapshot_month""",
    "report_average_score": """
        SELECT customer_segment, avg(rfm_total_score) AS average_score FROM rfm_snapshot
        GROUP BY ALL""",
    "report_movement_totals": """
        SELECT segment_movement, count(*) AS customer_months FROM rfm_movement GROUP BY ALL""",
    "report_transitions": """
        SELECT segment_transition, count(*) AS customer_months FROM rfm_movement GROUP BY ALL""",
    "report_top_transitions": """
        SELECT segment_transition, count(*) AS customer_months FROM rfm_movement
        GROUP BY ALL ORDER BY customer_months DESC, segment_transition LIMIT 5""",
    "report_movement_by_month": """
        SELECT snapshot_month,
               count(*) FILTER (WHERE segment_movement = 'Upgraded') AS upgraded,
               count(*) FILTER (WHERE segment_movement = 'Downgraded') AS downgraded
        FROM rfm_movement GROUP BY snapshot_month""",
}


# ── the declared checks: (check, column, SQL that is true for a violating row) ──


def _not_null(*columns: str):
    return [("not_null", c, f"{c} IS NULL") for c in columns]


def _between(column: str, low: object, high: object):
    return [("between", column, f"{column} < {low} OR {column} > {high}")]


def _in(column: str, *values: str):
    accepted = ", ".join(f"'{v}'" for v in values)
    return [("accepted_values", column, f"{column} NOT IN ({accepted})")]


_KEY_32 = [("length_equals", "sales_id", "length(sales_id) <> 32")]
_SCORES = (
    _not_null("customer_id", "snapshot_month", "recency_score", "frequency_score")
    + _not_null("monetary_score", "rfm_total_score", "customer_segment")
    + _between("recency_score", 1, 5)
    + _between("frequency_score", 1, 5)
    + _between("monetary_score", 1, 5)
    + _between("rfm_total_score", 3, 15)
    + _in("customer_segment", "Champion", "Loyal Customer", "New Customer", "At Risk", "Lost",
          "Potential Loyalist")
)

# report name -> (common table expression, row checks, unique columns, unique combination)
_CHECKED = {
    "raw_ecommerce": ("bronze", _not_null("InvoiceNo", "StockCode"), (), None),
    "silver_ecommerce": (
        "silver",
        _not_null("invoice_no", "stock_code", "description", "quantity", "invoice_date")
        + _not_null("unit_price", "country", "total_price"),
        (),
        ("invoice_no", "stock_code"),
    ),
    "dim_customers": ("dim_customers", _not_null("customer_id", "country"), ("customer_id",), None),
    "dim_products": ("dim_products", _not_null("stock_code", "unit_price"), ("stock_code",), None),
    "dim_date": (
        "dim_date",
        _not_null("date_id", "date", "year", "month", "quarter"),
        ("date_id", "date"),
        None,
    ),
    "fact_sales": (
        "fact_sales",
        _not_null("sales_id", "invoice_no", "stock_code", "date_id", "quantity")
        + _KEY_32
        + _between("quantity", 1, 100000)
        + _between("total_price", 0, 200000),
        ("sales_id",),
        None,
    ),
    "mart_invoices": (
        "mart_invoices",
        _not_null("sales_id", "invoice_no", "status", "stock_code", "quantity", "total_price")
        + _KEY_32
        + _in("status", "Shipped", "Cancelled")
        + _between("quantity", 1, 100000)
        + _between("total_price", 0, 200000),
        ("sales_id",),
        ("invoice_no", "stock_code"),
    ),
    "mart_rfm_snapshot": (
        "rfm_snapshot",
        _SCORES
        + _between("snapshot_month", "DATE '1995-01-01'", "DATE '2001-08-01'")
        + _not_null("most_recent_order", "number_of_orders", "total_spent")
        + _between("number_of_orders", 1, 1000)
        + _between("total_spent", 0, 1000000),
        (),
        ("customer_id", "snapshot_month"),
    ),
    "mart_rfm_movement": (
        "rfm_movement",
        _SCORES
        + _not_null("segment_movement", "segment_transition")
        + _in("segment_movement", "New", "Stable", "Upgraded", "Downgraded", "Lateral")
        + [("matches_regex", "segment_transition",
            "NOT regexp_matches(segment_transition, '.+ → .+')")],
        (),
        ("customer_id", "snapshot_month"),
    ),
}


def _line(table: str, check: str, column: str, violations: str, source: str = "") -> str:
    return (
        f"SELECT '{table}' AS table_name, '{check}' AS check_name, "
        f"'{column}' AS column_name, CAST({violations} AS BIGINT) AS violations {source}"
    )


def _report(lines: list[str]) -> str:
    return "SELECT *, violations = 0 AS passed FROM (" + " UNION ALL ".join(lines) + ")"


# Table of the store: (source, key sets, required, longest texts, parents).
_STORED = {
    "customers": ("tnf_customers", ("customer_id",), ("customer_id", "country"),
                  {"customer_id": 20, "country": 100}, {}),
    "products": ("tnf_products", ("stock_code",), ("stock_code",),
                 {"stock_code": 20, "description": 255}, {}),
    "orders": ("tnf_orders", ("invoice_no",), ("invoice_no", "customer_id", "invoice_date"),
               {"invoice_no": 20, "customer_id": 20}, {"customer_id": "tnf_customers"}),
    "order_items": ("stored_order_items", ("id", "invoice_no, stock_code"),
                    ("id", "invoice_no", "stock_code", "quantity"),
                    {"invoice_no": 20, "stock_code": 20},
                    {"invoice_no": "tnf_orders", "stock_code": "tnf_products"}),
}


def _store_check_report() -> str:
    lines = []
    for table, (source, keys, required, longest, parents) in _STORED.items():
        for key in keys:
            dup = f"SELECT 1 FROM {source} GROUP BY {key} HAVING count(*) > 1"
            lines.append(_line(table, "unique_combination", key, "count(*)", f"FROM ({dup})"))
        for c in required:
            bad = f"count(*) FILTER (WHERE {c} IS NULL)"
            lines.append(_line(table, "not_null", c, bad, f"FROM {source}"))
        for c, n in longest.items():
            bad = f"count(*) FILTER (WHERE length({c}) > {n})"
            lines.append(_line(table, "max_length", c, bad, f"FROM {source}"))
        for c, parent in parents.items():
            orphans = f"FROM {source} WHERE {c} NOT IN (SELECT {c} FROM {parent})"
            lines.append(_line(table, "foreign_key", c, "count(*)", orphans))
    return _report(lines)


def _check_report() -> str:
    line = _line
    lines = [
        line("raw_ecommerce", check, column, "0")
        for check, column in (
            ("column_exists", "InvoiceNo"),
            ("column_exists", "StockCode"),
            ("column_type", "Quantity"),
            ("column_type", "UnitPrice"),
        )
    ]
    for table, (source, row_checks, unique, combination) in _CHECKED.items():
        for check, column, bad in row_checks:
            lines.append(line(table, check, column, f"count(*) FILTER (WHERE {bad})", f"FROM {source}"))
        for c in unique:
            dup = f"SELECT 1 FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1"
            lines.append(line(table, "unique", c, "count(*)", f"FROM ({dup})"))
        if combination:
            keys = ", ".join(combination)
            dup = f"SELECT 1 FROM {source} GROUP BY {keys} HAVING count(*) > 1"
            lines.append(line(table, "unique_combination", keys, "count(*)", f"FROM ({dup})"))
    return _report(lines)


def oracle_sql() -> dict[str, str]:
    reports = {"check_report": _check_report(), "store_check_report": _store_check_report()}
    return {name: _WITH + sql for name, sql in (_QUERIES | reports).items()}
