"""The queries of ``bound.queries`` as SQL over the same star schema, for a second engine."""

from __future__ import annotations


def _ratio(part: str, whole: str, digits: int) -> str:
    """part / whole rounded half away from zero, in whole hundredths; null on a zero whole."""
    top, base = f"cast({part} * 100 AS hugeint)", f"cast({whole} * 100 AS hugeint)"
    return (
        f"(CASE WHEN ({part} < 0) <> ({whole} < 0) THEN -1 ELSE 1 END"
        f" * cast((abs({top}) * {2 * 10**digits} + abs({base})) // nullif(2 * abs({base}), 0)"
        f" AS double) / {10**digits}.0)"
    )


def _kept(source: str, keys: str, order: str) -> str:
    ranked = ", ".join(f"{c} DESC NULLS LAST" for c in order.split(", "))
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys}"
        f" ORDER BY {ranked}) AS rn FROM {source}) WHERE rn = 1"
    )


# Named steps, each using only those before it.
_STEPS = {
    "customers_raw": """
        SELECT upper(trim(cast(c_custkey AS varchar))) AS customer_id, trim(c_name) AS company_name,
               trim(c_mktsegment) AS contact_name, trim(n_name) AS country
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "s_customers": _kept("customers_raw", "customer_id", "company_name, contact_name, country"),
    "employees_raw": """
        SELECT s_suppkey AS employee_id, split_part(s_name, '#', 1) AS first_name,
               split_part(s_name, '#', 2) AS last_name, n_name AS title
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "s_employees": _kept("employees_raw", "employee_id", "first_name, last_name, title"),
    "lookup": """
        SELECT upper(trim(n_name)) AS country_key, r_name AS region
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "shipment": """
        SELECT l_orderkey, min(l_suppkey) AS employee_id, max(l_shipdate) AS shipped
        FROM lineitem GROUP BY l_orderkey""",
    "orders_raw": """
        SELECT o_orderkey AS order_id, cast(o_custkey AS varchar) AS customer_id,
               s.employee_id, cast(o_orderdate AS date) AS order_date,
               cast(s.shipped AS date) AS shipped_date,
               cast(substring(o_orderpriority, 1, 1) AS bigint) AS shipper_id,
               n_name AS ship_country
        FROM orders
        LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN shipment s ON o_orderkey = s.l_orderkey""",
    "orders_kept": _kept(
        "orders_raw", "order_id",
        "order_date, customer_id, ship_country, employee_id, shipped_date, shipper_id",
    ),
    "s_orders": """
        SELECT o.*, l.region FROM orders_kept o
        LEFT JOIN lookup l ON upper(trim(o.ship_country)) = l.country_key""",
    "source": "SELECT l_partkey, min(l_suppkey) AS supplier_id FROM lineitem GROUP BY l_partkey",
    "products_raw": """
        SELECT p_partkey AS product_id, trim(p_name) AS product_name,
               cast(split_part(p_brand, '#', 2) AS bigint) AS category_id, s.supplier_id,
               cast(p_retailprice AS decimal(12,2)) AS unit_price
        FROM part LEFT JOIN source s ON p_partkey = s.l_partkey""",
    "products_kept": _kept(
        "products_raw", "product_id", "product_name, category_id, unit_price, supplier_id"
    ),
    "categories": """
        SELECT DISTINCT cast(split_part(p_brand, '#', 2) AS bigint) AS category_id,
               p_brand AS category_name
        FROM part""",
    "s_products": """
        SELECT p.product_id, p.product_name, p.category_id, p.supplier_id,
               cast(p.unit_price AS double) AS unit_price, c.category_name,
               s.s_name AS supplier_name, n.n_name AS supplier_country
        FROM products_kept p
        LEFT JOIN categories c ON p.category_id = c.category_id
        LEFT JOIN supplier s ON p.supplier_id = s.s_suppkey
        LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey""",
    "shippers": "SELECT DISTINCT o_orderpriority FROM orders",
    "priced": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id,
               cast((2 * cast(cast(l_extendedprice AS decimal(14,2)) * 100 AS bigint)
                     + cast(l_quantity AS bigint)) // nullif(2 * cast(l_quantity AS bigint), 0)
                    AS decimal(12,0)) * cast(0.01 AS decimal(3,2)) AS unit_price,
               cast(l_quantity AS bigint) AS quantity,
               cast(l_discount AS decimal(4,2)) AS discount
        FROM lineitem""",
    "lines": """
        SELECT *, cast(round(unit_price * quantity * (1 - discount), 2) AS decimal(18,2))
                  AS line_revenue
        FROM priced""",
    "purchases": """
        SELECT cast(user_id AS varchar) AS customer_id,
               count(*) AS total_orders_export,
               min(cast(ts AS date)) AS first_order_date, max(cast(ts AS date)) AS last_order_date
        FROM events WHERE event_type = 'purchase' GROUP BY user_id""",
    "s_activity": """
        SELECT *, cast((SELECT max(cast(ts AS date)) + 1 FROM events) - last_order_date AS bigint)
                  AS days_since_last_order
        FROM purchases""",
    "fact": """
        SELECT d.order_id, o.order_date, o.shipped_date, o.region, o.customer_id, c.company_name,
               c.country, o.employee_id, e.first_name, e.last_name, d.product_id, p.product_name,
               p.category_name, d.quantity, d.unit_price, d.discount, d.line_revenue
        FROM lines d
        LEFT JOIN s_orders o ON d.order_id = o.order_id
        LEFT JOIN s_products p ON d.product_id = p.product_id
        LEFT JOIN s_customers c ON o.customer_id = c.customer_id
        LEFT JOIN s_employees e ON o.employee_id = e.employee_id""",
    "monthly": """
        SELECT strftime(order_date, '%Y-%m') AS year_month, sum(line_revenue) AS total_revenue,
               count(DISTINCT order_id) AS order_count,
               count(DISTINCT customer_id) AS active_customers
        FROM fact GROUP BY 1""",
    "by_category": """
        SELECT category_name, sum(line_revenue) AS total_revenue,
               cast(sum(quantity) AS bigint) AS units_sold
        FROM fact GROUP BY 1""",
    "by_region": """
        SELECT region, sum(line_revenue) AS total_revenue, count(DISTINCT order_id) AS order_count
        FROM fact GROUP BY 1""",
    "top": """
        SELECT product_id, product_name, category_name, sum(line_revenue) AS total_revenue,
               cast(sum(quantity) AS bigint) AS units_sold
        FROM fact GROUP BY 1, 2, 3 ORDER BY total_revenue DESC, product_id LIMIT 10""",
    "rfm": """
        SELECT f.customer_id, any_value(f.company_name) AS company_name,
               any_value(f.country) AS country,
               arg_max(f.region, row(f.order_date, f.order_id)) AS region,
               count(DISTINCT f.order_id) AS frequency_orders,
               sum(f.line_revenue) AS monetary_total,
               max(f.order_date) AS last_order_date, min(f.order_date) AS first_order_date
        FROM fact f GROUP BY f.customer_id""",
    "recency": """
        SELECT rfm.*, cast(coalesce(a.days_since_last_order,
                      (SELECT max(cast(o_orderdate AS date)) + 1 FROM orders) - rfm.last_order_date)
                      AS bigint) AS recency_days
        FROM rfm LEFT JOIN s_activity a ON rfm.customer_id = a.customer_id""",
}


def _churn_step(days: int) -> str:
    return f"""
        SELECT customer_id, company_name, country, region, frequency_orders,
               cast(monetary_total AS double) AS monetary_total, last_order_date, first_order_date,
               recency_days, {_ratio('monetary_total', 'frequency_orders', 2)} AS avg_order_value,
               coalesce(recency_days > {days}, false) AS is_churned,
               CASE WHEN recency_days > {days} THEN 'Churned'
                    WHEN recency_days <= 60 THEN 'Active' ELSE 'At Risk' END AS customer_segment
        FROM recency"""


_STEPS["churn"] = _churn_step(180)
_STEPS["churn_90"] = _churn_step(90)
_STEPS["summary_counts"] = """
        SELECT region, count(*) AS total_customers,
               cast(sum(CASE WHEN is_churned THEN 1 ELSE 0 END) AS bigint) AS churned_customers
        FROM churn GROUP BY region"""
_STEPS["summary"] = f"""
        SELECT *, {_ratio('churned_customers * 100', 'total_customers', 1)} AS churn_rate_pct
        FROM summary_counts"""


def _with(final: str) -> str:
    """``final`` with the steps it needs, directly or through other steps, put before it."""
    words = set(final.replace("(", " ").replace(")", " ").replace(",", " ").split())
    needed = set()
    for name in reversed(list(_STEPS)):
        if name in words:
            needed.add(name)
            text = _STEPS[name]
            words |= set(text.replace("(", " ").replace(")", " ").replace(",", " ").split())
    if not needed:
        return final
    steps = ",\n".join(f"{n} AS ({_STEPS[n]})" for n in _STEPS if n in needed)
    return f"WITH {steps}\n{final}"


def _money(step: str, rest: str) -> str:
    return f"SELECT cast(total_revenue AS double) AS total_revenue, {rest} FROM {step}"


def _share(step: str, rest: str, value: str = "total_revenue") -> str:
    share = _ratio(f"{value} * 100", "whole", 1)
    return (
        f"SELECT {rest}, cast({value} AS double) AS {value}, {share} AS share_of_max_pct"
        f" FROM (SELECT *, max({value}) OVER () AS whole FROM {step})"
    )


_COUNTED = {
    "bronze_shippers": "shippers",
    "bronze_region_lookup": "lookup",
    "bronze_customers": "customer",
    "bronze_employees": "supplier",
    "bronze_orders": "orders",
    "bronze_orderdetails": "lineitem",
    "bronze_products": "part",
    "bronze_categories": "categories",
    "bronze_suppliers": "supplier",
    "bronze_customer_activity_export": "purchases",
    "silver_customers": "s_customers",
    "silver_employees": "s_employees",
    "silver_orders": "s_orders",
    "silver_products": "s_products",
    "silver_order_details": "lines",
    "silver_customer_activity": "s_activity",
    "gold_sales_fact": "fact",
    "gold_sales_monthly": "monthly",
    "gold_sales_by_category": "by_category",
    "gold_sales_by_region": "by_region",
    "gold_top_products": "top",
    "gold_customer_churn": "churn",
    "gold_churn_summary": "summary",
}

_FACT = """
    SELECT * REPLACE (cast(unit_price AS double) AS unit_price, cast(discount AS double) AS discount,
                      cast(line_revenue AS double) AS line_revenue) FROM fact"""
_ACTIVITY_EXPORT = """
    SELECT c.customer_id, coalesce(a.n, 0) AS total_orders, a.first_day AS first_order_date,
           a.last_day AS last_order_date,
           cast((SELECT max(cast(o_orderdate AS date)) + 1 FROM orders) - a.last_day AS integer)
           AS days_since_last_order
    FROM s_customers c LEFT JOIN (
        SELECT customer_id, count(*) AS n, min(order_date) AS first_day, max(order_date) AS last_day
        FROM s_orders GROUP BY customer_id) a ON c.customer_id = a.customer_id"""
_MOM = f"""
    SELECT year_month, cast(total_revenue AS double) AS total_revenue,
           cast(prev AS double) AS prev_revenue,
           {_ratio('(total_revenue - prev) * 100', 'prev', 1)} AS mom_change_pct
    FROM (SELECT *, lag(total_revenue) OVER (ORDER BY year_month) AS prev FROM monthly)"""

# Marts of the feed: step, key, columns; fractions are compared in hundredths.
_FEED = {
    "sales_monthly": ("monthly", "year_month", "year_month total_revenue order_count active_customers"),
    "sales_by_category": ("by_category", "category_name", "category_name total_revenue units_sold"),
    "sales_by_region": ("by_region", "region", "region total_revenue order_count"),
    "top_products": (
        "top", "product_id", "product_id product_name category_name total_revenue units_sold",
    ),
    "customer_churn": (
        "churn", "customer_id",
        "customer_id company_name country region frequency_orders monetary_total last_order_date "
        "first_order_date recency_days avg_order_value is_churned customer_segment",
    ),
    "churn_summary": ("summary", "region", "region total_customers churned_customers churn_rate_pct"),
}
_FRACTIONS = ("total_revenue", "monetary_total", "avg_order_value", "churn_rate_pct")



def _feed() -> str:
    """Every field of the six marts as a row."""
    return " UNION ALL ".join(
        f"SELECT '{mart}' AS mart, cast({key} AS varchar) AS row_key, '{column}' AS field, "
        f"cast({'cast(round(' + column + ' * 100) AS hugeint)' if column in _FRACTIONS else column} AS varchar)"
        f" AS value FROM {step}"
        for mart, (step, key, columns) in _FEED.items()
        for column in columns.split()
    )


def _extremes() -> list[str]:
    """Rows, nulls, least and greatest value of every column of the fact."""
    out = []
    for column in _FACT_COLUMNS.split():
        value = f"cast(round({column} * 100) AS hugeint)" if column in ("unit_price", "discount", "line_revenue") else column
        for field, figure in (
            ("rows", "count(*)"), ("nulls", f"count(*) - count({column})"), ("least", f"min({value})"), ("greatest", f"max({value})"),
        ):
            out.append(
                f"SELECT 'sales_fact' AS mart, '{column}' AS row_key, '{field}' AS field, cast({figure} AS varchar) AS value FROM fact "
            )
    return out


_FACT_COLUMNS = (
    "order_id order_date shipped_date region customer_id company_name country employee_id first_name last_name "
    "product_id product_name category_name quantity unit_price discount line_revenue"
)

_FINAL = {
    "scan_csv": _ACTIVITY_EXPORT,
    "null_tokens": """
        SELECT c_custkey AS customer_id,
               CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE') THEN NULL
                    ELSE c_name || ', ' || c_mktsegment END AS note
        FROM customer""",
    "scan_json": """
        SELECT p_partkey AS "ProductID", p_name AS "ProductName",
               split_part(p_brand, '#', 2) AS "CategoryID", s.supplier_id AS "SupplierID",
               p_retailprice AS "UnitPrice"
        FROM part LEFT JOIN source s ON p_partkey = s.l_partkey""",
    "json_object_rows": """
        SELECT event_id, unnest(json_keys(props)) AS key,
               json_extract_string(props, '$.' || unnest(json_keys(props))) AS value
        FROM events""",
    "json_path": """
        SELECT event_id, user_id, cast(json_extract(props, '$.k') AS bigint) AS k FROM events""",
    "ingest_lineage": """
        SELECT o_orderkey AS "OrderID", cast(o_custkey AS varchar) AS "CustomerID",
               s.employee_id AS "EmployeeID", cast(o_orderdate AS date) AS "OrderDate",
               cast(s.shipped AS date) AS "ShippedDate", substring(o_orderpriority, 1, 1) AS "ShipVia",
               n_name AS "ShipCountry", 'db_source' AS "_source_system"
        FROM orders
        LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN shipment s ON o_orderkey = s.l_orderkey""",
    "silver_customers": "SELECT * FROM s_customers",
    "silver_employees": "SELECT * FROM s_employees",
    "silver_orders": "SELECT * FROM s_orders",
    "silver_products": "SELECT * FROM s_products",
    "silver_order_details": """
        SELECT * REPLACE (cast(unit_price AS double) AS unit_price,
                          cast(discount AS double) AS discount,
                          cast(line_revenue AS double) AS line_revenue) FROM lines""",
    "silver_activity": "SELECT * FROM s_activity",
    "line_revenue": """
        SELECT order_id, product_id, cast(line_revenue AS double) AS line_revenue FROM lines""",
    "dedup_by_key": _kept(
        "(SELECT * REPLACE (cast(l_shipdate AS date) AS l_shipdate) FROM lineitem)",
        "l_orderkey, l_linenumber",
        "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
        "l_returnflag, l_linestatus",
    ),
    "distinct_rows": """
        SELECT DISTINCT * REPLACE (cast(l_shipdate AS date) AS l_shipdate) FROM lineitem""",
    "sales_fact": _FACT,
    "sales_fact_inner": _FACT + " WHERE order_id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')",
    "sales_monthly": _money("monthly", "year_month, order_count, active_customers"),
    "sales_by_category": _money("by_category", "category_name, units_sold"),
    "sales_by_region": _money("by_region", "region, order_count"),
    "top_products": _money("top", "product_id, product_name, category_name, units_sold"),
    "customer_rfm": """
        SELECT * REPLACE (cast(monetary_total AS double) AS monetary_total) FROM rfm""",
    "customer_churn": "SELECT * FROM churn",
    "churn_threshold_90": "SELECT * FROM churn_90",
    "churn_summary": "SELECT * FROM summary",
    "customer_activity_export": _ACTIVITY_EXPORT,
    "kpi_sales": f"""
        SELECT cast(revenue AS double) AS total_revenue, cast(orders AS bigint) AS total_orders,
               months, {_ratio('revenue', 'orders', 2)} AS avg_order_value
        FROM (SELECT sum(total_revenue) AS revenue, sum(order_count) AS orders, count(*) AS months
              FROM monthly)""",
    "kpi_churn": f"""
        SELECT *, {_ratio('churned_customers * 100', 'total_customers', 1)} AS churn_rate_pct
        FROM (SELECT count(*) AS total_customers,
                     count(*) FILTER (is_churned) AS churned_customers,
                     count(*) FILTER (customer_segment = 'At Risk') AS at_risk_customers,
                     count(*) FILTER (customer_segment = 'Active') AS active_customers
              FROM churn )""",
    "sales_mom": _MOM,
    "sales_latest_month": _money("monthly", "year_month, order_count, active_customers")
    + " ORDER BY year_month DESC LIMIT 1",
    "month_label": _money("monthly", "year_month, substring(year_month, 3, 5) AS month_label"),
    "category_share_of_max": _share("by_category", "category_name, units_sold"),
    "region_share_of_max": _share("by_region", "region, order_count"),
    "product_share_of_max": _share("top", "product_id, product_name, category_name, units_sold"),
    "month_share_of_max": """
        SELECT year_month, order_count, active_customers,
               cast(total_revenue AS double) AS total_revenue,
               cast(total_revenue AS double)
               / (SELECT max(cast(total_revenue AS double)) FROM monthly) AS fraction_of_max
        FROM monthly""",
    "churn_share_of_max": f"""
        SELECT region, total_customers, churned_customers, churn_rate_pct,
               {_ratio('tenths * 100', 'whole', 1)} AS share_of_max_pct
        FROM (SELECT *, max(tenths) OVER () AS whole
              FROM (SELECT *, cast(round(churn_rate_pct * 10) AS bigint) AS tenths FROM summary))""",
    "top_products_ranked": _money(
        "top",
        "product_id, product_name, category_name, units_sold, "
        "cast(row_number() OVER (ORDER BY top.total_revenue DESC, product_id) AS integer) AS rank",
    ),
    "roster_at_risk": """
        SELECT customer_id, company_name, region, frequency_orders, monetary_total, recency_days,
               customer_segment
        FROM churn WHERE customer_segment = 'At Risk'""",
    "export_csv": "SELECT * FROM churn",
    "export_json": _feed(),
    "gzip_scan": """
        SELECT s_suppkey AS "SupplierID", s_name AS "CompanyName", n_name AS "Country"
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "replaced_table": """
        SELECT *, (SELECT count(*) FROM s_customers ) AS rows_written FROM s_customers""",
    "appended_load": """
        SELECT s_suppkey AS supplier_id, s_name AS supplier_name, n_name AS supplier_country,
               CASE WHEN s_suppkey % 2 = 0 THEN 'first' ELSE 'second' END AS "_source_system"
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "raw_json_view": """
        SELECT p_partkey AS "ProductID", p_name AS "ProductName",
               cast(split_part(p_brand, '#', 2) AS bigint) AS "CategoryID", s.supplier_id AS "SupplierID",
               p_retailprice AS "UnitPrice", 'object_store' AS "_source_system"
        FROM part LEFT JOIN source s ON p_partkey = s.l_partkey""",
    "ledger_load": """
        SELECT s_suppkey AS supplier_id, s_name AS supplier_name, n_name AS supplier_country,
               'object_store' AS "_source_system", cast(0 AS bigint) AS rows_again,
               (SELECT count(*) FROM supplier WHERE s_suppkey % 2 = 1) AS rows_added
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "rejected_records": """
        SELECT CASE WHEN good THEN c_custkey END AS customer_id, CASE WHEN good THEN c_name END AS company_name,
               CASE WHEN c_custkey % 7 = 0 THEN 'no.' || c_custkey || ',' || c_name
                    WHEN NOT good THEN c_custkey || ',' || c_name || ',too,many' END AS record
        FROM (SELECT *, c_custkey % 7 <> 0 AND c_custkey % 11 <> 0 AS good FROM customer)""",
    "gold_run": " UNION ALL ".join([_feed(), *_extremes()]),
    "layer_row_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {step}"
        for name, step in _COUNTED.items()
    ),
}


def all_oracles() -> dict[str, str]:
    return {name: _with(final) for name, final in _FINAL.items()}
