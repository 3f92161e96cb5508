"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The SQL restates each query over the raw test tables with the same numeric
rules as ``functions.numeric``: exact decimal money, sums cast to double at
the edge, ratios pinned through decimal(20,6).  Shared CTEs rebuild the star
exactly as ``sources.star`` maps it.
"""

from __future__ import annotations

from starkpi.functions.numeric import sql_pct as _pct
from starkpi.functions.numeric import sql_ratio as _ratio
from starkpi.plans import dirty

STAR_CTES = """
product AS (
  SELECT CAST(p_partkey AS BIGINT) AS product_id, p_name AS product_name, p_type AS category,
         p_brand AS sub_category, CAST(p_retailprice AS DECIMAL(10,2)) AS unit_cost
  FROM part),
cust AS (
  SELECT CAST(c.c_custkey AS BIGINT) AS customer_id, c.c_name AS customer_name, c.c_mktsegment AS segment,
         n.n_name AS country, r.r_name AS region
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
                  JOIN region r ON n.n_regionkey = r.r_regionkey),
lines AS (
  SELECT l.l_orderkey AS order_id, CAST(l.l_linenumber AS INTEGER) AS line_number,
         l.l_partkey AS product_id, l.l_suppkey AS supplier_id, o.o_custkey AS customer_id,
         CAST(o.o_orderdate AS DATE) AS order_date, CAST(l.l_shipdate AS DATE) AS ship_date,
         CAST(l.l_quantity AS INTEGER) AS quantity,
         CAST(ROUND(CAST(l.l_extendedprice / NULLIF(l.l_quantity, 0) AS DECIMAL(20,6)), 2) AS DECIMAL(18,2)) AS unit_price,
         CAST(l.l_discount AS DECIMAL(4,2)) AS discount,
         CAST(ROUND(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))), 2)
              AS DECIMAL(18,2)) AS sales_amount
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
fact AS (
  SELECT ln.*, CAST(ROUND(ln.sales_amount - ln.quantity * p.unit_cost, 2) AS DECIMAL(18,2)) AS profit
  FROM lines ln JOIN product p ON ln.product_id = p.product_id),
cal_bounds AS (
  SELECT make_date(CAST(year(min(CAST(o_orderdate AS DATE))) AS INTEGER), 1, 1) AS lo,
         make_date(CAST(year(max(CAST(o_orderdate AS DATE))) AS INTEGER) + 1, 1, 1) AS hi
  FROM orders),
dim_date AS (
  SELECT CAST(d AS DATE) AS date_id, CAST(day(d) AS INTEGER) AS day, CAST(month(d) AS INTEGER) AS month,
         monthname(d) AS month_name, CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
         CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
  FROM (SELECT unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP) - INTERVAL 1 DAY,
                                      INTERVAL 1 DAY)) AS d FROM cal_bounds))
"""


def with_star(body: str) -> str:
    body = body.strip()
    sep = "\n" if body.upper().startswith("SELECT") else ",\n"
    return "WITH " + STAR_CTES.strip() + sep + body


def _m(x: str) -> str:
    return f"CAST(ROUND({x}, 2) AS DOUBLE)"


# Registered filter of the dashboard queries (see catalog.DASH_FILTER).
FLT_DATES = "f.order_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'"
FLT_CATS = "p.category IN ('ECONOMY', 'PROMO')"
FLT_CTRY = "c.country IN ('NATION_0', 'NATION_1', 'NATION_2', 'NATION_3', 'NATION_4')"
BENCH_RANGE = "f.order_date BETWEEN DATE '1996-06-01' AND DATE '1996-06-30'"
PRODUCT_TOTALS = """ptot AS (
  SELECT p.product_name, p.category, p.sub_category, SUM(f.sales_amount) AS rev, SUM(f.profit) AS pro,
         CAST(SUM(f.quantity) AS BIGINT) AS units_sold
  FROM fact f JOIN product p ON f.product_id = p.product_id
  GROUP BY p.product_name, p.category, p.sub_category)"""
PRODUCT_PERF = PRODUCT_TOTALS + """,
pperf AS (
  SELECT product_name, category, sub_category, CAST(ROUND(rev, 2) AS DOUBLE) AS total_revenue,
         CAST(ROUND(pro, 2) AS DOUBLE) AS total_profit, units_sold,
         CAST(RANK() OVER (ORDER BY rev DESC) AS INTEGER) AS revenue_rank
  FROM ptot)"""
MONTHLY = """monthly AS (
  SELECT d.year, d.month, d.month_name, SUM(f.sales_amount) AS rev, SUM(f.profit) AS pro,
         COUNT(DISTINCT f.order_id) AS order_count
  FROM fact f JOIN dim_date d ON f.order_date = d.date_id
  GROUP BY d.year, d.month, d.month_name)"""
RFM = """rfm AS (
  SELECT c.customer_id, c.customer_name, c.segment, MAX(f.order_date) AS last_order_date,
         COUNT(DISTINCT f.order_id) AS frequency, CAST(ROUND(SUM(f.sales_amount), 2) AS DOUBLE) AS monetary_value
  FROM fact f JOIN cust c ON f.customer_id = c.customer_id
  GROUP BY c.customer_id, c.customer_name, c.segment)"""
SALES = "fact f JOIN product p ON f.product_id = p.product_id JOIN cust c ON f.customer_id = c.customer_id"
DASH_WHERE = f"WHERE {FLT_CATS} AND {FLT_CTRY} AND {FLT_DATES}"


ORACLE: dict[str, str] = {
    "kpi_summary": with_star(f"""
agg AS (SELECT SUM(sales_amount) AS rev, SUM(profit) AS pro, COUNT(DISTINCT order_id) AS total_orders FROM fact)
SELECT {_m('rev')} AS total_revenue, {_m('pro')} AS total_profit, {_pct('pro', 'rev')} AS margin_pct,
       total_orders, {_ratio('rev', 'total_orders')} AS avg_order_value FROM agg"""),

    "monthly_revenue": with_star(MONTHLY + f"""
SELECT year, month, month_name, {_m('rev')} AS total_revenue, {_m('pro')} AS total_profit, order_count
FROM monthly ORDER BY year, month"""),

    "product_performance": with_star(PRODUCT_PERF + """
SELECT * FROM pperf ORDER BY total_revenue DESC"""),

    "category_performance": with_star(f"""
cat AS (SELECT p.category, SUM(f.sales_amount) AS rev, SUM(f.profit) AS pro, COUNT(DISTINCT f.order_id) AS order_count
        FROM fact f JOIN product p ON f.product_id = p.product_id GROUP BY p.category)
SELECT category, {_m('rev')} AS total_revenue, {_m('pro')} AS total_profit, {_pct('pro', 'rev')} AS margin_pct,
       order_count FROM cat ORDER BY total_revenue DESC"""),

    "regional_performance": with_star(f"""
reg AS (SELECT c.region, c.country, SUM(f.sales_amount) AS rev, COUNT(DISTINCT f.order_id) AS order_count
        FROM fact f JOIN cust c ON f.customer_id = c.customer_id GROUP BY c.region, c.country)
SELECT region, country, {_m('rev')} AS total_revenue, order_count, {_ratio('rev', 'order_count')} AS avg_order_value
FROM reg ORDER BY total_revenue DESC"""),

    "customer_rfm": with_star(RFM + """
SELECT * FROM rfm ORDER BY monetary_value DESC"""),

    "top_products": with_star(PRODUCT_PERF + """
SELECT * FROM pperf ORDER BY total_revenue DESC, product_name, category, sub_category LIMIT 10"""),

    "top_customers_rfm": with_star(RFM + """
SELECT * FROM rfm ORDER BY monetary_value DESC, customer_id LIMIT 10"""),

    "last_months": with_star(MONTHLY + f"""
SELECT year, month, month_name, {_m('rev')} AS total_revenue, {_m('pro')} AS total_profit, order_count
FROM monthly ORDER BY year DESC, month DESC LIMIT 6"""),

    "top_margin_products": with_star(PRODUCT_PERF + f"""
SELECT *, {_pct('total_profit', 'total_revenue')} AS margin_pct FROM pperf
ORDER BY margin_pct DESC NULLS LAST, product_name, category, sub_category LIMIT 10"""),

    "category_share": with_star(f"""
cat AS (SELECT p.category, SUM(f.sales_amount) AS rev FROM fact f JOIN product p ON f.product_id = p.product_id
        GROUP BY p.category)
SELECT category, {_m('rev')} AS total_revenue, {_pct('rev', '(SELECT SUM(rev) FROM cat)')} AS share_pct FROM cat"""),

    "country_share": with_star(f"""
ctry AS (SELECT c.country, SUM(f.sales_amount) AS rev FROM fact f JOIN cust c ON f.customer_id = c.customer_id
         WHERE {FLT_CTRY} AND {FLT_DATES} GROUP BY c.country)
SELECT country, {_m('rev')} AS revenue, {_pct('rev', '(SELECT SUM(rev) FROM ctry)')} AS share_pct FROM ctry"""),

    "product_pareto": with_star(PRODUCT_TOTALS + f""",
run AS (SELECT *, CAST(RANK() OVER (ORDER BY rev DESC) AS INTEGER) AS revenue_rank,
               SUM(rev) OVER (ORDER BY rev DESC, product_name, category, sub_category
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run_rev
        FROM ptot)
SELECT product_name, category, sub_category, {_m('rev')} AS total_revenue, revenue_rank,
       {_m('run_rev')} AS running_revenue, {_pct('run_rev', '(SELECT SUM(rev) FROM ptot)')} AS cumulative_pct
FROM run"""),

    "weekend_revenue": with_star(f"""
wk AS (SELECT EXTRACT(year FROM order_date) AS year, EXTRACT(month FROM order_date) AS month,
              SUM(sales_amount) AS rev, COUNT(DISTINCT order_id) AS order_count
       FROM fact WHERE EXTRACT(quarter FROM order_date) = 4 AND EXTRACT(isodow FROM order_date) >= 6 GROUP BY 1, 2)
SELECT CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month, {_m('rev')} AS total_revenue, order_count FROM wk"""),

    "monthly_growth": with_star(MONTHLY + f""",
m2 AS (SELECT year, month, rev, year * 12 + month AS idx FROM monthly)
SELECT a.year, a.month, {_m('a.rev')} AS total_revenue, {_m('b.rev')} AS prev_revenue,
       {_pct('a.rev - b.rev', 'b.rev')} AS mom_growth_pct
FROM m2 a LEFT JOIN m2 b ON b.idx = a.idx - 1"""),

    "yearly_growth": with_star(MONTHLY + f"""
SELECT a.year, a.month, {_m('a.rev')} AS total_revenue, {_m('b.rev')} AS prev_year_revenue,
       {_pct('a.rev - b.rev', 'b.rev')} AS yoy_growth_pct
FROM monthly a LEFT JOIN monthly b ON b.month = a.month AND b.year = a.year - 1"""),

    "dash_kpis": with_star(f"""
k AS (SELECT SUM(f.sales_amount) AS rev, SUM(f.profit) AS pro, COUNT(DISTINCT f.order_id) AS total_orders,
             COUNT(f.sales_amount) AS n
      FROM {SALES} {DASH_WHERE})
SELECT {_m('rev')} AS total_revenue, {_m('pro')} AS total_profit, total_orders,
       {_ratio('rev', 'n')} AS avg_order, {_pct('pro', 'rev')} AS avg_margin FROM k"""),

    "dash_daily_trend": with_star(f"""
SELECT f.order_date AS date, {_m('SUM(f.sales_amount)')} AS revenue, {_m('SUM(f.profit)')} AS profit
FROM {SALES} {DASH_WHERE} GROUP BY f.order_date ORDER BY date"""),

    "dash_categories": with_star(f"""
SELECT p.category, {_m('SUM(f.sales_amount)')} AS revenue
FROM {SALES} {DASH_WHERE} GROUP BY p.category ORDER BY revenue DESC"""),

    "dash_top_products": with_star(f"""
SELECT p.product_name, {_m('SUM(f.sales_amount)')} AS revenue, COUNT(*) AS orders
FROM {SALES} {DASH_WHERE} GROUP BY p.product_name ORDER BY revenue DESC, product_name LIMIT 10"""),

    "dash_countries": with_star(f"""
SELECT c.country, {_m('SUM(f.sales_amount)')} AS revenue, COUNT(*) AS orders
FROM fact f JOIN cust c ON f.customer_id = c.customer_id WHERE {FLT_CTRY} AND {FLT_DATES}
GROUP BY c.country ORDER BY revenue DESC"""),

    "dash_top_customers": with_star(f"""
SELECT c.customer_name, c.segment, {_m('SUM(f.sales_amount)')} AS lifetime_value, COUNT(*) AS order_count,
       MAX(f.order_date) AS last_order
FROM fact f JOIN cust c ON f.customer_id = c.customer_id WHERE {FLT_CTRY} AND {FLT_DATES}
GROUP BY c.customer_name, c.segment ORDER BY lifetime_value DESC, customer_name, segment LIMIT 15"""),
}

_EXPLORE_SALES = f"""
shown AS (
  SELECT f.order_date, p.product_name, c.customer_name, f.quantity, f.sales_amount, f.profit
  FROM {SALES} {DASH_WHERE}
  ORDER BY f.order_date DESC, f.order_id, f.line_number, f.product_id, f.supplier_id, f.ship_date,
           f.quantity, f.sales_amount
  LIMIT 100)"""

ORACLE.update({
    "explore_sales": with_star(_EXPLORE_SALES + f"""
SELECT order_date, product_name, customer_name, quantity, {_m('sales_amount')} AS sales_amount,
       {_m('profit')} AS profit,
       CASE WHEN sales_amount = 0 THEN 0.0 ELSE {_ratio('profit', 'sales_amount', 1, 100.0)} END AS margin_pct
FROM shown"""),

    "explore_sales_totals": with_star(_EXPLORE_SALES + f"""
SELECT COUNT(*) AS records, {_m('SUM(sales_amount)')} AS total_revenue, {_m('SUM(profit)')} AS total_profit
FROM shown"""),

    "explore_customers": with_star(f"""
g AS (SELECT c.customer_name, c.segment, c.country, COUNT(DISTINCT f.order_id) AS total_orders,
             SUM(f.sales_amount) AS rev, COUNT(f.sales_amount) AS n, MAX(f.order_date) AS last_purchase
      FROM cust c LEFT JOIN fact f ON c.customer_id = f.customer_id
      WHERE {FLT_CTRY}
      GROUP BY c.customer_name, c.segment, c.country)
SELECT customer_name, segment, country, total_orders, {_m('rev')} AS total_spent,
       {_ratio('rev', 'n')} AS avg_order, last_purchase
FROM g ORDER BY total_spent DESC NULLS LAST, customer_name, segment, country LIMIT 100"""),

    "explore_products": with_star(f"""
g AS (SELECT p.product_name, p.category, p.unit_cost, COUNT(*) AS times_sold,
             CAST(SUM(f.quantity) AS BIGINT) AS units_sold, SUM(f.sales_amount) AS rev, SUM(f.profit) AS pro
      FROM product p LEFT JOIN fact f ON p.product_id = f.product_id
      WHERE {FLT_CATS}
      GROUP BY p.product_name, p.category, p.unit_cost)
SELECT product_name, category, CAST(unit_cost AS DOUBLE) AS unit_price, times_sold, units_sold,
       {_m('rev')} AS total_revenue,
       COALESCE({_ratio('pro', 'rev', 1, 100.0)}, 0.0) AS avg_margin
FROM g ORDER BY total_revenue DESC NULLS LAST"""),

    "bench_month_product": with_star(f"""
SELECT p.product_name, p.category, {_m('SUM(f.sales_amount)')} AS revenue, {_m('SUM(f.profit)')} AS profit,
       COUNT(*) AS line_items
FROM fact f JOIN product p ON f.product_id = p.product_id WHERE {BENCH_RANGE}
GROUP BY p.product_name, p.category ORDER BY revenue DESC"""),

    "product_lookup": with_star("""
SELECT CAST(unit_cost AS DOUBLE) AS unit_cost, category FROM product WHERE product_id = 42"""),

    "bound_product_lookup": with_star("""
SELECT CAST(unit_cost AS DOUBLE) AS unit_cost, category FROM product WHERE product_id = 42"""),
    "order_lookup": with_star(f"""
SELECT order_id, line_number, CAST(order_date AS VARCHAR) AS order_date, customer_id, product_id, quantity,
       {_m('sales_amount')} AS sales_amount, {_m('profit')} AS profit FROM fact WHERE order_id = 7"""),
    "customer_lookup": with_star(f"""
SELECT order_id, line_number, CAST(order_date AS VARCHAR) AS order_date, customer_id, product_id, quantity,
       {_m('sales_amount')} AS sales_amount, {_m('profit')} AS profit FROM fact WHERE customer_id = 10"""),
    "distinct_categories": with_star("SELECT DISTINCT category FROM product ORDER BY category"),
    "distinct_countries": with_star("SELECT DISTINCT country FROM cust ORDER BY country"),
    "pick_list_products": with_star("SELECT product_id, product_name FROM product ORDER BY product_name"),
    "pick_list_customers": with_star("SELECT customer_id, customer_name FROM cust ORDER BY customer_name"),
})

# ---- cleaning, quality and line-level queries ---------------------------

_FACT_COLS = ["order_id", "line_number", "product_id", "supplier_id", "customer_id", "order_date",
              "ship_date", "quantity", "unit_price", "discount", "sales_amount", "profit"]
_MONEY = {"unit_price", "discount", "sales_amount", "profit", "unit_cost"}
_LINE_FIRST = ["product_id", "supplier_id", "customer_id", "order_date", "ship_date", "quantity",
               "unit_price", "discount", "sales_amount", "profit"]


def _out_cols(cols, alias=""):
    pre = f"{alias}." if alias else ""
    return ", ".join(f"CAST({pre}{c} AS DOUBLE) AS {c}" if c in _MONEY else f"{pre}{c}" for c in cols)


_DEDUP = ("dedup AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY order_id, line_number "
          "ORDER BY " + ", ".join(f"{c} NULLS FIRST" for c in _LINE_FIRST) + ") AS rn FROM fact) WHERE rn = 1)")
_NOT_NULL = ("req AS (SELECT * FROM dedup WHERE order_date IS NOT NULL AND customer_id IS NOT NULL "
             "AND product_id IS NOT NULL AND quantity IS NOT NULL AND unit_price IS NOT NULL)")
_VALID = "valid AS (SELECT * FROM req WHERE quantity > 0 AND unit_price > 0)"
_RECOMPUTE = ("CAST(ROUND(CAST(quantity AS DECIMAL(10,0)) * unit_price * (1 - discount), 2) AS DECIMAL(18,2))")

_TABLE_COLS = {
    "fact_sales": ("fact", _FACT_COLS),
    "dim_product": ("product", ["product_id", "product_name", "category", "sub_category", "unit_cost"]),
    "dim_customer": ("cust", ["customer_id", "customer_name", "segment", "country", "region"]),
    "dim_date": ("dim_date", ["date_id", "day", "month", "month_name", "quarter", "year", "is_weekend"]),
}

_NULL_SQL = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS null_count FROM {v}"
    for t, (v, cols) in _TABLE_COLS.items() for c in cols)

_DUP_KEYS = {"fact_sales": ["order_id", "line_number"], "dim_product": ["product_id"],
             "dim_customer": ["customer_id"], "dim_date": ["date_id"]}
_DUP_SQL = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, "
    f"concat_ws('|', {', '.join(f"COALESCE(CAST({k} AS VARCHAR), 'NULL')" for k in ks)}) AS key_value, "
    f"COUNT(*) AS copies FROM {_TABLE_COLS[t][0]} GROUP BY {', '.join(ks)} HAVING COUNT(*) > 1"
    for t, ks in _DUP_KEYS.items())

_ORPHAN_SQL = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS check_name, COUNT(*) AS orphan_rows FROM lines l "
    f"WHERE NOT EXISTS (SELECT 1 FROM {parent} x WHERE x.{pk} = l.{fk})"
    for name, parent, pk, fk in [
        ("fact_sales.order_date -> dim_date", "dim_date", "date_id", "order_date"),
        ("fact_sales.customer_id -> dim_customer", "cust", "customer_id", "customer_id"),
        ("fact_sales.product_id -> dim_product", "product", "product_id", "product_id")])


def _currency(x: str, d: int) -> str:
    return f"'$' || format('{{:,.{d}f}}', CAST({x} AS DOUBLE))"


ORACLE.update({
    "clean_dedup": with_star(_DEDUP + f"\nSELECT {_out_cols(_FACT_COLS)} FROM dedup"),

    "recompute_sales_amount": with_star(f"""
SELECT order_id, line_number, product_id, supplier_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(discount AS DOUBLE) AS discount, CAST({_RECOMPUTE} AS DOUBLE) AS sales_amount FROM fact"""),

    "clean_report": with_star(",\n".join([_DEDUP, _NOT_NULL, _VALID]) + """
SELECT (SELECT COUNT(*) FROM fact) AS rows_before, (SELECT COUNT(*) FROM dedup) AS rows_after_dedup,
       (SELECT COUNT(*) FROM req) AS rows_after_not_null, (SELECT COUNT(*) FROM valid) AS rows_after,
       (SELECT COUNT(*) FROM fact) - (SELECT COUNT(*) FROM valid) AS rows_dropped"""),

    "clean_fact": with_star(",\n".join([_DEDUP, _NOT_NULL, _VALID]) + f""",
rec AS (SELECT * REPLACE ({_RECOMPUTE} AS sales_amount) FROM valid)
SELECT {_out_cols(_FACT_COLS)} FROM rec"""),

    "clean_dimension": with_star("""
d AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY
        product_name NULLS FIRST, category NULLS FIRST, sub_category NULLS FIRST, unit_cost NULLS FIRST) AS rn
      FROM product) WHERE rn = 1 AND product_id IS NOT NULL)
SELECT product_id, product_name, category, sub_category, CAST(unit_cost AS DOUBLE) AS unit_cost FROM d"""),

    "dq_not_null": with_star(_NULL_SQL),
    "dq_duplicate_keys": with_star(_DUP_SQL),
    "dq_orphans": with_star(_ORPHAN_SQL),

    "calendar": with_star("SELECT * FROM dim_date ORDER BY date_id"),

    "line_pricing": with_star(f"""
lp AS (SELECT f.*, p.unit_cost, {_RECOMPUTE.replace('quantity', 'f.quantity').replace('unit_price', 'f.unit_price')
                                  .replace('discount', 'f.discount')} AS sa
       FROM fact f JOIN product p ON f.product_id = p.product_id)
SELECT order_id, line_number, product_id, supplier_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(discount AS DOUBLE) AS discount, CAST(sa AS DOUBLE) AS sales_amount,
       CAST(ROUND(sa - quantity * unit_cost, 2) AS DOUBLE) AS profit FROM lp"""),

    "ship_lag": with_star("""
SELECT CAST(date_diff('day', order_date, ship_date) AS INTEGER) AS lag_days, COUNT(*) AS lines
FROM fact GROUP BY 1 ORDER BY 1"""),

    "ship_dates": with_star("""
SELECT order_id, line_number, product_id, supplier_id, quantity,
       CAST(order_date + CAST(quantity % 7 + 1 AS INTEGER) AS VARCHAR) AS ship_date FROM fact"""),
    "manual_order_ids": with_star("""
SELECT DISTINCT CAST(order_date AS VARCHAR) AS order_date,
       'ORD' || CAST(epoch(order_date) AS BIGINT) AS order_id FROM fact"""),
    "orders_by_period": with_star("""
SELECT CAST(year(order_date) AS VARCHAR) AS period, COUNT(DISTINCT order_id) AS order_count FROM fact GROUP BY ALL
UNION ALL SELECT 'all', COUNT(DISTINCT order_id) FROM fact"""),
    "default_filter_countries": with_star(f"""
SELECT c.country, {_m('SUM(f.sales_amount)')} AS revenue, COUNT(*) AS orders
FROM fact f JOIN cust c ON f.customer_id = c.customer_id
WHERE c.country IN (SELECT country FROM cust GROUP BY country ORDER BY country LIMIT 5)
  AND f.order_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'
GROUP BY c.country ORDER BY revenue DESC"""),
    "order_label": with_star("""
SELECT order_id, printf('ORD-%06d', order_id) AS order_label FROM (SELECT DISTINCT order_id FROM fact)"""),

    "manual_sale_pricing": with_star("""
mp AS (SELECT product_id, CAST(ROUND(unit_cost * CAST(1.5 AS DECIMAL(2,1)), 2) AS DECIMAL(18,2)) AS up FROM product)
SELECT product_id, CAST(up AS DOUBLE) AS unit_price, 1 AS quantity, CAST(up AS DOUBLE) AS revenue,
       CAST(ROUND(up * 40 / 100, 2) AS DOUBLE) AS profit FROM mp"""),

    "monthly_series": with_star(MONTHLY + f"""
SELECT printf('%04d-%02d', year, month) AS month_label, year, month, {_m('rev')} AS total_revenue,
       {_m('pro')} AS total_profit FROM monthly"""),

    "kpi_cards": with_star(f"""
k AS (SELECT SUM(f.sales_amount) AS rev, SUM(f.profit) AS pro, COUNT(DISTINCT f.order_id) AS total_orders,
             COUNT(f.sales_amount) AS n
      FROM {SALES} {DASH_WHERE}),
v AS (SELECT {_m('rev')} AS total_revenue, {_m('pro')} AS total_profit, total_orders,
             {_ratio('rev', 'n')} AS avg_order, {_pct('pro', 'rev')} AS avg_margin FROM k)
SELECT {_currency('total_revenue', 0)} AS revenue_card, {_currency('total_profit', 0)} AS profit_card,
       format('{{:,.0f}}', CAST(total_orders AS DOUBLE)) AS orders_card,
       {_currency('avg_order', 2)} AS avg_order_card,
       format('{{:.1f}}', avg_margin) || '%' AS margin_card FROM v"""),

    "table_status": with_star("""
SELECT 'fact_sales' AS table_name, COUNT(*) AS row_count FROM fact
UNION ALL SELECT 'dim_product', COUNT(*) FROM product
UNION ALL SELECT 'dim_customer', COUNT(*) FROM cust
UNION ALL SELECT 'dim_date', COUNT(*) FROM dim_date"""),

    "filtered_lines": with_star(f"""
SELECT f.order_id, f.line_number, f.order_date, p.product_name, p.category, c.customer_name, c.country,
       f.quantity, CAST(f.sales_amount AS DOUBLE) AS sales_amount, CAST(f.profit AS DOUBLE) AS profit
FROM {SALES} {DASH_WHERE}"""),

    "star_join": with_star(f"""
SELECT {_out_cols(_FACT_COLS, 'f')}, p.product_name, p.category, p.sub_category,
       CAST(p.unit_cost AS DOUBLE) AS unit_cost, c.customer_name, c.segment, c.country, c.region
FROM {SALES}"""),
})


ORACLE.update({
    "page_products": with_star(PRODUCT_PERF + """
SELECT product_name, category, sub_category, total_revenue, total_profit, units_sold FROM pperf
ORDER BY total_revenue DESC, product_name, category, sub_category LIMIT 10"""),
    "page_customers": with_star(RFM + """
SELECT * FROM rfm ORDER BY monetary_value DESC, customer_id LIMIT 100"""),
})

# Date columns leave as ISO text (yyyy-MM-dd) in both engines, the source
# system's own representation of dates.
DATE_COLUMNS = {
    "customer_rfm": ["last_order_date"], "top_customers_rfm": ["last_order_date"],
    "dash_daily_trend": ["date"], "dash_top_customers": ["last_order"],
    "explore_sales": ["order_date"], "explore_customers": ["last_purchase"],
    "clean_dedup": ["order_date", "ship_date"], "clean_fact": ["order_date", "ship_date"],
    "calendar": ["date_id"], "filtered_lines": ["order_date"],
    "star_join": ["order_date", "ship_date"], "page_customers": ["last_order_date"],
}
for _name, _cols in DATE_COLUMNS.items():
    _repl = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _cols)
    ORACLE[_name] = f"SELECT * REPLACE ({_repl}) FROM (\n{ORACLE[_name]}\n) AS q"

# ---- the same queries over the dirtied star (plans.dirty) -------------------

_RAW = STAR_CTES.strip()

def _dirty_ctes() -> str:
    raw = _RAW
    for name in ("product", "cust", "fact", "dim_date"):
        raw = raw.replace(f"{name} AS (", f"{name}_raw AS (", 1)
    raw = raw.replace("JOIN product p", "JOIN product_raw p")

    def hit(col, rule):
        return f"{col} % {rule[0]} = {rule[1]}"

    def dim(name, key, label, rest):
        parts = [f"SELECT {key}, {label}, {rest} FROM {name}_raw"]
        for rule, new_key, prefix in ((dirty.UNSOLD, f"{key} + {dirty.UNSOLD_SHIFT}", "IDLE "), (dirty.TWICE, key, "COPY "),
                                      (dirty.NO_KEY, "NULL", "LOST ")):
            parts.append(f"SELECT CAST({new_key} AS BIGINT), '{prefix}' || {label}, {rest} FROM {name}_raw WHERE {hit(key, rule)}")
        return f"{name} AS (" + " UNION ALL ".join(parts) + ")"

    def null_if(col, rule, value=None):
        return f"CASE WHEN {hit('order_id', rule)} THEN NULL ELSE {value or col} END AS {col}"

    def shifted(col, rule):
        return f"CASE WHEN {hit('order_id', rule)} THEN {col} + {dirty.ORPHAN_SHIFT} ELSE {col} END"

    return raw + f""",
{dim("product", "product_id", "product_name", "category, sub_category, unit_cost")},
{dim("cust", "customer_id", "customer_name", "segment, country, region")},
dim_date AS (SELECT * FROM dim_date_raw WHERE date_id < DATE '{dirty.CALENDAR_END}'),
fact_changed AS (SELECT * REPLACE (
  {null_if("line_number", dirty.NULL_LINE_NUMBER)},
  {null_if("product_id", dirty.NULL_PRODUCT, shifted("product_id", dirty.ORPHAN_PRODUCT))},
  {null_if("customer_id", dirty.NULL_CUSTOMER, shifted("customer_id", dirty.ORPHAN_CUSTOMER))},
  CASE WHEN {hit("order_id", dirty.ZERO_QUANTITY)} THEN 0 ELSE quantity END AS quantity,
  {null_if("unit_price", dirty.NULL_PRICE)},
  {null_if("discount", dirty.NULL_DISCOUNT)}) FROM fact_raw),
fact AS (SELECT * FROM fact_changed UNION ALL
         SELECT * REPLACE (quantity + 1 AS quantity) FROM fact_changed WHERE {hit("order_id", dirty.SECOND_COPY)})"""


# views from monthly rollups give the rows of the views
_VIEWS = ("kpi_summary", "monthly_revenue", "product_performance", "category_performance", "regional_performance", "customer_rfm")
ORACLE.update({f"rollup_{_name}": ORACLE[_name] for _name in _VIEWS})

for _name in ("monthly_revenue", "clean_dedup", "clean_report", "clean_fact", "clean_dimension", "dq_not_null",
              "dq_duplicate_keys", "dq_orphans", "explore_customers", "explore_products",
              *(f"rollup_{_view}" for _view in _VIEWS)):
    # orphans are looked for among the facts themselves
    ORACLE[f"dirty_{_name}"] = ORACLE[_name].replace(_RAW, _dirty_ctes()).replace("FROM lines l WHERE", "FROM fact l WHERE")
    if _name in dirty.TEXT_COLUMNS:
        _repl = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in dirty.TEXT_COLUMNS[_name])
        ORACLE[f"dirty_{_name}"] = f"SELECT * REPLACE ({_repl}) FROM (\n{ORACLE[f'dirty_{_name}']}\n) AS q"
