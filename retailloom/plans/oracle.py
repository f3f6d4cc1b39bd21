"""DuckDB SQL with the same result as each registered query, over the same Parquet tables."""

from __future__ import annotations

TXN = "concat('L', l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey)"

VIEWS = {
    "product": """
        SELECT concat('P', p_partkey) AS product_id, p_name AS product_name, p_retailprice AS unit_cost,
               p_size * 4 AS reorder_level
        FROM part""",
    "retail_customer": """
        SELECT concat('C', c_custkey) AS customer_id, c_name AS customer_name, c_mktsegment AS segment,
               r_name AS region
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "erp": f"""
        SELECT {TXN} AS txn_id, concat('INV', l_orderkey) AS invoice_id, concat('P', l_partkey) AS product_id,
               CASE WHEN l_linestatus = 'F' THEN s_name END AS store_id, r_name AS region,
               CAST(l_quantity AS INT) AS qty, round(l_extendedprice * (1 - l_discount), 0) AS revenue,
               round(l_quantity * p_retailprice, 0) AS cost,
               CASE WHEN l_linestatus = 'F' THEN 'offline' ELSE 'online' END AS channel,
               CAST(l_shipdate AS DATE) AS txn_date, CAST(month(l_shipdate) AS INT) AS month
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
             JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "pos": f"""
        SELECT {TXN} AS txn_id, concat('INV', l_orderkey) AS invoice_id, concat('P', l_partkey) AS product_id,
               s_name AS store_id, r_name AS region, CAST(l_quantity AS INT) AS qty,
               round(l_extendedprice * (1 - l_discount), 0) AS revenue,
               CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS promotion, CAST(l_shipdate AS DATE) AS txn_date
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey
        WHERE l_linestatus = 'F'""",
    "ecom": f"""
        SELECT {TXN} AS txn_id, concat('C', o_custkey) AS customer_id, r_name AS region,
               concat('P', l_partkey) AS product_id, CAST(l_quantity AS INT) AS qty, round(l_extendedprice * (1 - l_discount), 0) AS revenue,
               o_orderstatus AS device, o_orderpriority AS payment_method, CAST(l_shipdate AS DATE) AS txn_date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
             JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        WHERE l_linestatus = 'O'""",
    "movement": """
        SELECT concat('P', p_partkey) AS product_id, 'opening' AS kind, p_size * 10 AS qty,
               round(p_size * 10 * p_retailprice, 0) AS cost, CAST(NULL AS DATE) AS moved_on
        FROM part
        UNION ALL
        SELECT concat('P', l_partkey), CASE WHEN l_returnflag = 'R' THEN 'inbound' ELSE 'outbound' END,
               CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS INT) ELSE -CAST(l_quantity AS INT) END,
               round(l_extendedprice, 0), CAST(l_shipdate AS DATE)
        FROM lineitem""",
    "stock": """
        SELECT product_id, CAST(sum(qty) AS BIGINT) AS stock_qty FROM movement GROUP BY product_id""",
    "inventory": """
        SELECT s.product_id, p.product_name, s.stock_qty, p.reorder_level, p.unit_cost,
               round(s.stock_qty * p.unit_cost, 0) AS stock_value
        FROM stock s LEFT JOIN product p ON s.product_id = p.product_id""",
    "snapshots": """
        SELECT m.product_id, p.product_name, m.stock_qty, p.reorder_level, p.unit_cost,
               round(m.stock_qty * p.unit_cost, 0) AS stock_value, m.snapshot_date
        FROM (SELECT d.snapshot_date, product_id, CAST(sum(qty) AS BIGINT) AS stock_qty
              FROM movement JOIN (VALUES (DATE '1998-06-30'), (DATE '1999-12-31'), (DATE '2001-09-30'))
                   AS d(snapshot_date) ON moved_on IS NULL OR moved_on <= d.snapshot_date
              GROUP BY d.snapshot_date, product_id) m
             LEFT JOIN product p ON m.product_id = p.product_id""",
    "bound": "SELECT max(txn_date) AS d FROM erp",
    "all_days": """
        SELECT txn_date AS period, round(sum(revenue), 0) AS revenue, round(sum(revenue - cost), 0) AS profit,
               count(*) AS row_count
        FROM erp WHERE txn_date IS NOT NULL GROUP BY txn_date""",
    "days": "SELECT * FROM all_days WHERE period < (SELECT d FROM bound)",
    "weeks": """
        SELECT * FROM (
            SELECT CAST(date_trunc('week', period) AS DATE) AS period, sum(revenue) AS revenue,
                   sum(profit) AS profit, CAST(sum(row_count) AS BIGINT) AS row_count
            FROM days GROUP BY 1)
        WHERE period < (SELECT CAST(date_trunc('week', d) AS DATE) FROM bound)""",
    "months": """
        SELECT * FROM (
            SELECT CAST(date_trunc('month', period) AS DATE) AS period, sum(revenue) AS revenue,
                   sum(profit) AS profit, CAST(sum(row_count) AS BIGINT) AS row_count
            FROM days GROUP BY 1)
        WHERE period < (SELECT CAST(date_trunc('month', d) AS DATE) FROM bound)""",
    "quarters": """
        SELECT * FROM (
            SELECT CAST(date_trunc('quarter', period) AS DATE) AS period, sum(revenue) AS revenue,
                   sum(profit) AS profit, CAST(sum(row_count) AS BIGINT) AS row_count
            FROM months GROUP BY 1)
        WHERE period < (SELECT CAST(date_trunc('quarter', d) AS DATE) FROM bound)""",
    "years": """
        SELECT * FROM (
            SELECT CAST(date_trunc('year', period) AS DATE) AS period, sum(revenue) AS revenue,
                   sum(profit) AS profit, CAST(sum(row_count) AS BIGINT) AS row_count
            FROM months GROUP BY 1)
        WHERE period < (SELECT CAST(date_trunc('year', d) AS DATE) FROM bound)""",
    "demand": """
        SELECT product_id, round(avg(units), 1) AS monthly_demand
        FROM (SELECT product_id, month, sum(qty) AS units FROM erp GROUP BY product_id, month)
        GROUP BY product_id""",
    "monthly": """
        SELECT year(txn_date) AS year, month(txn_date) AS month, sum(revenue) AS revenue
        FROM erp WHERE cost IS NOT NULL GROUP BY 1, 2""",
    "indexed": """
        SELECT CAST(year AS INT) AS year, CAST(month AS INT) AS month,
               CAST((year - (SELECT min(year) FROM monthly)) * 12 + month AS INT) AS t, revenue
        FROM monthly""",
    "live": """
        SELECT concat('E', event_id) AS txn_id, concat('U', user_id) AS store_id, event_type AS region,
               value AS revenue, CAST(regexp_extract(props, '"k": *(-?[0-9.]+)', 1) AS DOUBLE) AS cost,
               value - CAST(regexp_extract(props, '"k": *(-?[0-9.]+)', 1) AS DOUBLE) AS profit
        FROM events WHERE regexp_matches(props, '"k": *-?[0-9]')""",
    "alerts": "SELECT * FROM live WHERE profit < -50",
    "fact": """
        SELECT txn_id, invoice_id, store_id, product_id, region, qty, revenue, cost, CAST(NULL AS INT) AS promotion,
               channel, CAST(NULL AS VARCHAR) AS customer_id, CAST(NULL AS VARCHAR) AS device,
               CAST(NULL AS VARCHAR) AS payment_method, txn_date, 'erp' AS source, month,
               CAST(year(txn_date) AS INT) AS year
        FROM erp
        UNION ALL
        SELECT txn_id, invoice_id, store_id, product_id, region, qty, revenue, NULL, promotion, 'offline', NULL, NULL,
               NULL, txn_date, 'pos', CAST(month(txn_date) AS INT), CAST(year(txn_date) AS INT)
        FROM pos
        UNION ALL
        SELECT txn_id, NULL, NULL, product_id, region, qty, revenue, NULL, NULL, 'online', customer_id, device,
               payment_method, txn_date, 'ecommerce', CAST(month(txn_date) AS INT), CAST(year(txn_date) AS INT)
        FROM ecom""",
}


def _with(sql: str, *views: str) -> str:
    """The query with the views it names, and those they name, in front."""
    needed = [name for name in VIEWS if name in views]
    return "WITH " + ",\n".join(f"{name} AS ({VIEWS[name]})" for name in needed) + "\n" + sql


def _mark(kind: str, column: str, prefix: str, view: str) -> str:
    number = f"max(CAST(substring({column}, {len(prefix) + 1}) AS BIGINT))"
    return (f"SELECT '{kind}' AS kind, {number} AS last_id, CAST(coalesce({number} + 1, 0) AS BIGINT) AS next_id "
            f"FROM {view} WHERE regexp_matches({column}, '^{prefix}[0-9]+$')")


def _read_twice(table: str, column: str) -> str:
    return (f"SELECT '{table}' AS table_name, 1 AS read_no, count(*) AS rows_read, max({column}) AS last_id FROM {table} "
            f"UNION ALL SELECT '{table}', 2, 0, max({column}) FROM {table}")


# Of several rows with one key the first by all other columns is kept, nulls last.
FACT_REST = ("invoice_id store_id product_id region qty revenue cost promotion channel customer_id device "
             "payment_method txn_date month year").split()
FACT_COLUMNS = ", ".join(["source", "txn_id", *FACT_REST])
FACT_ORDER = ", ".join(f"{name} NULLS LAST" for name in FACT_REST)
PERIOD_VIEWS = ("erp", "bound", "all_days", "days")
MEASURES = """
    sum(revenue) AS revenue, sum(cost) AS cost, sum(revenue - cost) AS profit, CAST(sum(qty) AS BIGINT) AS units,
    count(*) AS row_count, count(revenue) AS priced_rows"""
REGION_PROFIT = _with("""
    SELECT region, round(sum(revenue), 0) AS revenue, round(sum(revenue - cost), 0) AS profit
    FROM erp WHERE cost IS NOT NULL GROUP BY region ORDER BY profit DESC, region""", "erp")

ORACLE: dict[str, str] = {
    "region_profit": REGION_PROFIT,
    "region_profit_from_cube": REGION_PROFIT,
    "region_profit_presented": _with("""
        SELECT region, CAST(round(sum(revenue), 0) AS BIGINT) AS revenue,
               CAST(round(sum(revenue - cost), 0) AS BIGINT) AS profit
        FROM erp WHERE cost IS NOT NULL GROUP BY region""", "erp"),
    "ingested_cubes": _with(f"""
        , stored AS (
            SELECT {FACT_COLUMNS}
            FROM (SELECT *, row_number() OVER (PARTITION BY source, txn_id ORDER BY {FACT_ORDER}) AS rn FROM fact)
            WHERE rn = 1),
        books AS (SELECT * FROM stored WHERE source = 'erp'),
        orders_ AS (SELECT * FROM stored WHERE source = 'ecommerce'),
        by_product AS (
            SELECT product_id, round(sum(revenue), 0) AS revenue,
                   round(sum(revenue - cost) FILTER (WHERE cost IS NOT NULL), 0) AS profit,
                   count(cost) > 0 AS costed
            FROM books GROUP BY product_id)
        SELECT 'region_profit' AS report, coalesce(region, '') AS key, round(sum(revenue), 0) AS revenue,
               round(sum(revenue - cost), 0) AS profit
        FROM books WHERE cost IS NOT NULL GROUP BY region
        UNION ALL
        SELECT 'store_month_pnl', concat_ws('/', store_id, month), round(sum(revenue), 0),
               round(sum(revenue - cost), 0)
        FROM books WHERE channel = 'offline' AND cost IS NOT NULL GROUP BY store_id, month
        UNION ALL
        SELECT 'top_products_revenue', product_id, revenue, NULL
        FROM (SELECT * FROM by_product ORDER BY revenue DESC, product_id LIMIT 10)
        UNION ALL
        SELECT 'top_products_profit', product_id, NULL, profit
        FROM (SELECT * FROM by_product WHERE costed ORDER BY profit DESC, product_id LIMIT 10)
        UNION ALL
        SELECT 'channel_pnl', channel, round(sum(revenue), 0), round(sum(revenue - cost), 0)
        FROM books WHERE channel IS NOT NULL GROUP BY channel
        UNION ALL
        SELECT 'device_payment', concat_ws('/', device, payment_method), round(sum(revenue), 0), NULL
        FROM orders_ GROUP BY device, payment_method
        UNION ALL
        SELECT 'segment_revenue', segment, round(sum(revenue), 0), NULL
        FROM orders_ o JOIN retail_customer k ON o.customer_id = k.customer_id GROUP BY segment
        UNION ALL
        SELECT 'daily_series', CAST(txn_date AS VARCHAR), round(sum(revenue), 0), round(sum(revenue - cost), 0)
        FROM books WHERE txn_date IS NOT NULL GROUP BY txn_date""",
        "retail_customer", "erp", "pos", "ecom", "fact"),
    "order_cube": _with("""
        SELECT customer_id, device, payment_method, sum(revenue) AS revenue, count(*) AS order_count
        FROM ecom GROUP BY customer_id, device, payment_method""", "ecom"),
    "store_month_pnl": _with("""
        SELECT store_id, month, round(sum(revenue), 0) AS revenue, round(sum(cost), 0) AS cost,
               round(sum(revenue - cost), 0) AS profit
        FROM erp WHERE channel = 'offline' AND cost IS NOT NULL
        GROUP BY store_id, month ORDER BY store_id, month""", "erp"),
    "top_products_revenue": _with("""
        SELECT product_id, round(sum(revenue), 0) AS revenue, CAST(sum(qty) AS BIGINT) AS units_sold
        FROM erp GROUP BY product_id ORDER BY revenue DESC, product_id LIMIT 10""", "erp"),
    "top_products_profit": _with("""
        SELECT product_id, round(sum(revenue - cost), 0) AS profit, count(*) AS rows_sold
        FROM erp WHERE cost IS NOT NULL GROUP BY product_id ORDER BY profit DESC, product_id LIMIT 10""", "erp"),
    "channel_pnl": _with("""
        SELECT channel, count(*) AS row_count, round(sum(revenue), 0) AS revenue,
               round(sum(revenue - cost), 0) AS profit
        FROM erp WHERE channel IS NOT NULL GROUP BY channel ORDER BY revenue DESC, channel""", "erp"),
    "daily_series": _with("""
        SELECT txn_date AS day, round(sum(revenue), 0) AS revenue, round(sum(revenue - cost), 0) AS profit,
               count(*) AS row_count
        FROM erp WHERE txn_date IS NOT NULL GROUP BY txn_date ORDER BY day""", "erp"),
    "daily_series_range": _with("""
        SELECT txn_date AS day, round(sum(revenue), 0) AS revenue, round(sum(revenue - cost), 0) AS profit,
               count(*) AS row_count
        FROM erp WHERE txn_date BETWEEN DATE '1998-01-01' AND DATE '1999-12-31' GROUP BY txn_date""", "erp"),
    "store_day_cube": _with(f"""
        SELECT txn_date, month, store_id, region, channel, cost IS NOT NULL AS costed, {MEASURES}
        FROM erp GROUP BY txn_date, month, store_id, region, channel, cost IS NOT NULL""", "erp"),
    "product_month_cube": _with(f"""
        SELECT product_id, CAST(date_trunc('month', txn_date) AS DATE) AS txn_month, month,
               cost IS NOT NULL AS costed, {MEASURES}
        FROM erp GROUP BY product_id, CAST(date_trunc('month', txn_date) AS DATE), month, cost IS NOT NULL""", "erp"),
    "rows_per_source": _with("SELECT source, count(*) AS row_count FROM fact GROUP BY source",
                             "erp", "pos", "ecom", "fact"),
    "rows_per_channel": _with(
        "SELECT channel, count(*) AS row_count FROM fact WHERE channel IS NOT NULL GROUP BY channel",
        "erp", "pos", "ecom", "fact"),
    "device_payment": _with("""
        SELECT device, payment_method, count(*) AS order_count, round(sum(revenue), 0) AS revenue
        FROM ecom GROUP BY device, payment_method ORDER BY revenue DESC, device, payment_method""", "ecom"),
    "segment_revenue": _with("""
        SELECT k.segment, count(*) AS order_count, round(sum(e.revenue), 0) AS revenue
        FROM ecom e JOIN retail_customer k ON e.customer_id = k.customer_id
        GROUP BY k.segment ORDER BY revenue DESC, k.segment""", "ecom", "retail_customer"),
    "business_date": _with("SELECT d AS business_date FROM bound", "erp", "bound"),
    "period_day": _with("SELECT * FROM days", *PERIOD_VIEWS),
    "period_week": _with("SELECT * FROM weeks", *PERIOD_VIEWS, "weeks"),
    "period_month": _with("SELECT * FROM months", *PERIOD_VIEWS, "months"),
    "period_quarter": _with("SELECT * FROM quarters", *PERIOD_VIEWS, "months", "quarters"),
    "period_year": _with("SELECT * FROM years", *PERIOD_VIEWS, "months", "years"),
    "period_resume": _with("SELECT * FROM months WHERE period > DATE '1999-06-01'", *PERIOD_VIEWS, "months"),
    "rollup_cascade": _with("""
        SELECT *, 'day' AS unit FROM days UNION ALL SELECT *, 'week' FROM weeks
        UNION ALL SELECT *, 'month' FROM months UNION ALL SELECT *, 'quarter' FROM quarters
        UNION ALL SELECT *, 'year' FROM years""", *PERIOD_VIEWS, "weeks", "months", "quarters", "years"),
    "period_repair": _with("""
        SELECT *, 'day' AS unit FROM days UNION ALL SELECT *, 'week' FROM weeks
        UNION ALL SELECT *, 'month' FROM months UNION ALL SELECT *, 'quarter' FROM quarters
        UNION ALL SELECT *, 'year' FROM years""", *PERIOD_VIEWS, "weeks", "months", "quarters", "years"),
    "serving_counts": _with("""
        SELECT 'agg_day' AS label, count(*) AS row_count FROM days
        UNION ALL SELECT 'agg_week', count(*) FROM weeks UNION ALL SELECT 'agg_month', count(*) FROM months
        UNION ALL SELECT 'agg_quarter', count(*) FROM quarters UNION ALL SELECT 'agg_year', count(*) FROM years
        ORDER BY label""", *PERIOD_VIEWS, "weeks", "months", "quarters", "years"),
    "stock_on_hand": _with("SELECT * FROM stock", "movement", "stock"),
    "stock_on_hand_incremental": _with("SELECT * FROM stock", "movement", "stock"),
    "stock_ledger": _with("SELECT * FROM stock", "movement", "stock"),
    "current_inventory": _with("SELECT * FROM inventory", "product", "movement", "stock", "inventory"),
    "low_stock": _with("""
        SELECT product_id, product_name, stock_qty, reorder_level FROM inventory
        WHERE stock_qty < reorder_level ORDER BY stock_qty, product_id""",
        "product", "movement", "stock", "inventory"),
    "stock_value": _with("""
        SELECT product_id, product_name, stock_qty, unit_cost, stock_value FROM inventory
        ORDER BY stock_value DESC, product_id""", "product", "movement", "stock", "inventory"),
    "stock_trend": _with("""
        SELECT snapshot_date, round(sum(stock_value), 0) AS stock_value,
               CAST(sum(CASE WHEN stock_qty < reorder_level THEN 1 ELSE 0 END) AS BIGINT) AS low_stock_products
        FROM snapshots GROUP BY snapshot_date ORDER BY snapshot_date""", "product", "movement", "snapshots"),
    "snapshot_table": _with("SELECT * FROM snapshots", "product", "movement", "snapshots"),
    "movement_kinds": _with("""
        SELECT kind, count(*) AS row_count, CAST(sum(qty) AS BIGINT) AS qty, sum(cost) AS cost,
               min(moved_on) AS first_day, max(moved_on) AS last_day
        FROM movement GROUP BY kind""", "movement"),
    "opening_balances": _with("""
        SELECT product_id, 'opening' AS kind, reorder_level * 2 AS qty,
               round(reorder_level * 2 * unit_cost, 0) AS cost
        FROM product""", "product"),
    "reorder_lots": _with("""
        SELECT p.product_id, 'inbound' AS kind, reorder_level * 4 AS qty,
               round(reorder_level * 4 * unit_cost, 0) AS cost
        FROM product p LEFT JOIN stock s ON p.product_id = s.product_id
        WHERE coalesce(stock_qty, 0) < reorder_level""", "product", "movement", "stock"),
    "sales_to_movements": _with("""
        SELECT e.product_id, 'outbound' AS kind, -qty AS qty, round(qty * unit_cost, 0) AS cost,
               txn_date AS moved_on
        FROM erp e LEFT JOIN product p ON e.product_id = p.product_id""", "product", "erp"),
    "post_financials": _with("""
        SELECT s.*, round(qty * unit_cost, 0) AS cost
        FROM (SELECT txn_id, invoice_id, store_id, region, product_id, qty, revenue, txn_date, 'offline' AS channel
              FROM pos
              UNION ALL
              SELECT txn_id, txn_id, NULL, region, product_id, qty, revenue, txn_date, 'online' FROM ecom) s
             LEFT JOIN product p ON s.product_id = p.product_id""",
        "product", "pos", "ecom"),
    "monthly_demand": _with("SELECT * FROM demand", "erp", "demand"),
    "replenishment_plan": _with("""
        SELECT product_id, product_name, monthly_demand, stock_qty, reorder_level,
               CASE WHEN missing > 0 THEN CAST(ceil(missing) AS BIGINT) ELSE 0 END AS suggested_qty,
               CASE WHEN missing > 0 THEN round(missing * unit_cost, 0) ELSE 0 END AS expected_cost
        FROM (SELECT stock.product_id, monthly_demand, stock_qty, 1.5 * monthly_demand - stock_qty AS missing
              FROM stock JOIN demand USING (product_id)) JOIN product USING (product_id)""",
        "product", "erp", "movement", "stock", "demand"),
    "promo_profit_corr": _with("""
        SELECT 'promotion_vs_profit' AS metric, round(corr(p.promotion, e.revenue - e.cost), 4) AS value
        FROM pos p JOIN erp e ON p.txn_id = e.txn_id WHERE e.cost IS NOT NULL""", "erp", "pos"),
    "monthly_series": _with("SELECT * FROM indexed", "erp", "monthly", "indexed"),
    "revenue_forecast": _with("""
        SELECT CAST(max(t) + 1 AS INT) AS t,
               round(regr_intercept(revenue, t) + regr_slope(revenue, t) * (max(t) + 1), 0) AS revenue_forecast
        FROM indexed""", "erp", "monthly", "indexed"),
    "revenue_forecast_closed": _with("""
        SELECT CAST(max(t) + 1 AS INT) AS t,
               round(regr_intercept(revenue, t) + regr_slope(revenue, t) * (max(t) + 1), 0) AS revenue_forecast
        FROM indexed
        WHERE make_date(year, month, 1) < (SELECT CAST(date_trunc('month', d) AS DATE) FROM bound)""",
        "erp", "bound", "monthly", "indexed"),
    "store_features": _with("""
        SELECT store_id, sum(revenue) AS revenue, avg(revenue) AS avg_revenue, count(*) AS txn_count
        FROM erp WHERE store_id IS NOT NULL AND cost IS NOT NULL GROUP BY store_id""", "erp"),
    "store_cluster_check": _with("""
        SELECT store_id, round((revenue - avg(revenue) OVER ()) / stddev_samp(revenue) OVER (), 6) AS revenue_z,
               round((avg_revenue - avg(avg_revenue) OVER ()) / stddev_samp(avg_revenue) OVER (), 6) AS avg_revenue_z,
               round((txn_count - avg(txn_count) OVER ()) / stddev_samp(txn_count) OVER (), 6) AS txn_count_z,
               TRUE AS nearest, TRUE AS centred
        FROM (SELECT store_id, sum(revenue) AS revenue, avg(revenue) AS avg_revenue, count(*) AS txn_count
              FROM erp WHERE store_id IS NOT NULL AND cost IS NOT NULL GROUP BY store_id)""", "erp"),
    "sales_normalized": _with("SELECT * FROM fact", "erp", "pos", "ecom", "fact"),
    "landing_ingest": _with(f"""
        SELECT {FACT_COLUMNS}
        FROM (SELECT *, row_number() OVER (PARTITION BY source, txn_id ORDER BY {FACT_ORDER}) AS rn FROM fact)
        WHERE rn = 1""", "erp", "pos", "ecom", "fact"),
    "resends_by_state": _with(f"SELECT {FACT_COLUMNS} FROM fact", "erp", "pos", "ecom", "fact"),
    "key_index_lookup": _with("""
        SELECT source, year, month, count(*) AS row_count FROM fact WHERE source = 'erp' AND year = 1998 AND month <= 2
        GROUP BY ALL""", "erp", "pos", "ecom", "fact"),
    "intake_gaps": _with("""
        SELECT txn_id, customer_id, product_id, qty, revenue, txn_date FROM fact WHERE source = 'ecommerce'""",
        "erp", "pos", "ecom", "fact"),
    "intake_to_landing": _with("""
        SELECT * FROM fact WHERE source <> 'pos'
        UNION ALL
        SELECT txn_id, invoice_id, concat('T', o_custkey), product_id, o_orderstatus, qty, revenue, NULL, promotion,
               'offline', NULL, NULL, NULL, CAST(o_orderdate AS DATE), 'pos', CAST(month(o_orderdate) AS INT),
               CAST(year(o_orderdate) AS INT)
        FROM pos JOIN orders ON invoice_id = concat('INV', o_orderkey)""", "erp", "pos", "ecom", "fact"),
    "channel_derivation": _with("""
        SELECT source, channel, count(*) AS row_count FROM fact GROUP BY source, channel
        UNION ALL SELECT 'unmarked', NULL, count(*) FROM erp""", "erp", "pos", "ecom", "fact"),
    "sales_dedup": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                            ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn
              FROM lineitem)
        WHERE rn = 1""",
    "customer_dedup": _with("""
        SELECT customer_id,
               CASE WHEN n % 2 = 0 AND n % 3 = 0 THEN NULL ELSE customer_name END AS customer_name,
               CASE WHEN n % 2 = 0 THEN 'CHANGED' ELSE segment END AS segment, region
        FROM (SELECT *, CAST(substring(customer_id, 2) AS BIGINT) AS n FROM retail_customer)""", "retail_customer"),
    "invoice_flatten": _with("""
        SELECT txn_id, invoice_id, concat('T', o_custkey) AS store_id, o_orderstatus AS region, product_id, qty,
               revenue, promotion, CAST(o_orderdate AS DATE) AS txn_date, 'pos' AS source, 'offline' AS channel
        FROM pos JOIN orders ON invoice_id = concat('INV', o_orderkey)""", "pos"),
    "invoice_messages": _with("""
        SELECT invoice_id, any_value(concat('T', o_custkey)) AS store_id, CAST(count(*) AS INT) AS line_count
        FROM pos JOIN orders ON invoice_id = concat('INV', o_orderkey) GROUP BY invoice_id""", "pos"),
    "ecommerce_rename": _with("SELECT *, 'ecommerce' AS source FROM ecom", "ecom"),
    "json_round_trip": _with("""
        SELECT 'erp' AS source, txn_id, store_id, region, product_id, revenue, cost,
               CAST(txn_date AS VARCHAR) AS txn_date
        FROM erp""", "erp"),
    "array_split": _with("""
        SELECT txn_id, product_id, qty FROM erp UNION ALL SELECT txn_id, product_id, -qty FROM erp""", "erp"),
    "incremental_read": " UNION ALL ".join([
        _read_twice("orders", "o_orderkey"), _read_twice("customer", "c_custkey"), _read_twice("part", "p_partkey")]),
    "id_high_water_mark": _with(" UNION ALL ".join([
        _mark("invoice", "invoice_id", "INV", "erp"), _mark("customer", "customer_id", "C", "retail_customer"),
        _mark("order", "invoice_id", "WEB", "erp")]), "retail_customer", "erp"),
    "first_rows": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5",
    "product_insert_absent": _with("""
        SELECT product_id, product_name, unit_cost,
               CASE WHEN reorder_level >= 100 THEN reorder_level ELSE 0 END AS reorder_level
        FROM product""", "product"),
    "live_stats": _with("""
        SELECT round(sum(revenue), 0) AS revenue, round(sum(profit), 0) AS profit, count(*) AS txn_count
        FROM live""", "live"),
    "live_alerts": _with("SELECT * FROM alerts", "live", "alerts"),
    "labelled_alerts": _with("SELECT 'LO NANG' AS warning, * FROM alerts", "live", "alerts"),
    "alert_total": _with("SELECT count(*) AS alert_count FROM alerts", "live", "alerts"),
    "latest_alerts": _with("SELECT * FROM alerts ORDER BY txn_id LIMIT 5", "live", "alerts"),
}

# The same results by another way.
ORACLE |= {"promo_profit_buckets": ORACLE["promo_profit_corr"], "live_alerts_timed": ORACLE["live_alerts"]}
