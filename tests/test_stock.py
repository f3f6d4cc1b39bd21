from datetime import date

from retailloom.operators import inventory, normalize, planning
from retailloom.operators.dedup import absent, dedup, new_only, newest_customers
from retailloom.operators.reports import product_month_cube
from retailloom.sinks.tables import ensure_table, insert_absent, overwrite_day
from retailloom.schemas import FACT, SNAPSHOT
from tests.conftest import CH, CO, MA, PA, plan, tuples


def test_stock_and_value(shop):
    assert tuples(shop.inventory.select("product_id", "stock_qty", "stock_value")) == [
        (CH, 14, 2100), (PA, 235, 1410), (CO, 56, 16800), (MA, 47, 9400)]


def test_unknown_product_keeps_nulls(spark, shop):
    moves = spark.createDataFrame([("X", 5)], "product_id string, qty int")
    assert tuples(inventory.inventory(moves, shop.product)) == [("X", None, 5, None, None, None)]


def test_balance_plus_new_movements(shop):
    before = shop.movement.where("moved_on is null")
    after = shop.movement.where("moved_on is not null")
    assert tuples(inventory.stock_on_hand(after, inventory.stock_on_hand(before))) == \
        tuples(inventory.stock_on_hand(shop.movement))


def test_snapshot_day_replaces_itself(spark, shop, database):
    table = f"{database}.snap"
    ensure_table(spark, table, SNAPSHOT, ["snapshot_date"])
    for day, rows in ((date(2026, 7, 1), shop.inventory), (date(2026, 7, 2), shop.inventory),
                      (date(2026, 7, 2), shop.inventory.where(f"product_id = '{CO}'"))):
        overwrite_day(inventory.snapshot(rows, day), table, "snapshot_date", day)
    assert tuples(spark.table(table).groupBy("snapshot_date").count()) == [
        (date(2026, 7, 1), 4), (date(2026, 7, 2), 1)]


def test_post_financials(shop):
    columns = ["txn_id", "invoice_id", "store_id", "region", "product_id", "qty", "revenue", "txn_date", "channel", "cost"]
    posted = inventory.post_financials(shop.pos, shop.orders, shop.product)
    assert tuples(posted.select(columns)) == tuples(shop.erp.select(columns))


def test_movements_of_sales(shop):
    moved = inventory.outbound_movements(shop.erp, shop.product)
    assert tuples(moved.where(f"product_id = '{CH}'")) == [(CH, "outbound", -1, 150.0, date(2026, 7, 1))]


def test_opening_and_lots(shop):
    assert (CO, "opening", 70, 21000.0) in tuples(inventory.opening_balances(shop.product))
    stock = inventory.stock_on_hand(shop.movement)
    assert tuples(inventory.reorder_lots(shop.product, stock)) == [(CH, "inbound", 88, 13200.0)]
    never_moved = stock.where(f"product_id <> '{MA}'")
    assert (MA, "inbound", 112, 22400.0) in tuples(inventory.reorder_lots(shop.product, never_moved))


def test_insert_if_absent(spark, shop, database):
    table = f"{database}.dim_product"
    insert_absent(shop.product, table, ["product_id"])
    changed = shop.product.selectExpr("product_id", "product_name", "0.0D unit_cost", "0 reorder_level")
    new = spark.createDataFrame([("NEW", "New", 1.0, 5)], shop.product.schema)
    insert_absent(changed.unionByName(new), table, ["product_id"])
    assert tuples(spark.table(table)) == tuples(shop.product.unionByName(new))
    assert absent(changed, shop.product, ["product_id"]).isEmpty()


def test_demand(shop):
    for sales in (shop.sales, product_month_cube(shop.sales)):
        found = dict(tuples(planning.monthly_demand(sales)))
        assert found == {CO: 1.3, PA: 5.0, MA: 3.0, CH: 1.0}
        assert dict(tuples(planning.monthly_demand(sales, by_year=True))) == found


def test_demand_matches_two_levels(spark):
    rows = [("P", None, 4), ("P", 1, 3), ("P", 1, 4), ("P", 12, None), ("Q", 2, None), ("R", 5, -3), ("R", 6, 8)]
    sales = spark.createDataFrame(rows, "product_id string, month int, units bigint")
    sales.createOrReplaceTempView("demand_rows")
    expected = spark.sql("""SELECT product_id, round(avg(units), 1) monthly_demand FROM (
        SELECT product_id, month, sum(units) units FROM demand_rows GROUP BY product_id, month) GROUP BY product_id""")
    assert tuples(planning.monthly_demand(sales)) == tuples(expected)


def test_plan_costs_the_exact_shortage(spark):
    demand = spark.createDataFrame([("A", 1.3), ("B", 1.0)], "product_id string, monthly_demand double")
    product = spark.createDataFrame([("A", "a", 300.0, 5), ("B", "b", 10.0, 5)],
                                    "product_id string, product_name string, unit_cost double, reorder_level int")
    stock = spark.createDataFrame([("A", 1), ("B", 9)], "product_id string, stock_qty bigint")
    assert tuples(planning.replenishment_plan(demand, product, stock)) == [
        ("A", "a", 1.3, 1, 5, 1, 285.0), ("B", "b", 1.0, 9, 5, 0, 0.0)]


def test_dedup_is_deterministic(spark):
    rows = spark.createDataFrame([("erp", "T", 2), ("erp", "T", 1), ("pos", "T", 3), ("erp", "U", None)],
                                 "source string, txn_id string, qty int")
    for parts in (1, 3):
        assert tuples(dedup(rows.repartition(parts), ["source", "txn_id"], ["qty"])) == [
            ("erp", "T", 1), ("erp", "U", None), ("pos", "T", 3)]


def test_hot_key_is_cut_before_the_shuffle(spark):
    rows = spark.range(20000).selectExpr("case when id % 3 = 0 then 0 else id end as k", "id as v")
    once = dedup(rows, ["k"], ["v"])
    text = plan(once)
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert once.count() == rows.select("k").distinct().count()


def test_newest_customer(spark):
    rows = spark.createDataFrame([("C1", "Old", "2026-01-01"), ("C1", "New", "2026-02-01"), (None, "x", "2026-03-01")],
                                 "customer_id string, customer_name string, seen string")
    assert tuples(newest_customers(rows, "seen")) == [("C1", "New", "2026-02-01")]


def test_new_only_finds_resent_rows_of_other_days(spark, shop):
    batch = shop.fact.withColumn("txn_date", shop.fact.txn_date + 60)
    assert new_only(batch, shop.fact).isEmpty()
    fresh = normalize.to_fact(spark.createDataFrame(
        [("L000000001", "ecommerce"), ("A", "strange"), ("L000000001", "pos")], "txn_id string, source string"))
    assert tuples(new_only(fresh, shop.fact).select("source", "txn_id")) == [
        ("ecommerce", "L000000001"), ("strange", "A")]
    assert tuples(new_only(fresh, spark.createDataFrame([], FACT)).select("source")) == [
        ("ecommerce",), ("pos",), ("strange",)]
    assert new_only(fresh.where("false"), shop.fact).isEmpty()


def test_new_only_reads_only_the_batch_range(spark, shop, database):
    table = f"{database}.sales"
    shop.fact.write.partitionBy("source", "month").saveAsTable(table)
    batch = shop.fact.where("txn_id in ('L000000001', 'L000000003')")
    text = plan(new_only(batch.coalesce(1), spark.table(table)))
    for source in ("erp", "pos"):
        scan = next(line for line in text.splitlines()
                    if "PartitionFilters" in line and f"= {source})" in line.split("PushedFilters")[0] and "PushedFilters" in line)
        assert "GreaterThanOrEqual(txn_id,L000000001), LessThanOrEqual(txn_id,L000000003)" in scan
        assert "ReadSchema: struct<txn_id:string>" in scan


def test_fuller_duplicate_stays(spark):
    rows = spark.createDataFrame([("T", None, 1), ("T", 4.0, 1), ("U", None, 1)], "id string, cost double, qty int")
    assert tuples(dedup(rows, ["id"])) == [("T", 4.0, 1), ("U", None, 1)]


def test_an_old_id_adds_a_range_of_its_own(spark, shop, database):
    """A batch of new ids with one old id among them does not read what lies between."""
    table = f"{database}.sales"
    shop.fact.write.partitionBy("source", "month").saveAsTable(table)
    ids = ["L000000003", "L950000001", "L950000007", "WEB000000001"]
    batch = normalize.to_fact(spark.createDataFrame([(i, "erp") for i in ids], "txn_id string, source string"))
    text = plan(new_only(batch, spark.table(table)))
    assert " <= L000000003)" in text and " >= L950000001)" in text and "<= WEB000000001)" in text
    assert tuples(new_only(batch, spark.table(table)).select("txn_id")) == [("L950000001",), ("L950000007",)]


def test_ranges_are_merged_across_the_smallest_gaps():
    from retailloom.operators.dedup import _merged

    blocks = [("L", n, low, high) for n, low, high in (
        (0, "a", "b"), (1, "c", "d"), (50, "e", "f"), (52, "g", "h"), (900, "i", "j"))]
    assert _merged(blocks, 3) == [("a", "d"), ("e", "h"), ("i", "j")]
    assert _merged(blocks, 1) == [("a", "j")] and len(_merged(blocks, 9)) == 5
    assert _merged([*blocks, ("W", 1, "y", "z")], 2) == [("a", "j"), ("y", "z")]


def test_movements_by_the_names_they_are_sent_under(spark):
    from retailloom.schemas import MOVEMENT_LANDING
    from retailloom.streaming.ingest import to_movements

    sent = [("1", "A", None, "nhap_dau", "10", "5.0", None, "2026-07-01 10:00:00"),
            ("2", "A", None, "xuat", "-3", "1.5", None, "2026-07-02"), ("3", "A", "inbound", None, "2", None, "2026-07-03", None),
            ("4", "A", None, "nhap", "1", None, None, "bad")]
    found = to_movements(spark.createDataFrame(sent, MOVEMENT_LANDING)).selectExpr("id", "kind", "qty", "cost", "date(moved_at)")
    assert tuples(found) == [(1, "opening", 10, 5.0, date(2026, 7, 1)), (2, "outbound", -3, 1.5, date(2026, 7, 2)),
                             (3, "inbound", 2, None, date(2026, 7, 3)), (4, "inbound", 1, None, None)]
