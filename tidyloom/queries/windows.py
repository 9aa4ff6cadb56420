"""Ranks, running totals, fills, changes and bins in order."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tidyloom.functions import amounts, dates, predicates
from tidyloom.operators import groups, ordered, ranks, scaffold
from tidyloom.operators.ranges import down
from tidyloom.plans import bank, retail, school
from tidyloom.queries.registry import moment, query, table


@query("""
    SELECT event_id, user_id, dayname(ts) AS weekday, CAST(isodow(ts) AS INTEGER) AS weekday_number,
           RANK() OVER (PARTITION BY dayname(ts) ORDER BY value DESC) AS rank FROM events
""")
def q_weekday_rank(spark, folder):
    events = table(spark, folder, "events").select(
        "event_id", "user_id", "value", dates.weekday_name("ts").alias("weekday"), dates.weekday_number("ts").alias("weekday_number")
    )
    ranked = ranks.ranked(events, ["weekday"], "value", descending=True)
    return ranked.orderBy("weekday_number", "rank").drop("value")


@query("""
    WITH c AS (SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS file_date, o_totalprice,
        CASE WHEN o_totalprice < 100000 THEN 'Small' WHEN o_totalprice < 300000 THEN 'Medium' WHEN o_totalprice < 450000 THEN 'Large' ELSE 'Huge' END AS band
        FROM orders)
    SELECT *, RANK() OVER (PARTITION BY file_date, band ORDER BY o_totalprice) AS rank FROM c QUALIFY rank <= 5
""")
def q_lowest5(spark, folder):
    band = predicates.below("o_totalprice", [(100_000, "Small"), (300_000, "Medium"), (450_000, "Large")], "Huge")
    trades = table(spark, folder, "orders").select("o_orderkey", dates.month_start("o_orderdate").alias("file_date"), "o_totalprice", band.alias("band"))
    return ranks.best_of_group(trades, ["file_date", "band"], "o_totalprice", 5)


@query("""
    WITH m AS (SELECT p_brand, p_type, CAST(SUM(ROUND(p_retailprice * 100)) AS BIGINT) / COUNT(*) AS mean_cents FROM part GROUP BY ALL)
    SELECT p_brand, p_type, mean_cents FROM m
    QUALIFY COUNT(*) OVER (PARTITION BY p_type ORDER BY mean_cents RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) = 1
""")
def q_rank_max(spark, folder):
    mean = F.sum(amounts.cents("p_retailprice")) / F.count(F.lit(1))
    means = table(spark, folder, "part").groupBy("p_brand", "p_type").agg(mean.alias("mean_cents"))
    return ranks.ranked(means, ["p_type"], "mean_cents", ties="max").where("rank = 1").drop("rank")


@query("""
    SELECT c_custkey, c_nationkey, c_mktsegment, ROW_NUMBER() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_acctbal, c_name DESC, c_custkey) AS rank
    FROM customer
""")
def q_ordinal(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal", "c_name")
    order = [F.col("c_acctbal"), down("c_name"), F.col("c_custkey")]
    return ranks.ordinal_rank(customer, ["c_nationkey", "c_mktsegment"], order).drop("c_acctbal", "c_name")


@query("""
    WITH r AS (SELECT c_custkey, c_nationkey, c_mktsegment, c_acctbal,
        ROW_NUMBER() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_acctbal, c_custkey) AS rank FROM customer)
    SELECT c_custkey, c_nationkey, c_mktsegment, c_acctbal FROM r
    QUALIFY rank > MAX(rank) OVER (PARTITION BY c_nationkey, c_mktsegment) - CASE WHEN c_nationkey % 5 = 0 THEN 6 ELSE 2 END
""")
def q_select_n(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    places = F.when(F.col("c_nationkey") % 5 == 0, 6).otherwise(2)
    order = [F.col("c_acctbal").desc(), F.col("c_custkey").desc()]
    return school.best_applicants(customer, ["c_nationkey", "c_mktsegment"], order, places, most=6)


@query("""
    SELECT p_partkey, p_retailprice, RANK() OVER (ORDER BY p_retailprice DESC) AS price_rank FROM part
""")
def q_global_rank(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", "p_retailprice")
    return ranks.ranked(parts, [], "p_retailprice", "price_rank", descending=True)


@query("""
    SELECT ROW_NUMBER() OVER (ORDER BY o_orderdate, o_totalprice DESC, o_orderkey) AS sort_order, o_orderkey, CAST(o_orderdate AS DATE) AS ordered_on, o_totalprice
    FROM orders
""")
def q_sort_index(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("ordered_on"), "o_totalprice")
    return ordered.row_index(orders, [F.col("ordered_on"), down("o_totalprice"), F.col("o_orderkey")], "sort_order")


@query("""
    WITH r AS (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS created_on, CAST(ROUND(o_totalprice * 100) AS BIGINT) AS cents,
        CAST(SUM(ROUND(o_totalprice * 100)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_totalprice DESC, o_orderkey ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_balance
        FROM orders)
    SELECT * FROM r WHERE month(created_on) = 2
""")
def q_running_balance(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("created_on"), amounts.cents("o_totalprice").alias("cents")
    )
    order = [F.col("created_on"), down("cents"), F.col("o_orderkey")]
    return ordered.running_sum(orders, ["o_custkey"], order, F.col("cents"), "running_balance").where(F.month("created_on") == 2)


@query("""
    WITH moves AS (
        SELECT o_orderkey AS transaction_id, o_custkey AS account_number, CAST(o_orderdate AS DATE) AS created_on, -CAST(ROUND(o_totalprice * 100) AS BIGINT) AS movement
        FROM orders WHERE o_orderstatus <> 'P'
        UNION ALL SELECT o_orderkey, o_orderkey // 10, CAST(o_orderdate AS DATE), CAST(ROUND(o_totalprice * 100) AS BIGINT) FROM orders WHERE o_orderstatus <> 'P'
        UNION ALL SELECT NULL, c_custkey, DATE '1994-12-31', CAST(ROUND(c_acctbal * 100) AS BIGINT) FROM customer)
    SELECT transaction_id, account_number, created_on, movement, CAST(SUM(movement) OVER (PARTITION BY account_number
           ORDER BY created_on, movement DESC, transaction_id NULLS FIRST ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_balance
    FROM moves
""")
def q_ledger(spark, folder):
    transfers = table(spark, folder, "orders").where(F.col("o_orderstatus") != "P").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.to_date("o_orderdate").alias("created_on"),
        amounts.cents("o_totalprice").alias("cents"),
        F.col("o_custkey").alias("source"),
        F.floor(F.col("o_orderkey") / 10).alias("destination"),
    )
    flows = scaffold.signed_flows(transfers, "source", "destination", F.col("cents"), "account_number").drop("cents")
    opening = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("account_number"), F.lit(datetime.date(1994, 12, 31)).alias("created_on"), amounts.cents("c_acctbal").alias("movement")
    )
    order = [F.col("created_on"), down("movement"), F.col("transaction_id")]
    return scaffold.ledger(opening, flows, "account_number", order, "movement")


@query("""
    WITH r AS (SELECT user_id, event_id, ts, CAST(SUM(ROUND(value * 100)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running
               FROM events)
    SELECT user_id, CAST(ts AS DATE) AS day, running AS daily_end_balance FROM r QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1
""")
def q_day_end_balance(spark, folder):
    return bank.day_end_balance(_event_statement(spark, folder), "user_id", "day", ["ts", "event_id"])


def _event_statement(spark, folder):
    events = table(spark, folder, "events").select("user_id", "event_id", "ts", F.to_date("ts").alias("day"), amounts.cents("value").alias("movement"))
    return ordered.running_sum(events, ["user_id"], [F.col("ts"), F.col("event_id")], F.col("movement"), "running_balance")


@query("""
    WITH edges AS (SELECT MIN(CAST(ts AS DATE)) AS lo, MAX(CAST(ts AS DATE)) AS hi FROM events),
    days AS (SELECT CAST(UNNEST(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM edges),
    daily AS (SELECT user_id, CAST(ts AS DATE) AS day, CAST(SUM(ROUND(value * 100)) AS BIGINT) AS cents FROM events GROUP BY ALL),
    grid AS (SELECT * FROM (SELECT DISTINCT user_id FROM events) CROSS JOIN days)
    SELECT user_id, day, COALESCE(cents, 0) AS total_movement,
           CAST(SUM(cents) OVER (PARTITION BY user_id ORDER BY day ROWS UNBOUNDED PRECEDING) AS BIGINT) AS daily_end_balance
    FROM grid LEFT JOIN daily USING (user_id, day)
""")
def q_daily_balance(spark, folder):
    return bank.daily_balance(_event_statement(spark, folder), "user_id", "day", "movement", ["ts", "event_id"])


@query("""
    SELECT CAST(ts AS DATE) AS day, COUNT(*) AS events FROM events WHERE CAST(ts AS DATE) <> (SELECT MIN(CAST(ts AS DATE)) FROM events) GROUP BY 1
""")
def q_after_first_day(spark, folder):
    per_day = groups.count_by(table(spark, folder, "events"), F.to_date("ts").alias("day"), name="events")
    first = per_day.agg(F.min("day").alias("day")).select("day").scalar()
    return per_day.where(F.col("day") != first)


@query("""
    SELECT event_id, user_id, last_value(CASE WHEN event_type <> 'error' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM events
""")
def q_ffill(spark, folder):
    gaps = table(spark, folder, "events").select("event_id", "user_id", "ts", F.when(F.col("event_type") != "error", F.col("value")).alias("value"))
    return ordered.forward_fill(gaps, ["user_id"], [F.col("ts"), F.col("event_id")], "value").drop("ts")


@query("""
    WITH s AS (SELECT o_orderpriority AS store_location, CAST((quarter(o_orderdate) + 1) % 4 + 1 AS INTEGER) AS fiscal_quarter, CAST(SUM(ROUND(o_totalprice * 100)) AS BIGINT) AS volume_sold
               FROM orders GROUP BY ALL)
    SELECT *, ROUND(100 * (volume_sold / LAG(volume_sold) OVER (PARTITION BY store_location ORDER BY fiscal_quarter) - 1), 1) AS pct_diff FROM s
""")
def q_pct_change(spark, folder):
    sales = table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("store_location"), F.to_date("o_orderdate").alias("ordered_on"), amounts.cents("o_totalprice").alias("volume_sold")
    )
    return retail.fiscal_quarter_change(sales)


@query("""
    WITH m AS (SELECT o_custkey AS customer, CAST(date_trunc('month', o_orderdate) AS DATE) AS order_date, COUNT(*) AS quantity FROM orders GROUP BY ALL)
    SELECT *, quantity - LAG(quantity) OVER (PARTITION BY customer ORDER BY order_date) AS running_diff FROM m
""")
def q_running_diff(spark, folder):
    monthly = groups.count_by(
        table(spark, folder, "orders"), F.col("o_custkey").alias("customer"), dates.month_start("o_orderdate").alias("order_date"), name="quantity"
    )
    return ordered.difference_to_previous(monthly, ["customer"], [F.col("order_date")], F.col("quantity"), "running_diff")


@query("""
    WITH months AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders WHERE o_orderdate < DATE '2001-07-01'),
    keys AS (SELECT DISTINCT c_nationkey AS store FROM customer), kinds AS (SELECT DISTINCT c_mktsegment AS bike_type FROM customer),
    facts AS (SELECT c_nationkey AS store, c_mktsegment AS bike_type, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, COUNT(*) AS monthly_sales,
                     CAST(SUM(ROUND(o_totalprice * 100)) AS BIGINT) AS monthly_profit FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
    g AS (SELECT store, bike_type, month, COALESCE(monthly_sales, 0) AS monthly_sales, COALESCE(monthly_profit, 0) AS monthly_profit
          FROM keys CROSS JOIN kinds CROSS JOIN months LEFT JOIN facts USING (store, bike_type, month))
    SELECT *, CASE WHEN COUNT(*) OVER w = 3 THEN CAST(SUM(monthly_profit) OVER w AS BIGINT) / 3 END AS rolling_monthly_profit FROM g
    WINDOW w AS (PARTITION BY store, bike_type ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
""")
def q_rolling3(spark, folder):
    sales = table(spark, folder, "orders").join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    sales = sales.select(
        F.col("c_nationkey").alias("store"), F.col("c_mktsegment").alias("bike_type"), F.to_date("o_orderdate").alias("sales_on"),
        F.lit(1).cast("long").alias("daily_sales"), amounts.cents("o_totalprice").alias("daily_profit"),
    )
    return retail.rolling_profit(sales, datetime.date(2001, 7, 1))


@query("""
    WITH b AS (SELECT p_brand, quantile_cont(p_retailprice, [1/6, 2/6, 3/6, 4/6, 5/6]) AS q FROM part GROUP BY 1)
    SELECT p_brand, CASE WHEN p_retailprice <= q[1] THEN 'F' WHEN p_retailprice <= q[2] THEN 'E' WHEN p_retailprice <= q[3] THEN 'D'
           WHEN p_retailprice <= q[4] THEN 'C' WHEN p_retailprice <= q[5] THEN 'B' ELSE 'A' END AS grade, COUNT(*) AS parts
    FROM part JOIN b USING (p_brand) GROUP BY ALL
""")
def q_qcut6(spark, folder):
    graded = ranks.quantile_bins(table(spark, folder, "part"), ["p_brand"], "p_retailprice", 6, ["F", "E", "D", "C", "B", "A"], "grade")
    return groups.count_by(graded, "p_brand", "grade", name="parts")


@query("""
    WITH b AS (SELECT quantile_cont(p_retailprice, [0.25, 0.75]) AS q FROM part)
    SELECT p_partkey, CASE WHEN p_retailprice <= q[1] THEN 'lower' WHEN p_retailprice <= q[2] THEN 'mid' ELSE 'upper' END AS category FROM part, b
""")
def q_qcut_quartile(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", "p_retailprice")
    return ranks.quantile_bins(parts, [], "p_retailprice", [0.25, 0.75], ["lower", "mid", "upper"], "category").drop("p_retailprice")


@query("""
    WITH m AS (SELECT o_custkey AS student_id, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS term, CAST(SUM(ROUND(o_totalprice * 100)) AS BIGINT) AS cents
               FROM orders GROUP BY ALL),
    r AS (SELECT *, CASE WHEN COUNT(*) OVER w = 3 THEN CAST(SUM(cents) OVER w AS BIGINT) / 3 END AS moving_average FROM m
          WINDOW w AS (PARTITION BY student_id ORDER BY term ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
    SELECT student_id, term, cents, moving_average FROM r WHERE moving_average >= (SELECT quantile_cont(moving_average, 0.98) FROM r)
""")
def q_top2pct(spark, folder):
    orders = table(spark, folder, "orders")
    terms = orders.groupBy(F.col("o_custkey").alias("student_id"), F.trunc("o_orderdate", "quarter").alias("term")).agg(
        F.sum(amounts.cents("o_totalprice")).alias("cents")
    )
    return retail.top_share_by_moving_average(terms, ["student_id"], "term", "cents", size=3, share=0.02)


@query("""
    WITH m AS (SELECT user_id, event_id, ts, CAST(ts AS DATE) AS day, CAST(ROUND(value * 100) AS BIGINT) AS movement FROM events),
    s AS (SELECT *, CAST(SUM(movement) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS balance FROM m),
    d AS (SELECT user_id, day, CAST(SUM(movement) AS BIGINT) AS total_movement, arg_max(balance, (ts, event_id)) AS daily_end_balance FROM s GROUP BY ALL
          UNION ALL SELECT user_id, (SELECT MIN(day) FROM m), 0, NULL FROM m GROUP BY user_id HAVING MIN(day) > (SELECT MIN(day) FROM m))
    SELECT user_id, day, total_movement, daily_end_balance,
           COALESCE(LEAD(day) OVER (PARTITION BY user_id ORDER BY day) - 1, (SELECT MAX(day) FROM m))::DATE AS until FROM d
""")
def q_balance_runs(spark, folder):
    return bank.balance_runs(_event_statement(spark, folder), "user_id", "day", "movement", ["ts", "event_id"])
