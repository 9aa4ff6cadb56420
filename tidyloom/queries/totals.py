"""Aggregates, shares and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidyloom.functions import amounts, dates, predicates
from tidyloom.operators import groups, ordered, ranks
from tidyloom.plans import bank, flights, retail, school
from tidyloom.queries.registry import query, table
from tidyloom.sources import lookups


def _transactions(spark, folder):
    status = F.col("o_orderstatus")
    return table(spark, folder, "orders").select(
        "o_custkey",
        F.col("o_orderpriority").alias("bank"),
        predicates.first_match([(status == "F", "Online"), (status == "O", "In-Person")]).alias("transaction_method"),
        F.to_date("o_orderdate").alias("created_on"),
        "o_totalprice",
    )


@query("SELECT o_orderpriority AS bank, ROUND(SUM(o_totalprice), 2) AS total_value FROM orders GROUP BY 1")
def q_sum_by_status(spark, folder):
    total = groups.total_by(_transactions(spark, folder), "bank", value="o_totalprice")
    return total.withColumn("total_value", F.round("total_value", 2))


@query("SELECT o_orderpriority AS bank, o_custkey, ROUND(SUM(o_totalprice), 2) AS total_value FROM orders GROUP BY 1, 2")
def q_sum_by_status_cust(spark, folder):
    total = groups.total_by(_transactions(spark, folder), "bank", "o_custkey", value="o_totalprice")
    return total.withColumn("total_value", F.round("total_value", 2))


@query("""
    SELECT o_orderpriority AS bank, CASE o_orderstatus WHEN 'F' THEN 'Online' WHEN 'O' THEN 'In-Person' END AS transaction_method,
           dayname(o_orderdate) AS weekday, ROUND(SUM(o_totalprice), 2) AS total_value
    FROM orders GROUP BY ALL
""")
def q_sum_by_status_prio_weekday(spark, folder):
    weekday = dates.weekday_name("created_on").alias("weekday")
    total = groups.total_by(_transactions(spark, folder), "bank", "transaction_method", weekday, value="o_totalprice")
    return total.withColumn("total_value", F.round("total_value", 2))


@query("""
    SELECT user_id, COUNT(*) FILTER (WHERE value >= 75) AS num_passed, CAST(SUM(ROUND(value * 100)) AS BIGINT) / COUNT(*) AS mean_cents FROM events GROUP BY 1
""")
def q_mean_pass(spark, folder):
    return table(spark, folder, "events").groupBy("user_id").agg(
        F.count_if(F.col("value") >= 75).alias("num_passed"), F.avg(amounts.cents("value")).alias("mean_cents")
    )


@query("""
    SELECT monthname(o_orderdate) AS birthday_month, dayname(o_orderdate) AS birthday_weekday, COUNT(*) AS count FROM orders GROUP BY ALL
""")
def q_count_month_weekday(spark, folder):
    # Days first: names are then made once for each day, not once for each row.
    days = groups.count_by(table(spark, folder, "orders"), F.to_date("o_orderdate").alias("day"), name="on_day")
    named = days.groupBy(dates.month_name("day").alias("birthday_month"), dates.weekday_name("day").alias("birthday_weekday"))
    return named.agg(F.sum("on_day").alias("count"))


@query("""
    SELECT l_linestatus AS seat_class, l_returnflag = 'R' AS has_flow_card, CAST(quarter(l_shipdate) AS INTEGER) AS calendar_quarter,
           MIN(l_extendedprice) AS minimum_price, ROUND(median(l_extendedprice), 4) AS median_price, ROUND(AVG(l_extendedprice), 4) AS mean_price,
           MAX(l_extendedprice) AS maximum_price
    FROM lineitem GROUP BY ALL
""")
def q_price_stats(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        F.col("l_linestatus").alias("seat_class"),
        (F.col("l_returnflag") == "R").alias("has_flow_card"),
        F.to_date("l_shipdate").alias("flew_on"),
        F.col("l_extendedprice").alias("price"),
    )
    stats = flights.price_statistics(lines)
    return stats.withColumns({c: F.round(c, 4) for c in ("median_price", "mean_price")})


@query("""
    SELECT l_orderkey, ROUND(LN(product(1 - l_discount)), 9) AS log_kept_share FROM lineitem GROUP BY 1
""")
def q_product(spark, folder):
    # The logarithm of the product has no exact halves, which two engines may round apart.
    kept = F.product(1 - F.col("l_discount"))
    return table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.round(F.log(kept), 9).alias("log_kept_share"))


@query("""
    WITH n AS (SELECT dayname(ts) AS weekday, event_type, COUNT(*) AS num_trips FROM events GROUP BY ALL),
         t AS (SELECT dayname(ts) AS weekday, COUNT(*) AS total_trips FROM events GROUP BY 1)
    SELECT weekday, event_type, num_trips, total_trips, 100 * ROUND(num_trips / total_trips, 3) AS pct_trips FROM n JOIN t USING (weekday)
""")
def q_trip_share(spark, folder):
    trips = groups.count_by(table(spark, folder, "events"), dates.weekday_name("ts").alias("weekday"), "event_type", name="num_trips")
    per_day = trips.groupBy("weekday").agg(F.sum("num_trips").alias("total_trips"))
    joined = trips.join(per_day, "weekday")
    return joined.withColumn("pct_trips", 100 * F.round(amounts.ratio("num_trips", "total_trips"), 3))


@query("""
    WITH n AS (SELECT CASE WHEN o_totalprice / 50000 >= 7 THEN 'MegaByte' WHEN o_totalprice / 50000 >= 5 THEN 'Byte' ELSE 'NullByte' END AS category,
                      o_orderpriority AS gender, COUNT(*) AS count FROM orders GROUP BY ALL)
    SELECT *, 100 * ROUND(count / SUM(count) OVER (PARTITION BY category), 4) AS pct FROM n
""")
def q_share_window(spark, folder):
    spending = table(spark, folder, "orders").select((F.col("o_totalprice") / 1000).alias("sale_total"), F.col("o_orderpriority").alias("gender"))
    return retail.loyalty_by_gender(spending)


@query("""
    WITH spend AS (SELECT o_custkey AS customer_id, CAST(SUM(ROUND(o_totalprice * 100)) AS BIGINT) AS customer_sales FROM orders GROUP BY 1),
    r AS (SELECT *, CAST(SUM(customer_sales) OVER (ORDER BY customer_sales DESC, customer_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running,
                 CAST((SELECT SUM(customer_sales) FROM spend) AS BIGINT) AS total FROM spend)
    SELECT customer_id, customer_sales, customer_sales / total AS prop_customer_sales, running / total AS running_prop_sales
    FROM r WHERE running / total <= 0.8
""")
def q_pareto(spark, folder):
    orders = table(spark, folder, "orders").select(F.col("o_custkey").alias("customer_id"), amounts.cents("o_totalprice").alias("sales"))
    return retail.customers_up_to_share(orders, ["customer_id"], 0.8)


@query("""
    WITH b AS (SELECT o_orderpriority AS subject, quantile_cont(o_totalprice, [1/6, 2/6, 3/6, 4/6, 5/6]) AS q FROM orders GROUP BY 1),
    g AS (SELECT o_custkey AS pupil_id, CASE WHEN o_totalprice <= q[1] THEN 'F' WHEN o_totalprice <= q[2] THEN 'E' WHEN o_totalprice <= q[3] THEN 'D'
                 WHEN o_totalprice <= q[4] THEN 'C' WHEN o_totalprice <= q[5] THEN 'B' ELSE 'A' END AS grade
          FROM orders JOIN b ON o_orderpriority = subject),
    p AS (SELECT pupil_id, grade, CASE grade WHEN 'A' THEN 10 WHEN 'B' THEN 8 WHEN 'C' THEN 6 WHEN 'D' THEN 4 WHEN 'E' THEN 2 ELSE 1 END AS points FROM g),
    t AS (SELECT pupil_id, SUM(points) AS total FROM p GROUP BY 1)
    SELECT grade, ROUND(AVG(total), 6) AS grade_point_average FROM p JOIN t USING (pupil_id) GROUP BY 1
""")
def q_gpa(spark, folder):
    scores = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("pupil_id"), F.col("o_orderpriority").alias("subject_name"), F.col("o_totalprice").alias("score")
    )
    return school.grade_point_average(school.grade_points(scores), digits=6)


@query("""
    SELECT c_nationkey, COUNT(*) AS ee_count, COUNT(*) FILTER (WHERE c_acctbal < 0) AS xfer_count, ROUND(AVG(c_acctbal), 4) AS avg_balance,
           ROUND(AVG(c_acctbal) FILTER (WHERE c_acctbal < 0), 4) AS avg_xfer_balance,
           ROUND(100 * COUNT(*) FILTER (WHERE c_acctbal < 0) / COUNT(*), 2) AS xfer_pct
    FROM customer GROUP BY 1
""")
def q_transfer_summary(spark, folder):
    moved, balance = F.col("c_acctbal") < 0, F.col("c_acctbal")
    return table(spark, folder, "customer").groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("ee_count"),
        F.count_if(moved).alias("xfer_count"),
        F.round(F.avg(balance), 4).alias("avg_balance"),
        F.round(F.avg(F.when(moved, balance)), 4).alias("avg_xfer_balance"),
        F.round(100 * F.count_if(moved) / F.count(F.lit(1)), 2).alias("xfer_pct"),
    )


@query("""
    SELECT l_suppkey AS project, CAST(SUM(ROUND(l_extendedprice * 100)) FILTER (WHERE l_returnflag = 'R') AS BIGINT) AS cost,
           CAST(SUM(ROUND(l_extendedprice * 100)) FILTER (WHERE l_returnflag <> 'R') AS BIGINT) AS invoice,
           CAST(SUM(ROUND(l_extendedprice * 100)) FILTER (WHERE l_returnflag <> 'R') AS BIGINT)
           - CAST(SUM(ROUND(l_extendedprice * 100)) FILTER (WHERE l_returnflag = 'R') AS BIGINT) AS profit
    FROM lineitem GROUP BY 1
""")
def q_project_profit(spark, folder):
    lines = table(spark, folder, "lineitem")
    kind = predicates.replace_values("l_returnflag", {"R": "cost", "A": "invoice", "N": "invoice"})
    entries = lines.select(F.col("l_suppkey").alias("project"), kind.alias("kind"), amounts.cents("l_extendedprice").alias("cents"))
    return retail.project_profit(entries, "project", "kind", "cents")


@query("""
    WITH quota(p_type, target_quota) AS (VALUES ('ECONOMY', 260000), ('LARGE', 250000), ('MEDIUM', 240000), ('PROMO', 230000), ('SMALL', 255000), ('STANDARD', 265000)),
    made AS (SELECT p_type, CAST(SUM(l_quantity) AS BIGINT) AS total_produced FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
    SELECT p_type, CAST(target_quota AS BIGINT) AS target_quota, total_produced, target_quota - total_produced AS spare_capacity FROM quota JOIN made USING (p_type)
""")
def q_quota(spark, folder):
    rows = [("ECONOMY", 260_000), ("LARGE", 250_000), ("MEDIUM", 240_000), ("PROMO", 230_000), ("SMALL", 255_000), ("STANDARD", 265_000)]
    quota = lookups.inline_table(spark, rows, "p_type string, target_quota long")
    per_part = table(spark, folder, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("quantity"))
    joined = per_part.join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    made = joined.groupBy("p_type").agg(F.sum("quantity").cast("long").alias("total_produced"))
    spare = F.col("target_quota") - F.col("total_produced")
    return lookups.lookup(made, quota, "p_type", "inner").select("p_type", "target_quota", "total_produced", spare.alias("spare_capacity"))


@query("""
    SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS joined_on, o_totalprice FROM orders
    QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1
""")
def q_first_order(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("joined_on"), "o_totalprice")
    return groups.earliest_of_group(orders, ["o_custkey"], ["joined_on", "o_orderkey"])


@query("""
    SELECT user_id, event_id, ts, event_type FROM events QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def q_latest_event(spark, folder):
    events = table(spark, folder, "events").select("user_id", "event_id", "ts", "event_type")
    return groups.latest_of_group(events, ["user_id"], ["ts", "event_id"])


@query("""
    WITH c AS (SELECT *, CAST(SUM(ROUND(c_acctbal * 100)) OVER w AS BIGINT) AS total, COUNT(*) OVER w AS n, MIN(c_acctbal) OVER w AS lowest,
                      MAX(c_acctbal) OVER w AS highest FROM customer WINDOW w AS (PARTITION BY c_nationkey))
    SELECT c_custkey, c_nationkey, total, total / n AS mean, lowest, highest, n FROM c
""")
def q_partition_stats(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal", amounts.cents("c_acctbal").alias("cents"))
    stats = {"total": F.sum("cents"), "n": F.count(F.lit(1)), "lowest": F.min("c_acctbal"), "highest": F.max("c_acctbal")}
    described = groups.with_group_stats(customer, ["c_nationkey"], stats)
    return described.withColumn("mean", F.col("total") / F.col("n")).drop("c_acctbal", "cents")


@query("""
    WITH n AS (SELECT c_mktsegment, c_nationkey, c_nationkey % 5 AS region, COUNT(*) AS accepted FROM customer GROUP BY ALL),
    s AS (SELECT c_mktsegment, c_nationkey, region, accepted / (CASE WHEN region = 0 THEN 75 ELSE 25 END) AS prop_accepted FROM n)
    SELECT c_mktsegment, c_nationkey, region, prop_accepted, CASE WHEN prop_accepted = MAX(prop_accepted) OVER (PARTITION BY c_mktsegment, region) THEN 'high'
           WHEN prop_accepted = MIN(prop_accepted) OVER (PARTITION BY c_mktsegment, region) THEN 'low' ELSE 'middle' END AS school_performance
    FROM s
""")
def q_performance(spark, folder):
    counts = groups.count_by(table(spark, folder, "customer"), "c_mktsegment", "c_nationkey", name="accepted").withColumn("region", F.col("c_nationkey") % 5)
    allocation = F.when(F.col("region") == 0, 75).otherwise(25)
    shares = counts.select("c_mktsegment", "c_nationkey", "region", (F.col("accepted") / allocation).alias("prop_accepted"))
    spans = groups.with_group_stats(shares, ["c_mktsegment", "region"], {"best": F.max("prop_accepted"), "worst": F.min("prop_accepted")})
    share = F.col("prop_accepted")
    label = predicates.first_match([(share == F.col("best"), "high"), (share == F.col("worst"), "low")], "middle")
    return spans.withColumn("school_performance", label).drop("best", "worst")


@query("""
    WITH g AS (SELECT *, epoch_us(ts) - epoch_us(LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS gap FROM events),
    m AS (SELECT dayname(ts) AS weekday, CAST(SUM(gap) AS BIGINT) / COUNT(gap) / 1000000 AS mean_gap_seconds FROM g GROUP BY 1)
    SELECT RANK() OVER (ORDER BY mean_gap_seconds DESC) AS rank, weekday, ROUND(mean_gap_seconds, 3) AS mean_gap_seconds FROM m
""")
def q_mean_gap_weekday(spark, folder):
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    events = table(spark, folder, "events").select("user_id", "event_id", "ts", micros.alias("at"))
    spaced = ordered.difference_to_previous(events, ["user_id"], [F.col("ts"), F.col("event_id")], F.col("at"), "gap")
    per_day = spaced.groupBy(F.to_date("ts").alias("day")).agg(F.sum("gap").alias("gap"), F.count("gap").alias("gaps"))
    means = per_day.groupBy(dates.weekday_name("day").alias("weekday")).agg((F.sum("gap") / F.sum("gaps") / 1_000_000).alias("mean_gap_seconds"))
    return ranks.ranked(means, [], "mean_gap_seconds", descending=True).withColumn("mean_gap_seconds", F.round("mean_gap_seconds", 3))


@query("""
    WITH p AS (SELECT user_id, 100 * COUNT(*) FILTER (WHERE value > 100) / COUNT(*) AS pct_over FROM events GROUP BY 1)
    SELECT RANK() OVER (ORDER BY pct_over DESC) AS rank, user_id, pct_over FROM p
""")
def q_pct_over_ranked(spark, folder):
    over = F.count_if(F.col("value") > 100)
    shares = table(spark, folder, "events").groupBy("user_id").agg((100 * over / F.count(F.lit(1))).alias("pct_over"))
    return ranks.ranked(shares, [], "pct_over", descending=True)


@query("""
    WITH m AS (SELECT date_trunc('month', o_orderdate) AS month, o_orderpriority AS bank, CAST(SUM(ROUND(o_totalprice * 100)) AS BIGINT) AS total FROM orders GROUP BY ALL),
    r AS (SELECT *, RANK() OVER (PARTITION BY month ORDER BY total DESC) AS rank FROM m)
    SELECT bank, strftime(month, '%B-%Y') AS transactions_in, total AS total_transaction_value, rank,
           AVG(total) OVER (PARTITION BY rank) AS mean_transaction_value_per_rank, AVG(rank) OVER (PARTITION BY bank) AS mean_rank_per_bank
    FROM r
""")
def q_monthly_rank(spark, folder):
    return bank.monthly_ranking(_transactions(spark, folder).withColumn("value", amounts.cents("o_totalprice")))


@query("""
    WITH n AS (SELECT c_mktsegment, c_nationkey, COUNT(*) AS vote_count FROM customer GROUP BY ALL)
    SELECT *, RANK() OVER (PARTITION BY c_mktsegment ORDER BY vote_count DESC) AS rank FROM n QUALIFY rank <= 5
""")
def q_top5_group(spark, folder):
    votes = groups.count_by(table(spark, folder, "customer"), "c_mktsegment", "c_nationkey", name="vote_count")
    return ranks.best_of_group(votes, ["c_mktsegment"], "vote_count", 5, descending=True)


@query("""
    SELECT o_custkey, CAST(SUM(ROUND(o_totalprice * 100)) AS BIGINT) AS cents, SUM(ROUND(o_totalprice * 100)) / (SELECT SUM(ROUND(o_totalprice * 100)) FROM orders) AS share FROM orders GROUP BY 1
""")
def q_share_total(spark, folder):
    spend = table(spark, folder, "orders").groupBy("o_custkey").agg(F.sum(amounts.cents("o_totalprice")).alias("cents"))
    return groups.share_of_total(spend, "cents", "share")
