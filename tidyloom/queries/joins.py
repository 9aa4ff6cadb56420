"""Joins, lookups on ranges and dates, and the grids built on them."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tidyloom.functions import amounts, dates, predicates, text
from tidyloom.operators import groups, joins, ranks, reshape, scaffold
from tidyloom.plans import staff
from tidyloom.queries.registry import in_year, query, table
from tidyloom.queries.sources import HOLIDAY_SQL, HOLIDAYS
from tidyloom.sources import lookups


@query("""
    SELECT o_orderpriority, COUNT(*) AS lines, CAST(SUM(l_quantity) AS BIGINT) AS quantity
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1
""")
def q_join_inner(spark, folder):
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("order_key"), "o_orderpriority")
    # Lines are summed on the join key first, so that an order with very many of them is one row in the join.
    lines = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("order_key")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity")
    )
    return orders.join(lines, "order_key").groupBy("o_orderpriority").agg(
        F.sum("lines").alias("lines"), F.sum("quantity").cast("long").alias("quantity")
    )


@query("""
    SELECT c_mktsegment, COUNT(*) AS orders, ROUND(SUM(o_totalprice), 2) AS total_value
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1
""")
def q_join_renamed(spark, folder):
    orders = table(spark, folder, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"), F.sum("o_totalprice").alias("value"))
    joined = orders.join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.drop("c_custkey").groupBy("c_mktsegment").agg(F.sum("orders").alias("orders"), F.round(F.sum("value"), 2).alias("total_value"))


@query("""
    WITH target(method, quarter, target) AS (VALUES ('F', 1, 320000000), ('F', 2, 310000000), ('F', 3, 300000000), ('F', 4, 290000000),
                                                    ('O', 1, 325000000), ('O', 2, 315000000), ('O', 3, 305000000), ('O', 4, 295000000),
                                                    ('P', 1, 15000000), ('P', 2, 16000000), ('P', 3, 17000000), ('P', 4, 18000000)),
    total AS (SELECT o_orderstatus AS method, CAST(quarter(o_orderdate) AS INTEGER) AS quarter, ROUND(SUM(o_totalprice), 2) AS total_value FROM orders GROUP BY ALL)
    SELECT method, quarter, total_value, CAST(target AS BIGINT) AS target, ROUND(total_value - target, 2) AS variance_to_target
    FROM total JOIN target USING (method, quarter)
""")
def q_target_variance(spark, folder):
    wide = lookups.inline_table(
        spark,
        [("F", 320_000_000, 310_000_000, 300_000_000, 290_000_000), ("O", 325_000_000, 315_000_000, 305_000_000, 295_000_000), ("P", 15_000_000, 16_000_000, 17_000_000, 18_000_000)],
        "method string, `Quarter 1` long, `Quarter 2` long, `Quarter 3` long, `Quarter 4` long",
    )
    long = reshape.melt(wide, ["method"], names_to="quarter", values_to="target")
    target = long.withColumn("quarter", text.extract("quarter", r"(\d)").cast("int"))
    total = groups.total_by(table(spark, folder, "orders"), F.col("o_orderstatus").alias("method"), F.quarter("o_orderdate").alias("quarter"), value="o_totalprice")
    total = total.withColumn("total_value", F.round("total_value", 2))
    joined = lookups.lookup(total, target, ["method", "quarter"], "inner")
    return joined.withColumn("variance_to_target", F.round(F.col("total_value") - F.col("target"), 2))


@query("""
    SELECT r_name, n_name, ROUND(SUM(l_extendedprice * (1 - l_discount)), 2) AS revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
         JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY ALL
""")
def q_star(spark, folder):
    # Revenue of each order is summed before the joins, on the key of the first one.
    lines = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))
    joined = (
        lines.join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.groupBy("r_name", "n_name").agg(F.round(F.sum("revenue"), 2).alias("revenue"))


@query("""
    SELECT s.n_name AS supplier_n_name, c.n_name AS customer_n_name, COUNT(*) AS lines
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
         JOIN nation s ON s_nationkey = s.n_nationkey JOIN nation c ON c_nationkey = c.n_nationkey
    GROUP BY ALL
""")
def q_role_join(spark, folder):
    joined = (
        table(spark, folder, "lineitem")
        .join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    pairs = groups.count_by(joined, "s_nationkey", "c_nationkey", name="lines")
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    roles = {"s_nationkey": "supplier_", "c_nationkey": "customer_"}
    return joins.role_join(pairs, nation, "n_nationkey", roles).select("supplier_n_name", "customer_n_name", "lines")


@query("""
    SELECT p_partkey, p_name, year, DATE '2024-01-31' AS reported_on FROM part, (SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem)
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND year(l_shipdate) = year)
""")
def q_unbooked(spark, folder):
    shipped = table(spark, folder, "lineitem").select(F.col("l_partkey").alias("p_partkey"), F.year("l_shipdate").alias("year"))
    every = scaffold.key_grid(table(spark, folder, "part").select("p_partkey", "p_name"), shipped.select("year").distinct())
    unbooked = joins.not_in(every, shipped, ["p_partkey", "year"])
    return unbooked.withColumn("reported_on", F.lit(datetime.date(2024, 1, 31)))


@query("""
    SELECT c_custkey, c_name, year FROM customer, (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders)
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND year(o_orderdate) = year)
""")
def q_unbooked_cust(spark, folder):
    ordered = table(spark, folder, "orders").select(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("year"))
    every = scaffold.key_grid(table(spark, folder, "customer").select("c_custkey", "c_name"), ordered.select("year").distinct())
    return joins.not_in(every, ordered, ["c_custkey", "year"])


@query("""
    SELECT o_orderkey, c_name, n_name, o_totalprice, CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS is_cancelled
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    WHERE c_mktsegment <> 'BUILDING' AND o_orderstatus = 'O' AND o_totalprice > 450000
""")
def q_flagged(spark, folder):
    status = F.col("o_orderstatus")
    orders = table(spark, folder, "orders").withColumn("is_cancelled", predicates.three_state(status == "F", status == "O"))
    joined = orders.join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    flagged = (F.col("c_mktsegment") != "BUILDING") & ~F.col("is_cancelled") & (F.col("o_totalprice") > 450_000)
    return joined.where(flagged).select("o_orderkey", "c_name", "n_name", "o_totalprice", "is_cancelled")


@query("""
    SELECT o_orderkey AS employee_id, 'G' || o_custkey || '-' || o_orderkey AS guid, o_orderstatus AS status FROM orders
""")
def q_fill_ids(spark, folder):
    guid = F.concat(F.lit("G"), F.col("o_custkey").cast("string"), F.lit("-"), F.col("o_orderkey").cast("string"))
    snapshot = table(spark, folder, "orders").select(F.col("o_orderkey").alias("employee_id"), guid.alias("guid"), F.col("o_orderstatus").alias("status"))
    employees = snapshot.select(
        F.when(F.col("status") != "F", F.col("employee_id")).alias("employee_id"), F.when(F.col("status") != "O", F.col("guid")).alias("guid"), "status"
    )
    pairs = joins.id_pairs([employees, snapshot], "employee_id", "guid")
    return joins.fill_ids(employees, pairs, "employee_id", "guid")


@query("""
    WITH c AS (SELECT c_custkey, c_nationkey, CAST(right(c_name, 9) AS BIGINT) AS number, substr(c_mktsegment, 1, 1) AS initial FROM customer),
         s AS (SELECT s_suppkey, s_nationkey, CAST(right(s_name, 9) AS BIGINT) AS number FROM supplier)
    SELECT c_custkey, initial, s_suppkey FROM c LEFT JOIN s ON c_nationkey = s_nationkey AND c.number = s.number
""")
def q_natural_key(spark, folder):
    number = lambda name: text.part(name, "#", 1).cast("long")
    customer = table(spark, folder, "customer").select(
        "c_custkey", F.substring("c_mktsegment", 1, 1).alias("initial"), F.col("c_nationkey").alias("nation"), number("c_name").alias("number")
    )
    supplier = table(spark, folder, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"), number("s_name").alias("number"))
    return customer.join(supplier, ["nation", "number"], "left").select("c_custkey", "initial", "s_suppkey")


@query("""
    WITH band(code, lower_threshold, upper_threshold, rate) AS (VALUES ('basic', 12570, 50270, 0.2::DOUBLE), ('higher', 50270, 125140, 0.4::DOUBLE), ('additional', 125140, NULL, 0.45::DOUBLE)),
    salary AS (SELECT o_custkey AS staff_id, CAST(floor(CAST(SUM(ROUND(o_totalprice * 100)) AS BIGINT) / 3000) AS BIGINT) AS annual_salary FROM orders GROUP BY 1),
    due AS (SELECT staff_id, annual_salary, code, ROUND(rate * (LEAST(annual_salary, upper_threshold) - lower_threshold), 2) AS tax FROM salary, band)
    SELECT staff_id, annual_salary, ROUND(SUM(tax), 2) AS total_tax_liability, MAX(tax) FILTER (WHERE code = 'basic') AS basic,
           MAX(tax) FILTER (WHERE code = 'higher') AS higher, MAX(tax) FILTER (WHERE code = 'additional') AS additional,
           CASE WHEN COUNT(*) FILTER (WHERE code = 'additional') > 0 THEN 'Additional (45%)'
                WHEN COUNT(*) FILTER (WHERE code = 'higher') > 0 THEN 'Higher (40%)' ELSE 'Basic (20%)' END AS max_tax_rate
    FROM due WHERE tax >= 0 GROUP BY staff_id, annual_salary
""")
def q_tax_bands(spark, folder):
    spend = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("staff_id")).agg(F.sum(amounts.cents("o_totalprice")).alias("cents"))
    taxed = staff.income_tax(spend.select("staff_id", F.floor(F.col("cents") / 3000).alias("annual_salary")))
    return taxed.withColumn("total_tax_liability", F.round("total_tax_liability", 2))


@query("""
    WITH generation(generation, lo, hi) AS (VALUES ('first', 0, 1995), ('second', 1996, 1998), ('third', 1999, 9999))
    SELECT g.generation, COUNT(*) AS orders FROM orders JOIN generation g ON year(o_orderdate) BETWEEN lo AND hi GROUP BY 1
""")
def q_generation(spark, folder):
    bands = lookups.inline_table(spark, [("first", 0, 1995), ("second", 1996, 1998), ("third", 1999, 9999)], "generation string, start_year int, end_year int")
    years = groups.count_by(table(spark, folder, "orders"), F.year("o_orderdate").alias("born_year"), name="orders")
    joined = joins.band_join(years, bands, F.col("born_year"), "start_year", "end_year")
    return joined.groupBy("generation").agg(F.sum("orders").alias("orders"))


_DAYS_SQL = f"""
    edges AS (SELECT MIN(CAST(o_orderdate AS DATE)) AS lo, MAX(CAST(o_orderdate AS DATE)) AS hi FROM orders),
    days AS (SELECT CAST(UNNEST(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM edges),
    work AS (SELECT day FROM days WHERE isodow(day) <= 5 AND day NOT IN (SELECT holiday FROM {HOLIDAY_SQL}))
"""


def _order_calendar(spark, folder):
    orders = table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("day"))
    days = scaffold.dense_dates(orders, "day", "day")
    holidays = lookups.inline_table(spark, HOLIDAYS, "holiday date, holiday_name string")
    return orders, days, scaffold.working_days(days, "day", F.broadcast(holidays), "holiday")


@query(f"""
    WITH {_DAYS_SQL}, next_day AS (SELECT d.day AS joined_on, MIN(w.day) AS reported_on FROM days d JOIN work w ON w.day >= d.day GROUP BY 1)
    SELECT reported_on, COUNT(*) AS orders FROM orders JOIN next_day ON CAST(o_orderdate AS DATE) = joined_on GROUP BY 1
""")
def q_next_workday(spark, folder):
    orders, days, work = _order_calendar(spark, folder)
    mapped = joins.next_at_or_after(days, "day", work, "day", "reported_on")
    per_day = groups.count_by(orders, "day", name="orders")
    return per_day.join(mapped, "day").groupBy("reported_on").agg(F.sum("orders").alias("orders"))


@query(f"""
    WITH {_DAYS_SQL}, following AS (SELECT day, LEAD(day) OVER (ORDER BY day) AS after FROM work)
    SELECT day, strftime(after, '%b-%y') AS reporting_month, CAST(ROW_NUMBER() OVER (PARTITION BY date_trunc('month', after) ORDER BY day) AS INTEGER) AS reporting_day
    FROM following WHERE after IS NOT NULL
""")
def q_next_report(spark, folder):
    _, _, work = _order_calendar(spark, folder)
    return joins.reporting_detail(work, "day")


@query("""
    WITH months AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders),
    facts AS (SELECT o_custkey AS agent_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, COUNT(*) AS orders FROM orders GROUP BY ALL)
    SELECT c_custkey AS agent_id, months.month, COALESCE(orders, 0) AS orders FROM customer CROSS JOIN months
    LEFT JOIN facts ON facts.agent_id = c_custkey AND facts.month = months.month
""")
def q_scaffold_month(spark, folder):
    orders = table(spark, folder, "orders")
    facts = groups.count_by(orders, F.col("o_custkey").alias("agent_id"), dates.month_start("o_orderdate").alias("month"), name="orders")
    months = orders.select(dates.month_start("o_orderdate").alias("month")).distinct()
    agents = table(spark, folder, "customer").select(F.col("c_custkey").alias("agent_id"))
    return scaffold.fill_grid(scaffold.key_grid(agents, months), facts, ["agent_id", "month"], {"orders": 0})


@query("""
    WITH d AS (SELECT c_nationkey AS center, last_day(CAST(o_orderdate AS DATE)) AS month_end, year(o_orderdate) AS y, o_orderstatus, o_orderpriority, c_mktsegment
               FROM orders JOIN customer ON o_custkey = c_custkey),
    long AS (SELECT center, month_end, 'o_orderstatus' AS demographic_type, o_orderstatus AS demographic_detail FROM d
             UNION ALL SELECT center, month_end, 'o_orderpriority', o_orderpriority FROM d UNION ALL SELECT center, month_end, 'c_mktsegment', c_mktsegment FROM d
             UNION ALL SELECT center, month_end, 'order_year', CAST(y AS VARCHAR) FROM d),
    seen AS (SELECT *, COUNT(*) AS n FROM long GROUP BY ALL),
    grid AS (SELECT * FROM (SELECT DISTINCT center, month_end FROM seen) CROSS JOIN (SELECT DISTINCT demographic_type, demographic_detail FROM seen))
    SELECT center, month_end, demographic_type, demographic_detail, COALESCE(n, 0) AS number_of_employees
    FROM grid LEFT JOIN seen USING (center, month_end, demographic_type, demographic_detail)
""")
def q_demographics(spark, folder):
    joined = table(spark, folder, "orders").join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    wide = joined.select(
        F.col("c_nationkey").alias("center"), F.last_day("o_orderdate").alias("month_end"), "o_orderstatus", "o_orderpriority", "c_mktsegment",
        F.year("o_orderdate").alias("order_year"),
    )
    return staff.demographics(wide, ["center", "month_end"], ["o_orderstatus", "o_orderpriority", "c_mktsegment", "order_year"])


@query("""
    WITH edges AS (SELECT MIN(CAST(ts AS DATE)) AS lo, MAX(CAST(ts AS DATE)) AS hi FROM events),
    days AS (SELECT CAST(UNNEST(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS term_date FROM edges),
    clubs(weekday, club_name) AS (VALUES ('Monday', 'Art Club'), ('Tuesday', 'Karate Club'), ('Friday', 'Chess Club')),
    named(term_date, event_name) AS (VALUES (DATE '2024-01-01', 'First Day of Term'), (DATE '2024-01-26', 'Last Day of Term')),
    seen AS (SELECT CAST(ts AS DATE) AS term_date, COUNT(*) AS events FROM events GROUP BY 1)
    SELECT term_date, event_name, club_name, COALESCE(events, 0) AS events
    FROM days LEFT JOIN named USING (term_date) LEFT JOIN clubs ON dayname(term_date) = weekday LEFT JOIN seen USING (term_date)
""")
def q_term_calendar(spark, folder):
    events = table(spark, folder, "events").select(F.to_date("ts").alias("term_date"))
    clubs = lookups.inline_table(spark, [("Monday", "Art Club"), ("Tuesday", "Karate Club"), ("Friday", "Chess Club")], "weekday string, club_name string")
    named = lookups.inline_table(
        spark,
        [(datetime.date(2024, 1, 1), "First Day of Term"), (datetime.date(2024, 1, 26), "Last Day of Term")],
        "term_date date, event_name string",
    )
    days = scaffold.dense_dates(events, "term_date", "term_date").withColumn("weekday", dates.weekday_name("term_date"))
    listed = lookups.lookup(lookups.lookup(days, named, "term_date"), clubs, "weekday").drop("weekday")
    return scaffold.fill_grid(listed, groups.count_by(events, "term_date", name="events"), ["term_date"], {"events": 0}).select(
        "term_date", "event_name", "club_name", "events"
    )


@query("""
    WITH benchmark(p_type, l_returnflag, benchmark) AS (VALUES ('ECONOMY', 'A', 1200), ('ECONOMY', 'R', 1300), ('PROMO', 'N', 1250), ('SMALL', 'A', 1100), ('LARGE', 'N', 1350)),
    j AS (SELECT l_orderkey, l_linenumber, p_type, l_returnflag, l_extendedprice, CAST(benchmark AS BIGINT) AS benchmark
          FROM lineitem JOIN part ON l_partkey = p_partkey JOIN benchmark USING (p_type, l_returnflag)
          WHERE l_extendedprice <= benchmark AND NOT (p_type = 'PROMO' AND l_extendedprice < 1000))
    SELECT *, RANK() OVER (PARTITION BY p_type, l_returnflag ORDER BY l_extendedprice) AS student_rank FROM j
""")
def q_athletes(spark, folder):
    standards = lookups.inline_table(
        spark,
        [("ECONOMY", "A", 1200), ("ECONOMY", "R", 1300), ("PROMO", "N", 1250), ("SMALL", "A", 1100), ("LARGE", "N", 1350)],
        "p_type string, l_returnflag string, benchmark long",
    )
    lines = table(spark, folder, "lineitem").join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    joined = lookups.lookup(lines, standards, ["p_type", "l_returnflag"], "inner")
    too_fast = (F.col("p_type") == "PROMO") & (F.col("l_extendedprice") < 1000)
    kept = joined.where((F.col("l_extendedprice") <= F.col("benchmark")) & ~too_fast)
    chosen = kept.select("l_orderkey", "l_linenumber", "p_type", "l_returnflag", "l_extendedprice", "benchmark")
    return ranks.ranked(chosen, ["p_type", "l_returnflag"], "l_extendedprice", "student_rank")
