"""Shop and flight jobs on inputs that are derived from the given tables."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tidyloom.functions import amounts
from tidyloom.operators import groups, scaffold
from tidyloom.plans import flights, retail
from tidyloom.queries.registry import query, table
from tidyloom.sources import lookups

MONTHS = [datetime.date(2000, number, 1).strftime("%B") for number in range(1, 13)]


@query("""
    SELECT c_custkey AS person_id, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN make_date(2023, 1, CAST(1 + c_custkey % 28 AS INTEGER))
        ELSE make_date(2023, 2, CAST(1 + c_custkey % 28 AS INTEGER)) END AS joined_on, c_mktsegment AS ethnicity, DATE '1980-01-01' + CAST(c_custkey % 9000 AS INTEGER) AS born_on,
        'Type ' || c_nationkey AS account_type
    FROM customer
""")
def q_new_customers(spark, folder):
    customer = table(spark, folder, "customer")
    born = F.date_format(F.date_add(F.lit("1980-01-01").cast("date"), (F.col("c_custkey") % 9000).cast("int")), "M/d/yyyy")
    facts = {"Ethnicity": F.col("c_mktsegment"), "Date of Birth": born, "Account Type": F.concat(F.lit("Type "), F.col("c_nationkey").cast("string"))}
    listed = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), v.alias("v")) for k, v in facts.items()]))
    day = (F.col("c_custkey") % 28 + 1).cast("int")
    first = F.col("c_mktsegment").isin("BUILDING", "MACHINERY")

    def sheet(rows, header):
        exploded = rows.select(F.col("c_custkey").alias("ID"), day.alias("Joining Day"), listed.alias("_f"))
        return exploded.select("ID", "Joining Day", F.col("_f.k").alias(header), F.col("_f.v").alias("Value"))

    return retail.new_customers({"January": sheet(customer.where(first), "Demographic"), "February": sheet(customer.where(~first), "Demagraphic")})


_BIKE_HEADERS = [["Store", "Bike Type", "Order Date", "Sales", "Model"], ["*Store", "*BikeType", "*Order Date", "*Sales", "*Model"], ["Store", "BikeType", "OrderDate", "Sales", "Model"]]


@query("""
    WITH s AS (SELECT o_orderpriority AS store_location, CAST((quarter(o_orderdate) + 1) % 4 + 1 AS INTEGER) AS fiscal_quarter, CAST(SUM(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS volume_sold
               FROM orders GROUP BY ALL)
    SELECT *, ROUND(100 * (volume_sold / LAG(volume_sold) OVER (PARTITION BY store_location ORDER BY fiscal_quarter) - 1), 1) AS pct_diff FROM s
""")
def q_bike_quarters(spark, folder):
    cells = [F.col("o_orderpriority"), F.col("o_orderstatus"), F.date_format("o_orderdate", "EEEE, d, yyyy"), F.floor("o_totalprice").cast("string"), F.lit("m")]
    rows = table(spark, folder, "orders").select(F.date_format("o_orderdate", "MMMM").alias("sheet"), F.array(*cells).alias("cells"))
    headers = {month: _BIKE_HEADERS[number % 3] for number, month in enumerate(MONTHS, start=1)}
    return retail.fiscal_quarter_change(retail.clean_bike_rows(rows, headers))


@query("""
    WITH s AS (SELECT year(o_orderdate) AS year, quarter(o_orderdate) AS q, CAST(SUM(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS v, COUNT(*) AS n FROM orders GROUP BY ALL)
    SELECT year, CAST(SUM(v // 1000 * 1000) AS BIGINT) AS sales, CAST(SUM(n * 1000) AS BIGINT) AS profits FROM s GROUP BY 1
""")
def q_annual_sales(spark, folder):
    orders = table(spark, folder, "orders")
    quarterly = orders.groupBy(F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q")).agg(F.sum(F.floor("o_totalprice")).alias("v"), F.count(F.lit(1)).alias("n"))
    written = quarterly.select(
        "y", F.concat(F.lit("Q"), F.col("q").cast("string")).alias(" "),
        F.concat(F.floor(F.col("v") / 1000).cast("string"), F.lit("K")).alias("Sales"), F.concat(F.col("n").cast("string"), F.lit("K")).alias("Profits"),
    )
    # The years come from the data: all sheets in one frame, each row with its sheet's name.
    return retail.annual_sales(written.withColumn("sheet", F.col("y").cast("string")).drop("y"))


@query("""
    SELECT o_orderkey AS receipt_number, 'x' AS gender, o_orderstatus = 'F' AS is_online, o_totalprice AS sale_value, c_custkey AS customer_id, dayname(o_orderdate) AS weekday,
           RANK() OVER (PARTITION BY dayname(o_orderdate) ORDER BY o_totalprice DESC) AS rank
    FROM orders JOIN customer ON o_custkey = c_custkey
""")
def q_weekday_ranking(spark, folder):
    customer = table(spark, folder, "customer")
    joined = table(spark, folder, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    spending = joined.select(
        F.col("c_name").alias("first_name"), F.col("c_mktsegment").alias("last_name"), F.lit("x").alias("gender"), F.col("o_orderkey").alias("receipt_number"),
        F.col("o_orderdate").alias("purchased_on"), (F.col("o_orderstatus") == "F").alias("is_online"), F.col("o_totalprice").alias("sale_value"),
    )
    names = customer.select(F.col("c_name").alias("first_name"), F.col("c_mktsegment").alias("last_name"), F.col("c_custkey").alias("customer_id"))
    return retail.weekday_ranking(spending, names)


@query("""
    SELECT o_orderkey AS receipt_number, o_totalprice / 1000 / 50 AS loyalty_points,
           CASE WHEN o_totalprice / 1000 / 50 >= 7 THEN 'MegaByte' WHEN o_totalprice / 1000 / 50 >= 5 THEN 'Byte' ELSE 'NullByte' END AS loyalty_points_category
    FROM orders
""")
def q_receipt_points(spark, folder):
    raw = table(spark, folder, "orders").select(
        F.lit("a").alias("First Name"), F.lit("b").alias("Last Name"), F.lit("x").alias("Gender"), F.col("o_orderkey").alias("Receipt Number"),
        F.to_date("o_orderdate").alias("Date"), (F.col("o_totalprice") / 1000).alias("Sale Total"), F.lit("Yes").alias("Online"), F.lit("No").alias("In Person"),
    )
    return retail.receipt_points(retail.clean_spending(raw))


_CLASSES = {"1-URGENT": "First Class", "2-HIGH": "Business Class", "3-MEDIUM": "Premium Economy"}


def _flights(spark, folder):
    """Orders written as one detail text, split again, the classes put right."""
    seat = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in _CLASSES.items() for x in pair]), F.col("o_orderpriority")), F.lit("Economy"))
    detail = F.concat_ws(
        "//", F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderkey").cast("string"), F.lit("London-Perth"), seat, amounts.cents("o_totalprice").cast("string")
    )
    raw = table(spark, folder, "orders").select(
        detail.alias("Flight Details"), F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("Flow Card?"), F.lit(1).alias("Bags Checked"), F.lit("x").alias("Meal Type")
    )
    return flights.correct_classes(flights.split_details(raw))


_FLIGHTS_SQL = """
    f AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS flew_on, CASE o_orderpriority WHEN '1-URGENT' THEN 'Economy' WHEN '2-HIGH' THEN 'Premium Economy' WHEN '3-MEDIUM' THEN 'Business Class' ELSE 'First Class' END AS seat_class,
                 ROUND(o_totalprice * 100)::DOUBLE AS price, o_orderstatus = 'F' AS has_flow_card FROM orders)
"""


@query(f"""
    WITH {_FLIGHTS_SQL} SELECT ROW_NUMBER() OVER (ORDER BY flew_on, CAST(o_orderkey AS VARCHAR)) AS flight_detail_id, flew_on, CAST(o_orderkey AS VARCHAR) AS flight_number, 'London' AS "from", 'Perth' AS "to",
           seat_class, price, has_flow_card, 1 AS num_bags_checked, 'x' AS meal_type
    FROM f
""")
def q_flight_details(spark, folder):
    return flights.numbered(_flights(spark, folder))


@query(f"""
    WITH {_FLIGHTS_SQL}, target AS (SELECT c AS seat_class, strftime(make_date(y, CAST(m AS INTEGER), 1), '%Y-%m') AS target_month, CAST(9000000 * m AS BIGINT) AS target_sales
        FROM (VALUES ('Economy'), ('Premium Economy'), ('Business Class'), ('First Class')) x(c), generate_series(1, 12) g(m), (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y FROM orders))
    SELECT seat_class, target_month, total_sales, target_sales, total_sales - target_sales AS difference_to_target
    FROM (SELECT seat_class, strftime(flew_on, '%Y-%m') AS target_month, SUM(price) AS total_sales FROM f GROUP BY ALL) JOIN target USING (seat_class, target_month)
""")
def q_sales_against_target(spark, folder):
    # A target for each class, month and year of the data.
    years = table(spark, folder, "orders").select(F.year("o_orderdate").alias("Year")).distinct()
    months = years.select("Year", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("Month"))
    sheets = [months.select("Year", "Month", F.lit(code).alias("Class"), (F.col("Month").cast("long") * 9_000_000).alias("Target")) for code in ("E", "PE", "BC", "FC")]
    return flights.sales_against_target(_flights(spark, folder), flights.clean_targets(sheets, "Year"))


@query("""
    SELECT q AS seat, p_partkey AS row, p_brand AS seat_class_code FROM part, (SELECT DISTINCT CAST(l_quantity AS BIGINT) AS q FROM lineitem)
    WHERE (p_partkey, q) NOT IN (SELECT (l_partkey, CAST(l_quantity AS BIGINT)) FROM lineitem)
""")
def q_unbooked_seats(spark, folder):
    # A part is a row of seats, a quantity a seat in it; every line books one.
    rows = table(spark, folder, "part").select(F.col("p_partkey").alias("Row"), F.col("p_brand").alias("Class"))
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("CustomerID"), F.col("l_quantity").cast("long").alias("Seat"), F.col("l_partkey").alias("Row"))
    plan = scaffold.key_grid(rows, lines.select("Seat").distinct()).select("Seat", "Row", "Class")
    return flights.unbooked_seats([lines.join(rows, "Row").select("CustomerID", "Seat", "Row", "Class")], plan)


def _tickets(spark, folder):
    """A flight number is a priority and status, each flies on every day of the data; every order is a ticket."""
    number = F.concat("o_orderpriority", "o_orderstatus")
    orders = table(spark, folder, "orders").select(
        F.to_date("o_orderdate").alias("flies_on"), number.alias("flight_number"), F.col("o_custkey").alias("customer_id"), F.col("o_totalprice").alias("ticket_price")
    )
    every = scaffold.key_grid(orders.select("flies_on").distinct(), orders.select("flight_number").distinct())
    all_flights = every.withColumns({"flies_from": F.lit("London"), "flies_to": F.lit("Perth")})
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("customer_id"), F.lit(datetime.date(2023, 12, 31)).alias("last_flew_on"))
    return flights.ticket_report(all_flights, customers, orders, datetime.date(2024, 1, 31))


@query("""
    SELECT o_orderpriority || o_orderstatus AS flight_number, CAST(o_orderdate AS DATE) AS flies_on, o_custkey AS customer_id, o_totalprice AS ticket_price, DATE '2023-12-31' AS last_flew_on, 'London' AS flies_from, 'Perth' AS flies_to
    FROM orders
""")
def q_ticket_detail(spark, folder):
    return _tickets(spark, folder)["ticket_sale_detail"]


_UNBOOKED_SQL = """
    SELECT flight_number, flies_on, 'London' AS flies_from, 'Perth' AS flies_to, DATE '2024-01-31' AS reported_on
    FROM (SELECT DISTINCT o_orderpriority || o_orderstatus AS flight_number FROM orders), (SELECT DISTINCT CAST(o_orderdate AS DATE) AS flies_on FROM orders)
    WHERE (flight_number, flies_on) NOT IN (SELECT (o_orderpriority || o_orderstatus, CAST(o_orderdate AS DATE)) FROM orders)
"""


@query(_UNBOOKED_SQL)
def q_unbooked_flights(spark, folder):
    return _tickets(spark, folder)["unbooked_flights"]


@query(f"""
    WITH detail AS (SELECT DATE '2023-12-31' AS last_flew_on, o_custkey AS customer_id, 'London' AS flies_from, 'Perth' AS flies_to, CAST(o_orderdate AS DATE) AS flies_on, o_orderpriority || o_orderstatus AS flight_number, o_totalprice AS ticket_price
                    FROM orders),
    flown AS ({_UNBOOKED_SQL}),
    idle AS (SELECT c_custkey AS customer_id, DATE '2023-12-31' AS last_flew_on FROM customer WHERE c_custkey NOT IN (SELECT customer_id FROM detail))
    SELECT 'ticket_sale_detail' AS "table", ROW_NUMBER() OVER (ORDER BY customer_id, flies_from, flies_on, flies_to, flight_number, last_flew_on, ticket_price) AS position,
        CAST(to_json({{'customer_id': customer_id, 'flies_from': flies_from, 'flies_on': flies_on, 'flies_to': flies_to, 'flight_number': flight_number, 'last_flew_on': last_flew_on, 'ticket_price': ticket_price}}) AS VARCHAR) AS json FROM detail
    UNION ALL
    SELECT 'unbooked_flights', ROW_NUMBER() OVER (ORDER BY flies_from, flies_on, flies_to, flight_number, reported_on),
        CAST(to_json({{'flies_from': flies_from, 'flies_on': flies_on, 'flies_to': flies_to, 'flight_number': flight_number, 'reported_on': reported_on}}) AS VARCHAR) FROM flown
    UNION ALL
    SELECT 'unbooked_customers', ROW_NUMBER() OVER (ORDER BY customer_id, last_flew_on), CAST(to_json({{'customer_id': customer_id, 'last_flew_on': last_flew_on}}) AS VARCHAR) FROM idle
""")
def q_ticket_document(spark, folder):
    report = _tickets(spark, folder)
    return flights.ticket_document({name: part.select(*sorted(part.columns)) for name, part in report.items()})


@query("""
    WITH r AS (SELECT o_orderkey AS receipt_number, 'x' AS gender, o_orderstatus = 'F' AS is_online, o_totalprice AS sale_value, c_custkey AS customer_id, dayname(o_orderdate) AS weekday,
                      RANK() OVER (PARTITION BY dayname(o_orderdate) ORDER BY o_totalprice DESC) AS rank
               FROM orders JOIN customer ON o_custkey = c_custkey)
    SELECT weekday, ROW_NUMBER() OVER (PARTITION BY weekday ORDER BY rank, receipt_number) AS position,
        CAST(to_json({'rank': rank, 'receipt_number': receipt_number, 'customer_id': customer_id, 'sale_value': sale_value}) AS VARCHAR) AS json FROM r
""")
def q_weekday_documents(spark, folder):
    ranking = q_weekday_ranking(spark, folder).select("weekday", "rank", "receipt_number", "customer_id", "sale_value")
    return retail.weekday_documents(ranking)
