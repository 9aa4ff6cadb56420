"""Projections, tests, text, amounts and dates."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tidyloom.functions import amounts, dates, predicates, text
from tidyloom.operators import groups, reshape
from tidyloom.plans import staff
from tidyloom.queries.registry import query, table
from tidyloom.sources import lookups


@query("""
    SELECT c_custkey, c_name || ', ' || n_name AS full_name, lower(c_name || '.' || n_name || '@' || c_mktsegment || '.com') AS contact
    FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def q_full_name(spark, folder):
    nation = table(spark, folder, "nation")
    customer = table(spark, folder, "customer")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey",
        text.joined_name("c_name", "n_name", ", ").alias("full_name"),
        text.email("c_name", "n_name", "c_mktsegment").alias("contact"),
    )


@query("""
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Online' WHEN 'O' THEN 'In-Person' END AS method FROM orders
""")
def q_method_case(spark, folder):
    status = F.col("o_orderstatus")
    method = predicates.first_match([(status == "F", "Online"), (status == "O", "In-Person")])
    return table(spark, folder, "orders").select("o_orderkey", method.alias("method"))


@query("""
    WITH t AS (
        SELECT o_orderkey, o_totalprice, CAST(floor(o_totalprice / 100) AS BIGINT) AS tenths, CAST(floor(o_totalprice) AS BIGINT) AS whole FROM orders),
    written AS (
        SELECT *, CASE WHEN tenths < 500 THEN '$' || whole
                       WHEN tenths < 2500 THEN '$' || (tenths // 10) || '.' || (tenths % 10) || 'K'
                       ELSE '$' || (tenths // 10000) || '.' || lpad(CAST(tenths % 10000 AS VARCHAR), 4, '0') || 'M' END AS amount_text FROM t)
    SELECT o_orderkey, amount_text,
           CAST(trunc(CAST(regexp_extract(amount_text, '(\\d+\\.\\d+|\\d+)') AS DOUBLE)
                * CASE right(amount_text, 1) WHEN 'K' THEN 1000 WHEN 'M' THEN 1000000 ELSE 1 END) AS BIGINT) AS amount,
           whole AS grouped_amount, o_totalprice AS price
    FROM written
""")
def q_parse_money(spark, folder):
    tenths, whole = F.col("tenths"), F.col("whole")
    written = predicates.first_match(
        [
            (tenths < 500, F.concat(F.lit("$"), whole.cast("string"))),
            (tenths < 2500, F.concat(F.lit("$"), F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit("K"))),
        ],
        F.concat(F.lit("$"), F.floor(tenths / 10000).cast("string"), F.lit("."), F.lpad((tenths % 10000).cast("string"), 4, "0"), F.lit("M")),
    )
    grouped = F.concat(F.floor(whole / 1000).cast("string"), F.lit(","), F.lpad((whole % 1000).cast("string"), 3, "0"))
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        F.floor(F.col("o_totalprice") / 100).alias("tenths"),
        F.floor("o_totalprice").alias("whole"),
        F.concat(F.lit("$"), F.col("o_totalprice").cast("string")).alias("price_text"),
    )
    return orders.withColumns({"amount_text": written, "grouped_text": grouped}).select(
        "o_orderkey",
        "amount_text",
        amounts.parse_amount("amount_text").alias("amount"),
        amounts.parse_grouped_amount("grouped_text").alias("grouped_amount"),
        amounts.parse_price("price_text").alias("price"),
    )


@query("""
    SELECT CASE WHEN o_totalprice = 250000 THEN 'y' ELSE 'n' END AS eq, CASE WHEN o_totalprice < 100000 THEN 'y' ELSE 'n' END AS lt,
           CASE WHEN o_totalprice <= 200000 THEN 'y' ELSE 'n' END AS le, CASE WHEN o_totalprice > 300000 THEN 'y' ELSE 'n' END AS gt,
           CASE WHEN o_totalprice >= 400000 THEN 'y' ELSE 'n' END AS ge, CASE WHEN o_orderstatus IN ('F', 'P') THEN 'y' ELSE 'n' END AS listed,
           COUNT(*) AS orders
    FROM orders GROUP BY ALL
""")
def q_if_else(spark, folder):
    tests = {
        "eq": ("o_totalprice", 250000, "=="),
        "lt": ("o_totalprice", 100000, "<"),
        "le": ("o_totalprice", 200000, "<="),
        "gt": ("o_totalprice", 300000, ">"),
        "ge": ("o_totalprice", 400000, ">="),
        "listed": ("o_orderstatus", ["F", "P"], "in"),
    }
    labels = [predicates.if_else(column, value, "y", "n", op).alias(name) for name, (column, value, op) in tests.items()]
    return groups.count_by(table(spark, folder, "orders"), *labels, name="orders")


@query("""
    SELECT c_mktsegment, c_mktsegment IN ('BUILDING', 'MACHINERY') AS is_listed, COUNT(*) AS customers
    FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') OR c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'FURNITURE')
    GROUP BY ALL
""")
def q_isin(spark, folder):
    segment = F.col("c_mktsegment")
    listed = segment.isin("BUILDING", "MACHINERY")
    kept = table(spark, folder, "customer").where(listed | ~segment.isin("BUILDING", "MACHINERY", "FURNITURE"))
    return groups.count_by(kept, "c_mktsegment", listed.alias("is_listed"), name="customers")


@query("""
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'Not provided' WHEN floor(c_acctbal / 100) < 20 THEN 'Under 20 years'
        WHEN floor(c_acctbal / 100) >= 70 THEN '70+ years'
        ELSE (5 * CAST(floor(c_acctbal / 500) AS INTEGER)) || '-' || (5 * CAST(floor(c_acctbal / 500) AS INTEGER) + 4) || ' years' END AS age_range
    FROM customer
""")
def q_age_band(spark, folder):
    age = F.when(F.col("c_acctbal") >= 0, F.floor(F.col("c_acctbal") / 100))
    aged = table(spark, folder, "customer").select("c_custkey", age.alias("age"))
    return aged.select("c_custkey", predicates.label_null("age", predicates.banded("age", staff.age_bands())).alias("age_range"))


@query("""
    WITH e AS (SELECT event_id, event_type, CASE WHEN value >= 1 THEN value END AS value, CASE WHEN event_type <> 'error' THEN props END AS props FROM events)
    SELECT event_type, COUNT(*) FILTER (WHERE value IS NOT NULL) AS with_value,
           COUNT(*) FILTER (WHERE value IS NOT NULL AND props IS NOT NULL) AS complete
    FROM e GROUP BY event_type HAVING COUNT(value) > 0
""")
def q_dropna(spark, folder):
    events = table(spark, folder, "events").select(
        "event_type",
        F.when(F.col("value") >= 1, F.col("value")).alias("value"),
        F.when(F.col("event_type") != "error", F.col("props")).alias("props"),
    )
    kept = events.dropna(subset=["value"])
    complete = groups.count_by(events.dropna(), "event_type", name="complete")
    joined = groups.count_by(kept, "event_type", name="with_value").join(complete, "event_type", "left")
    return joined.fillna(0, subset=["complete"])


@query("""
    SELECT CASE WHEN l_extendedprice < 25000 THEN 'Small' WHEN l_extendedprice < 50000 THEN 'Medium' WHEN l_extendedprice < 75000 THEN 'Large'
                ELSE 'Very Large' END AS price_band,
           CASE WHEN l_quantity BETWEEN 1 AND 10 THEN 'few' WHEN l_quantity BETWEEN 11 AND 40 THEN 'some' END AS quantity_band, COUNT(*) AS lines
    FROM lineitem GROUP BY ALL
""")
def q_price_band(spark, folder):
    price = predicates.below("l_extendedprice", [(25_000, "Small"), (50_000, "Medium"), (75_000, "Large")], "Very Large")
    quantity = predicates.banded("l_quantity", [(1, 10, "few"), (11, 40, "some")])
    return groups.count_by(table(spark, folder, "lineitem"), price.alias("price_band"), quantity.alias("quantity_band"), name="lines")


@query("""
    WITH shipped AS (SELECT l_orderkey, MIN(CAST(l_shipdate AS DATE)) AS first_ship, MAX(CAST(l_shipdate AS DATE)) AS last_ship FROM lineitem GROUP BY 1),
    spans AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS hired_on,
        CASE WHEN first_ship IS NULL THEN DATE '2001-12-31' WHEN DATE '2001-12-31' <= first_ship THEN DATE '2001-12-31' ELSE first_ship END AS until
        FROM orders LEFT JOIN shipped ON o_orderkey = l_orderkey)
    SELECT o_orderkey, until, CAST(floor((until - hired_on) / 365.25) AS BIGINT) AS tenure_years,
           CAST(floor(12 * (until - hired_on) / 365.25) AS BIGINT) AS tenure_months
    FROM spans
""")
def q_tenure(spark, folder):
    shipped = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.to_date(F.min("l_shipdate")).alias("left_on"))
    orders = table(spark, folder, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("hired_on"))
    spans = orders.join(shipped, "o_orderkey", "left")
    spans = spans.withColumn("until", dates.earliest(F.lit(datetime.date(2001, 12, 31)), "left_on"))
    return spans.select(
        "o_orderkey",
        "until",
        dates.whole_years_between("hired_on", "until").alias("tenure_years"),
        dates.whole_months_between("hired_on", "until").alias("tenure_months"),
    )


@query("""
    SELECT o_orderkey, CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS priority_code, split_part(o_orderpriority, '-', 2) AS priority_name
    FROM orders
""")
def q_split_cols(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        text.part("o_orderpriority", "-", 0).cast("int").alias("priority_code"),
        text.part("o_orderpriority", "-", 1).alias("priority_name"),
    )


@query("""
    SELECT CAST(o_orderdate AS DATE) AS flew_on, CAST(o_orderkey AS BIGINT) AS flight_number, o_orderstatus AS "from", c_mktsegment AS "to",
           o_orderpriority AS seat_class, o_totalprice AS price, c_custkey
    FROM orders JOIN customer ON o_custkey = c_custkey
""")
def q_regex_groups(spark, folder):
    joined = table(spark, folder, "orders").join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    slashes = F.lit("//")
    detail = F.concat(
        F.to_date("o_orderdate").cast("string"), slashes, F.col("o_orderkey").cast("string"), slashes,
        "o_orderstatus", F.lit("-"), "c_mktsegment", slashes, F.translate("o_orderpriority", "-", "~"), slashes,
        F.col("o_totalprice").cast("string"),
    )
    pattern = r"^(.+)//(.+)//(.+)-(.+)//(.+)//(.+)$"
    names = ["flew_on", "flight_number", "from", "to", "seat_class", "price"]
    split = reshape.split_groups(joined.select(detail.alias("detail"), "c_custkey"), "detail", pattern, names)
    return split.withColumns(
        {
            "flew_on": dates.parse_date("flew_on", "iso"),
            "flight_number": F.col("flight_number").cast("long"),
            "seat_class": F.translate("seat_class", "~", "-"),
            "price": F.col("price").cast("double"),
        }
    )


@query("""
    SELECT c_custkey, CAST(regexp_extract(c_name, '(\\d+)$', 1) AS BIGINT) AS name_number, CAST(NULL AS VARCHAR) AS missing FROM customer
""")
def q_regex_extract(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey", text.extract("c_name", r"(\d+)$").cast("long").alias("name_number"), text.extract("c_name", r"(%+)").alias("missing")
    )


@query("""
    WITH n AS (SELECT event_id, unnest(regexp_extract_all(props, '\\d+')) AS number FROM events)
    SELECT CAST(number AS BIGINT) AS number, COUNT(*) AS events FROM n GROUP BY 1
""")
def q_regex_all(spark, folder):
    numbers = table(spark, folder, "events").select(F.explode(text.extract_all("props", r"\d+")).alias("number"))
    return groups.count_by(numbers.select(F.col("number").cast("long").alias("number")), "number", name="events")


@query("""
    SELECT c_custkey, 'GB' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || replace(c_name, 'Customer#', '') || upper(substr(c_mktsegment, 1, 4)) AS iban
    FROM customer
""")
def q_code_concat(spark, folder):
    digits = text.pad_left(F.col("c_nationkey").cast("string"), 2)
    iban = F.concat(F.lit("GB"), digits, text.remove_text("c_name", "Customer#"), F.upper(F.substring("c_mktsegment", 1, 4)))
    return table(spark, folder, "customer").select("c_custkey", iban.alias("iban"))


@query("""
    SELECT o_orderkey, CASE WHEN length(CAST(o_orderkey AS VARCHAR)) < 3 THEN lpad(CAST(o_orderkey AS VARCHAR), 3, '0') ELSE CAST(o_orderkey AS VARCHAR) END AS padded
    FROM orders
""")
def q_pad(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", text.pad_left(F.col("o_orderkey").cast("string"), 3).alias("padded"))


_PRINTED = {
    "iso": "yyyy-MM-dd",
    "month_first": "M/d/yyyy",
    "day_first": "dd/MM/yyyy",
    "day_short_month": "dd-MMM-yyyy",
    "day_long_month": "d-MMMM-yyyy",
    "month_first_short_year": "MM-dd-yy",
    "joined_long_month": "ddMMMMyyyy",
    "written": "EEEE, dd MMMM, yyyy",
}


@query("SELECT o_orderkey, " + ", ".join(f"CAST(o_orderdate AS DATE) AS {name}" for name in _PRINTED) + " FROM orders")
def q_parse_dates(spark, folder):
    printed = table(spark, folder, "orders").select(
        "o_orderkey", *[F.date_format("o_orderdate", pattern).alias(name) for name, pattern in _PRINTED.items()]
    )
    return printed.select("o_orderkey", *[dates.parse_date(name, name).alias(name) for name in _PRINTED])


@query("""
    SELECT strftime(ts, '%H:%M') || ':00' AS starts_at, COUNT(*) AS events FROM events GROUP BY 1
""")
def q_time_of_day(spark, folder):
    written = table(spark, folder, "events").select(F.date_format("ts", "H:mm").alias("time"))
    return groups.count_by(written, dates.time_of_day("time").alias("starts_at"), name="events")


@query("""
    SELECT o_orderkey, CASE WHEN month(o_orderdate) = 2 AND day(o_orderdate) = 29 THEN NULL
        ELSE make_date(2022, CAST(month(o_orderdate) AS INTEGER), CAST(day(o_orderdate) AS INTEGER)) END AS birthday,
        monthname(o_orderdate) AS birthday_month,
        CASE WHEN month(o_orderdate) = 2 AND day(o_orderdate) = 29 THEN NULL
        ELSE dayname(make_date(2022, CAST(month(o_orderdate) AS INTEGER), CAST(day(o_orderdate) AS INTEGER))) END AS birthday_weekday
    FROM orders
""")
def q_birthday(spark, folder):
    moved = table(spark, folder, "orders").select(
        "o_orderkey", dates.anniversary("o_orderdate", 2022).alias("birthday"), dates.month_name("o_orderdate").alias("birthday_month")
    )
    return moved.withColumn("birthday_weekday", dates.weekday_name("birthday"))


@query("""
    WITH n AS (SELECT user_id, COUNT(*) FILTER (WHERE event_type = 'error' AND value > 100) AS errors,
                      COUNT(*) FILTER (WHERE event_type = 'click' AND value > 100) AS clicks, COUNT(*) AS events FROM events GROUP BY user_id)
    SELECT user_id, ROUND(errors / NULLIF(clicks, 0), 3) AS rate_errors,
           CASE WHEN errors / events >= 0.05 THEN FALSE WHEN errors / events < 0.05 THEN TRUE END AS is_under_threshold FROM n
""")
def q_rates(spark, folder):
    over = lambda kind: F.count_if((F.col("event_type") == kind) & (F.col("value") > 100))
    counts = table(spark, folder, "events").groupBy("user_id").agg(
        over("error").alias("errors"), over("click").alias("clicks"), F.count(F.lit(1)).alias("events")
    )
    share = amounts.ratio("errors", "events")
    return counts.select(
        "user_id",
        F.round(amounts.ratio("errors", "clicks"), 3).alias("rate_errors"),
        predicates.three_state(share < 0.05, share >= 0.05).alias("is_under_threshold"),
    )


@query("""
    SELECT o_orderkey, CASE WHEN o_orderdate >= DATE '2000-09-01' THEN 1 WHEN o_orderdate >= DATE '1999-09-01' THEN 2
        WHEN o_orderdate >= DATE '1998-09-01' THEN 3 WHEN o_orderdate >= DATE '1997-09-01' THEN 4 END AS school_year
    FROM orders
""")
def q_school_year(spark, folder):
    year = dates.academic_year(F.to_date("o_orderdate"), datetime.date(2000, 9, 1))
    return table(spark, folder, "orders").select("o_orderkey", year.alias("school_year"))


@query("""
    SELECT CAST((quarter(o_orderdate) + 1) % 4 + 1 AS INTEGER) AS fiscal_quarter,
           CAST((quarter(o_orderdate) + 1) % 4 + 1 AS INTEGER) AS mapped_quarter, COUNT(*) AS orders
    FROM orders GROUP BY ALL
""")
def q_fiscal_quarter(spark, folder):
    quarters = lookups.inline_table(spark, [(1, 3), (2, 4), (3, 1), (4, 2)], "calendar_quarter int, mapped_quarter int")
    dated = table(spark, folder, "orders").select(
        F.quarter("o_orderdate").alias("calendar_quarter"), dates.fiscal_quarter("o_orderdate").alias("fiscal_quarter")
    )
    return groups.count_by(lookups.lookup(dated, quarters, "calendar_quarter", "inner"), "fiscal_quarter", "mapped_quarter", name="orders")
