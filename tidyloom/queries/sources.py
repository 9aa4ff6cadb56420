"""Sources, sinks, unions, calendars."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tidyloom.functions import amounts, dates, predicates, text
from tidyloom.operators import groups, ranks, reshape, scaffold
from tidyloom.queries.registry import query, table
from tidyloom.settings import scratch_path
from tidyloom.sources import lookups, readers, sinks

# Days the office is closed.
HOLIDAYS = [(datetime.date(2024, 1, 1), "New Year's Day"), (datetime.date(2024, 1, 15), "Founders' Day")]
HOLIDAY_SQL = "(VALUES (DATE '2024-01-01'), (DATE '2024-01-15')) h(holiday)"


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
    FROM orders
""")
def q_scan_csv(spark, folder):
    path = scratch_path(spark, "orders-csv")
    orders = table(spark, folder, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    orders.write.option("header", True).option("dateFormat", "MM/dd/yyyy").csv(path)
    return readers.read_csv(spark, path, orders.schema, date_layout="MM/dd/yyyy")


@query("""
    SELECT c_mktsegment, COUNT(*) AS customers, COUNT(*) FILTER (WHERE c_acctbal < 0) AS without_balance,
           ROUND(SUM(c_acctbal) FILTER (WHERE c_acctbal >= 0), 2) AS balance
    FROM customer GROUP BY c_mktsegment
""")
def q_scan_csv_nulls(spark, folder):
    path = scratch_path(spark, "customer-csv")
    customer = table(spark, folder, "customer").withColumn("c_acctbal", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")))
    customer.write.option("header", True).option("sep", ";").option("nullValue", "n/a").csv(path)
    back = readers.read_csv(spark, path, customer.schema, separator=";", null_marker="n/a")
    return back.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(F.col("c_acctbal").isNull()).alias("without_balance"),
        F.round(F.sum("c_acctbal"), 2).alias("balance"),
    )


@query("""
    SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS market_segment
    FROM customer
""")
def q_rename(spark, folder):
    shouted = reshape.rename_by(table(spark, folder, "customer"), str.upper)
    lowered = reshape.rename_by(reshape.rename_leading(shouted, ["Customer_ID", "Customer_Name"]), str.lower)
    mapped = reshape.rename(lowered, {"c_nationkey": "nation", "c_acctbal": "balance"})
    return reshape.rename_prefix(mapped, "c_mkt", "market_segment")


@query("""
    SELECT make_date(2023, CAST(month(o_orderdate) AS INTEGER), 1) AS file_date, COUNT(*) AS orders, ROUND(SUM(o_totalprice), 2) AS total_value
    FROM orders GROUP BY 1
""")
def q_file_month(spark, folder):
    path = scratch_path(spark, "orders-by-month")
    month = F.month("o_orderdate")
    batch = F.when(month == 1, F.lit("trades")).otherwise(F.concat(F.lit("trades-"), month.cast("string")))
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", batch.alias("batch"))
    orders.hint("rebalance", "batch").write.partitionBy("batch").option("header", True).csv(path)
    files = readers.read_csv(spark, path, "o_orderkey long, o_totalprice double", folders_hold_labels=True)
    dated = files.withColumn("file_date", readers.file_month(readers.file_path(), r"trades-(\d+)", 2023))
    return dated.groupBy("file_date").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total_value")
    )


@query("""
    SELECT lang AS code, COUNT(*) AS documents, CAST(SUM(n_chars) AS BIGINT) AS n_chars FROM documents GROUP BY lang
""")
def q_file_code(spark, folder):
    path = scratch_path(spark, "documents-by-language")
    documents = table(spark, folder, "documents").select("doc_id", "n_chars", F.concat(F.lit("en_"), "lang", F.lit("_2024")).alias("country"))
    documents.hint("rebalance", "country").write.partitionBy("country").option("header", True).csv(path)
    files = readers.read_csv(spark, path, "doc_id long, n_chars long", folders_hold_labels=True)
    name = text.extract(readers.file_path(), r"/country=([^/]+)/[^/]+$")
    return (
        files.withColumn("code", readers.file_code(name, 3, 2))
        .groupBy("code")
        .agg(F.count(F.lit(1)).alias("documents"), F.sum("n_chars").alias("n_chars"))
    )


@query("""
    SELECT CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' WHEN 'P' THEN 'Partial' END AS sheet,
           COUNT(*) AS orders, ROUND(SUM(o_totalprice), 2) AS total_value
    FROM orders WHERE o_orderstatus IN ('F', 'O', 'P') GROUP BY 1
""")
def q_labelled_union(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderstatus", "o_totalprice")
    stacked = readers.labelled_rows(orders, "sheet", {"Finished": "F", "Open": "O", "Partial": "P"}, "o_orderstatus")
    return stacked.groupBy("sheet").agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total_value"))


@query("""
    SELECT c_custkey AS party_key, c_name AS party_name, c_mktsegment, CAST(NULL AS DOUBLE) AS s_acctbal, 'customer' AS source FROM customer
    UNION ALL
    SELECT s_suppkey, s_name, NULL, s_acctbal, 'supplier' FROM supplier
""")
def q_union_diagonal(spark, folder):
    customer = table(spark, folder, "customer").select(F.col("c_custkey").alias("party_key"), F.col("c_name").alias("party_name"), "c_mktsegment")
    supplier = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("party_key"), F.col("s_name").alias("party_name"), "s_acctbal")
    frames = [customer.withColumn("source", F.lit("customer")), supplier.withColumn("source", F.lit("supplier"))]
    return readers.stack(frames, fill_missing=True)


@query("""
    SELECT m.kind, m.is_account, COUNT(*) AS events
    FROM events LEFT JOIN (VALUES ('click', 'Browse', FALSE), ('view', 'Browse', FALSE), ('purchase', 'Order', TRUE), ('signup', 'Account', TRUE))
         m(event_type, kind, is_account) USING (event_type)
    GROUP BY ALL
""")
def q_lookup_clean(spark, folder):
    kinds = lookups.inline_table(
        spark,
        [("click", "Browse", False), ("view", "Browse", False), ("purchase", "Order", True), ("signup", "Account", True)],
        "event_type string, kind string, is_account boolean",
    )
    return groups.count_by(lookups.lookup(table(spark, folder, "events"), kinds, "event_type"), "kind", "is_account", name="events")


@query(f"""
    WITH edges AS (SELECT MIN(CAST(ts AS DATE)) AS lo, MAX(CAST(ts AS DATE)) AS hi FROM events),
         days AS (SELECT CAST(UNNEST(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM edges)
    SELECT day, COUNT(e.event_id) AS events
    FROM days LEFT JOIN events e ON CAST(e.ts AS DATE) = day
    WHERE isodow(day) <= 5 AND day NOT IN (SELECT holiday FROM {HOLIDAY_SQL})
    GROUP BY day
""")
def q_calendar(spark, folder):
    events = table(spark, folder, "events").select(F.to_date("ts").alias("day"))
    holidays = lookups.inline_table(spark, HOLIDAYS, "holiday date, holiday_name string")
    days = scaffold.working_days(scaffold.dense_dates(events, "day", "day"), "day", F.broadcast(holidays), "holiday")
    return scaffold.fill_grid(days, groups.count_by(events, "day", name="events"), ["day"], {"events": 0})


@query("""
    WITH by_status AS (SELECT o_orderstatus, CAST(SUM(ROUND(o_totalprice * 100)) AS BIGINT) AS total_cents FROM orders GROUP BY 1),
         by_segment AS (SELECT c_mktsegment, COUNT(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
    SELECT 'by_status' AS "table", ROW_NUMBER() OVER (ORDER BY o_orderstatus) AS position, CAST(to_json({'o_orderstatus': o_orderstatus, 'total_cents': total_cents}) AS VARCHAR) AS json FROM by_status
    UNION ALL
    SELECT 'by_segment', ROW_NUMBER() OVER (ORDER BY c_mktsegment), CAST(to_json({'c_mktsegment': c_mktsegment, 'orders': orders}) AS VARCHAR) FROM by_segment
""")
def q_json_bundle(spark, folder):
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer")
    by_status = groups.total_by(orders, "o_orderstatus", value=amounts.cents("o_totalprice"), name="total_cents")
    per_customer = groups.count_by(orders, "o_custkey", name="n")
    joined = per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    by_segment = joined.groupBy("c_mktsegment").agg(F.sum("n").alias("orders"))
    return sinks.json_bundle({"by_status": by_status, "by_segment": by_segment})


@query("""
    WITH r AS (SELECT dayname(ts) AS weekday, event_id, user_id, RANK() OVER (PARTITION BY dayname(ts) ORDER BY value DESC) AS rank FROM events)
    SELECT weekday, ROW_NUMBER() OVER (PARTITION BY weekday ORDER BY rank, event_id) AS position, CAST(to_json({'rank': rank, 'event_id': event_id, 'user_id': user_id}) AS VARCHAR) AS json
    FROM r WHERE rank <= 3
""")
def q_json_by_key(spark, folder):
    events = table(spark, folder, "events").select(dates.weekday_name("ts").alias("weekday"), "event_id", "user_id", "value")
    best = ranks.best_of_group(events, ["weekday"], "value", 3, descending=True)
    return sinks.json_by_key(best.drop("value"), "weekday", ["rank", "event_id"])


@query("""
    SELECT o_orderstatus, o_orderpriority, COUNT(*) AS orders, CAST(MIN(o_orderdate) AS DATE) AS first_on FROM orders GROUP BY ALL
""")
def q_json_lines(spark, folder):
    path = scratch_path(spark, "totals-json")
    orders = table(spark, folder, "orders")
    totals = orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("orders"), F.to_date(F.min("o_orderdate")).alias("first_on"))
    sinks.write_json_lines(totals, path)
    return spark.read.schema(totals.schema).json(path)


@query("""
    SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'Express' WHEN '5-LOW' THEN 'Slow' ELSE o_orderpriority END AS service, COUNT(*) AS orders
    FROM orders GROUP BY 1
""")
def q_value_map(spark, folder):
    service = predicates.replace_values("o_orderpriority", {"1-URGENT": "Express", "5-LOW": "Slow"})
    return groups.count_by(table(spark, folder, "orders"), service.alias("service"), name="orders")


@query("""
    SELECT c_custkey, c_name, c_mktsegment FROM customer
""")
def q_trim_all(spark, folder):
    padded = table(spark, folder, "customer").select(
        "c_custkey",
        F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("c_name"),
        F.concat("c_mktsegment", F.lit("   ")).alias("c_mktsegment"),
    )
    return text.trim_strings(padded)


@query("""
    SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderstatus = 'F' AS is_done, floor(o_totalprice) AS whole,
           CASE WHEN o_orderkey % 2 = 0 THEN 'n' || o_custkey ELSE CAST(o_custkey AS VARCHAR) END AS mixed
    FROM orders
""")
def q_infer_csv(spark, folder):
    path = scratch_path(spark, "orders-inferred")
    mixed = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("n"), F.col("o_custkey").cast("string"))).otherwise(F.col("o_custkey").cast("string"))
    written = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate"), (F.col("o_orderstatus") == "F").alias("is_done"),
        # Whole numbers with a few broken ones among them: doubles.
        F.floor("o_totalprice").cast("double").alias("whole"), mixed.alias("mixed"),
    )
    written.write.option("header", True).option("dateFormat", "dd/MM/yyyy").csv(path)
    return readers.read_csv(spark, path, date_layout="dd/MM/yyyy")


@query("""
    SELECT o_orderpriority AS store_location, o_orderstatus AS bike_type, CASE WHEN month(o_orderdate) % 3 <> 2 THEN 'm' END AS bike_model, COUNT(*) AS orders, CAST(SUM(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS volume_sold
    FROM orders GROUP BY ALL
""")
def q_headed_files(spark, folder):
    from tidyloom.plans.retail import BIKE_COLUMNS

    path = scratch_path(spark, "orders-headed")
    orders = table(spark, folder, "orders").withColumn("part", F.month("o_orderdate") % 3)
    values = {"Store": F.col("o_orderpriority"), "Type": F.col("o_orderstatus"), "Sales": F.floor("o_totalprice").cast("string"), "Model": F.lit("m")}
    headers = [{"Store": "*Store", "Sales": "*Sales", "Type": "*BikeType", "Model": "*Model"}, {"Model": "Model", "Type": "Bike Type", "Store": "Store", "Sales": "Sales"}, {"Type": "BikeType", "Store": "Store", "Sales": "Sales"}]
    for number, header in enumerate(headers):
        part = orders.where(F.col("part") == number).select(*[values[column].alias(spelled) for column, spelled in header.items()])
        part.write.option("header", True).csv(f"{path}/part={number}")
    rows = readers.read_headed(spark, path, BIKE_COLUMNS, ["store_location", "bike_type", "bike_model", "volume_sold"])
    return rows.groupBy("store_location", "bike_type", "bike_model").agg(F.count(F.lit(1)).alias("orders"), F.sum(F.col("volume_sold").cast("long")).alias("volume_sold"))


@query("""
    SELECT CASE WHEN c_nationkey % 2 = 0 THEN 'UTF-8' ELSE 'ISO-8859-1' END AS encoding, 'é' || c_name || 'ü' AS line, CASE WHEN c_nationkey % 2 = 0 THEN 0 ELSE 2 END::INTEGER AS n_replaced FROM customer
""")
def q_two_encodings(spark, folder):
    path = scratch_path(spark, "customer-encodings")
    customer = table(spark, folder, "customer").select(F.concat(F.lit("é"), "c_name", F.lit("ü")).alias("line"), (F.col("c_nationkey") % 2).alias("part"))
    for part, encoding in enumerate(("UTF-8", "ISO-8859-1")):
        customer.where(F.col("part") == part).select("line").write.option("encoding", encoding).csv(f"{path}/part={part}")
    return readers.read_lines(spark, path).select("encoding", "line", "n_replaced")
