"""Bank, call-centre and trade jobs on inputs that are derived from the given tables."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tidyloom.functions import amounts, predicates, text
from tidyloom.operators import groups
from tidyloom.plans import bank, calls, trades
from tidyloom.queries.registry import ORACLES, query, table
from tidyloom.settings import scratch_path
from tidyloom.sources import lookups, readers


def _transactions_raw(spark, folder):
    status = F.col("o_orderstatus")
    return table(spark, folder, "orders").select(
        F.concat(F.translate("o_orderpriority", "- 12345", ""), F.lit("-"), F.col("o_orderkey").cast("string")).alias("Transaction Code"),
        amounts.cents("o_totalprice").alias("Value"),
        F.col("o_custkey").alias("Customer Code"),
        predicates.first_match([(status == "F", 1), (status == "O", 2)]).alias("Online or In-Person"),
        F.col("o_orderdate").alias("Transaction Date"),
    )


_BANK_SQL = """
    t AS (SELECT translate(o_orderpriority, '- 12345', '') AS bank, CASE o_orderstatus WHEN 'F' THEN 'Online' WHEN 'O' THEN 'In-Person' END AS transaction_method,
                 o_custkey AS customer_code, CAST(o_orderdate AS DATE) AS created_on, CAST(ROUND(o_totalprice * 100) AS BIGINT) AS value FROM orders)
"""


@query(f"WITH {_BANK_SQL} SELECT bank, CAST(SUM(value) AS BIGINT) AS total_value FROM t GROUP BY ALL")
def q_bank_totals(spark, folder):
    return bank.totals(bank.clean_transactions(_transactions_raw(spark, folder)))["by_bank"]


@query(f"""
    WITH {_BANK_SQL} SELECT bank, transaction_method, dayname(created_on) AS weekday, CAST(SUM(value) AS BIGINT) AS total_value FROM t GROUP BY ALL
""")
def q_bank_totals_weekday(spark, folder):
    return bank.totals(bank.clean_transactions(_transactions_raw(spark, folder)))["by_bank_method_weekday"]


@query(f"WITH {_BANK_SQL} SELECT bank, customer_code, CAST(SUM(value) AS BIGINT) AS total_value FROM t GROUP BY ALL")
def q_bank_totals_customer(spark, folder):
    return bank.totals(bank.clean_transactions(_transactions_raw(spark, folder)))["by_bank_customer"]


@query(f"""
    WITH {_BANK_SQL}, g(transaction_method, quarter, target) AS (VALUES ('Online', 1, 7200000000), ('Online', 2, 7400000000), ('Online', 3, 7100000000), ('Online', 4, 6900000000),
        ('In-Person', 1, 7500000000), ('In-Person', 2, 7600000000), ('In-Person', 3, 7300000000), ('In-Person', 4, 7000000000))
    SELECT transaction_method, quarter, total_value, CAST(target AS BIGINT) AS target, total_value - target AS variance_to_target
    FROM (SELECT transaction_method, CAST(quarter(created_on) AS INTEGER) AS quarter, CAST(SUM(value) AS BIGINT) AS total_value FROM t WHERE bank = 'URGENT' GROUP BY ALL)
    JOIN g USING (transaction_method, quarter)
""")
def q_variance_to_target(spark, folder):
    wide = lookups.inline_table(
        spark,
        [("Online", 7_200_000_000, 7_400_000_000, 7_100_000_000, 6_900_000_000), ("In-Person", 7_500_000_000, 7_600_000_000, 7_300_000_000, 7_000_000_000)],
        "`Online or In-Person` string, Q1 long, Q2 long, Q3 long, Q4 long",
    )
    transactions = bank.clean_transactions(_transactions_raw(spark, folder))
    return bank.variance_to_target(transactions, bank.quarterly_targets(wide), "URGENT")


@query("""
    SELECT o_orderkey AS transaction_id, 'GB' || d || s || CAST(200000 + o_custkey % 10000 AS VARCHAR) || CAST(o_custkey AS VARCHAR) AS iban
    FROM orders JOIN (VALUES ('1-URGENT', '01', 'URGE'), ('2-HIGH', '12', 'HIGH'), ('3-MEDIUM', '23', 'MEDI'), ('4-NOT SPECIFIED', '34', 'NOTS'), ('5-LOW', '55', 'LOWW')) w(b, d, s) ON o_orderpriority = b
""")
def q_account_codes(spark, folder):
    sort_code = F.concat_ws("-", F.lit("20"), F.lpad(F.floor(F.col("o_custkey") % 10000 / 100).cast("string"), 2, "0"), F.lpad((F.col("o_custkey") % 100).cast("string"), 2, "0"))
    transactions = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("Transaction ID"), F.col("o_custkey").alias("Account Number"), sort_code.alias("Sort Code"), F.col("o_orderpriority").alias("Bank")
    )
    swift = lookups.inline_table(
        spark, [("1-URGENT", "URGE", "01"), ("2-HIGH", "HIGH", "12"), ("3-MEDIUM", "MEDI", "23"), ("4-NOT SPECIFIED", "NOTS", "34"), ("5-LOW", "LOWW", "55")], "Bank string, `SWIFT code` string, `Check Digits` string"
    )
    return bank.account_codes(transactions, F.broadcast(swift))


def _accounts_raw(spark, folder):
    """Each customer has an account; the holders are the customer and the next one."""
    next_holder = (F.col("c_custkey") + 1).cast("string")
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("Account Number"),
        F.when(F.col("c_mktsegment") == "BUILDING", "Platinum").otherwise("Basic").alias("Account Type"),
        F.concat_ws(", ", F.col("c_custkey").cast("string"), next_holder).alias("Account Holder ID"),
        F.lit(datetime.date(1994, 12, 31)).alias("Balance Date"),
        amounts.cents("c_acctbal").alias("Balance"),
    )


def _payments(spark, folder):
    orders = table(spark, folder, "orders")
    status = F.col("o_orderstatus")
    payments = orders.select(
        F.col("o_orderkey").alias("Transaction ID"), F.to_date("o_orderdate").alias("Transaction Date"), amounts.cents("o_totalprice").alias("Value"),
        predicates.first_match([(status == "F", "Y"), (status == "O", "N")]).alias("Cancelled?"),
    )
    paths = orders.select(
        F.col("o_orderkey").alias("Transaction ID"), F.col("o_custkey").alias("Account_From"), F.floor(F.col("o_orderkey") / 10).alias("Account_To")
    )
    return bank.clean_payments(payments), bank.clean_paths(paths)


@query("""
    SELECT o_orderkey AS transaction_id, o_orderkey // 10 AS destination_account_number, CAST(o_orderdate AS DATE) AS transaction_created_on,
           CAST(ROUND(o_totalprice * 100) AS BIGINT) AS transaction_value, FALSE AS is_cancelled, o_custkey AS source_account_number, DATE '1994-12-31' AS balance_taken_on,
           CAST(ROUND(a.c_acctbal * 100) AS BIGINT) AS balance, h.c_name AS full_name, DATE '1970-01-01' AS date_of_birth, lpad(CAST(7700000000 + h.c_custkey AS VARCHAR), 11, '0') AS mobile_contact,
           h.c_mktsegment AS first_line_of_address
    FROM orders JOIN customer a ON o_custkey = a.c_custkey JOIN customer h ON h.c_custkey IN (a.c_custkey, a.c_custkey + 1)
    WHERE a.c_mktsegment <> 'BUILDING' AND o_orderstatus = 'O' AND o_totalprice > 400000
""")
def q_flagged_payments(spark, folder):
    holders = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("Account Holder ID"), F.col("c_name").alias("Name"), F.lit(datetime.date(1970, 1, 1)).alias("Date of Birth"),
        (F.col("c_custkey") + 7_700_000_000).alias("Contact Number"), F.col("c_mktsegment").alias("First Line of Address"),
    )
    payments, paths = _payments(spark, folder)
    accounts = bank.clean_accounts(_accounts_raw(spark, folder))
    return bank.flagged_payments(bank.clean_holders(holders), accounts, payments, paths, over=40_000_000)


_STATEMENT_SQL = """
    moves AS (SELECT o_orderkey AS id, o_custkey AS account_number, CAST(o_orderdate AS DATE) AS transaction_created_on, -CAST(ROUND(o_totalprice * 100) AS BIGINT) AS transaction_value
              FROM orders WHERE o_orderstatus = 'O'
              UNION ALL SELECT o_orderkey, o_orderkey // 10, CAST(o_orderdate AS DATE), CAST(ROUND(o_totalprice * 100) AS BIGINT) FROM orders WHERE o_orderstatus = 'O'
              UNION ALL SELECT NULL, c_custkey, DATE '1994-12-31', CAST(ROUND(c_acctbal * 100) AS BIGINT) FROM customer),
    s AS (SELECT account_number, transaction_created_on, transaction_value, CAST(SUM(transaction_value) OVER w AS BIGINT) AS running_balance, ROW_NUMBER() OVER w AS line FROM moves
          WINDOW w AS (PARTITION BY account_number ORDER BY transaction_created_on, transaction_value DESC, id NULLS FIRST ROWS UNBOUNDED PRECEDING))
"""


@query(f"WITH {_STATEMENT_SQL} SELECT * FROM s WHERE month(transaction_created_on) = 2")
def q_statement(spark, folder):
    return bank.statement(bank.clean_accounts(_accounts_raw(spark, folder)), *_payments(spark, folder))


@query(f"""
    WITH {_STATEMENT_SQL}
    SELECT account_number, DATE '1998-02-14' AS summary_on, CAST(COALESCE(SUM(transaction_value) FILTER (WHERE transaction_created_on = DATE '1998-02-14'), 0) AS BIGINT) AS total_transaction_value,
           arg_max(running_balance, line) AS daily_end_balance
    FROM s WHERE transaction_created_on <= DATE '1998-02-14' AND account_number IN (SELECT c_custkey FROM customer) GROUP BY account_number
""")
def q_account_summary(spark, folder):
    accounts = bank.clean_accounts(_accounts_raw(spark, folder))
    lines = bank.statement(accounts, *_payments(spark, folder), month=None)
    return bank.account_summary(lines, accounts, datetime.date(1998, 2, 14))


# A sheet of holidays whose year stands on the first row of its block.
HOLIDAY_SHEET = [
    (1, 1995, "1-January", "New Year"), (2, None, "25-December", "Christmas Day"), (3, None, "26-December", "Boxing Day"),
    (4, None, None, None), (5, 1996, "1-January", "New Year"), (6, None, "25-December", "Christmas Day"),
    (7, 1997, "1-January", "New Year"), (8, None, "25-December", "Christmas Day"),
]


@query("""
    WITH days AS (SELECT CAST(UNNEST(generate_series((SELECT MIN(CAST(o_orderdate AS DATE)) FROM orders), (SELECT MAX(CAST(o_orderdate AS DATE)) + 30 FROM orders), INTERVAL 1 DAY)) AS DATE) AS day),
    closed(day) AS (VALUES (DATE '1995-01-01'), (DATE '1995-12-25'), (DATE '1995-12-26'), (DATE '1996-01-01'), (DATE '1996-12-25'), (DATE '1997-01-01'), (DATE '1997-12-25')),
    work AS (SELECT day FROM days WHERE isodow(day) <= 5 AND day NOT IN (SELECT day FROM closed)),
    rep AS (SELECT d.day AS joined_on, MIN(w.day) AS reported_on FROM days d JOIN work w ON w.day >= d.day GROUP BY 1),
    following AS (SELECT reported_on, LEAD(reported_on) OVER (ORDER BY reported_on) AS after FROM (SELECT DISTINCT reported_on FROM rep)),
    detail AS (SELECT reported_on, strftime(after, '%b-%y') AS m, CAST(ROW_NUMBER() OVER (PARTITION BY date_trunc('month', after) ORDER BY reported_on) AS INTEGER) AS d FROM following WHERE after IS NOT NULL),
    uk AS (SELECT CAST(o_orderdate AS DATE) AS joined_on, COUNT(*) AS n FROM orders GROUP BY 1),
    roi AS (SELECT CAST(o_orderdate AS DATE) AS joined_on, strftime(MIN(o_orderdate), '%b-%y') AS rm, COUNT(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY 1),
    c AS (SELECT reported_on, MAX(rm) AS rm, CAST(SUM(uk.n) AS BIGINT) AS u, CAST(COALESCE(SUM(roi.n), 0) AS BIGINT) AS r FROM uk LEFT JOIN roi USING (joined_on) JOIN rep USING (joined_on) GROUP BY 1)
    SELECT m IS DISTINCT FROM rm AS misalignment_flag, m AS uk_reporting_month, d AS reporting_day, reported_on, u AS number_of_new_uk_customers, r AS number_of_new_roi_customers, rm AS roi_reporting_month
    FROM c JOIN detail USING (reported_on)
""")
def q_reporting_calendar(spark, folder):
    orders = table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("day"), "o_orderstatus")
    uk = groups.count_by(orders, "day", name="New Customers").select(F.date_format("day", "MM-dd-yy").alias("Date"), "New Customers")
    roi = groups.count_by(orders.where(F.col("o_orderstatus") == "O"), "day", name="New Customers").select(
        F.date_format("day", "MM-dd-yy").alias("Reporting Date"), F.date_format("day", "MMM-yy").alias("Reporting Month"), "New Customers"
    )
    sheet = lookups.inline_table(spark, HOLIDAY_SHEET, "position int, Year int, Date string, `Bank holiday` string")
    holidays = F.broadcast(bank.clean_holidays(sheet))
    first, last = orders.agg(F.min("day"), F.max("day")).first()
    # Thirty days more, so that the last day has a next reporting day and that one a following one.
    return bank.new_customers_by_reporting_day(holidays, uk, roi, first, last + datetime.timedelta(days=30))


@query("""
    WITH f AS (SELECT o_custkey, month(o_orderdate) AS m, COUNT(*) AS offered, COUNT(*) FILTER (WHERE o_orderstatus = 'P') AS missed, COUNT(*) FILTER (WHERE o_orderstatus <> 'P') AS answered,
                      CAST(SUM(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS duration, COUNT(*) FILTER (WHERE o_orderstatus = 'F') - COUNT(*) FILTER (WHERE o_orderstatus = 'O') AS mood
               FROM orders GROUP BY ALL),
    g AS (SELECT a.o_custkey, b.m FROM (SELECT DISTINCT o_custkey FROM f) a CROSS JOIN (SELECT DISTINCT m FROM f) b)
    SELECT substr(monthname(make_date(2021, CAST(m AS INTEGER), 1)), 1, 3) || '-2021' AS collected_in, CAST(m AS INTEGER) AS month_number, o_custkey AS agent_id, c_mktsegment || ', ' || c_name AS agent_full_name,
           'Lead, ' || n_name AS leader_full_name, ROUND(missed / offered, 3) AS rate_calls_not_answered, ROUND(duration / NULLIF(answered, 0), 1) AS mean_call_duration,
           mood >= 0 AS had_positive_call_sentiment, missed / offered < 0.05 AS did_meet_call_not_answered_rate_threshold
    FROM g LEFT JOIN f USING (o_custkey, m) JOIN customer ON c_custkey = o_custkey JOIN nation ON c_nationkey = n_nationkey
""")
def q_agent_performance(spark, folder):
    orders, status = table(spark, folder, "orders"), F.col("o_orderstatus")
    missed, mood = F.count_if(status == "P"), F.count_if(status == "F") - F.count_if(status == "O")
    spelled = [
        ["Calls Offered", "Calls Not Answered", "Calls Answered"],
        ["Offered", "Not Answered", "Answered"],
        ["Calls Offered", "Not Answered Calls", "Answered Calls"],
    ]
    headers = {datetime.date(2021, n, 1).strftime("%b"): [*spelled[n % 3], "Total Duration", "Sentiment"] for n in range(1, 13)}
    cells = F.array(F.count(F.lit(1)), missed, F.count_if(status != "P"), F.sum(F.floor("o_totalprice")), mood)
    rows = orders.groupBy(F.date_format("o_orderdate", "MMM").alias("sheet"), F.col("o_custkey").alias("agent_id")).agg(cells.alias("cells"))
    people = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("first_name"), F.col("c_mktsegment").alias("last_name"), F.col("c_nationkey").alias("Location ID"),
        F.col("c_nationkey").alias("Leader 1"), F.lit(99).alias("Leader 2"),
    )
    nation = table(spark, folder, "nation")
    leaders = nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("first_name"), F.lit("Lead").alias("last_name"))
    places = nation.select(F.col("n_nationkey").alias("Location ID"), F.col("n_name").alias("Location"))
    return calls.agent_performance(calls.clean_metric_rows(rows, headers, 2021), calls.clean_agents(people), leaders, places)


@query("""
    WITH t AS (SELECT o_orderkey, c_mktsegment AS sector, CAST(month(o_orderdate) AS INTEGER) AS m, CAST(floor(o_totalprice) AS BIGINT) * 1000 AS cap, o_totalprice / 5 AS price
               FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice >= 5000),
    c AS (SELECT 'T' || o_orderkey AS ticker, sector, make_date(2023, m, 1) AS file_date, cap AS market_cap, price AS purchase_price,
                 CASE WHEN cap < 100000000 THEN 'Small' WHEN cap < 1000000000 THEN 'Medium' WHEN cap < 100000000000 THEN 'Large' ELSE 'Huge' END AS market_cap_category,
                 CASE WHEN price < 25000 THEN 'Small' WHEN price < 50000 THEN 'Medium' WHEN price < 75000 THEN 'Large' ELSE 'Very Large' END AS purchase_price_category FROM t)
    SELECT *, RANK() OVER (PARTITION BY file_date, market_cap_category, purchase_price_category ORDER BY purchase_price) AS rank FROM c QUALIFY rank <= 5
""")
def q_monthly_trades(spark, folder):
    joined = table(spark, folder, "orders").join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    raw = joined.select(
        F.col("o_orderkey").alias("id"), F.lit("a").alias("first_name"), F.lit("b").alias("last_name"),
        F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("Ticker"), F.col("c_mktsegment").alias("Sector"),
        F.when(F.col("o_totalprice") >= 5000, F.concat(F.lit("$"), F.floor("o_totalprice").cast("string"), F.lit("K"))).alias("Market Cap"),
        F.concat(F.lit("$"), (F.col("o_totalprice") / 5).cast("string")).alias("Purchase Price"),
        F.make_date(F.lit(2023), F.month("o_orderdate"), F.lit(1)).alias("file_date"),
    )
    return trades.monthly_trades(trades.clean_trades(raw))


@query("""
    WITH v AS (SELECT c_nationkey AS k, o_orderpriority AS product, CAST(year(o_orderdate) AS SMALLINT) AS year, COUNT(*) AS n, COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS f,
                      COUNT(*) FILTER (WHERE o_orderstatus = 'O') AS i, COUNT(*) FILTER (WHERE o_orderstatus = 'P') AS p
               FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
    SELECT year, 'NATION_' || k AS reporting_country_name, lpad(CAST(k AS VARCHAR), 3, 'N') AS reporting_country_code, k / 2.0::DOUBLE AS reporting_country_latitude, -k / 4.0::DOUBLE AS reporting_country_longitude,
           'NATION_' || (k + 1) AS partner_country_name, CASE WHEN k < 24 THEN lpad(CAST(k + 1 AS VARCHAR), 3, 'N') END AS partner_country_iso3_code,
           CASE WHEN k < 24 THEN (k + 1) / 2.0::DOUBLE END AS partner_country_latitude, CASE WHEN k < 24 THEN -(k + 1) / 4.0::DOUBLE END AS partner_country_longitude,
           product AS product_category, t AS indicator_type, CASE t WHEN 'Export' THEN n::DOUBLE END AS top5_export_partner_trade, CASE t WHEN 'Import' THEN NULLIF(i, 0)::DOUBLE END AS top5_import_partner_trade,
           CASE t WHEN 'Export' THEN NULLIF(f, 0)::DOUBLE END AS pct_share_top5_export_partners, CASE t WHEN 'Import' THEN NULLIF(p, 0)::DOUBLE END AS pct_share_top5_import_partners
    FROM v, (VALUES ('Export'), ('Import')) k(t) WHERE t = 'Export' OR i > 0 OR p > 0
""")
def q_partner_trade(spark, folder):
    raw, places = _partner_rows(spark, folder)
    return trades.partner_trade(trades.clean_partner_trade(raw), places)


def _partner_rows(spark, folder):
    """Rows of the country files, of all four indicators and all years, and the places of countries."""
    orders = table(spark, folder, "orders").join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    status = F.col("o_orderstatus")
    tests = dict(zip(trades.INDICATORS, [F.lit(True), status == "O", status == "F", status == "P"]))
    # A column for each year, as the files have: the years are those of the data.
    years = sorted(r["y"] for r in orders.select(F.year("o_orderdate").alias("y")).distinct().collect())
    in_years = lambda test: [F.nullif(F.count_if((F.year("o_orderdate") == y) & test), F.lit(0)).cast("string").alias(str(y)) for y in years]
    # One aggregate for the four indicators; each becomes a row with its years.
    cells = [F.struct(F.lit(name).alias("indicator"), *in_years(test)).alias(f"_{i}") for i, (name, test) in enumerate(tests.items())]
    counted = orders.groupBy("c_nationkey", "o_orderpriority").agg(*cells)
    counted = counted.select("c_nationkey", "o_orderpriority", F.explode(F.array(*[f"_{i}" for i in range(len(tests))])).alias("_cell")).select("c_nationkey", "o_orderpriority", "_cell.*")
    raw = counted.select(
        F.concat(F.lit(" NATION_"), F.col("c_nationkey").cast("string")).alias("Reporter"),
        F.concat(F.lit("NATION_"), (F.col("c_nationkey") + 1).cast("string")).alias("Partner"), F.col("o_orderpriority").alias("Product categories"),
        F.when(F.col("indicator").contains("Export"), "Export ").otherwise(" Import").alias("Indicator Type"), F.col("indicator").alias("Indicator"), *[str(y) for y in years],
        F.lpad(F.col("c_nationkey").cast("string"), 3, "N").alias("reporting_country_code"),
    )
    key = F.col("n_nationkey")
    point = F.concat((key / 2).cast("string"), F.lit(","), (-key / 4).cast("string"))
    places = table(spark, folder, "nation").select(
        F.lpad(key.cast("string"), 3, "N").alias("ISO3 CODE"), F.col("n_name").alias("LABEL EN"), point.alias("geo_point_2d")
    )
    return raw, trades.clean_places(places)


@query(ORACLES["q_partner_trade"])
def q_country_files(spark, folder):
    raw, places = _partner_rows(spark, folder)
    path = scratch_path(spark, "countries")
    labelled = raw.withColumn("country", F.concat(F.lit("en_"), "reporting_country_code", F.lit("_At-a-Glance"))).drop("reporting_country_code")
    labelled.hint("rebalance", "country").write.partitionBy("country").option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    schema = ", ".join(f"`{c}` string" for c in labelled.columns if c != "country")
    files = trades.read_partner_files(spark, path, schema, name=text.extract(readers.file_path(), r"/country=([^/]+)/[^/]+$"))
    return trades.partner_trade(trades.clean_partner_trade(files), places)


_TRADE_FILES_SQL = """
    n AS (SELECT *, ROW_NUMBER() OVER (ORDER BY file_date, id, ticker, purchase_price) AS trade_id FROM (
        SELECT o_orderkey AS id, 'T' || o_custkey AS ticker, c_mktsegment AS sector, 'NYSE' AS market, c_name AS stock_name, make_date(2023, CAST(month(o_orderdate) AS INTEGER), 1) AS file_date,
               CAST(floor(o_totalprice) AS BIGINT) * 1000 AS market_cap, CAST(floor(o_totalprice / 5) AS BIGINT) AS price, floor(o_totalprice / 5) AS purchase_price
        FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice >= 5000))
"""


def _trade_files(spark, folder):
    """Trades in a folder for each month, January's without a number, read back and numbered."""
    joined = table(spark, folder, "orders").join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    month = F.month("o_orderdate")
    rows = joined.select(
        F.col("o_orderkey").alias("id"), F.lit("a").alias("first_name"), F.lit("b").alias("last_name"),
        F.concat(F.lit("T"), F.col("o_custkey").cast("string")).alias("Ticker"), F.col("c_mktsegment").alias("Sector"), F.lit("NYSE").alias("Market"), F.col("c_name").alias("Stock Name"),
        F.when(F.col("o_totalprice") >= 5000, F.concat(F.lit("$"), F.floor("o_totalprice").cast("string"), F.lit("K"))).otherwise("n/a").alias("Market Cap"),
        F.concat(F.lit("$"), F.floor(F.col("o_totalprice") / 5).cast("string")).alias("Purchase Price"),
        F.when(month == 1, "MOCK_DATA").otherwise(F.concat(F.lit("MOCK_DATA-"), month.cast("string"))).alias("batch"),
    )
    path = scratch_path(spark, "trades")
    rows.hint("rebalance", "batch").write.partitionBy("batch").option("header", True).csv(path)
    return trades.numbered_trades(trades.clean_trades(trades.read_trades(spark, path, folders_hold_labels=True)))


@query(f"WITH {_TRADE_FILES_SQL} SELECT trade_id, file_date, ticker, sector, market, stock_name, market_cap, purchase_price FROM n")
def q_trade_files(spark, folder):
    return _trade_files(spark, folder).drop("first_name", "last_name")


@query(f"""
    WITH {_TRADE_FILES_SQL}, c AS (SELECT ticker, sector, market, stock_name, market_cap, purchase_price, file_date,
        CASE WHEN market_cap < 100000000 THEN 'Small' WHEN market_cap < 1000000000 THEN 'Medium' WHEN market_cap < 100000000000 THEN 'Large' ELSE 'Huge' END AS market_cap_category,
        CASE WHEN purchase_price < 25000 THEN 'Small' WHEN purchase_price < 50000 THEN 'Medium' WHEN purchase_price < 75000 THEN 'Large' ELSE 'Very Large' END AS purchase_price_category FROM n)
    SELECT *, RANK() OVER (PARTITION BY file_date, market_cap_category, purchase_price_category ORDER BY purchase_price) AS rank FROM c QUALIFY rank <= 5
""")
def q_trade_files_lowest(spark, folder):
    return trades.monthly_trades(_trade_files(spark, folder))
