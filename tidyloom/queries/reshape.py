"""Wide to long and back, splitting, harmonising, normalising."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidyloom.functions import predicates
from tidyloom.operators import groups, ranks, reshape
from tidyloom.plans import survey
from tidyloom.queries.registry import query, table


@query("""
    SELECT variable, l_returnflag, COUNT(*) AS cells, ROUND(SUM(value), 2) AS total FROM (
        UNPIVOT (SELECT l_returnflag, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
        ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME variable VALUE value)
    GROUP BY ALL
""")
def q_melt(spark, folder):
    wide = table(spark, folder, "lineitem").select("l_returnflag", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return reshape.melt(wide, ["l_returnflag"]).groupBy("variable", "l_returnflag").agg(
        F.count(F.lit(1)).alias("cells"), F.round(F.sum("value"), 2).alias("total")
    )


@query("""
    SELECT o_orderstatus, variable, value, COUNT(*) AS orders FROM (
        SELECT o_orderstatus, 'o_orderpriority' AS variable, o_orderpriority AS value FROM orders
        UNION ALL SELECT o_orderstatus, 'order_year', CAST(year(o_orderdate) AS VARCHAR) FROM orders)
    GROUP BY ALL
""")
def q_melt_values(spark, folder):
    orders = table(spark, folder, "orders").withColumn("order_year", F.year("o_orderdate"))
    return groups.count_by(reshape.melt(orders, ["o_orderstatus"], ["o_orderpriority", "order_year"]), "o_orderstatus", "variable", "value", name="orders")


@query("""
    SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
""")
def q_pivot_first(spark, folder):
    attributes = ["o_orderstatus", "o_orderpriority"]
    long = reshape.melt(table(spark, folder, "orders"), ["o_orderkey"], attributes)
    return reshape.spread(long, ["o_orderkey"], "variable", "value", attributes)


@query("""
    SELECT p_brand, NULLIF(COUNT(*) FILTER (WHERE bin = 'lower'), 0) AS lower, NULLIF(COUNT(*) FILTER (WHERE bin = 'mid'), 0) AS mid,
           NULLIF(COUNT(*) FILTER (WHERE bin = 'upper'), 0) AS upper
    FROM (SELECT p_brand, CASE WHEN p_retailprice <= q1 THEN 'lower' WHEN p_retailprice <= q2 THEN 'mid' ELSE 'upper' END AS bin
          FROM part JOIN (SELECT p_type, quantile_cont(p_retailprice, 0.25) AS q1, quantile_cont(p_retailprice, 0.75) AS q2 FROM part GROUP BY 1) USING (p_type))
    GROUP BY 1
""")
def q_pivot_count(spark, folder):
    binned = ranks.quantile_bins(table(spark, folder, "part"), ["p_type"], "p_retailprice", [0.25, 0.75], ["lower", "mid", "upper"], "bin")
    return reshape.spread_count(binned, ["p_brand"], "bin", ["lower", "mid", "upper"])


@query("""
    WITH m AS (SELECT user_id, median(value) FILTER (WHERE event_type = 'view') AS a, median(value) FILTER (WHERE event_type <> 'view') AS b FROM events GROUP BY 1),
    c AS (SELECT CASE WHEN a - b BETWEEN -1 AND 1 THEN 'Neutral' WHEN a - b >= 2 THEN 'Mobile App Superfan' WHEN a - b BETWEEN 1 AND 2 THEN 'Mobile App Fan'
                      WHEN a - b <= -2 THEN 'Online Interface Superfan' WHEN a - b BETWEEN -2 AND -1 THEN 'Online Interface Fan' END AS category FROM m)
    SELECT category, COUNT(*) AS num_responses, 100 * COUNT(*) / SUM(COUNT(*)) OVER () AS pct_responses FROM c GROUP BY 1
""")
def q_likert(spark, folder):
    events = table(spark, folder, "events")
    platform = F.when(F.col("event_type") == "view", "Mobile App").otherwise("Online Interface")
    return survey.preference_shares(events.select(F.col("user_id").alias("customer_id"), platform.alias("platform"), F.col("value").alias("rating")))


@query("""
    WITH words AS (SELECT lang, unnest(string_split_regex(text, '\\s+')) AS word FROM documents)
    SELECT lang, word, COUNT(*) AS occurrences FROM words WHERE word <> '' GROUP BY ALL
""")
def q_explode_split(spark, folder):
    words = reshape.split_to_rows(table(spark, folder, "documents").select("lang", "text"), "text", r"\s+", "word")
    return groups.count_by(words.where(F.col("word") != ""), "lang", "word", name="occurrences")


@query("""
    WITH letters AS (SELECT upper(p_name) AS word, unnest(string_split(upper(p_name), '')) AS letter FROM part)
    SELECT word, letter, COUNT(*) AS letter_frequency FROM letters WHERE letter <> '' GROUP BY ALL
""")
def q_letter_freq(spark, folder):
    words = table(spark, folder, "part").select(F.upper("p_name").alias("word"))
    # Repeated names are counted once and the count is carried through the split.
    counted = groups.count_by(words, "word", name="parts")
    letters = counted.withColumn("letter", F.explode(F.split("word", "")))
    return letters.where(F.col("letter") != "").groupBy("word", "letter").agg(F.sum("parts").alias("letter_frequency"))


@query("""
    SELECT c_custkey AS customer_id, c_mktsegment AS segment, c_acctbal AS balance FROM customer
""")
def q_harmonize_columns(spark, folder):
    customer = table(spark, folder, "customer")
    first = F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    one = customer.where(first).select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("*Segment"), F.col("c_acctbal").alias("Balance"), "c_name"
    )
    two = customer.where(~first).select(F.col("c_acctbal").alias("*Balance"), F.col("c_custkey").alias("ID"), F.col("c_mktsegment").alias("Segment"))
    name_map = {"id": "customer_id", "ID": "customer_id", "*Segment": "segment", "Segment": "segment", "Balance": "balance", "*Balance": "balance"}
    return reshape.harmonize([one, two], name_map, ["customer_id", "segment", "balance"])


@query("""
    SELECT l_orderkey AS agent_id, SUM(l_quantity) AS num_offered, SUM(l_quantity) FILTER (WHERE l_returnflag = 'R') AS num_not_answered,
           SUM(l_quantity) FILTER (WHERE l_returnflag <> 'R') AS num_answered
    FROM lineitem GROUP BY 1
""")
def q_harmonize_metrics(spark, folder):
    quantity, returned = F.col("l_quantity"), F.col("l_returnflag") == "R"
    wide = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("agent_id")).agg(
        F.sum(quantity).alias("Calls Offered"),
        F.sum(F.when(returned, quantity)).alias("Calls Not Answered"),
        F.sum(F.when(~returned, quantity)).alias("Calls Answered"),
    )

    tests = [("Offered", "num_offered"), ("Not Answered", "num_not_answered"), ("Answered", "num_answered")]
    rule = lambda name: next((new for piece, new in tests if piece in name), None)
    return reshape.harmonize_by_rule(wide, {"agent_id": "agent_id"}, rule, [new for _, new in tests])


@query("""
    SELECT l_partkey, l_suppkey, split_part(MIN(l_linestatus || '|' || l_returnflag), '|', 1) AS l_linestatus,
           split_part(MIN(l_linestatus || '|' || l_returnflag), '|', 2) AS l_returnflag
    FROM lineitem GROUP BY 1, 2
""")
def q_normalize_dedup(spark, folder):
    return reshape.normalize(table(spark, folder, "lineitem"), ["l_partkey", "l_suppkey"], ["l_linestatus", "l_returnflag"])


@query("""
    SELECT o_orderkey, o_custkey, c_mktsegment AS segment, c_name AS name,
           CAST(SUM(ROUND(o_totalprice * 100)) OVER (PARTITION BY o_custkey) AS BIGINT) / COUNT(*) OVER (PARTITION BY o_custkey) AS mean_cents
    FROM orders JOIN customer ON o_custkey = c_custkey
""")
def q_fill_blanks(spark, folder):
    orders = table(spark, folder, "orders").join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    orders = groups.with_group_stats(orders, ["o_custkey"], {"first_key": F.min("o_orderkey")})
    given = lambda c: F.when(F.col("o_orderkey") == F.col("first_key"), F.col(c))
    gaps = orders.select(
        "o_orderkey", "o_custkey", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"),
        given("c_mktsegment").alias("segment"), given("c_name").alias("name"),
    )
    filled = reshape.fill_blanks(gaps, ["o_custkey"], ["segment", "name"])
    means = groups.with_group_stats(filled, ["o_custkey"], {"total": F.sum("cents"), "orders": F.count(F.lit(1))})
    return means.withColumn("mean_cents", F.col("total") / F.col("orders")).drop("cents", "total", "orders")
