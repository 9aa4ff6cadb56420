"""Shops and customers: shares, loyalty, profits, quarters, weekday rankings."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyloom.functions import amounts, dates, predicates, text
from tidyloom.operators import groups, ordered, ranks, reshape, scaffold
from tidyloom.operators.ranges import down
from tidyloom.settings import stored
from tidyloom.sources import readers, sinks

# Spellings of bicycle sheet columns and their common names.
BIKE_COLUMNS = {
    "*BikeType": "bike_type",
    "*Bike Type": "bike_type",
    "*Model": "bike_model",
    "*Order Date": "ordered_on",
    "*Sales": "volume_sold",
    "*Store": "store_location",
    "Bike Type": "bike_type",
    "BikeType": "bike_type",
    "Model": "bike_model",
    "Order Date": "ordered_on",
    "OrderDate": "ordered_on",
    "Sales": "volume_sold",
    "Store": "store_location",
}
DEMOGRAPHICS = {"Ethnicity": "ethnicity", "Date of Birth": "born_on", "Account Type": "account_type"}
SPENDING_NAMES = {
    "First Name": "first_name",
    "Last Name": "last_name",
    "Gender": "gender",
    "Receipt Number": "receipt_number",
    "Date": "purchased_on",
    "Sale Total": "sale_total",
}


def customers_up_to_share(sales: DataFrame, keys: Sequence[str], share: float = 1.0) -> DataFrame:
    """The largest customers whose sales, summed up from the top, stay within a share of all sales.

    The customer that crosses the share is left out. Whole numbers (cents) in
    ``sales`` make the sums, and so the cut, exact.
    """
    spend = sales.groupBy(*keys).agg(F.sum("sales").alias("customer_sales"))
    order = [down("customer_sales"), *[F.col(key) for key in keys]]
    running = ordered.running_sum(spend, [], order, F.col("customer_sales"), "_running")
    # The same aggregate as above: Spark runs its shuffle once for both.
    total = spend.agg(F.sum("customer_sales").alias("total")).select("total").scalar()
    so_far = F.col("_running") / total
    return running.where(so_far <= share).select(
        *keys, "customer_sales", (F.col("customer_sales") / total).alias("prop_customer_sales"), so_far.alias("running_prop_sales")
    )


def clean_spending(raw: DataFrame) -> DataFrame:
    online = predicates.if_else("Online", "Yes", True, False)
    return reshape.rename(raw.withColumn("is_online", online).drop("Online", "In Person"), SPENDING_NAMES)


def loyalty_points(sale_total: Column | str) -> Column:
    """One point for every 50 spent."""
    return predicates.as_column(sale_total) / 50


def loyalty_category(points: Column) -> Column:
    return predicates.first_match([(points >= 7, "MegaByte"), (points >= 5, "Byte")], "NullByte")


def loyalty_by_gender(spending: DataFrame) -> DataFrame:
    """Receipts of each loyalty class by gender, and their share of the class."""
    category = loyalty_category(loyalty_points("sale_total"))
    counted = groups.count_by(spending, category.alias("category"), "gender")
    shared = groups.share_of_group(counted, ["category"], "count", "_share")
    return shared.withColumn("pct", 100 * F.round("_share", 4)).drop("_share")


def receipt_points(spending: DataFrame) -> DataFrame:
    points = spending.select("receipt_number", loyalty_points("sale_total").alias("loyalty_points"))
    return points.withColumn("loyalty_points_category", loyalty_category(F.col("loyalty_points")))


def rolling_profit(sales: DataFrame, forecast_from: datetime.date, size: int = 3) -> DataFrame:
    """Monthly sales and profit of every shop and bicycle type, 0 where none, with the mean of three months."""
    keys = ["store", "bike_type", "month"]
    monthly = sales.withColumn("month", dates.month_start("sales_on"))
    # The grid reads the monthly facts four times; they are far fewer than the sales and are stored once.
    facts = stored(
        monthly.groupBy(*keys).agg(
            groups.zero_sum("daily_sales").alias("monthly_sales"),
            groups.zero_sum("daily_profit").alias("monthly_profit"),
            F.min("sales_on").alias("_first"),
        )
    )
    months = facts.where(F.col("_first") < F.lit(forecast_from)).select("month").distinct()
    shops = scaffold.key_grid(facts.select("store").distinct(), facts.select("bike_type").distinct())
    defaults = {"monthly_sales": 0, "monthly_profit": 0}
    grid = scaffold.fill_grid(scaffold.key_grid(shops, months), facts.drop("_first"), keys, defaults)
    return ordered.rolling_mean(grid, keys[:2], [F.col("month")], F.col("monthly_profit"), "rolling_monthly_profit", size)


_BIKE_NAMES = ["bike_type", "bike_model", "ordered_on", "volume_sold", "store_location"]


def clean_bike_sales(sheets: Mapping[str, DataFrame]) -> DataFrame:
    """Sheets by month name under common column names; the date text gives day and year, the sheet the month."""
    parts = [reshape.harmonize([sheet], BIKE_COLUMNS, _BIKE_NAMES).withColumn("sheet", F.lit(month)) for month, sheet in sheets.items()]
    return _dated_bikes(readers.stack(parts))


def clean_bike_rows(rows: DataFrame, headers: Mapping[str, Sequence[str]]) -> DataFrame:
    """The same from one frame, ``sheet`` and ``cells``, with the header of each sheet."""
    return _dated_bikes(reshape.harmonize_rows(rows, "sheet", "cells", headers, BIKE_COLUMNS, _BIKE_NAMES))


def _dated_bikes(rows: DataFrame) -> DataFrame:
    day, year = text.extract("ordered_on", r"(\d+), (\d+)$", 1), text.extract("ordered_on", r"(\d+), (\d+)$", 2)
    dated = {"ordered_on": dates.date_from_month_text(day, F.col("sheet"), year), "volume_sold": F.col("volume_sold").cast("long")}
    return rows.withColumns(dated).drop("sheet")


def fiscal_quarter_change(sales: DataFrame) -> DataFrame:
    """Volume of each shop and fiscal quarter, and its change in percent to the quarter before."""
    quarter = dates.fiscal_quarter("ordered_on").alias("fiscal_quarter")
    volumes = groups.total_by(sales, "store_location", quarter, value="volume_sold", name="volume_sold")
    return ordered.percent_change(volumes, ["store_location"], [F.col("fiscal_quarter")], F.col("volume_sold"), "pct_diff")


def project_profit(entries: DataFrame, project: str, kind: str, value: str) -> DataFrame:
    """Cost and invoice of each project side by side, and the difference."""
    wide = reshape.spread(entries, [project], kind, value, ["cost", "invoice"], F.sum)
    return wide.withColumn("profit", F.col("invoice") - F.col("cost"))


def top_share_by_moving_average(
    terms: DataFrame, keys: Sequence[str], term: str, value: str, *, size: int = 3, share: float = 0.02
) -> DataFrame:
    """Rows whose moving average is within the top share of all moving averages."""
    moving = ordered.rolling_mean(terms, keys, [F.col(term)], F.col(value), "moving_average", size)
    cut = ranks.group_quantiles(moving, [], "moving_average", [1 - share]).select(F.col("quantiles")[0].alias("cut")).select("cut").scalar()
    return moving.where(F.col("moving_average") >= cut)


def new_customers(sheets: Mapping[str, DataFrame], year: int = 2023) -> DataFrame:
    """Customers of all month sheets, one row each for the first date they joined in a sheet."""
    parts = []
    for month, sheet in sheets.items():
        named = reshape.rename_prefix(sheet, "D", "Demographic")
        wide = reshape.spread(named, ["ID", "Joining Day"], "Demographic", "Value", list(DEMOGRAPHICS))
        joined_on = dates.date_from_month_text(F.col("Joining Day").cast("string"), F.lit(month), F.lit(str(year)))
        dated = wide.withColumns({"joined_on": joined_on, "Date of Birth": dates.parse_date("Date of Birth", "month_first")})
        renamed = reshape.rename(dated.drop("Joining Day"), {"ID": "person_id", **DEMOGRAPHICS})
        parts.append(groups.earliest_of_group(renamed, ["person_id"], ["joined_on"]))
    return readers.stack(parts)


def annual_sales(sheets: DataFrame, label: str = "sheet") -> DataFrame:
    """Sales and profits of each year from stacked sheets of quarters, labelled by year, with amounts as text (``1.2M``)."""
    typed = sheets.select(
        F.col(label).cast("long").alias("year"),
        amounts.parse_grouped_amount("Sales").alias("sales"),
        amounts.parse_grouped_amount("Profits").alias("profits"),
    )
    return typed.groupBy("year").agg(groups.zero_sum("sales").alias("sales"), groups.zero_sum("profits").alias("profits"))


def weekday_ranking(spending: DataFrame, customers: DataFrame) -> DataFrame:
    """Purchases ranked by value within their weekday."""
    joined = spending.join(customers, ["first_name", "last_name"])
    dated = joined.withColumn("weekday", dates.weekday_name("purchased_on"))
    ranked = ranks.ranked(dated, ["weekday"], "sale_value", descending=True)
    return ranked.drop("first_name", "last_name", "purchased_on")


def weekday_documents(ranked: DataFrame) -> DataFrame:
    """The ranking as JSON rows in order for each weekday."""
    return sinks.json_by_key(ranked, "weekday", ["rank", "receipt_number"])
