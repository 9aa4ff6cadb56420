"""Stock trades from monthly files, and trade between countries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyloom.functions import amounts, predicates, text
from tidyloom.operators import joins, ordered, ranks, reshape
from tidyloom.sources import readers

# Headers of the trade files.
TRADE_SCHEMA = (
    "id long, first_name string, last_name string, Ticker string, Sector string, Market string, "
    "`Stock Name` string, `Market Cap` string, `Purchase Price` string"
)
TRADE_NAMES = {
    "Ticker": "ticker",
    "Sector": "sector",
    "Market": "market",
    "Stock Name": "stock_name",
    "Market Cap": "market_cap",
    "Purchase Price": "purchase_price",
}
PARTNER_NAMES = {
    "Reporter": "reporting_country_name",
    "Partner": "partner_country_name",
    "Product categories": "product_category",
    "Indicator Type": "indicator_type",
    "Indicator": "indicator",
}
INDICATORS = {
    "Trade (US$ Mil)-Top 5 Export Partner": "top5_export_partner_trade",
    "Trade (US$ Mil)-Top 5 Import Partner": "top5_import_partner_trade",
    "Partner share(%)-Top 5 Export Partner": "pct_share_top5_export_partners",
    "Partner share(%)-Top 5 Import Partner": "pct_share_top5_import_partners",
}
# Names that stand for no single country.
NO_REPORTER = ["World", "European Union", "Occ.Pal.Terr", "Other Asia, nes"]
NO_PARTNER = ["World", "...", "Special Category"]


def read_trades(spark: SparkSession, pattern: str, year: int = 2023, *, folders_hold_labels: bool = False) -> DataFrame:
    """All trade files of a path pattern in one read; the number in a file's name (or its folder's) is its month, none is January."""
    raw = readers.read_csv(spark, pattern, TRADE_SCHEMA, null_marker="n/a", folders_hold_labels=folders_hold_labels)
    return raw.withColumn("file_date", readers.file_month(readers.file_path(), r"MOCK_DATA-(\d+)", year))


def clean_trades(raw: DataFrame) -> DataFrame:
    typed = raw.withColumns({"Market Cap": amounts.parse_amount("Market Cap"), "Purchase Price": amounts.parse_price("Purchase Price")})
    return reshape.rename(typed.dropna(subset=["Market Cap", "Purchase Price"]), TRADE_NAMES)


def numbered_trades(trades: DataFrame) -> DataFrame:
    """A running trade id over all files, by month and the id inside the file."""
    order = [F.col("file_date"), F.col("id"), F.col("ticker"), F.col("purchase_price")]
    return ordered.row_index(trades, order, "trade_id").drop("id")


def monthly_trades(trades: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` lowest prices, ties kept, of each month and pair of size classes; ids and names of people are left out."""
    # The size classes.
    cap = predicates.below("market_cap", [(100_000_000, "Small"), (1_000_000_000, "Medium"), (100_000_000_000, "Large")], "Huge")
    price = predicates.below("purchase_price", [(25_000, "Small"), (50_000, "Medium"), (75_000, "Large")], "Very Large")
    classed = trades.withColumns({"market_cap_category": cap, "purchase_price_category": price})
    keys = ["file_date", "market_cap_category", "purchase_price_category"]
    best = ranks.best_of_group(classed, keys, "purchase_price", n)
    wanted = [*(name for name in TRADE_NAMES.values() if name in trades.columns), *keys, "rank"]
    return best.select(*wanted)


def read_partner_files(spark: SparkSession, pattern: str, schema: str, *, name: Column | None = None) -> DataFrame:
    """Country files in one read; characters 4 to 6 of a file's name are the country code.

    ``name`` is for files that Spark has written: the label in their folder's name.
    """
    raw = readers.read_csv(spark, pattern, schema, folders_hold_labels=name is not None)
    return raw.withColumn("reporting_country_code", readers.file_code(readers.file_name() if name is None else name, 3, 3))


def clean_partner_trade(raw: DataFrame) -> DataFrame:
    """Year columns to rows; blank cells drop out."""
    ids = [*PARTNER_NAMES, "reporting_country_code"]
    long = reshape.melt(text.trim_strings(raw), ids, names_to="year", values_to="value").dropna()
    typed = long.withColumns({"year": F.col("year").cast("smallint"), "value": F.col("value").cast("double")})
    return reshape.rename(typed, PARTNER_NAMES)


def clean_places(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("ISO3 CODE").alias("iso3_code"),
        F.col("LABEL EN").alias("label_en"),
        text.part("geo_point_2d", ",", 0).cast("double").alias("latitude"),
        text.part("geo_point_2d", ",", 1).cast("double").alias("longitude"),
    )


def partner_trade(trade: DataFrame, places: DataFrame, indicators: Sequence[str] = tuple(INDICATORS)) -> DataFrame:
    """Trade with the top partners, one row for each pair of countries, product, type and year, with both positions."""
    kept = (
        F.col("indicator_type").isin("Import", "Export")
        & ~F.col("reporting_country_name").isin(NO_REPORTER)
        & ~F.col("partner_country_name").isin(NO_PARTNER)
    )
    index = ["reporting_country_name", "reporting_country_code", "partner_country_name", "product_category", "indicator_type", "year"]
    wide = reshape.rename(reshape.spread(trade.where(kept), index, "indicator", "value", indicators), INDICATORS)
    reporter = joins.prefixed(places.drop("label_en"), "reporting_country_")
    located = wide.join(reporter, F.col("reporting_country_code") == F.col("reporting_country_iso3_code"), "left")
    partner = joins.prefixed(places, "partner_country_")
    both = located.join(partner, F.col("partner_country_name") == F.col("partner_country_label_en"), "left")
    return both.select(
        "year", "reporting_country_name", "reporting_country_code", "reporting_country_latitude", "reporting_country_longitude",
        "partner_country_name", "partner_country_iso3_code", "partner_country_latitude", "partner_country_longitude",
        "product_category", "indicator_type", *[INDICATORS[i] for i in indicators],
    )
