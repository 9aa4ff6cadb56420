"""Flights: details in one text, prices, targets, seats and tickets."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyloom.functions import dates, predicates
from tidyloom.operators import groups, joins, ordered, ranks, reshape
from tidyloom.sources import readers, sinks

# Layout of the detail text, headers, and the classes that were mixed up.
DETAIL_PATTERN = r"^(.+)//(.+)//(.+)-(.+)//(.+)//(.+)$"
DETAIL_NAMES = ["flew_on", "flight_number", "from", "to", "seat_class", "price"]
FLIGHT_NAMES = {"Flow Card?": "has_flow_card", "Bags Checked": "num_bags_checked", "Meal Type": "meal_type"}
SWAPPED_CLASSES = {
    "Economy": "First Class",
    "Premium Economy": "Business Class",
    "Business Class": "Premium Economy",
    "First Class": "Economy",
}
CLASS_CODES = {"E": "Economy", "PE": "Premium Economy", "BC": "Business Class", "FC": "First Class"}
SEAT_NAMES = {"CustomerID": "customer_id", "Seat": "seat", "Row": "row", "Class": "seat_class_code"}


def plain_details(column: Column) -> Column:
    """The groups of ``DETAIL_PATTERN`` where its marks can only be meant in one way; null for other texts.

    The pattern turns back at every mark and takes most of the time of a table's
    split. In a text of one line with four double slashes and no triple one, the parts
    are those between the slashes, and the dash is the last one of the third part.
    """

    def groups(parts: Column) -> Column:
        first, number, route, seat, price = [F.get(parts, F.lit(i)) for i in range(5)]
        to = F.substring_index(route, "-", -1)
        # The characters before the dash; none or fewer if there is no dash.
        start = F.length(route) - F.length(to) - 1
        whole = (F.size(parts) == 5) & (F.length(first) > 0) & (F.length(price) > 0) & (F.length(to) > 0) & (start > 0)
        return F.when(whole, F.array(first, number, F.left(route, start), to, seat, price))

    odd = [column.contains(mark) for mark in ("///", "\n", "\r", "\u0085", "\u2028", "\u2029")]
    parts = F.when(~reduce(lambda a, b: a | b, odd), F.split(column, "//", -1))
    return F.get(F.transform(F.array(parts), groups), F.lit(0))


def split_details(raw: DataFrame) -> DataFrame:
    """The detail text as typed columns."""
    usual = plain_details(F.col("Flight Details"))
    split = reshape.split_groups(raw, "Flight Details", DETAIL_PATTERN, DETAIL_NAMES, usual)
    typed = split.withColumns(
        {
            "flew_on": dates.parse_date("flew_on", "iso"),
            "price": F.col("price").cast("double"),
            "Flow Card?": F.col("Flow Card?").cast("boolean"),
        }
    )
    return reshape.rename(typed, FLIGHT_NAMES)


def numbered(flights: DataFrame) -> DataFrame:
    """A running id over the whole table, in order of date, flight and the other columns."""
    order = ["flew_on", "flight_number", *[c for c in flights.columns if c not in ("flew_on", "flight_number")]]
    return ordered.row_index(flights, [F.col(f"`{c}`") for c in order], "flight_detail_id")


def correct_classes(flights: DataFrame) -> DataFrame:
    return flights.withColumn("seat_class", predicates.replace_values("seat_class", SWAPPED_CLASSES))


def price_statistics(flights: DataFrame) -> DataFrame:
    """Lowest, median, mean and highest price by class, flow card and quarter."""
    keys = ["seat_class", "has_flow_card", "calendar_quarter"]
    priced = flights.select("seat_class", "has_flow_card", F.quarter("flew_on").alias("calendar_quarter"), "price")
    stats = {
        "minimum_price": lambda price, times: F.min(price),
        "mean_price": lambda price, times: F.try_divide(F.sum(price * times), F.sum(times)),
        "maximum_price": lambda price, times: F.max(price),
    }
    found = ranks.group_quantiles(priced, keys, "price", [0.5], stats=stats)
    return found.select(*keys, "minimum_price", F.col("quantiles")[0].alias("median_price"), "mean_price", "maximum_price")


def clean_targets(sheets: Sequence[DataFrame], year: int | str) -> DataFrame:
    """Monthly targets of all sheets with the month as ``yyyy-MM`` and the class by name; ``year`` is a number, or a column of the sheets."""
    starts_on = F.make_date(F.lit(year) if isinstance(year, int) else F.col(year).cast("int"), F.col("Month").cast("int"), F.lit(1))
    return readers.stack(sheets).select(
        predicates.replace_values("Class", CLASS_CODES).alias("seat_class"),
        dates.month_year(starts_on, "yyyy-MM").alias("target_month"),
        F.col("Target").alias("target_sales"),
    )


def sales_against_target(flights: DataFrame, targets: DataFrame) -> DataFrame:
    month = dates.month_year("flew_on", "yyyy-MM").alias("target_month")
    sales = groups.total_by(flights, "seat_class", month, value="price", name="total_sales")
    joined = targets.join(sales, ["seat_class", "target_month"])
    return joined.withColumn("difference_to_target", F.col("total_sales") - F.col("target_sales"))


def unbooked_seats(bookings: Sequence[DataFrame], plan: DataFrame) -> DataFrame:
    booked = reshape.rename(readers.stack(bookings), SEAT_NAMES)
    return joins.not_in(reshape.rename(plan, SEAT_NAMES), booked, ["seat", "row", "seat_class_code"])


def ticket_report(flights: DataFrame, customers: DataFrame, sales: DataFrame, reported_on: datetime.date) -> dict[str, DataFrame]:
    """Sold tickets with customer and flight, flights nobody booked, customers who booked nothing."""
    detail = sales.join(customers, "customer_id").join(flights, ["flight_number", "flies_on"])
    unbooked = joins.not_in(flights, sales, ["flight_number", "flies_on"]).withColumn("reported_on", F.lit(reported_on))
    return {
        "ticket_sale_detail": detail,
        "unbooked_flights": unbooked,
        "unbooked_customers": joins.not_in(customers, sales, ["customer_id"]),
    }


def ticket_document(report: dict[str, DataFrame]) -> DataFrame:
    """The report as one document of JSON rows, in order by table and position."""
    return sinks.json_bundle(report)
