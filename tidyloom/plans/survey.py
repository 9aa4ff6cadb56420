"""Ratings of two platforms compared."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyloom.functions import predicates, text
from tidyloom.operators import groups, ranks, reshape


def clean_responses(raw: DataFrame) -> DataFrame:
    """Columns named ``platform - category`` to rows; the overall rating is left out."""
    long = reshape.melt(raw, ["Customer ID"], values_to="rating")
    named = long.select(
        F.col("Customer ID").alias("customer_id"),
        text.extract("variable", r"^(.+) -").alias("platform"),
        text.extract("variable", r"- (.+)$").alias("category"),
        "rating",
    )
    return named.where(F.col("category") != "Overall Rating")


def preference(difference: Column) -> Column:
    """Class of a rating difference; a difference of exactly 1 is still neutral."""
    return predicates.first_match(
        [
            (difference.between(-1, 1), "Neutral"),
            (difference >= 2, "Mobile App Superfan"),
            (difference > 1, "Mobile App Fan"),
            (difference <= -2, "Online Interface Superfan"),
            (difference < -1, "Online Interface Fan"),
        ]
    )


def preference_shares(responses: DataFrame) -> DataFrame:
    """Share of customers in each class of preference, by the difference of their median ratings."""
    medians = ranks.group_quantiles(responses, ["customer_id", "platform"], "rating", [0.5])
    platforms = ["Mobile App", "Online Interface"]
    wide = reshape.spread(medians.withColumn("median", F.col("quantiles")[0]), ["customer_id"], "platform", "median", platforms)
    category = preference(F.col(platforms[0]) - F.col(platforms[1]))
    counted = groups.count_by(wide, category.alias("category"), name="num_responses")
    total = counted.agg(F.sum("num_responses").alias("total")).select("total").scalar()
    return counted.withColumn("pct_responses", 100 * F.col("num_responses") / total).orderBy(F.desc("pct_responses"))
