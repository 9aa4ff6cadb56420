"""Call centre: monthly metrics of agents, also for months without any."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyloom.functions import amounts, dates, predicates, text
from tidyloom.operators import reshape, scaffold
from tidyloom.settings import stored
from tidyloom.sources import readers

# The names that metrics get, by what their old names contain or are. Order counts.
CONTAINED = [("Offered", "num_calls_offered"), ("Not Answered", "num_calls_not_answered"), ("Answered", "num_calls_answered")]
EQUAL = [("Total Duration", "total_duration"), ("Sentiment", "call_sentiment"), ("Transfers", "num_calls_transferred")]
METRICS = [new for _, new in CONTAINED + EQUAL]


def metric_name(old: str) -> str | None:
    for piece, new in CONTAINED:
        if piece in old:
            return new
    return dict(EQUAL).get(old)


def clean_metrics(sheets: Mapping[str, DataFrame], year: int) -> DataFrame:
    """Month sheets under common names, with the month they are from.

    Column names are known without reading data, so each sheet is projected.
    """
    parts = []
    for month, sheet in sheets.items():
        part = reshape.harmonize_by_rule(sheet, {"AgentID": "agent_id"}, metric_name, METRICS)
        label = f"{month}-{year}"
        number = F.month(dates.parse_date(F.lit(f"01-{label}"), "day_short_month"))
        parts.append(part.withColumns({"collected_in": F.lit(label), "month_number": number}))
    return readers.stack(parts, fill_missing=True)


def clean_metric_rows(rows: DataFrame, headers: Mapping[str, Sequence[str]], year: int) -> DataFrame:
    """The same from one frame, ``sheet``, ``agent_id`` and ``cells``, with the header of each sheet."""
    names = {old: new for header in headers.values() for old in header if (new := metric_name(old))}
    common = reshape.harmonize_rows(rows, "sheet", "cells", headers, names, METRICS)
    label = F.concat(F.col("sheet"), F.lit(f"-{year}"))
    number = F.month(dates.parse_date(F.concat(F.lit("01-"), label), "day_short_month"))
    return common.withColumns({"collected_in": label, "month_number": number}).drop("sheet")


def clean_agents(raw: DataFrame) -> DataFrame:
    """One row for each agent and leader; leaders are columns whose names hold a number."""
    long = reshape.melt(raw, ["id", "first_name", "last_name", "Location ID"], values_to="leader_id")
    return long.select(
        F.col("id").alias("agent_id"),
        F.col("first_name").alias("agent_first_name"),
        F.col("last_name").alias("agent_last_name"),
        F.col("Location ID").alias("location_id"),
        "leader_id",
        text.extract("variable", r"(\d+)").cast("long").alias("leader_number"),
    )


def listed_name(first: str, last: str) -> Column:
    return text.joined_name(last, first, ", ")


def agent_performance(metrics: DataFrame, agents: DataFrame, leaders: DataFrame, locations: DataFrame, limit: float = 0.05) -> DataFrame:
    """Every agent in every month: share of calls not answered, mean duration, sentiment, and whether the share is in bounds."""
    metrics = stored(metrics)  # one row for each agent and month, read three times
    months = metrics.select("month_number", "collected_in").distinct()
    grid = scaffold.key_grid(metrics.select("agent_id").distinct(), months)
    own_leader = agents.where(F.col("leader_number") == 1)
    chiefs = leaders.select(
        F.col("id").alias("leader_id"), F.col("first_name").alias("leader_first_name"), F.col("last_name").alias("leader_last_name")
    )
    places = locations.select(F.col("Location ID").alias("location_id"))
    joined = (
        grid.join(metrics, ["agent_id", "month_number", "collected_in"], "left")
        .join(own_leader, "agent_id")
        .join(chiefs, "leader_id")
        .join(places, "location_id")
    )
    missed = amounts.ratio("num_calls_not_answered", "num_calls_offered")
    mood = F.col("call_sentiment")
    return joined.select(
        "collected_in",
        "month_number",
        "agent_id",
        listed_name("agent_first_name", "agent_last_name").alias("agent_full_name"),
        listed_name("leader_first_name", "leader_last_name").alias("leader_full_name"),
        F.round(missed, 3).alias("rate_calls_not_answered"),
        F.round(amounts.ratio("total_duration", "num_calls_answered"), 1).alias("mean_call_duration"),
        predicates.three_state(mood >= 0, mood < 0).alias("had_positive_call_sentiment"),
        predicates.three_state(missed < limit, missed >= limit).alias("did_meet_call_not_answered_rate_threshold"),
    )
