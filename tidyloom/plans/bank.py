"""Bank data: totals, account codes, targets, flagged payments, statements, reporting days."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyloom.functions import dates, predicates, text
from tidyloom.operators import groups, joins, ordered, ranks, reshape, scaffold
from tidyloom.operators.ranges import down
from tidyloom.settings import stored

# Column headers of the inputs and their clean names.
TRANSACTION_NAMES = {"Transaction Code": "transaction_code", "Value": "value", "Customer Code": "customer_code"}
HOLDER_NAMES = {
    "Account Holder ID": "account_holder_id",
    "Name": "full_name",
    "Date of Birth": "date_of_birth",
    "Contact Number": "mobile_contact",
    "First Line of Address": "first_line_of_address",
}
ACCOUNT_NAMES = {
    "Account Number": "account_number",
    "Account Type": "account_type",
    "Account Holder ID": "account_holder_id",
    "Balance Date": "balance_taken_on",
    "Balance": "balance",
}
PAYMENT_NAMES = {"Transaction ID": "transaction_id", "Transaction Date": "transaction_created_on", "Value": "transaction_value"}
PATH_NAMES = {"Transaction ID": "transaction_id", "Account_From": "source_account_number", "Account_To": "destination_account_number"}
SWIFT_NAMES = {"Bank": "bank_name", "SWIFT code": "swift_code", "Check Digits": "check_digits"}


def clean_transactions(raw: DataFrame) -> DataFrame:
    channel = F.col("Online or In-Person")
    return reshape.rename(
        raw.withColumns(
            {
                "bank": text.extract("Transaction Code", r"^(\w+)"),
                "transaction_method": predicates.first_match([(channel == 1, "Online"), (channel == 2, "In-Person")]),
                "created_on": F.to_date("Transaction Date"),
            }
        ).drop("Online or In-Person", "Transaction Date"),
        TRANSACTION_NAMES,
    )


def totals(transactions: DataFrame) -> dict[str, DataFrame]:
    """Total value by bank; by bank, method and weekday; by bank and customer."""
    weekday = dates.weekday_name("created_on").alias("weekday")
    return {
        "by_bank": groups.total_by(transactions, "bank", value="value"),
        "by_bank_method_weekday": groups.total_by(transactions, "bank", "transaction_method", weekday, value="value"),
        "by_bank_customer": groups.total_by(transactions, "bank", "customer_code", value="value"),
    }


def account_codes(transactions: DataFrame, swift: DataFrame) -> DataFrame:
    """International account number of each transaction. The sort code is a number, as leading zeros count for nothing."""
    coded = transactions.select(
        F.col("Transaction ID").alias("transaction_id"),
        F.col("Bank").alias("bank_name"),
        text.remove_text("Sort Code", "-").cast("long").cast("string").alias("sort_code"),
        F.col("Account Number").cast("string").alias("account_number"),
    )
    iban = F.concat(F.lit("GB"), "check_digits", "swift_code", "sort_code", "account_number")
    return coded.join(reshape.rename(swift, SWIFT_NAMES), "bank_name").select("transaction_id", iban.alias("iban"))


def quarterly_targets(raw: DataFrame) -> DataFrame:
    """One column for each quarter to one row for each."""
    long = reshape.melt(raw, ["Online or In-Person"], names_to="quarter", values_to="target")
    quarter = text.extract("quarter", r"(\d)").cast("int")
    return long.select(F.col("Online or In-Person").alias("transaction_method"), quarter.alias("quarter"), "target")


def variance_to_target(transactions: DataFrame, targets: DataFrame, bank: str = "DSB") -> DataFrame:
    own = transactions.where(F.col("bank") == bank)
    quarter = F.quarter("created_on").alias("quarter")
    total = groups.total_by(own, "transaction_method", quarter, value="value")
    joined = total.join(targets, ["transaction_method", "quarter"])
    return joined.withColumn("variance_to_target", F.col("total_value") - F.col("target"))


def monthly_ranking(transactions: DataFrame) -> DataFrame:
    """Banks ranked by value in each month and year, with the mean value of a rank and mean rank of a bank."""
    monthly = groups.total_by(
        transactions, "bank", dates.month_year("created_on").alias("transactions_in"), value="value", name="total_transaction_value"
    )
    ranked = ranks.ranked(monthly, ["transactions_in"], "total_transaction_value", descending=True)
    by_rank = groups.with_group_stats(ranked, ["rank"], {"mean_transaction_value_per_rank": F.avg("total_transaction_value")})
    return groups.with_group_stats(by_rank, ["bank"], {"mean_rank_per_bank": F.avg("rank")})


def clean_holders(raw: DataFrame) -> DataFrame:
    padded = text.pad_left(F.col("Contact Number").cast("string"), 11)
    return reshape.rename(raw.withColumn("Contact Number", padded), HOLDER_NAMES)


def clean_accounts(raw: DataFrame) -> DataFrame:
    """One row for each account and holder; holders are listed in one text."""
    split = reshape.split_to_rows(raw.withColumn("Account Holder ID", F.col("Account Holder ID").cast("string")), "Account Holder ID", ", ")
    return reshape.rename(split.withColumn("Account Holder ID", F.col("Account Holder ID").cast("long")), ACCOUNT_NAMES)


def clean_payments(raw: DataFrame) -> DataFrame:
    flag = F.col("Cancelled?")
    cancelled = predicates.three_state(flag == "Y", flag == "N")
    return reshape.rename(raw.withColumn("is_cancelled", cancelled).drop("Cancelled?"), PAYMENT_NAMES)


def clean_paths(raw: DataFrame) -> DataFrame:
    return reshape.rename(raw, PATH_NAMES)


def flagged_payments(holders: DataFrame, accounts: DataFrame, payments: DataFrame, paths: DataFrame, over: float = 1000) -> DataFrame:
    """Payments over a limit that went through and came from accounts other than platinum, with their holders."""
    kept = (F.col("account_type") != "Platinum") & ~F.col("is_cancelled") & (F.col("transaction_value") > over)
    sources = accounts.withColumnRenamed("account_number", "source_account_number")
    joined = payments.join(paths, "transaction_id").join(sources, "source_account_number").join(holders, "account_holder_id")
    return joined.where(kept).select(
        "transaction_id", "destination_account_number", "transaction_created_on", "transaction_value", "is_cancelled",
        "source_account_number", "balance_taken_on", "balance", "full_name", "date_of_birth", "mobile_contact", "first_line_of_address",
    )


def statement(accounts: DataFrame, payments: DataFrame, paths: DataFrame, month: int | None = 2) -> DataFrame:
    """Balance after each payment of an account, the opening balance first; ``line`` is the row's place in it."""
    transfers = payments.where(~F.col("is_cancelled")).join(paths, "transaction_id").select(
        "transaction_id", "transaction_created_on", "transaction_value", "source_account_number", "destination_account_number"
    )
    flows = scaffold.signed_flows(
        transfers, "source_account_number", "destination_account_number", F.col("transaction_value"), "account_number"
    ).select("transaction_id", "account_number", "transaction_created_on", F.col("movement").alias("transaction_value"))
    # A joint account comes once for each holder; its opening balance counts once.
    opening = groups.distinct_entity(accounts, ["account_number"], ["balance_taken_on", "balance"]).select(
        "account_number", F.col("balance_taken_on").alias("transaction_created_on"), F.col("balance").alias("transaction_value")
    )
    lines = opening.unionByName(flows, allowMissingColumns=True)
    order = [F.col("transaction_created_on"), down("transaction_value"), F.col("transaction_id")]
    balanced = ordered.ordered_columns(
        lines, ["account_number"], order, running_sum={"running_balance": F.col("transaction_value")}, row_number="line"
    ).drop("transaction_id")
    return balanced if month is None else balanced.where(F.month("transaction_created_on") == month)


def day_end_balance(lines: DataFrame, account: str, day: str, order: Sequence[str], balance: str = "running_balance") -> DataFrame:
    """Balance after the last line of each account and day; ``order`` are columns that grow along the statement."""
    last = F.max_by(balance, F.struct(*order)).alias("daily_end_balance")
    return lines.groupBy(account, day).agg(last)


def daily_balance(lines: DataFrame, account: str, day: str, movement: str, order: Sequence[str], balance: str = "running_balance") -> DataFrame:
    """Every account on every day: movement of the day (0 if none) and the balance carried forward.

    A balance is a run of days up to the next payment; the days are made at the
    end. Days before an account's first payment have no balance.
    """
    changes = balance_runs(lines, account, day, movement, order, balance)
    return scaffold.run_days(changes, day, only_on_first={"total_movement": 0})


def balance_runs(lines: DataFrame, account: str, day: str, movement: str, order: Sequence[str], balance: str = "running_balance") -> DataFrame:
    """Balances as runs, ``day`` to ``until``, over all days of the table, one row for each change."""
    last = F.max_by(balance, F.struct(*order)).alias("daily_end_balance")
    observed = lines.groupBy(account, day).agg(groups.zero_sum(movement).alias("total_movement"), last)
    edge = lambda extreme: lines.agg(extreme(F.col(day)).cast("date").alias("_edge")).select("_edge").scalar()
    # Where an account starts later than the table, a run without a balance comes first.
    starts = lines.groupBy(account).agg(F.min(day).alias("_first")).where(F.col("_first") > edge(F.min))
    before = starts.select(account, edge(F.min).alias(day), F.lit(0).cast(observed.schema["total_movement"].dataType).alias("total_movement"))
    return scaffold.runs(observed.unionByName(before, allowMissingColumns=True), [account], day, edge(F.max))


def account_summary(lines: DataFrame, accounts: DataFrame, on: datetime.date) -> DataFrame:
    """Movement and balance of every account on one day; before its first payment an account has its opening balance.

    One day needs no grid of days: the last line up to it has the balance that
    a forward fill would have carried there.
    """
    opening = groups.distinct_entity(accounts, ["account_number"], ["balance_taken_on", "balance"])
    day = F.lit(on)
    so_far = lines.where(F.col("transaction_created_on") <= day).groupBy("account_number").agg(
        groups.zero_sum(F.when(F.col("transaction_created_on") == day, F.col("transaction_value"))).alias("total_transaction_value"),
        F.max_by("running_balance", "line").alias("daily_end_balance"),
    )
    joined = opening.join(so_far, "account_number", "left")
    return joined.select(
        "account_number",
        day.alias("summary_on"),
        F.coalesce("total_transaction_value", F.lit(0)).alias("total_transaction_value"),
        F.coalesce("daily_end_balance", "balance").alias("daily_end_balance"),
    )


def clean_holidays(raw: DataFrame, position: str = "position") -> DataFrame:
    """Holiday dates from a sheet that gives the year on the first row of each block only.

    ``position`` is the row's place in the sheet, which a frame does not keep by itself.
    """
    filled = ordered.forward_fill(raw, [], [F.col(position)], "Year").dropna(subset=["Year", "Date", "Bank holiday"])
    written = F.concat("Date", F.lit("-"), F.col("Year").cast("int").cast("string"))
    return filled.select(dates.parse_date(written, "day_long_month").alias("bank_holiday_date"), F.col("Bank holiday").alias("bank_holiday_name"))


def new_customers_by_reporting_day(
    holidays: DataFrame, uk: DataFrame, roi: DataFrame, start: datetime.date, end: datetime.date
) -> DataFrame:
    """New customers of two countries on the first working day on or after they joined, and whether months agree."""
    spark = uk.sparkSession
    calendar = scaffold.calendar(spark, start, end, "joined_on")
    working = scaffold.working_days(calendar.withColumnRenamed("joined_on", "reported_on"), "reported_on", holidays, "bank_holiday_date")
    reported = joins.next_at_or_after(calendar, "joined_on", working, "reported_on", "reported_on")
    detail = joins.reporting_detail(reported, "reported_on")
    uk_days = uk.select(dates.parse_date("Date", "month_first_short_year").alias("joined_on"), F.col("New Customers").alias("uk"))
    roi_days = roi.select(
        dates.parse_date("Reporting Date", "month_first_short_year").alias("joined_on"),
        F.col("Reporting Month").alias("roi_reporting_month"),
        F.col("New Customers").alias("roi"),
    )
    counted = (
        uk_days.join(roi_days, "joined_on", "left")
        .join(reported, "joined_on")
        .groupBy("reported_on")
        .agg(
            F.max("roi_reporting_month").alias("roi_reporting_month"),
            groups.zero_sum("uk").alias("number_of_new_uk_customers"),
            groups.zero_sum("roi").alias("number_of_new_roi_customers"),
        )
    )
    flag = F.when(F.col("reporting_month") == F.col("roi_reporting_month"), False).otherwise(True)
    return counted.join(detail, "reported_on").select(
        flag.alias("misalignment_flag"),
        F.col("reporting_month").alias("uk_reporting_month"),
        "reporting_day",
        "reported_on",
        "number_of_new_uk_customers",
        "number_of_new_roi_customers",
        "roi_reporting_month",
    )
