"""Employees: missing ids, generations, ages, tenure, demographics, income tax."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyloom.functions import dates, predicates
from tidyloom.operators import groups, joins, reshape, scaffold
from tidyloom.settings import stored

# Column headers and their clean names.
EMPLOYEE_NAMES = {"date_of_birth": "born_on", "hire_date": "hired_on", "leave_date": "left_on"}
SNAPSHOT_NAMES = {"dc_nbr": "distribution_center", "month_end_date": "last_day_of_month", "hire_date": "hired_on", "leave_date": "left_on"}

# Income tax bands (code, lower threshold, upper threshold, rate, label).
TAX_BANDS = [
    ("basic", 12_570, 50_270, 0.2, "Basic (20%)"),
    ("higher", 50_270, 125_140, 0.4, "Higher (40%)"),
    ("additional", 125_140, None, 0.45, "Additional (45%)"),
]


def age_bands() -> list[tuple[int, int, str]]:
    """Under 20, five-year bands from 20 on, and 70 or more."""
    fives = [(age, age + 4, f"{age}-{age + 4} years") for age in range(20, 70, 5)]
    return [(0, 19, "Under 20 years"), *fives, (70, 200, "70+ years")]


def clean_employees(raw: DataFrame) -> DataFrame:
    return reshape.rename(raw, EMPLOYEE_NAMES)


def clean_snapshots(raw: DataFrame) -> DataFrame:
    return reshape.rename(raw, SNAPSHOT_NAMES)


def with_filled_ids(employees: DataFrame, snapshots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables with employee number and guid filled from pairs seen in either."""
    # One row for each employee, read four times: stored once.
    pairs = stored(joins.id_pairs([employees, snapshots], "employee_id", "guid"))
    return tuple(joins.fill_ids(frame, pairs, "employee_id", "guid") for frame in (employees, snapshots))


def describe_generations(raw: DataFrame) -> DataFrame:
    """A label for each generation; an open start or end is closed by 0 or 9999."""
    start, end = F.col("start_year"), F.col("end_year")
    label = predicates.first_match(
        [
            (start.isNull(), F.concat(F.lit("(Born in or before "), end.cast("string"), F.lit(")"))),
            (end.isNull(), F.concat(F.lit("(Born in or after "), start.cast("string"), F.lit(")"))),
        ],
        F.concat("generation", F.lit(" ("), start.cast("string"), F.lit("-"), end.cast("string"), F.lit(")")),
    )
    return raw.select(
        label.alias("generation_descr"), F.coalesce(start, F.lit(0)).alias("start_year"), F.coalesce(end, F.lit(9_999)).alias("end_year")
    )


def with_generation(employees: DataFrame, generations: DataFrame) -> DataFrame:
    """Employees with their generation, one row each; ``Not provided`` where the birth date is null.

    The bands are joined to the birth years, of which there are few, and the
    labelled years to the employees.
    """
    years = employees.select(F.year("born_on").alias("_year")).dropna().distinct()
    labels = joins.band_join(years, describe_generations(generations), F.col("_year"), "start_year", "end_year").select("_year", "generation_descr")
    joined = employees.withColumn("_year", F.year("born_on")).join(labels, "_year", "left")
    kept = joined.where(F.col("born_on").isNull() | F.col("generation_descr").isNotNull())
    described = kept.select(*employees.columns, predicates.label_null("born_on", "generation_descr").alias("employee_generation_descr"))
    return groups.distinct_entity(described, ["employee_id"], described.columns)


def with_age_range(snapshots: DataFrame, employees: DataFrame) -> DataFrame:
    """Snapshots with the employee's age band at the end of the month."""
    born = employees.select("employee_id", "born_on")
    age = dates.whole_years_between("born_on", "last_day_of_month")
    banded = snapshots.join(born, "employee_id").withColumn("_band", predicates.banded(age, age_bands()))
    described = banded.where(F.col("born_on").isNull() | F.col("_band").isNotNull()).select(
        "distribution_center", "last_day_of_month", "employee_id", "guid", "hired_on", "left_on",
        predicates.label_null("born_on", "_band").alias("age_range_descr"),
    )
    return groups.distinct_entity(described, ["last_day_of_month", "employee_id"], described.columns).select(*described.columns)


def with_tenure(snapshots: DataFrame) -> DataFrame:
    until = dates.earliest("last_day_of_month", "left_on")
    return snapshots.withColumn("selected_date", until).withColumns(
        {
            "tenure_years": dates.whole_years_between("hired_on", "selected_date"),
            "tenure_months": dates.whole_months_between("hired_on", "selected_date"),
        }
    )


def demographics(wide: DataFrame, ids: Sequence[str], attributes: Sequence[str], count: str = "number_of_employees") -> DataFrame:
    """Count of each attribute value in each unit, 0 where a unit lacks a value that others have."""
    keys = [*ids, "demographic_type", "demographic_detail"]
    long = reshape.melt(wide.select(*ids, *attributes), ids, attributes, names_to="demographic_type", values_to="demographic_detail")
    seen = stored(groups.count_by(long, *keys, name=count))  # read three times below
    grid = scaffold.key_grid(seen.select(*ids).distinct(), seen.select("demographic_type", "demographic_detail").distinct())
    # Observed and expected rows are summed: a null detail groups with itself, where a join would lose it.
    together = seen.unionByName(grid.withColumn(count, F.lit(0).cast("long")))
    return together.groupBy(*keys).agg(F.sum(count).alias(count))


def demographic_summary(snapshots: DataFrame, employees: DataFrame) -> DataFrame:
    """Headcounts by nationality, gender, generation, age band and tenure for each centre and month."""
    attributes = ["nationality", "gender", "employee_generation_descr", "age_range_descr", "tenure_years"]
    people = employees.select("employee_id", "nationality", "gender", "employee_generation_descr")
    ids = ["distribution_center", "last_day_of_month"]
    return demographics(snapshots.join(people, "employee_id"), ids, attributes)


def latest_salaries(raw: DataFrame, position: str = "position") -> DataFrame:
    """The last row of each employee by its place in the file."""
    return groups.latest_of_group(raw, ["StaffID"], [position])


def annual_salaries(latest: DataFrame, months: Sequence[str]) -> DataFrame:
    """Sum of the month columns. With one row for each employee this needs no melting and no shuffle."""
    total = sum((F.coalesce(F.col(f"`{month}`"), F.lit(0)) for month in months[1:]), F.coalesce(F.col(f"`{months[0]}`"), F.lit(0)))
    return latest.select(F.col("StaffID").alias("staff_id"), total.alias("annual_salary"))


def income_tax(salaries: DataFrame) -> DataFrame:
    """Tax in each band, total, and highest rate. People under the first threshold are left out.

    The bands are known, so each is a column of the same row: no scaffold, no pivot.
    """
    salary = F.col("annual_salary")
    paid = {}
    for code, lower, upper, rate, _ in TAX_BANDS:
        within = (salary if upper is None else F.least(salary, F.lit(upper))) - lower
        tax = F.round(rate * within, 2)
        paid[code] = F.when(tax >= 0, tax)
    due = salaries.withColumns(paid)
    total = sum((F.coalesce(F.col(code), F.lit(0.0)) for code in list(paid)[1:]), F.coalesce(F.col(next(iter(paid))), F.lit(0.0)))
    label = predicates.first_match([(F.col(code).isNotNull(), text) for code, _, _, _, text in reversed(TAX_BANDS)], "No liability")
    liable = F.coalesce(*[F.col(code) for code in paid]).isNotNull()
    return due.where(liable).withColumns({"total_tax_liability": total, "max_tax_rate": label})
