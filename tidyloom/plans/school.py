"""Schools: contacts, birthdays, grades, travel, attendance, admissions, costs, athletics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidyloom.functions import dates, predicates, text
from tidyloom.operators import groups, ordered, ranks, reshape
from tidyloom.settings import stored
from tidyloom.sources import lookups, readers

# Column headers and their clean names.
PUPIL_NAMES = {
    "id": "pupil_id",
    "pupil first name": "first_name",
    "pupil last name": "last_name",
    "gender": "gender",
    "Date of Birth": "born_on",
    "Preferred Contact Employer": "preferred_parental_contact_employer",
    "Parental Contact": "preferred_parental_contact_number",
}
LESSON_NAMES = {
    "Weekday": "weekday_name",
    "Week": "week_num",
    "Teacher": "teacher_name",
    "Lesson Name": "lesson_name",
    "Subject": "subject_name",
    "Attendance": "num_attended",
}
STUDENT_NAMES = {
    "Unique Row ID": "id",
    "Student ID": "student_id",
    "Last Name": "last_name",
    "First Name": "first_name",
    "Date of Birth": "born_on",
    "Subject": "subject",
    "Grade": "grade",
}
APPLICANT_NAMES = {
    "Date of Birth": "born_on",
    "School Name": "school_name",
    "Initials": "initials",
    "Home Address": "home_address",
    "English": "english",
    "Science": "science",
    "Maths": "maths",
    "Distance From School (Miles)": "miles_distance_to_school",
    "Subject Selection": "selected_subject",
}

# Spellings of travel modes, (written, clean, sustainable).
TRAVEL_MODES = [
    ("Aeroplane", "Aeroplane", False),
    ("Bycycle", "Bicycle", True),
    ("Bicycle", "Bicycle", True),
    ("Car", "Car", False),
    ("Carr", "Car", False),
    ("Dad's Shoulders", "Mum's Shoulders", True),
    ("Helicopter", "Helicopter", False),
    ("Helicopeter", "Helicopter", False),
    ("Hopped", "Hopped", True),
    ("Jumped", "Jumped", True),
    ("Mum's Shoulders", "Mum's Shoulders", True),
    ("Scooter", "Scooter", True),
    ("Scootr", "Scooter", True),
    ("Scoter", "Scooter", True),
    ("Skipped", "Skipped", True),
    ("Van", "Van", False),
    ("Walk", "Walk", True),
    ("WAlk", "Walk", True),
    ("Waalk", "Walk", True),
    ("Walkk", "Walk", True),
    ("Wallk", "Walk", True),
]
WEEKDAY_CODES = {"M": "Monday", "Tu": "Tuesday", "W": "Wednesday", "Th": "Thursday", "F": "Friday"}

# Grades, lowest first, with their points; admission scores; places by region.
GRADES = ["F", "E", "D", "C", "B", "A"]
GRADE_POINTS = {"A": 10, "B": 8, "C": 6, "D": 4, "E": 2, "F": 1}
ADMISSION_SCORES = [("A", 1, 50), ("B", 2, 40), ("C", 3, 30), ("D", 4, 20), ("E", 5, 10), ("F", 6, 0)]
REGION_PLACES = {"EAST": 15, "WEST": 5}
REGION_ALLOCATION = {"EAST": 75, "WEST": 25}


def clean_pupils(raw: DataFrame) -> DataFrame:
    """One row for each pupil, parents left out."""
    named = reshape.rename(raw.withColumn("Date of Birth", dates.parse_date("Date of Birth", "month_first")), PUPIL_NAMES)
    return groups.distinct_entity(named, ["pupil_id"], list(PUPIL_NAMES.values()))


def preferred_contacts(raw: DataFrame) -> DataFrame:
    """School year, names and e-mail of the parent to contact.

    Parents are columns whose names end in a number. The number a pupil prefers
    picks one of them in the row itself, with no melting and joining.
    """
    preferred = F.col("Parental Contact")
    numbered = {}
    for name in raw.columns:
        digits = name[len(name.rstrip("0123456789")) :]
        if digits and name not in PUPIL_NAMES:
            numbered[int(digits)] = name
    parent = predicates.first_match([(preferred == number, F.col(f"`{name}`")) for number, name in numbered.items()])
    last = F.col("pupil last name")
    picked = raw.where(preferred.isin(list(numbered))).select(
        dates.academic_year(dates.parse_date("Date of Birth", "month_first")).alias("academic_year"),
        text.joined_name("pupil first name", last).alias("pupil_full_name"),
        text.joined_name(parent, last).alias("parental_contact_full_name"),
        text.email(parent, last, "Preferred Contact Employer").alias("parental_contact_email"),
    )
    return picked


def birthdays(pupils: DataFrame, year: int) -> DataFrame:
    """Birthday in a year with month and weekday name; null for 29 February in a common year."""
    birthday = dates.anniversary("born_on", year)
    return pupils.select(
        "pupil_id", "first_name", "last_name", birthday.alias("birthday"),
        dates.month_name("born_on").alias("birthday_month"), dates.weekday_name(birthday).alias("birthday_weekday"),
    )


def birthday_counts(pupils: DataFrame, year: int) -> DataFrame:
    return groups.count_by(birthdays(pupils, year), "birthday_month", "birthday_weekday")


def scores_long(raw: DataFrame) -> DataFrame:
    long = reshape.melt(raw, ["Student ID"], names_to="subject_name", values_to="score")
    return long.withColumnRenamed("Student ID", "pupil_id")


def performance_summary(pupils: DataFrame, scores: DataFrame, pass_mark: float = 75) -> DataFrame:
    joined = pupils.select("pupil_id", "gender").join(scores, "pupil_id")
    return joined.groupBy("pupil_id", "gender").agg(
        F.count_if(F.col("score") >= pass_mark).alias("num_subjects_passed"), F.avg("score").alias("mean_score")
    )


def travel_summary(raw: DataFrame) -> DataFrame:
    """Trips by mode and weekday with their share of the weekday."""
    long = reshape.melt(raw, ["Student ID"], names_to="weekday_code", values_to="written")
    modes = lookups.inline_table(raw.sparkSession, TRAVEL_MODES, "written string, mode_of_transport string, is_sustainable boolean")
    code = F.col("weekday_code")
    weekday = predicates.first_match([(code == short, name) for short, name in WEEKDAY_CODES.items()])
    trips = groups.count_by(
        lookups.lookup(long, modes, "written").withColumn("weekday", weekday), "mode_of_transport", "weekday", "is_sustainable", name="num_trips"
    )
    shared = groups.share_of_group(trips.where(F.col("weekday").isNotNull()), ["weekday"], "num_trips", "_share", total="total_trips")
    return shared.withColumn("pct_trips", 100 * F.round("_share", 3)).drop("_share")


def grade_points(scores: DataFrame) -> DataFrame:
    """Grade of each score by sixths of its subject, and the points it earns."""
    graded = ranks.quantile_bins(scores, ["subject_name"], "score", 6, GRADES, "grade")
    points = predicates.first_match([(F.col("grade") == grade, value) for grade, value in GRADE_POINTS.items()])
    return graded.select("pupil_id", "subject_name", "grade", points.alias("grade_point"))


def total_grade_points(points: DataFrame) -> DataFrame:
    return points.groupBy("pupil_id").agg(groups.zero_sum("grade_point").alias("total_grade_points"))


def grade_point_average(points: DataFrame, digits: int = 2) -> DataFrame:
    """For each grade the mean of the total points of pupils who have it."""
    with_totals = groups.with_group_stats(points, ["pupil_id"], {"total": F.sum("grade_point")})
    return with_totals.groupBy("grade").agg(F.round(F.avg("total"), digits).alias("grade_point_average"))


def lesson_attendance(raw: DataFrame) -> DataFrame:
    """Lessons with name and subject filled in and the mean attendance of their slot."""
    timed = raw.withColumn("starts_at", dates.time_of_day("Lesson Time")).drop("Lesson Time")
    slot = ["weekday_name", "starts_at"]
    filled = reshape.fill_blanks(reshape.rename(timed, LESSON_NAMES), slot, ["lesson_name", "subject_name"])
    return groups.with_group_stats(filled, slot, {"mean_num_attended": F.avg("num_attended")})


def cause_for_concern(raw: DataFrame, before: int = 2021, after: int = 2022) -> DataFrame:
    """Students whose median grade fell between two years."""
    ids = ["student_id", "first_name", "last_name", "Gender", "D.O.B"]
    # Nearly every grade is a group of its own, so what a task of the scan counts grows with its file: deal the students out first.
    spread = raw.repartition(int(raw.sparkSession.conf.get("spark.sql.shuffle.partitions")), *[F.col(f"`{c}`") for c in raw.columns])
    long = reshape.melt(spread, ids, names_to="variable", values_to="grade")
    people = ["student_id", "first_name", "last_name", "gender", "born_on"]
    graded = long.select(
        "student_id", "first_name", "last_name",
        predicates.if_else("Gender", "M", "male", "female").alias("gender"),
        dates.parse_date("`D.O.B`", "iso").alias("born_on"),
        text.part("variable", "-", 0).cast("int").alias("year"),
        "grade",
    )
    medians = ranks.group_quantiles(graded, [*people, "year"], "grade", [0.5]).withColumn("median", F.col("quantiles")[0])
    wide = reshape.spread(medians, people, "year", "median", [before, after])
    return wide.where(F.col(f"`{before}`") > F.col(f"`{after}`"))


def _split_name(df: DataFrame, name: str = "student_name") -> DataFrame:
    return df.withColumns({"first_name": text.part(name, "_", 0), "last_name": text.part(name, "_", 1)}).drop(name)


def attendance_and_scores(attendance: DataFrame, scores: DataFrame) -> DataFrame:
    """Test scores with the attendance class of the student, joined on names."""
    rate = F.col("attendance_percentage")
    category = predicates.first_match([(rate < 0.7, "Low"), (rate > 0.9, "High")], "Medium")
    fixes = [("Engish", "English"), ("Math", "Mathematics"), ("Sciece", "Science")]
    tested = _split_name(scores).withColumns(
        {"subject": text.replace_texts("subject", fixes), "approximate_test_score": F.round("test_score").cast("tinyint")}
    )
    return tested.join(_split_name(attendance), ["first_name", "last_name"]).select(
        "student_id", "last_name", "first_name", rate.alias("prop_attendance"), category.alias("attendance_category"),
        "subject", "test_score", "approximate_test_score",
    )


def clean_students(raw: DataFrame) -> DataFrame:
    """Trimmed values under trimmed lower-case headers."""
    return reshape.rename_by(text.trim_strings(raw), lambda name: "_".join(name.lower().split()))


def results_long(raw: DataFrame) -> DataFrame:
    long = reshape.melt(raw, ["Student ID"], names_to="subject", values_to="result")
    return long.withColumnRenamed("Student ID", "student_id")


def lowest_class_by_subject(students: DataFrame, results: DataFrame) -> DataFrame:
    """The class with the lowest mean in each subject; none where two share the lowest place."""
    means = students.join(results, "student_id").groupBy("class", "subject").agg(F.avg("result").alias("mean_result"))
    return ranks.ranked(means, ["subject"], "mean_result", ties="max").where("rank = 1").drop("rank")


def low_performers(students: DataFrame, results: DataFrame, subjects: Sequence[str], classes: Sequence[str] = ("9A", "9B")) -> DataFrame:
    """Students of some classes who are in the lower quarter of two subjects or more."""
    binned = ranks.quantile_bins(results, ["subject"], "result", [0.25, 0.75], ["lower", "mid", "upper"], "category")
    low = F.count_if(F.col("category") == "lower").alias("_low")
    cells = [F.max(F.when(F.col("subject") == s, F.col("category"))).alias(f"{s.lower()}_subject_rank") for s in subjects]
    per_student = binned.groupBy("student_id").agg(low, *cells).where("_low >= 2").drop("_low")
    chosen = students.where(F.col("class").isin(list(classes))).select("student_id", "full_name", "gender", "class")
    return chosen.join(per_student, "student_id")


def clean_applicants(raw: DataFrame, date_layout: str, numeric_grades: bool) -> DataFrame:
    """One region's grades as letters with their scores, names in upper case. A grade outside the table drops out."""
    written = 1 if numeric_grades else 0
    named = reshape.rename(raw.withColumn("Date of Birth", dates.parse_date("Date of Birth", date_layout)), STUDENT_NAMES)
    scored = [(str(row[written]), row[0], row[2]) for row in ADMISSION_SCORES]
    table = lookups.inline_table(raw.sparkSession, scored, "grade string, alpha_grade string, grade_score long")
    graded = lookups.lookup(named.withColumn("grade", F.col("grade").cast("string")), table, "grade", "inner").drop("grade")
    return graded.withColumns({name: F.upper(name) for name in ("first_name", "last_name")})


def admissions(east: DataFrame, west: DataFrame, schools: DataFrame, subjects: Sequence[str] = ("english", "science", "maths")) -> DataFrame:
    """Both regions' students in one table: school, total score, and one grade column for each subject."""
    both = readers.stack([clean_applicants(east, "written", False), clean_applicants(west, "day_first", True)], fill_missing=True)
    fixes = [("St Marys", "St. Mary's"), ("Viliers Hill", "Villiers Hill")]
    named_schools = schools.select(
        F.col("Student ID").alias("student_id"), text.replace_texts("School Name", fixes).alias("school_name")
    )
    people = both.select(
        text.extract("student_id", r"(\d+)").cast("long").alias("student_id"),
        text.extract("student_id", r"([A-Za-z]+)").alias("school_region"),
        F.upper(text.joined_name("first_name", "last_name")).alias("full_name"),
        "born_on",
        F.lower("subject").alias("subject"),
        "alpha_grade",
        "grade_score",
    )
    # One pass makes the total and the grade columns; the school is joined to one row for each student.
    cells = [F.max(F.when(F.col("subject") == s, F.col("alpha_grade"))).alias(s) for s in subjects]
    per_student = people.groupBy("student_id", "full_name", "born_on", "school_region").agg(F.sum("grade_score").alias("total_grade_score"), *cells)
    return per_student.join(named_schools, "student_id").select(
        "student_id", "full_name", "born_on", "school_region", "school_name", "total_grade_score", *subjects
    )


def clean_applicant_details(raw: DataFrame) -> DataFrame:
    return reshape.rename(raw, APPLICANT_NAMES)


def best_applicants(df: DataFrame, keys: Sequence[str], order: Sequence[Column], places: Column, most: int) -> DataFrame:
    """The first ``places`` rows of each group, a number that may differ by row; ``most`` is its largest value.

    Filtering on the constant first lets Spark drop rows before the shuffle.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    first = df.withColumn("_position", position).where(F.col("_position") <= most)
    return first.where(F.col("_position") <= places).drop("_position")


def selected_applicants(performance: DataFrame, details: DataFrame) -> DataFrame:
    """Applicants with the best scores for each region and subject, and how their school did.

    Details are joined on birth date, initials, school and grades; of equal scores the nearer home wins.
    """
    initials = F.concat(F.substring(text.part("full_name", " ", 0), 1, 1), F.substring(text.part("full_name", " ", 1), 1, 1))
    key = ["born_on", "initials", "school_name", "english", "maths", "science"]
    chosen = details.select(*key, "miles_distance_to_school", "selected_subject")
    applicants = performance.withColumn("initials", initials).join(chosen, key, "left")
    east = F.col("school_region") == "EAST"
    order = [F.col("total_grade_score").desc(), F.col("miles_distance_to_school").asc_nulls_last(), F.col("student_id").asc()]
    places = F.when(east, REGION_PLACES["EAST"]).otherwise(REGION_PLACES["WEST"])
    best = best_applicants(applicants, ["school_region", "selected_subject"], order, places, max(REGION_PLACES.values()))
    # A few rows for each region and subject, read several times by the next step: stored once.
    return school_performance(stored(best)).select(
        "student_id", "full_name", "born_on", "school_region", "school_name", "school_performance", "selected_subject",
        "english", "science", "maths", "total_grade_score",
    )


def school_performance(selected: DataFrame) -> DataFrame:
    """Share of its region's places that each school won: high, low or middle."""
    region = F.col("school_region")
    allocation = predicates.first_match([(region == name, places) for name, places in REGION_ALLOCATION.items()])
    counted = groups.with_group_stats(selected.where(allocation.isNotNull()), ["school_name"], {"_won": F.count(F.lit(1))})
    shared = counted.withColumn("_share", F.col("_won") / allocation)
    spanned = groups.with_group_stats(shared, ["school_region"], {"_best": F.max("_share"), "_worst": F.min("_share")})
    label = predicates.first_match([(F.col("_share") == F.col("_best"), "high"), (F.col("_share") == F.col("_worst"), "low")], "middle")
    return spanned.withColumn("school_performance", label).drop("_won", "_share", "_best", "_worst")


def school_costs(sheets: Sequence[DataFrame], costs: Sequence[str] = ("Electricity Cost", "Water Cost", "Gas Cost", "Maintenance Cost")) -> DataFrame:
    """Monthly costs of each school side by side with their total, numbered in order."""
    rows = readers.stack(sheets).select(
        F.col("School Name").alias("school_name"),
        dates.date_from_month_text(F.lit("01"), "Month", F.col("Year").cast("string")).alias("date"),
        F.col("Name").alias("name"),
        F.col("Value").alias("value"),
    )
    cells = [F.max(F.when(F.col("name") == c, F.col("value"))).alias("_".join(c.lower().split())) for c in costs]
    monthly = rows.groupBy("school_name", "date").agg(groups.zero_sum("value").alias("total_monthly_cost"), *cells)
    indexed = ordered.row_index(monthly, [F.col("school_name"), F.col("date")], "sort_order")
    return indexed.select("sort_order", *monthly.columns)


def track_team(students: DataFrame, times: DataFrame, benchmarks: DataFrame) -> DataFrame:
    """Students within the benchmark of their event, gender and age, ranked; a 200m time under 25 s is an error."""
    standards = benchmarks.select(
        F.col("`Gender `").alias("gender"), F.col("`Age `").alias("age"), F.col("`Event `").alias("track_event"), F.col("Benchmark").alias("benchmark_time")
    )
    joined = times.join(students, "id").join(standards, ["track_event", "gender", "age"])
    impossible = (F.col("track_event") == "200m") & (F.col("time") < 25)
    kept = joined.where((F.col("time") <= F.col("benchmark_time")) & ~impossible)
    return ranks.ranked(kept, ["gender", "age", "track_event"], "time", "student_rank")

