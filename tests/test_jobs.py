"""Whole jobs on small literal inputs with the headers of the original files."""

import datetime

from conftest import rows
from pyspark.sql import functions as F

from tidyloom.plans import bank, calls, flights, games, retail, school, staff, survey
from tidyloom.sources import readers


def day(text):
    return datetime.date.fromisoformat(text)


def test_preferred_contacts_and_birthdays(spark):
    raw = spark.createDataFrame(
        [
            (1, "Ann", "Lee", "Female", "2/29/2012", "Acme", 2, "Joe", "Sue"),
            (2, "Bob", "Ray", "Male", "9/1/2014", "Bolt", 1, "Kim", None),
            (3, "Cat", "Fox", "Female", "8/1/2010", "Bolt", 3, "Kim", "Pat"),
        ],
        "id long, `pupil first name` string, `pupil last name` string, gender string, `Date of Birth` string, `Preferred Contact Employer` string, "
        "`Parental Contact` long, `Parental Contact Name_1` string, `Parental Contact Name_2` string",
    )
    # A pupil whose number names no parent has no contact.
    assert rows(school.preferred_contacts(raw)) == [(1, "Bob Ray", "Kim Ray", "kim.ray@bolt.com"), (4, "Ann Lee", "Sue Lee", "sue.lee@acme.com")]
    pupils = school.clean_pupils(raw.unionByName(raw))
    assert pupils.count() == 3
    assert rows(school.birthday_counts(pupils, 2022)) == [("August", "Monday", 1), ("February", None, 1), ("September", "Thursday", 1)]


def test_grades(spark):
    scores = school.scores_long(spark.createDataFrame([(i, float(i), float(70 + i)) for i in range(1, 8)], "`Student ID` long, Maths double, Art double"))
    points = school.grade_points(scores)
    assert [r.grade for r in points.where("subject_name = 'Maths'").orderBy("pupil_id").collect()] == ["F", "F", "E", "D", "C", "B", "A"]
    assert rows(school.total_grade_points(points).where("pupil_id = 7")) == [(7, 20)]
    assert rows(school.grade_point_average(points).where("grade = 'F'")) == [("F", 2.0)]


def test_travel(spark):
    raw = spark.createDataFrame([(1, "Carr", "Walkk"), (2, "WAlk", "Rocket"), (3, "Car", "Walk")], "`Student ID` long, M string, Th string")
    assert rows(school.travel_summary(raw), "weekday", "mode_of_transport", "is_sustainable", "num_trips", "total_trips", "pct_trips") == [
        ("Monday", "Car", False, 2, 3, 66.7), ("Monday", "Walk", True, 1, 3, 33.300000000000004), ("Thursday", None, None, 1, 3, 33.300000000000004),
        ("Thursday", "Walk", True, 2, 3, 66.7),
    ]


def test_lessons(spark):
    raw = spark.createDataFrame(
        [("Monday", 1, "J", "9:00", "Statistics", None, 24), ("Monday", 2, "J", "9:00", None, "Maths", 12), ("Monday", 3, "J", "10:00", None, None, 5)],
        "Weekday string, Week long, Teacher string, `Lesson Time` string, `Lesson Name` string, Subject string, Attendance long",
    )
    assert rows(school.lesson_attendance(raw), "week_num", "starts_at", "lesson_name", "subject_name", "mean_num_attended") == [
        (1, "09:00:00", "Statistics", "Maths", 18.0), (2, "09:00:00", "Statistics", "Maths", 18.0),
    ]


def test_lowest_class_needs_a_single_lowest(spark):
    students = school.clean_students(spark.createDataFrame([(1, " A ", "F", "9A "), (2, "B", "M", "9B"), (3, "C", "M", "9C")], "` Student ID ` long, ` Full name         ` string, ` Gender ` string, ` Class ` string"))
    assert students.columns == ["student_id", "full_name", "gender", "class"]
    results = school.results_long(spark.createDataFrame([(1, 50, 40), (2, 60, 40), (3, 70, 80)], "`Student ID` long, English long, Maths long"))
    assert rows(school.lowest_class_by_subject(students, results), "class", "subject", "mean_result") == [("9A", "English", 50.0)]


def test_attendance(spark):
    attendance = spark.createDataFrame([("Al_Ray", 0.7), ("Bo_Fox", 0.95)], "student_name string, attendance_percentage double")
    scores = spark.createDataFrame([(1, "Al_Ray", "Math", 95.5), (2, "Bo_Fox", "Sciece", 82.4), (3, "No_One", "Art", 1.0)], "student_id long, student_name string, subject string, test_score double")
    assert rows(school.attendance_and_scores(attendance, scores)) == [
        (1, "Ray", "Al", 0.7, "Medium", "Mathematics", 95.5, 96), (2, "Fox", "Bo", 0.95, "High", "Science", 82.4, 82),
    ]


def test_words(spark):
    tiles = games.clean_tiles(spark.createDataFrame([("0 points: Blank ×2",), ("1 point: A ×2, B ×1",), ("3 points: C ×5",)], "Scrabble string"))
    assert rows(tiles) == [(0, None, 2), (1, "A", 2), (1, "B", 1), (3, "C", 5)]
    found = games.word_analysis(spark.createDataFrame([("ab",), ("ba",), ("cc",), ("bb",)], "word string"), tiles)
    # Two Bs cannot be drawn; anagrams tie.
    assert rows(found, "word", "total_points", "probability_rank", "total_points_rank") == [("AB", 2, 2, 2), ("BA", 2, 2, 2), ("CC", 6, 1, 1)]


def test_evolutions(spark):
    names = ", ".join(f"{part} int" for part in games.POWER_PARTS)
    stats = spark.createDataFrame([(n, i, 1) + (p,) * 6 for i, (n, p) in enumerate([("a", 1), ("b", 2), ("c", 5), ("x", 1)])], f"name string, pokedex_number int, gen_introduced int, {names}")
    lines = spark.createDataFrame([("a", "b", "c"), ("x", None, None), ("b", "c", None)], "Stage_1 string, Stage_2 string, Stage_3 string")
    assert rows(games.evolution_gains(stats, lines), "stage_1", "initial_combat_power", "final_combat_power", "prop_change_combat_power") == [("a", 6, 30, 5.0), ("b", 12, 30, 2.5)]


def test_iban_and_targets(spark):
    transactions = spark.createDataFrame([(3888, 62230725, "95-98-82", "Data Source Bank")], "`Transaction ID` long, `Account Number` long, `Sort Code` string, Bank string")
    swift = spark.createDataFrame([("Data Source Bank", "DSBX", "12")], "Bank string, `SWIFT code` string, `Check Digits` string")
    assert rows(bank.account_codes(transactions, swift)) == [(3888, "GB12DSBX95988262230725")]
    raw = spark.createDataFrame(
        [("DSB-1", 70000, 1, 1, day("2023-02-01")), ("DSB-2", 4562, 1, 1, day("2023-03-01")), ("DTB-3", 9, 1, 2, day("2023-03-01"))],
        "`Transaction Code` string, Value long, `Customer Code` long, `Online or In-Person` int, `Transaction Date` date",
    )
    targets = bank.quarterly_targets(spark.createDataFrame([("Online", 72500), ("In-Person", 75000)], "`Online or In-Person` string, Q1 long"))
    cleaned = bank.clean_transactions(raw)
    assert rows(bank.variance_to_target(cleaned, targets)) == [("Online", 1, 74562, 72500, 2062)]
    assert rows(bank.totals(cleaned)["by_bank"]) == [("DSB", 74562), ("DTB", 9)]


def accounts_and_payments(spark):
    accounts = bank.clean_accounts(spark.createDataFrame(
        [(1, "Basic", "7, 8", day("2023-01-31"), 100.0), (2, "Platinum", "9", day("2023-01-31"), 50.0)],
        "`Account Number` long, `Account Type` string, `Account Holder ID` string, `Balance Date` date, Balance double",
    ))
    payments = bank.clean_payments(spark.createDataFrame(
        [(1, day("2023-02-01"), 30.0, "N"), (2, day("2023-02-01"), 1500.0, "N"), (3, day("2023-02-03"), 5.0, "Y"), (4, day("2023-02-03"), 20.0, "N")],
        "`Transaction ID` long, `Transaction Date` date, Value double, `Cancelled?` string",
    ))
    paths = bank.clean_paths(spark.createDataFrame([(1, 1, 2), (2, 1, 2), (3, 1, 2), (4, 2, 1)], "`Transaction ID` long, Account_From long, Account_To long"))
    return accounts, payments, paths


def test_payments(spark):
    accounts, payments, paths = accounts_and_payments(spark)
    holders = bank.clean_holders(spark.createDataFrame([(i, f"H{i}", day("1980-01-01"), 7700900000 + i, "1 Road") for i in (7, 8, 9)], "`Account Holder ID` long, Name string, `Date of Birth` date, `Contact Number` long, `First Line of Address` string"))
    assert rows(bank.flagged_payments(holders, accounts, payments, paths), "transaction_id", "full_name", "mobile_contact") == [
        (2, "H7", "07700900007"), (2, "H8", "07700900008"),
    ]


def test_statement_and_summary(spark):
    accounts, payments, paths = accounts_and_payments(spark)
    lines = bank.statement(accounts, payments, paths)
    assert [(r.transaction_value, r.running_balance) for r in lines.where("account_number = 1").orderBy("line").collect()] == [(-30.0, 70.0), (-1500.0, -1430.0), (20.0, -1410.0)]
    # The joint account's opening balance counts once.
    assert [(r.transaction_value, r.running_balance) for r in lines.where("account_number = 2").orderBy("line").collect()] == [(1500.0, 1550.0), (30.0, 1580.0), (-20.0, 1560.0)]
    assert rows(bank.account_summary(lines, accounts, day("2023-02-02")), "account_number", "total_transaction_value", "daily_end_balance") == [(1, 0.0, -1430.0), (2, 0.0, 1580.0)]
    grid = bank.daily_balance(lines, "account_number", "transaction_created_on", "transaction_value", ["line"])
    assert rows(grid.where("account_number = 1"), "transaction_created_on", "total_movement", "daily_end_balance") == [
        (day("2023-02-01"), -1530.0, -1430.0), (day("2023-02-02"), 0.0, -1430.0), (day("2023-02-03"), 20.0, -1410.0),
    ]


def test_account_without_payments_keeps_its_opening_balance(spark):
    accounts, payments, paths = accounts_and_payments(spark)
    idle = spark.createDataFrame([(3, "Basic", 1, day("2023-01-31"), 5.0)], accounts.schema)
    summary = bank.account_summary(bank.statement(accounts, payments, paths), accounts.unionByName(idle), day("2023-02-01"))
    assert rows(summary.where("account_number = 3"), "total_transaction_value", "daily_end_balance") == [(0.0, 5.0)]


def test_holidays(spark):
    sheet = spark.createDataFrame([(1, 2022, "3-January", "New Year"), (2, None, "15-April", "Good Friday"), (3, None, None, None), (4, 2023, "2-January", "New Year")], "position int, Year int, Date string, `Bank holiday` string")
    assert rows(bank.clean_holidays(sheet), "bank_holiday_date") == [(day("2022-01-03"),), (day("2022-04-15"),), (day("2023-01-02"),)]


def test_reporting_days(spark):
    holidays = spark.createDataFrame([(day("2022-01-03"),)], "bank_holiday_date date")
    uk = spark.createDataFrame([("01-01-22", 5), ("01-04-22", 2), ("01-31-22", 9)], "Date string, `New Customers` int")
    roi = spark.createDataFrame([("01-04-22", "Jan-22", 1), ("01-31-22", "Jan-22", 4)], "`Reporting Date` string, `Reporting Month` string, `New Customers` int")
    found = bank.new_customers_by_reporting_day(holidays, uk, roi, day("2021-12-31"), day("2022-02-10"))
    assert rows(found, "reported_on", "misalignment_flag", "uk_reporting_month", "reporting_day", "number_of_new_uk_customers", "number_of_new_roi_customers") == [
        (day("2022-01-04"), False, "Jan-22", 2, 7, 1), (day("2022-01-31"), True, "Feb-22", 1, 9, 4),
    ]


def test_survey(spark):
    raw = spark.createDataFrame(
        [(1, 5, 4, 1, 3, 3, 9), (2, 3, 3, 1, 2, 2, 1), (3, 1, 1, 1, 2, 3, 1)],
        "`Customer ID` long, `Mobile App - Ease` long, `Mobile App - Speed` long, `Mobile App - Overall Rating` long, "
        "`Online Interface - Ease` long, `Online Interface - Speed` long, `Online Interface - Overall Rating` long",
    )
    found = survey.preference_shares(survey.clean_responses(raw))
    assert [(r[0], r[1]) for r in rows(found, "category", "num_responses")] == [("Mobile App Fan", 1), ("Neutral", 1), ("Online Interface Fan", 1)]
    assert abs(sum(r.pct_responses for r in found.collect()) - 100) < 1e-9


def test_agents(spark):
    sheets = {
        "Jan": spark.createDataFrame([(1, 10, 1, 9, 90, 0.5)], "AgentID long, `Calls Offered` long, `Calls Not Answered` long, `Calls Answered` long, `Total Duration` long, Sentiment double"),
        "Feb": spark.createDataFrame([(2, 0, 0, 0, 0, -1.0)], "AgentID long, Offered long, `Not Answered` long, Answered long, `Total Duration` long, Sentiment double"),
    }
    people = spark.createDataFrame([(1, "A", "Z", 5, 11, 12), (2, "B", "Y", 5, 12, 11)], "id long, first_name string, last_name string, `Location ID` long, `Leader 1` long, `Leader 2` long")
    leaders = spark.createDataFrame([(11, "L", "One"), (12, "M", "Two")], "id long, first_name string, last_name string")
    places = spark.createDataFrame([(5, "Here")], "`Location ID` long, Location string")
    found = calls.agent_performance(calls.clean_metrics(sheets, 2021), calls.clean_agents(people), leaders, places)
    assert rows(found, "agent_id", "collected_in", "agent_full_name", "leader_full_name", "rate_calls_not_answered", "mean_call_duration", "had_positive_call_sentiment") == [
        (1, "Feb-2021", "Z, A", "One, L", None, None, None), (1, "Jan-2021", "Z, A", "One, L", 0.1, 10.0, True),
        (2, "Feb-2021", "Y, B", "Two, M", None, None, False), (2, "Jan-2021", "Y, B", "Two, M", None, None, None),
    ]


def test_pareto_leaves_out_the_customer_that_crosses(spark):
    sales = spark.createDataFrame([("a", 30), ("a", 20), ("b", 30), ("c", 15), ("d", 5)], "customer_id string, sales long")
    assert rows(retail.customers_up_to_share(sales, ["customer_id"], 0.8)) == [("a", 50, 0.5, 0.5), ("b", 30, 0.3, 0.8)]
    assert rows(retail.customers_up_to_share(sales, ["customer_id"], 0.79), "customer_id") == [("a",)]


def test_bikes(spark):
    sheets = {
        "January": spark.createDataFrame([("Road", "m", "Monday, 2, 2023", "100", "York")], "`*BikeType` string, `*Model` string, `*Order Date` string, `*Sales` string, `*Store` string"),
        "April": spark.createDataFrame([("York", "150", "Sat, 15, 2023", "m", "Road")], "Store string, Sales string, OrderDate string, Model string, `Bike Type` string"),
    }
    found = retail.fiscal_quarter_change(retail.clean_bike_sales(sheets))
    assert rows(found) == [("York", 3, 100, None), ("York", 4, 150, 50.0)]


def test_new_customers_and_annual_sales(spark):
    sheet = spark.createDataFrame([(1, 5, "Ethnicity", "x"), (1, 5, "Date of Birth", "1/2/1990"), (1, 5, "Account Type", "Gold"), (1, 2, "Ethnicity", "y")], "ID long, `Joining Day` int, Demagraphic string, Value string")
    assert rows(retail.new_customers({"March": sheet}), "person_id", "ethnicity", "born_on", "account_type", "joined_on") == [(1, "y", None, None, day("2023-03-02"))]
    years = {"2018": spark.createDataFrame([("Q1", "1.5M", "200K"), ("Q2", "2M", "1,100")], "` ` string, Sales string, Profits string")}
    assert rows(retail.annual_sales(readers.labelled_union(years, "sheet"))) == [(2018, 3_500_000, 201_100)]


def test_loyalty(spark):
    spending = spark.createDataFrame([(350.0, "F"), (349.0, "F"), (250.0, "M"), (1.0, "M")], "sale_total double, gender string")
    assert rows(retail.loyalty_by_gender(spending)) == [("Byte", "F", 1, 50.0), ("Byte", "M", 1, 50.0), ("MegaByte", "F", 1, 100.0), ("NullByte", "M", 1, 100.0)]


def test_employees(spark):
    employees = staff.clean_employees(spark.createDataFrame(
        [(1, None, day("1950-05-05"), "GB", "F"), (None, "G2", None, "FR", "M")], "employee_id long, guid string, date_of_birth date, nationality string, gender string"
    ))
    snapshots = staff.clean_snapshots(spark.createDataFrame(
        [(4, day("2023-01-31"), day("2022-01-31"), None, 1, "G1"), (4, day("2023-01-31"), day("2020-02-01"), day("2023-01-15"), 2, "G2"), (5, day("2023-01-31"), day("2023-01-01"), None, 1, None)],
        "dc_nbr int, month_end_date date, hire_date date, leave_date date, employee_id long, guid string",
    ))
    employees, snapshots = staff.with_filled_ids(employees, snapshots)
    assert rows(employees, "employee_id", "guid") == [(1, "G1"), (2, "G2")]
    assert rows(snapshots, "employee_id", "guid") == [(1, "G1"), (1, "G1"), (2, "G2")]
    generations = spark.createDataFrame([("Old", None, 1945), ("Boom", 1946, 1964), ("New", 1997, None)], "generation string, start_year int, end_year int")
    described = staff.with_generation(employees, generations)
    assert rows(described, "employee_id", "employee_generation_descr") == [(1, "Boom (1946-1964)"), (2, "Not provided")]
    tenured = staff.with_tenure(staff.with_age_range(snapshots, employees))
    assert rows(tenured, "employee_id", "age_range_descr", "selected_date", "tenure_years", "tenure_months") == [
        (1, "70+ years", day("2023-01-31"), 0, 11), (2, "Not provided", day("2023-01-15"), 2, 35),
    ]
    summary = staff.demographic_summary(tenured, described)
    assert rows(summary.where("demographic_type = 'gender'"), "demographic_detail", "number_of_employees") == [("F", 1), ("M", 1)]


def test_demographics_count_null_details(spark):
    wide = spark.createDataFrame([(1, None, 3), (2, "x", 3)], "c int, a string, n int")
    found = staff.demographics(wide, ["c"], ["a", "n"])
    assert rows(found) == [(1, "a", None, 1), (1, "a", "x", 0), (1, "n", "3", 1), (2, "a", None, 0), (2, "a", "x", 1), (2, "n", "3", 1)]


def test_income_tax(spark):
    raw = spark.createDataFrame([(1, 0, 9, 9), (1, 1, 30_000, 30_000), (2, 2, 1_000, None), (3, 3, 100_000, 50_000), (4, 4, 12_570, 0)], "StaffID long, position int, `1` long, `2` long")
    taxed = staff.income_tax(staff.annual_salaries(staff.latest_salaries(raw), ["1", "2"]))
    assert rows(taxed, "staff_id", "annual_salary", "basic", "higher", "additional", "max_tax_rate") == [
        (1, 60_000, 7540.0, 3892.0, None, "Higher (40%)"), (3, 150_000, 7540.0, 29948.0, 11187.0, "Additional (45%)"), (4, 12_570, 0.0, None, None, "Basic (20%)"),
    ]


def test_flights(spark):
    raw = spark.createDataFrame(
        [("2024-01-02//PA7//Rome-Oslo//Economy//100.5", 1, 2, "Egg"), ("2024-03-02//PA7//Rome-Oslo//Economy//50", 1, 0, None)],
        "`Flight Details` string, `Flow Card?` int, `Bags Checked` int, `Meal Type` string",
    )
    cleaned = flights.correct_classes(flights.split_details(raw))
    assert rows(flights.numbered(cleaned), "flight_detail_id", "flew_on", "from", "to", "seat_class", "price", "has_flow_card") == [
        (1, day("2024-01-02"), "Rome", "Oslo", "First Class", 100.5, True), (2, day("2024-03-02"), "Rome", "Oslo", "First Class", 50.0, True),
    ]
    assert rows(flights.price_statistics(cleaned)) == [("First Class", True, 1, 50.0, 75.25, 75.25, 100.5)]
    targets = flights.clean_targets([spark.createDataFrame([(1, "FC", 90), (2, "FC", 90)], "Month int, Class string, Target long")], 2024)
    assert rows(flights.sales_against_target(cleaned, targets)) == [("First Class", "2024-01", 90, 100.5, 10.5)]


def test_seats_and_tickets(spark):
    plan = spark.createDataFrame([(1, 1, "E"), (2, 1, "E"), (3, 1, "E")], "Seat int, Row int, Class string")
    booked = [spark.createDataFrame([(9, 1, 1, "E")], "CustomerID int, Seat int, Row int, Class string"), spark.createDataFrame([(8, 2, 1, "F")], "CustomerID int, Seat int, Row int, Class string")]
    assert rows(flights.unbooked_seats(booked, plan)) == [(2, 1, "E"), (3, 1, "E")]
    all_flights = spark.createDataFrame([(day("2024-01-01"), "P1"), (day("2024-01-02"), "P2")], "flies_on date, flight_number string")
    customers = spark.createDataFrame([(1, day("2023-01-01")), (2, None)], "customer_id int, last_flew_on date")
    sales = spark.createDataFrame([(day("2024-01-01"), "P1", 1, 9.5)], "flies_on date, flight_number string, customer_id int, ticket_price double")
    report = flights.ticket_report(all_flights, customers, sales, day("2024-01-31"))
    assert rows(report["ticket_sale_detail"], "customer_id", "last_flew_on") == [(1, day("2023-01-01"))]
    assert rows(report["unbooked_flights"], "flight_number", "reported_on") == [("P2", day("2024-01-31"))]
    assert rows(report["unbooked_customers"], "customer_id") == [(2,)]
    assert ("unbooked_customers", 1, '{"customer_id":2}') in rows(flights.ticket_document(report))


def test_grades_are_counted_in_many_tasks(spark):
    ids = [F.col("id").alias("student_id"), F.lit("a").alias("first_name"), F.lit("b").alias("last_name"), F.lit("M").alias("Gender"), F.lit("2010-03-05").alias("D.O.B")]
    raw = spark.range(0, 100, 1, 1).select(*ids, (F.col("id") * 1.0).alias("2021-maths"), F.lit(50.0).alias("2022-maths"))
    found = school.cause_for_concern(raw)
    plan = found._jdf.queryExecution().executedPlan().toString()
    # The scan's one task must not count all grades: each partial count lies above a shuffle of the students.
    assert plan.count("REPARTITION_BY_NUM") >= plan.count("Expand") > 0
    assert found.count() == 49


def test_plain_details_are_those_of_the_pattern(spark):
    from itertools import product

    # Every text of few marks and letters, and some longer ones: where the quick way answers, the pattern gives the same.
    texts = ["".join(t) for n in (1, 2, 3) for t in product(["//", "-", "a", "/", "\n", " "], repeat=n)]
    texts = [f"{a}//{b}//{c}//d//{e}" for a, b, c, e in product(["x", "", "x/y", "x-", "\r", "\u0085"], ["7", "-", "/"], [*texts, "p-q-r", "p-q-", "-q", "p--q"], ["9.5", ""])]
    texts += ["1//2//p-q//r//3//4", "1//2//p-q//r", "a\x01//2//p-q//r//3", "none"]
    frame = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    quick, slow = flights.plain_details(F.col("t")), [F.regexp_extract("t", flights.DETAIL_PATTERN, i) for i in range(1, 7)]
    found = frame.select("t", quick.alias("q"), F.when(F.rlike("t", F.lit(flights.DETAIL_PATTERN)), F.array(*slow)).alias("s"))
    assert found.where("q IS NOT NULL AND NOT q <=> s").count() == 0
    assert found.where("q IS NOT NULL").count() > 20 < found.where("q IS NULL AND s IS NOT NULL").count()
    plain = spark.createDataFrame([("2024-01-02//PA1//X-Y-Z//Economy//9.5",)], "t string").select(flights.plain_details(F.col("t")).alias("q"))
    assert rows(plain) == [(["2024-01-02", "PA1", "X-Y", "Z", "Economy", "9.5"],)]
