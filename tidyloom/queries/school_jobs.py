"""School, word and creature jobs on inputs that are derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidyloom.functions import predicates
from tidyloom.operators import groups
from tidyloom.plans import games, school
from tidyloom.queries.registry import query, table

# Born between 2010-09-01 and some five years later, by customer number.
_BORN_SQL = "DATE '2010-09-01' + CAST(c_custkey % 1800 AS INTEGER)"


def _born():
    return F.date_add(F.lit("2010-09-01").cast("date"), (F.col("c_custkey") % 1800).cast("int"))


def _pupils_raw(spark, folder):
    nation = F.col("c_nationkey").cast("string")
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("pupil first name"),
        F.concat(F.lit("Nation"), nation).alias("pupil last name"),
        F.when(F.col("c_acctbal") < 0, "M").otherwise("F").alias("gender"),
        F.date_format(_born(), "M/d/yyyy").alias("Date of Birth"),
        F.concat(F.lit("Firm"), nation).alias("Preferred Contact Employer"),
        (F.col("c_nationkey") % 3).cast("long").alias("Parental Contact"),
        F.concat(F.lit("Ann"), nation).alias("Parental Contact Name_1"),
        F.concat(F.lit("Bob"), nation).alias("Parental Contact Name_2"),
    )


@query(f"""
    WITH p AS (SELECT *, {_BORN_SQL} AS born, CASE c_nationkey % 3 WHEN 1 THEN 'Ann' WHEN 2 THEN 'Bob' END || c_nationkey AS parent, 'Nation' || c_nationkey AS last FROM customer)
    SELECT CASE WHEN born >= DATE '2014-09-01' THEN 1 WHEN born >= DATE '2013-09-01' THEN 2 WHEN born >= DATE '2012-09-01' THEN 3
                WHEN born >= DATE '2011-09-01' THEN 4 END AS academic_year,
           c_mktsegment || ' ' || last AS pupil_full_name, parent || ' ' || last AS parental_contact_full_name,
           lower(parent || '.' || last || '@Firm' || c_nationkey || '.com') AS parental_contact_email
    FROM p WHERE c_nationkey % 3 <> 0
""")
def q_preferred_contacts(spark, folder):
    return school.preferred_contacts(_pupils_raw(spark, folder))


@query(f"""
    WITH p AS (SELECT {_BORN_SQL} AS born FROM customer),
    b AS (SELECT born, CASE WHEN month(born) = 2 AND day(born) = 29 THEN NULL
          ELSE make_date(2022, CAST(month(born) AS INTEGER), CAST(day(born) AS INTEGER)) END AS birthday FROM p)
    SELECT monthname(born) AS birthday_month, dayname(birthday) AS birthday_weekday, COUNT(*) AS count FROM b GROUP BY ALL
""")
def q_birthday_counts(spark, folder):
    return school.birthday_counts(school.clean_pupils(_pupils_raw(spark, folder)), 2022)


@query("""
    WITH s AS (SELECT c_custkey AS pupil_id, c_acctbal, CASE WHEN c_acctbal < 0 THEN 'M' ELSE 'F' END AS gender, c_acctbal / 100 AS maths, c_nationkey * 4.0::DOUBLE AS english FROM customer)
    SELECT pupil_id, gender, CAST((maths >= 75) AS BIGINT) + CAST((english >= 75) AS BIGINT) AS num_subjects_passed, (maths + english) / 2 AS mean_score FROM s
""")
def q_performance_summary(spark, folder):
    scores = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("Student ID"), (F.col("c_acctbal") / 100).alias("Maths"), (F.col("c_nationkey") * 4.0).alias("English")
    )
    return school.performance_summary(school.clean_pupils(_pupils_raw(spark, folder)), school.scores_long(scores))


@query("""
    WITH modes(written, mode_of_transport, is_sustainable) AS (VALUES ('Carr', 'Car', FALSE), ('Walkk', 'Walk', TRUE), ('Helicopeter', 'Helicopter', FALSE), ('Scoter', 'Scooter', TRUE), ('Van', 'Van', FALSE)),
    long AS (SELECT 'Monday' AS weekday, CASE o_orderstatus WHEN 'F' THEN 'Carr' WHEN 'O' THEN 'Walkk' ELSE 'Helicopeter' END AS written FROM orders
             UNION ALL SELECT 'Tuesday', CASE WHEN o_totalprice < 100000 THEN 'Scoter' WHEN o_totalprice < 450000 THEN 'Van' ELSE 'Sleigh' END FROM orders
             UNION ALL SELECT 'Friday', 'Walkk' FROM orders),
    n AS (SELECT mode_of_transport, weekday, is_sustainable, COUNT(*) AS num_trips FROM long LEFT JOIN modes USING (written) GROUP BY ALL),
    t AS (SELECT *, CAST(SUM(num_trips) OVER (PARTITION BY weekday) AS BIGINT) AS total_trips FROM n)
    SELECT *, 100 * ROUND(num_trips / total_trips, 3) AS pct_trips FROM t
""")
def q_travel_summary(spark, folder):
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    plans = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("Student ID"),
        predicates.first_match([(status == "F", "Carr"), (status == "O", "Walkk")], "Helicopeter").alias("M"),
        predicates.below(price, [(100_000, "Scoter"), (450_000, "Van")], "Sleigh").alias("Tu"),
        F.lit("Walkk").alias("F"),
    )
    return school.travel_summary(plans)


@query("""
    WITH e AS (SELECT event_id, dayname(ts) AS weekday_name, strftime(ts, '%H') || ':00:00' AS starts_at, 'T' || user_id AS teacher_name,
                      CAST(weekofyear(ts) AS INTEGER) AS week_num, CAST(floor(value) AS BIGINT) AS num_attended FROM events)
    SELECT weekday_name, week_num, teacher_name, num_attended, starts_at, 'Lesson ' || weekday_name AS lesson_name, 'Subject ' || starts_at AS subject_name,
           CAST(SUM(num_attended) OVER w AS BIGINT) / COUNT(*) OVER w AS mean_num_attended
    FROM e WINDOW w AS (PARTITION BY weekday_name, starts_at)
""")
def q_lesson_attendance(spark, folder):
    events = table(spark, folder, "events").select(
        "event_id",
        F.date_format("ts", "EEEE").alias("Weekday"),
        F.weekofyear("ts").alias("Week"),
        F.concat(F.lit("T"), F.col("user_id").cast("string")).alias("Teacher"),
        F.concat(F.date_format("ts", "H"), F.lit(":00")).alias("Lesson Time"),
        F.concat(F.date_format("ts", "HH"), F.lit(":00:00")).alias("_slot"),
        F.floor("value").alias("Attendance"),
    )
    # The name stands on the first row of a slot, the subject on the last one.
    marked = groups.with_group_stats(events, ["Weekday", "Lesson Time"], {"_first": F.min("event_id"), "_last": F.max("event_id")})
    gaps = marked.withColumns(
        {
            "Lesson Name": F.when(F.col("event_id") == F.col("_first"), F.concat(F.lit("Lesson "), "Weekday")),
            "Subject": F.when(F.col("event_id") == F.col("_last"), F.concat(F.lit("Subject "), "_slot")),
        }
    ).drop("event_id", "_first", "_last", "_slot")
    return school.lesson_attendance(gaps)


# Points and number of the letter tiles.
TILE_LINES = [
    "0 points: Blank ×2",
    "1 point: E ×12, A ×9, I ×9, O ×8, N ×6, R ×6, T ×6, L ×4, S ×4, U ×4",
    "2 points: D ×4, G ×3",
    "3 points: B ×2, C ×2, M ×2, P ×2",
    "4 points: F ×2, H ×2, V ×2, W ×2, Y ×2",
    "5 points: K ×1",
    "8 points: J ×1, X ×1",
    "10 points: Q ×1, Z ×1",
]
_TILES_SQL = """
    lines(line) AS (VALUES {}),
    items AS (SELECT CAST(regexp_extract(line, '^(\\d+)', 1) AS BIGINT) AS points, unnest(regexp_extract_all(replace(line, '×', ''), '(\\w+)\\s(\\d+)')) AS tile FROM lines),
    tiles AS (SELECT points, NULLIF(regexp_extract(replace(tile, 'Blank', '_'), '([A-Z])', 1), '') AS letter, CAST(regexp_extract(tile, '(\\d+)', 1) AS BIGINT) AS frequency FROM items)
""".format(", ".join(f"('{line}')" for line in TILE_LINES))


@query(f"""
    WITH {_TILES_SQL},
    words AS (SELECT upper(replace(p_name, ' ', '')) AS word FROM part),
    letters AS (SELECT word, letter, COUNT(*) AS n FROM (SELECT word, unnest(string_split(word, '')) AS letter FROM (SELECT DISTINCT word FROM words)) WHERE letter <> '' GROUP BY ALL),
    scored AS (SELECT word, product(CASE WHEN n <= frequency THEN pow(frequency / (SELECT SUM(frequency) FROM tiles), n) ELSE 0 END) AS probability,
                      CAST(SUM(n * points) AS BIGINT) AS total_points FROM letters JOIN tiles USING (letter) GROUP BY 1)
    SELECT word, total_points, ROUND(LN(probability), 9) AS log_probability, RANK() OVER (ORDER BY ROUND(LN(probability), 9) DESC) AS probability_rank,
           RANK() OVER (ORDER BY total_points DESC) AS total_points_rank
    FROM words JOIN scored USING (word) WHERE probability > 0
""")
def q_word_analysis(spark, folder):
    words = table(spark, folder, "part").select(F.replace("p_name", F.lit(" "), F.lit("")).alias("word"))
    tiles = games.clean_tiles(spark.createDataFrame([(line,) for line in TILE_LINES], "Scrabble string"))
    analysed = games.word_analysis(words, tiles)
    return analysed.withColumn("log_probability", F.round(F.log("probability"), 9)).drop("probability")


@query("""
    WITH s AS (SELECT p_partkey, 'P' || p_partkey AS name, 6 * p_size + p_partkey % 7 AS power, p_size FROM part),
    e AS (SELECT p_partkey, 'P' || p_partkey AS stage_1, 'P' || (p_partkey + 1) AS stage_2, CASE WHEN p_size > 25 THEN 'P' || (p_partkey + 2) END AS stage_3 FROM part)
    SELECT stage_1, stage_2, stage_3, a.p_partkey AS pokedex_number, a.p_size AS gen_introduced, a.power AS initial_combat_power, b.power AS final_combat_power,
           b.power / a.power AS prop_change_combat_power
    FROM e JOIN s a ON a.name = stage_1 JOIN s b ON b.name = COALESCE(stage_3, stage_2)
""")
def q_evolution_gains(spark, folder):
    part = table(spark, folder, "part")
    named = lambda step: F.concat(F.lit("P"), (F.col("p_partkey") + step).cast("string"))
    parts = games.POWER_PARTS
    stats = part.select(
        named(0).alias("name"), F.col("p_partkey").alias("pokedex_number"), F.col("p_size").alias("gen_introduced"),
        (F.col("p_size") + F.col("p_partkey") % 7).alias(parts[0]), *[F.col("p_size").alias(p) for p in parts[1:]],
    )
    evolutions = part.select(named(0).alias("Stage_1"), named(1).alias("Stage_2"), F.when(F.col("p_size") > 25, named(2)).alias("Stage_3"))
    return games.evolution_gains(stats, evolutions)


@query("""
    WITH g AS (SELECT c_custkey AS student_id, c_name AS first_name, c_mktsegment AS last_name, CASE WHEN c_acctbal < 0 THEN 'male' ELSE 'female' END AS gender,
                      DATE '2010-03-05' AS born_on, list_aggregate([c_acctbal, c_nationkey * 100.0::DOUBLE, 500.0::DOUBLE], 'median') AS a,
                      list_aggregate([c_nationkey * 200.0::DOUBLE, 2500.0::DOUBLE], 'median') AS b FROM customer)
    SELECT student_id, first_name, last_name, gender, born_on, a AS "2021", b AS "2022" FROM g WHERE a > b
""")
def q_cause_for_concern(spark, folder):
    wide = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("student_id"), F.col("c_name").alias("first_name"), F.col("c_mktsegment").alias("last_name"),
        F.when(F.col("c_acctbal") < 0, "M").otherwise("F").alias("Gender"), F.lit("2010-03-05").alias("D.O.B"),
        F.col("c_acctbal").alias("2021-maths"), (F.col("c_nationkey") * 100.0).alias("2021-art"), F.lit(500.0).alias("2021-sport"),
        (F.col("c_nationkey") * 200.0).alias("2022-maths"), F.lit(2500.0).alias("2022-art"),
    )
    return school.cause_for_concern(wide)


@query("""
    SELECT c_custkey AS student_id, 'c' || c_custkey AS last_name, c_mktsegment AS first_name, c_nationkey / 25.0::DOUBLE AS prop_attendance,
           CASE WHEN c_nationkey / 25.0::DOUBLE < 0.7 THEN 'Low' WHEN c_nationkey / 25.0::DOUBLE > 0.9 THEN 'High' ELSE 'Medium' END AS attendance_category,
           CASE o_orderstatus WHEN 'F' THEN 'Mathematics' WHEN 'O' THEN 'English' ELSE 'Science' END AS subject, o_totalprice / 5000 AS test_score,
           CAST(ROUND(o_totalprice / 5000) AS TINYINT) AS approximate_test_score
    FROM orders JOIN customer ON o_custkey = c_custkey
""")
def q_attendance_scores(spark, folder):
    customer = table(spark, folder, "customer").withColumn("student_name", F.concat("c_mktsegment", F.lit("_c"), F.col("c_custkey").cast("string")))
    status = F.col("o_orderstatus")
    subject = predicates.first_match([(status == "F", "Math"), (status == "O", "Engish")], "Sciece")
    scores = table(spark, folder, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_custkey").alias("student_id"), "student_name", subject.alias("subject"), (F.col("o_totalprice") / 5000).alias("test_score")
    )
    attendance = customer.select("student_name", (F.col("c_nationkey") / 25.0).alias("attendance_percentage"))
    return school.attendance_and_scores(attendance, scores)


def _classes(spark, folder):
    """Students under padded headers, and a wide table of results in whole cents."""
    customer = table(spark, folder, "customer")
    students = customer.select(
        F.col("c_custkey").alias(" Student ID "),
        F.concat(F.lit(" "), "c_name").alias(" Full name         "),
        F.when(F.col("c_acctbal") < 0, "M ").otherwise("F ").alias(" Gender "),
        F.concat(F.lit("9"), F.substring("c_mktsegment", 1, 1), F.lit("  ")).alias(" Class "),
    )
    cents = F.round(F.col("c_acctbal") * 100).cast("long")
    results = customer.select(
        F.col("c_custkey").alias("Student ID"), cents.alias("English"), (cents * 7 % 10007).alias("Economics"), (cents * 11 % 20011).alias("Psychology")
    )
    return school.clean_students(students), school.results_long(results)


_RESULTS_SQL = """
    c AS (SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN 'M' ELSE 'F' END AS gender, '9' || substr(c_mktsegment, 1, 1) AS class, CAST(ROUND(c_acctbal * 100) AS BIGINT) AS cents FROM customer),
    r AS (SELECT c_custkey AS student_id, 'English' AS subject, cents AS result FROM c UNION ALL SELECT c_custkey, 'Economics', cents * 7 % 10007 FROM c
          UNION ALL SELECT c_custkey, 'Psychology', cents * 11 % 20011 FROM c)
"""


@query(f"""
    WITH {_RESULTS_SQL}, m AS (SELECT class, subject, SUM(result) / COUNT(*) AS mean_result FROM r JOIN c ON student_id = c_custkey GROUP BY ALL)
    SELECT * FROM m QUALIFY COUNT(*) OVER (PARTITION BY subject ORDER BY mean_result RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) = 1
""")
def q_lowest_class(spark, folder):
    return school.lowest_class_by_subject(*_classes(spark, folder))


@query(f"""
    WITH {_RESULTS_SQL}, q AS (SELECT subject, quantile_cont(result, [0.25, 0.75]) AS b FROM r GROUP BY 1),
    g AS (SELECT student_id, subject, CASE WHEN result <= b[1] THEN 'lower' WHEN result <= b[2] THEN 'mid' ELSE 'upper' END AS category FROM r JOIN q USING (subject))
    SELECT student_id, c_name AS full_name, gender, class, MAX(category) FILTER (WHERE subject = 'English') AS english_subject_rank,
           MAX(category) FILTER (WHERE subject = 'Economics') AS economics_subject_rank, MAX(category) FILTER (WHERE subject = 'Psychology') AS psychology_subject_rank
    FROM g JOIN c ON student_id = c_custkey WHERE class IN ('9A', '9B') GROUP BY ALL HAVING COUNT(*) FILTER (WHERE category = 'lower') >= 2
""")
def q_low_performers(spark, folder):
    return school.low_performers(*_classes(spark, folder), ["English", "Economics", "Psychology"])


_SCORES_SQL = """
    sc(alpha, num, score) AS (VALUES ('A', 1, 50), ('B', 2, 40), ('C', 3, 30), ('D', 4, 20), ('E', 5, 10), ('F', 6, 0)),
    st AS (SELECT c_custkey AS student_id, CASE WHEN c_nationkey < 15 THEN 'EAST' ELSE 'WEST' END AS school_region, upper('Kim ' || c_mktsegment) AS full_name,
                  DATE '2008-01-01' + CAST(c_custkey % 700 AS INTEGER) AS born_on, CASE WHEN c_nationkey % 2 = 0 THEN 'St. Mary''s' ELSE 'Villiers Hill' END || ' ' || c_nationkey AS school_name,
                  c_custkey % 6 + 1 AS e, c_custkey // 6 % 6 + 1 AS s, c_nationkey % 6 + 1 AS m, c_acctbal, c_mktsegment FROM customer),
    ad AS (SELECT st.*, a.score + b.score + c.score AS total, a.alpha AS english, b.alpha AS science, c.alpha AS maths
           FROM st JOIN sc a ON a.num = e JOIN sc b ON b.num = s JOIN sc c ON c.num = m)
"""


def _admissions(spark, folder):
    customer = table(spark, folder, "customer")
    east = F.col("c_nationkey") < 15
    grades = {"English": F.col("c_custkey") % 6, "Science": F.floor(F.col("c_custkey") / 6) % 6, "Maths": F.col("c_nationkey") % 6}
    born = F.date_add(F.lit("2008-01-01").cast("date"), (F.col("c_custkey") % 700).cast("int"))
    code = F.col("c_custkey").cast("string")
    listed = customer.withColumn(
        "_cells", F.explode(F.array(*[F.struct(F.lit(s).alias("subject"), g.cast("int").alias("grade")) for s, g in grades.items()]))
    )

    def region(rows, name, layout, grade):
        return rows.select(
            F.concat(code, F.lit("-"), F.col("_cells.subject")).alias("Unique Row ID"), F.concat(F.lit(name), code).alias("Student ID"),
            F.col("c_mktsegment").alias("Last Name"), F.lit("Kim").alias("First Name"), F.date_format(born, layout).alias("Date of Birth"),
            F.col("_cells.subject").alias("Subject"), grade.alias("Grade"),
        )

    letter = F.substring(F.lit("ABCDEF"), F.col("_cells.grade") + 1, F.lit(1))
    schools = customer.select(
        F.col("c_custkey").alias("Student ID"),
        F.concat(F.when(F.col("c_nationkey") % 2 == 0, "St Marys").otherwise("Viliers Hill"), F.lit(" "), F.col("c_nationkey").cast("string")).alias("School Name"),
    )
    return school.admissions(
        region(listed.where(east), "EAST", "EEEE, d MMMM, yyyy", letter),
        region(listed.where(~east), "WEST", "dd/MM/yyyy", F.col("_cells.grade") + 1),
        schools,
    )


@query(f"""
    WITH {_SCORES_SQL} SELECT student_id, full_name, born_on, school_region, school_name, CAST(total AS BIGINT) AS total_grade_score, english, science, maths FROM ad
""")
def q_admissions(spark, folder):
    return _admissions(spark, folder)


@query(f"""
    WITH {_SCORES_SQL},
    r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY school_region, c_mktsegment ORDER BY total DESC, c_acctbal, student_id) AS position FROM ad),
    k AS (SELECT * FROM r WHERE position <= CASE WHEN school_region = 'EAST' THEN 15 ELSE 5 END),
    w AS (SELECT *, COUNT(*) OVER (PARTITION BY school_name) / CASE WHEN school_region = 'EAST' THEN 75 ELSE 25 END AS share FROM k)
    SELECT student_id, full_name, born_on, school_region, school_name,
           CASE WHEN share = MAX(share) OVER (PARTITION BY school_region) THEN 'high' WHEN share = MIN(share) OVER (PARTITION BY school_region) THEN 'low' ELSE 'middle' END AS school_performance,
           c_mktsegment AS selected_subject, english, science, maths, CAST(total AS BIGINT) AS total_grade_score
    FROM w
""")
def q_selected_applicants(spark, folder):
    performance = _admissions(spark, folder)
    customer = table(spark, folder, "customer").select(F.col("c_custkey").alias("student_id"), "c_acctbal", "c_mktsegment")
    # Details carry no student number, only what the natural key is made of; the
    # birth date is shifted by the number so that the key is unique.
    keyed = performance.withColumn("born_on", F.date_add("born_on", F.col("student_id").cast("int")))
    details = keyed.join(customer, "student_id").select(
        F.col("born_on").alias("Date of Birth"), F.col("school_name").alias("School Name"),
        F.concat(F.lit("K"), F.substring("c_mktsegment", 1, 1)).alias("Initials"), F.lit("here").alias("Home Address"),
        F.col("english").alias("English"), F.col("science").alias("Science"), F.col("maths").alias("Maths"),
        F.col("c_acctbal").alias("Distance From School (Miles)"), F.col("c_mktsegment").alias("Subject Selection"),
    )
    selected = school.selected_applicants(keyed, school.clean_applicant_details(details))
    return selected.withColumn("born_on", F.date_sub("born_on", F.col("student_id").cast("int")))


@query("""
    WITH v AS (SELECT o_orderpriority AS school_name, CAST(date_trunc('month', o_orderdate) AS DATE) AS date, CASE WHEN o_orderstatus = 'O' AND o_custkey % 2 = 1 THEN 'M' ELSE o_orderstatus END AS s, CAST(SUM(ROUND(o_totalprice * 100)) AS BIGINT) AS value FROM orders GROUP BY ALL),
    w AS (SELECT school_name, date, CAST(SUM(value) AS BIGINT) AS total_monthly_cost, MAX(value) FILTER (WHERE s = 'F') AS electricity_cost,
                 MAX(value) FILTER (WHERE s = 'O') AS water_cost, MAX(value) FILTER (WHERE s = 'P') AS gas_cost, MAX(value) FILTER (WHERE s = 'M') AS maintenance_cost FROM v GROUP BY ALL)
    SELECT ROW_NUMBER() OVER (ORDER BY school_name, date) AS sort_order, * FROM w
""")
def q_school_costs(spark, folder):
    names = predicates.replace_values("o_orderstatus", {"F": "Electricity Cost", "O": "Water Cost", "P": "Gas Cost"})
    names = F.when((F.col("o_orderstatus") == "O") & (F.col("o_custkey") % 2 == 1), "Maintenance Cost").otherwise(names)
    sheet = table(spark, folder, "orders").groupBy(
        F.col("o_orderpriority").alias("School Name"), F.year("o_orderdate").alias("Year"), F.date_format("o_orderdate", "MMMM").alias("Month"), names.alias("Name")
    ).agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("Value"))
    return school.school_costs([sheet])


@query("""
    WITH b(gender, age, track_event, benchmark_time) AS (VALUES ('A', 5, '100m', 24.0::DOUBLE), ('R', 6, '200m', 31.0::DOUBLE), ('N', 7, '100m', 12.0::DOUBLE), ('N', 8, '200m', 40.0::DOUBLE))
    SELECT l_orderkey AS id, track_event, l_quantity AS time, gender, age, benchmark_time, RANK() OVER (PARTITION BY gender, age, track_event ORDER BY l_quantity) AS student_rank
    FROM lineitem JOIN b ON l_returnflag = gender AND CAST(l_linenumber AS INTEGER) + 1 = age AND CASE l_linestatus WHEN 'F' THEN '100m' ELSE '200m' END = track_event
    WHERE l_quantity <= benchmark_time AND NOT (track_event = '200m' AND l_quantity < 25)
""")
def q_track_team(spark, folder):
    lines = table(spark, folder, "lineitem")
    row = F.concat_ws("|", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    keyed = lines.select(
        row.alias("id"), "l_orderkey", F.col("l_returnflag").alias("gender"), (F.col("l_linenumber") + 1).alias("age"),
        F.when(F.col("l_linestatus") == "F", "100m").otherwise("200m").alias("track_event"), F.col("l_quantity").alias("time"),
    )
    benchmarks = spark.createDataFrame(
        [("A", 5, "100m", 24.0), ("R", 6, "200m", 31.0), ("N", 7, "100m", 12.0), ("N", 8, "200m", 40.0)],
        "`Gender ` string, `Age ` int, `Event ` string, Benchmark double",
    )
    students = keyed.select("id", "l_orderkey", "gender", "age")
    team = school.track_team(students, keyed.select("id", "track_event", "time"), benchmarks)
    return team.drop("id").withColumnRenamed("l_orderkey", "id")
