"""Operators on small frames against plain Python, with and without splitting groups."""

import datetime
import random
import statistics

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidyloom.operators import groups, joins, ordered, ranks, reshape, scaffold
from tidyloom.operators.ranges import Ranges, down
from tidyloom.settings import BORDERS_PER_PARTITION


@pytest.fixture(params=["0", "16", "200"])
def either(request, spark):
    """One border in all, a few, or more than there are rows."""
    spark.conf.set(BORDERS_PER_PARTITION, request.param)
    yield request.param
    spark.conf.unset(BORDERS_PER_PARTITION)


@pytest.fixture(scope="module")
def data():
    """One hot key, a null key, small keys; ties and nulls among the values."""
    draw = random.Random(7)
    keys = ["hot"] * 40 + [None] * 7 + ["a"] * 5 + ["b"] * 2 + ["c"]
    return [(i, key, draw.choice([None, 1, 2, 2, 3, 5, 8])) for i, key in enumerate(keys)]


@pytest.fixture
def frame(spark, data):
    return spark.createDataFrame(data, "id long, k string, x long").repartition(5)


def by_key(data):
    found = {}
    for row in data:
        found.setdefault(row[1], []).append(row)
    return found


def test_ordered_columns(frame, data, either):
    found = ordered.ordered_columns(
        frame, ["k"], [down("id")], running_sum={"s": F.col("x")}, row_number="n", previous={"p": F.col("x")}, last_seen={"l": F.col("x")}
    )
    expected = []
    for key, members in by_key(data).items():
        total = last = before = None
        for n, (i, _, x) in enumerate(sorted(members, reverse=True), start=1):
            total = total if x is None else (total or 0) + x
            last = last if x is None else x
            expected.append((i, key, x, total, n, before, last))
            before = x
    assert rows(found, "id", "k", "x", "s", "n", "p", "l") == sorted(expected, key=lambda row: [(v is not None, str(v)) for v in row])


def test_whole_table_index_and_sum(frame, data, either):
    found = ordered.ordered_columns(frame, [], [F.col("id")], running_sum={"s": F.col("id")}, row_number="n")
    assert sorted((r.id, r.n, r.s) for r in found.collect()) == [(i, i + 1, i * (i + 1) // 2) for i in range(len(data))]
    assert sorted(r.n for r in ordered.row_index(frame, [F.col("id")], "n", start=10).collect()) == list(range(10, 10 + len(data)))


@pytest.mark.parametrize("ties", ["min", "max"])
@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("keys", [["k"], []])
def test_ranks(frame, data, either, ties, descending, keys):
    found = {r.id: r.rank for r in ranks.ranked(frame, keys, "x", ties=ties, descending=descending).collect()}
    members = by_key(data).values() if keys else [data]
    for group in members:
        values = [x for _, _, x in group if x is not None]
        for i, _, x in group:
            if x is None:
                assert found[i] is None
                continue
            better = sum(v > x for v in values) if descending else sum(v < x for v in values)
            assert found[i] == better + (1 if ties == "min" else values.count(x))


def test_rank_rejects_unknown_ties(frame):
    with pytest.raises(ValueError):
        ranks.ranked(frame, ["k"], "x", ties="dense")


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("descending", [False, True])
def test_best_of_group_keeps_ties(frame, data, either, keys, descending):
    found = {r.id: r.rank for r in ranks.best_of_group(frame, keys, "x", 2, descending=descending).collect()}
    expected = {}
    for group in by_key(data).values() if keys else [data]:
        values = [x for _, _, x in group if x is not None]
        for i, _, x in group:
            better = 0 if x is None else sum(v > x if descending else v < x for v in values)
            if x is not None and better < 2:
                expected[i] = better + 1
    assert found == expected


@pytest.mark.parametrize("keys", [["k"], []])
def test_quantiles(frame, data, either, keys):
    found = ranks.group_quantiles(frame, keys, "x", [0.0, 0.25, 0.5, 1.0]).collect()
    found = {(r.k if keys else "all"): r.quantiles for r in found}
    for key, group in (by_key(data) if keys else {"all": data}).items():
        values = sorted(x for _, _, x in group if x is not None)
        if not values:
            assert key not in found
            continue
        quarter = 0.25 * (len(values) - 1)
        low = values[int(quarter)]
        at_quarter = low + (values[min(int(quarter) + 1, len(values) - 1)] - low) * (quarter - int(quarter))
        assert found[key] == pytest.approx([values[0], at_quarter, statistics.median(values), values[-1]])


def test_bins(spark, either):
    frame = spark.createDataFrame([("a", float(x)) for x in range(1, 9)] + [("a", None), ("b", 5.0)], "k string, x double")
    found = ranks.quantile_bins(frame, ["k"], "x", [0.25, 0.75], ["lower", "mid", "upper"], "bin")
    assert rows(found, "k", "x", "bin") == [
        ("a", None, None), ("a", 1.0, "lower"), ("a", 2.0, "lower"), ("a", 3.0, "mid"), ("a", 4.0, "mid"), ("a", 5.0, "mid"), ("a", 6.0, "mid"),
        ("a", 7.0, "upper"), ("a", 8.0, "upper"), ("b", 5.0, "lower"),
    ]
    with pytest.raises(ValueError):
        ranks.quantile_bins(frame, ["k"], "x", 3, ["one", "two"], "bin")


def test_group_stats_match_null_keys(frame, data, either):
    found = {r.id: (r.n, r.total) for r in groups.with_group_stats(frame, ["k"], {"n": F.count(F.lit(1)), "total": F.sum("x")}).collect()}
    for group in by_key(data).values():
        values = [x for _, _, x in group if x is not None]
        assert all(found[i] == (len(group), sum(values) if values else None) for i, _, _ in group)


def test_whole_table_stats(frame, data, either):
    found = groups.with_group_stats(frame, [], {"n": F.count(F.lit(1))}).select("n").distinct().collect()
    assert [r.n for r in found] == [len(data)]


def test_rolling_mean_and_changes(spark, either):
    frame = spark.createDataFrame([(i, 10.0 * (i % 4)) for i in range(8)], "i int, x double")
    order = [F.col("i")]
    rolled = {r.i: r.m for r in ordered.rolling_mean(frame, [], order, F.col("x"), "m", 3).collect()}
    assert rolled[0] is None and rolled[1] is None and rolled[2] == 10.0 and rolled[5] == pytest.approx(40 / 3)
    change = {r.i: r.c for r in ordered.percent_change(frame, [], order, F.col("x"), "c").collect()}
    assert change[0] is None and change[1] is None and change[2] == 100.0 and change[4] == -100.0
    difference = {r.i: r.d for r in ordered.difference_to_previous(frame, [], order, F.col("x"), "d").collect()}
    assert difference[0] is None and difference[4] == -30.0


def test_empty_input(spark, either):
    empty = spark.createDataFrame([], "k string, x long")
    assert ordered.running_sum(empty, ["k"], [F.col("x")], F.col("x"), "s").collect() == []
    assert ranks.ranked(empty, ["k"], "x").collect() == []
    assert ranks.group_quantiles(empty, ["k"], "x", [0.5]).collect() == []
    assert scaffold.dense_dates(spark.createDataFrame([], "d date"), "d", "d").collect() == []


def day(text):
    return datetime.date.fromisoformat(text)


def test_next_dates(spark, either):
    days = scaffold.calendar(spark, day("2024-01-05"), day("2024-01-09"), "d")
    holidays = spark.createDataFrame([(day("2024-01-08"),)], "h date")
    work = scaffold.working_days(days, "d", holidays, "h")
    assert [r.d for r in work.orderBy("d").collect()] == [day("2024-01-05"), day("2024-01-09")]
    found = joins.next_at_or_after(days, "d", work, "d", "to")
    assert rows(found, "d", "to") == [
        (day("2024-01-05"), day("2024-01-05")), (day("2024-01-06"), day("2024-01-09")), (day("2024-01-07"), day("2024-01-09")),
        (day("2024-01-08"), day("2024-01-09")), (day("2024-01-09"), day("2024-01-09")),
    ]
    repeated = days.unionByName(days)
    assert joins.next_at_or_after(repeated, "d", work, "d", "to").count() == 10
    nothing_after = scaffold.calendar(spark, day("2024-01-10"), day("2024-01-11"), "d")
    assert joins.next_at_or_after(nothing_after, "d", work, "d", "to").count() == 0


def test_reporting_detail_leaves_out_the_last_day(spark):
    days = spark.createDataFrame([(day("2024-01-30"),), (day("2024-01-31"),), (day("2024-02-01"),)], "d date")
    assert rows(joins.reporting_detail(days, "d")) == [(day("2024-01-30"), "Jan-24", 1), (day("2024-01-31"), "Feb-24", 1)]


@pytest.mark.parametrize("size", [3, 30_500])
def test_key_grid(spark, size):
    keys = spark.createDataFrame([("a",), (None,)], "k string")
    values = spark.range(size).withColumnRenamed("id", "v")
    grid = scaffold.key_grid(keys, values)
    assert grid.columns == ["k", "v"]
    assert grid.count() == 2 * size == grid.distinct().count()
    assert scaffold.key_grid(keys, spark.range(0)).count() == 0


def test_band_join(spark):
    bands = spark.createDataFrame([("low", 0, 9), ("mid", 10, 19), ("wide", 5, 1000), ("none", 7, 3)], "name string, lo int, hi int")
    values = spark.createDataFrame([(-1,), (0,), (9,), (10,), (500,), (2000,), (None,)], "v int")
    assert rows(joins.band_join(values, bands, F.col("v"), "lo", "hi"), "v", "name") == [
        (0, "low"), (10, "mid"), (10, "wide"), (500, "wide"), (9, "low"), (9, "wide"),
    ]
    many = spark.range(3000).selectExpr("id * 10 AS lo", "id * 10 + 9 AS hi", "id AS band")
    found = joins.band_join(spark.range(0, 30000, 7), many, F.col("id"), "lo", "hi")
    assert found.count() == len(range(0, 30000, 7)) and found.where("band <> id div 10").count() == 0
    assert joins.band_join(values, bands.limit(0), F.col("v"), "lo", "hi").count() == 0


def test_fill_ids(spark):
    known = spark.createDataFrame([(1, "A"), (2, "B"), (2, "B")], "n int, g string")
    gaps = spark.createDataFrame([(1, None, "x"), (None, "B", "y"), (None, None, "z"), (9, None, "w"), (2, "B", "v")], "n int, g string, t string")
    pairs = joins.id_pairs([gaps, known], "n", "g")
    assert rows(joins.fill_ids(gaps, pairs, "n", "g"), "t", "n", "g") == [("v", 2, "B"), ("w", 9, None), ("x", 1, "A"), ("y", 2, "B"), ("z", None, None)]


def test_anti_join_keeps_null_keys(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert rows(joins.not_in(left, spark.createDataFrame([(1,), (None,)], "k int"), ["k"])) == [(None,), (2,)]


def test_role_join(spark):
    trips = spark.createDataFrame([(1, 2), (2, 1)], "a int, b int")
    places = spark.createDataFrame([(1, "one"), (2, "two")], "id int, name string")
    assert rows(joins.role_join(trips, places, "id", {"a": "from_", "b": "to_"}), "from_name", "to_name") == [("one", "two"), ("two", "one")]


def test_melt_and_spread(spark):
    wide = spark.createDataFrame([(1, 10, None), (2, None, 20)], "id int, `a.b` long, c long")
    assert rows(reshape.melt(wide, ["id"])) == [(1, "a.b", 10), (1, "c", None), (2, "a.b", None), (2, "c", 20)]
    mixed = spark.createDataFrame([(1, "x", 5)], "id int, s string, n int")
    assert rows(reshape.melt(mixed, ["id"])) == [(1, "n", "5"), (1, "s", "x")]
    long = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (2, "a", 3)], "id int, name string, v int")
    back = reshape.spread(long, ["id"], "name", "v", ["b", "a"])
    assert back.columns == ["id", "b", "a"] and rows(back) == [(1, 2, 1), (2, None, 3)]
    assert rows(reshape.spread_count(long, ["id"], "name", ["a", "b"])) == [(1, 1, 1), (2, 1, None)]


def test_split_groups(spark):
    frame = spark.createDataFrame([(1, "2024-01-02//PA1//X-Y//Economy//9.5"), (2, "no match"), (3, None)], "id int, t string")
    found = reshape.split_groups(frame, "t", r"^(.+)//(.+)//(.+)-(.+)//(.+)//(.+)$", ["a", "b", "c", "d", "e", "f"])
    assert rows(found, "id", "a", "b", "c", "d", "e", "f") == [
        (1, "2024-01-02", "PA1", "X", "Y", "Economy", "9.5"), (2,) + (None,) * 6, (3,) + (None,) * 6,
    ]
    unanchored = spark.createDataFrame([("on March 5, 2023",)], "t string")
    assert rows(reshape.split_groups(unanchored, "t", r"(\d+), (\d+)$", ["d", "y"])) == [("5", "2023")]


def test_harmonize(spark):
    one = spark.createDataFrame([("x", 1, "drop")], "`*Store` string, Sales int, other string")
    two = spark.createDataFrame([(2, "y")], "`*Sales` int, Store string")
    names = {"*Store": "store", "Store": "store", "Sales": "sales", "*Sales": "sales"}
    assert rows(reshape.harmonize([one, two], names, ["store", "sales"])) == [("x", 1), ("y", 2)]
    with pytest.raises(ValueError):
        reshape.harmonize([spark.createDataFrame([(1, 2)], "Store int, `*Store` int")], names, ["store"])


def test_renaming(spark):
    frame = spark.createDataFrame([(1, 2)], "ID int, Demagraphic int")
    assert reshape.rename_prefix(frame, "D", "Demographic").columns == ["ID", "Demographic"]
    assert reshape.rename_leading(frame, ["id"]).columns == ["id", "Demagraphic"]
    assert reshape.rename_by(frame, str.lower).columns == ["id", "demagraphic"]
    with pytest.raises(ValueError):
        reshape.rename_prefix(frame, "Z", "z")


def test_fill_blanks(spark):
    frame = spark.createDataFrame([(1, "n", None), (1, None, "s"), (2, None, "t"), (3, None, None)], "k int, name string, subject string")
    assert rows(reshape.fill_blanks(frame, ["k"], ["name", "subject"])) == [(1, "n", "s"), (1, "n", "s"), (2, None, "t")]


def test_ledger_signs(spark):
    transfers = spark.createDataFrame([(1, 10, "A", "B"), (2, 4, "B", "A")], "id int, v int, src string, dst string")
    flows = scaffold.signed_flows(transfers, "src", "dst", F.col("v"))
    assert rows(flows, "id", "account", "movement") == [(1, "A", -10), (1, "B", 10), (2, "A", 4), (2, "B", -4)]


def test_sums_of_nulls_and_shares(spark):
    frame = spark.createDataFrame([("a", None), ("b", 3), ("b", 1)], "k string, x int")
    assert rows(groups.total_by(frame, "k", value="x")) == [("a", 0), ("b", 4)]
    assert rows(groups.share_of_total(frame.dropna(), "x", "s"), "x", "s") == [(1, 0.25), (3, 0.75)]
    zero = spark.createDataFrame([("a", 0)], "k string, x int")
    assert rows(groups.share_of_group(zero, ["k"], "x", "s"), "s") == [(None,)]


def test_extremes_of_groups(spark):
    frame = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y")], "k string, t int, v string")
    assert rows(groups.latest_of_group(frame, ["k"], ["t"])) == [("a", 3, "z")]
    assert rows(groups.earliest_of_group(frame, ["k"], ["t"])) == [("a", 1, "x")]
    assert rows(ranks.first_of_group(frame, ["k"], [F.col("v").desc()])) == [("a", 3, "z")]


def test_sums_have_one_type(spark, either):
    frame = spark.range(10).selectExpr("id", "cast(id as decimal(12,2)) as d")
    found = ordered.running_sum(frame, [], [F.col("id")], F.col("d"), "s")
    assert found.schema["s"].dataType.simpleString() == "decimal(22,2)"
    assert [float(r.s) for r in found.orderBy("id").collect()] == [sum(range(i + 1)) for i in range(10)]


def test_quantiles_have_one_arithmetic(spark, either):
    frame = spark.range(101).selectExpr("0 as k", "pow(id, 1.7) / 3 as x")
    found = ranks.group_quantiles(frame, ["k"], "x", [0.1, 1 / 3, 0.77]).first().quantiles
    assert found == frame.selectExpr(f"percentile(x, array(0.1d, {1 / 3}d, 0.77d)) as q").first().q


def test_rows_made_by_explode_are_split(spark):
    exploded = spark.range(1).select(F.explode(F.sequence(F.lit(1), F.lit(5000))).alias("x"))
    assert ordered.row_index(exploded, [F.col("x")], "i").where("i <> x").count() == 0
    sizes = [r["count"] for r in Ranges(exploded, [], [F.col("x")]).place(exploded).groupBy("_range").count().collect()]
    assert len(sizes) == 33 and max(sizes) < 5000 / 4


def test_mixed_orders_with_nulls(spark, either):
    draw = random.Random(11)
    data = [(i, draw.choice([None, 1.5, float("nan"), -2.0]), draw.choice([None, "", "a", "b"]), i % 3 or None) for i in range(90)]
    frame = spark.createDataFrame(data, "id long, x double, t string, k long")
    found = ordered.ordered_columns(
        frame, ["k"], [down("x"), F.col("t"), down("id")], row_number="n", previous={"p": F.col("id"), "p4": (F.col("t"), 4)}, last_seen={"l": F.col("t")}
    )
    window = "OVER (PARTITION BY k ORDER BY x DESC, t, id DESC{})"
    frame.createOrReplaceTempView("mixed_orders")
    plain = spark.sql(
        f"""SELECT *, CAST(row_number() {window.format('')} AS BIGINT) AS n, lag(id) {window.format('')} AS p, lag(t, 4) {window.format('')} AS p4,
            last(t, true) {window.format(' ROWS UNBOUNDED PRECEDING')} AS l FROM mixed_orders"""
    )
    assert sorted(map(str, found.select(plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_no_job_before_the_action_and_the_same_doubles(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "plans alone")
    frame = spark.range(3000).selectExpr("id", "id % 7 as k", "pow(id, 1.37) / 7 as x")
    try:
        built = [
            ordered.running_sum(frame, [], [F.col("id")], F.col("x"), "s"),
            ordered.rolling_mean(frame, ["k"], [F.col("id")], F.col("x"), "m", 30),
            ranks.ranked(frame, ["k"], "x"),
            ranks.quantile_bins(frame, ["k"], "x", 4, list("abcd"), "q"),
            joins.with_next(frame, "id", "after"),
        ]
        assert not tracker.getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [f.count() for f in built] == [3000] * 5
    # However the rows lie in files or tasks, borders and sums are the same.
    sums = [sorted(map(tuple, ordered.running_sum(frame.repartition(n), [], [F.col("id")], F.col("x"), "s").select("id", "s").collect())) for n in (1, 7)]
    assert sums[0] == sums[1]


def test_rolling_mean_hands_on_the_last_rows_of_a_range(spark):
    frame = ordered.rolling_mean(spark.range(500).withColumn("x", F.col("id") * 2), [], [F.col("id")], F.col("x"), "m", 30)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    # Lists are made of the last rows of ranges alone; no window over the rows of a range collects any.
    windows = [line for line in plan.splitlines() if " Window [" in line or "+- Window [" in line]
    assert windows and not [line for line in windows if "_range" in line and "collect_list" in line]
    assert {r["id"]: r["m"] for r in frame.where("id > 497 or id = 28").collect()} == {28: None, 498: 967.0, 499: 969.0}


@pytest.mark.parametrize("ties", ["min", "max"])
def test_a_value_of_most_rows_is_spread(spark, ties):
    frame = spark.range(0, 20_000, 1, 8).selectExpr("if(id % 10 > 0, 5, if(id % 100 = 0, null, id)) as x")
    found = ranks.ranked(frame, [], "x", ties=ties)
    small = frame.where("x < 5").count()
    assert [tuple(r) for r in found.where("x = 5").select("rank").distinct().collect()] == [(small + (1 if ties == "min" else 18_000),)]
    assert found.where("x is null and rank is null").count() == 200
    assert found.agg(F.max("rank")).first()[0] == frame.where("x is not null").count()
    # Of the common value and of the nulls, each source partition makes a group of its own.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SPARK_PARTITION_ID" in plan and any("rank(" in line or "count(" in line for line in plan.splitlines() if "Window [" in line and "_spread" in line)


def test_groups_of_a_text_with_control_characters(spark):
    frame = spark.createDataFrame([("a\x01b-c",), ("none",)], "t string")
    assert rows(reshape.split_groups(frame, "t", r"^(.+)-(.+)$", ["a", "b"])) == [(None, None), ("a\x01b", "c")]


def test_open_bands_are_listed_a_few_times(spark):
    bands = spark.range(1, 3001).selectExpr("id as band", "0 as low", "id as high")
    found = joins.band_join(spark.range(0, 3001, 100), bands, F.col("id"), "low", "high").groupBy("id").count()
    assert {r["id"]: r["count"] for r in found.collect()} == {v: 3000 - max(v, 1) + 1 for v in range(0, 3001, 100)}
    nodes = bands.select(F.sum(F.size(joins._widest_pieces(F.lit(0).cast("long"), F.col("high"), 13)))).first()[0]
    assert nodes < 10 * 3000


def test_a_cell_with_several_values_is_an_error(spark):
    long = spark.createDataFrame([(1, "a", 5), (1, "a", 6), (1, "b", None), (2, "b", 7)], "id int, name string, v int")
    with pytest.raises(Exception, match="several values"):
        reshape.spread(long, ["id"], "name", "v", ["a", "b"]).collect()
    assert rows(reshape.spread(long, ["id"], "name", "v", ["a", "b"], F.sum)) == [(1, 11, None), (2, None, 7)]
    assert rows(reshape.spread(long.where("v <> 5"), ["id"], "name", "v", ["a", "b"])) == [(1, 6, None), (2, None, 7)]


def test_runs_and_their_days(spark):
    frame = spark.createDataFrame([("a", datetime.date(2024, 1, 1), 5), ("a", datetime.date(2024, 1, 3), 6), ("b", datetime.date(2024, 1, 4), None)], "k string, day date, v int")
    runs = scaffold.runs(frame, ["k"], "day", F.lit(datetime.date(2024, 1, 4)))
    assert rows(runs, "k", "day", "until", "v") == [
        ("a", datetime.date(2024, 1, 1), datetime.date(2024, 1, 2), 5), ("a", datetime.date(2024, 1, 3), datetime.date(2024, 1, 4), 6), ("b", datetime.date(2024, 1, 4), datetime.date(2024, 1, 4), None),
    ]
    days = scaffold.run_days(runs.withColumn("moved", F.col("v")), "day", only_on_first={"moved": 0})
    assert rows(days.where("k = 'a'"), "day", "v", "moved") == [(datetime.date(2024, 1, d), v, m) for d, v, m in ((1, 5, 5), (2, 5, 0), (3, 6, 6), (4, 6, 0))]


def test_key_grid_of_many_blocks(spark):
    keys, values = spark.range(7).withColumnRenamed("id", "k"), spark.range(2500).withColumnRenamed("id", "v")
    grid = scaffold.key_grid(keys, values)
    assert grid.count() == 17_500 == grid.distinct().count()
    assert scaffold.key_grid(keys, values.limit(0)).count() == 0


def test_grid_of_few_values_is_made_in_many_tasks(spark):
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        keys = spark.range(0, 2000, 1, 1).withColumnRenamed("id", "k")
        values = spark.range(5000).select((F.col("id") % 7).alias("v")).distinct()
        grid = scaffold.key_grid(keys, values)
        sizes = [row["count"] for row in grid.groupBy(F.spark_partition_id().alias("at")).count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert sum(sizes) == 14000 and len(sizes) >= 4 and max(sizes) < 7000


def test_search_of_ranges_is_generated_code(spark):
    frame = spark.range(500).select(F.sha2(F.col("id").cast("string"), 256).alias("t"), (F.col("id") % 7).alias("x"))
    indexed = ordered.row_index(frame, [F.col("t"), F.col("x")], "i")
    # A higher-order function ends the generated code, and the borders are copied into every row before it.
    assert "aggregate([" not in indexed._jdf.queryExecution().optimizedPlan().toString()
    assert [r.i for r in indexed.orderBy("t", "x").collect()] == list(range(1, 501))


def test_split_groups_runs_its_pattern_once(spark):
    frame = spark.createDataFrame([("a-b",), ("none",)], "t string")
    split = reshape.split_groups(frame, "t", r"^(.+)-(.+)$", ["a", "b"])
    assert split._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(") == 1
    assert rows(split) == [(None, None), ("a", "b")]
