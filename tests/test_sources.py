"""Readers and writers on small files."""

import datetime
import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidyloom.functions import text
from tidyloom.plans import trades
from tidyloom.settings import build_session, scratch_path
from tidyloom.sources import lookups, readers, sinks


def write(path, content, encoding="utf-8"):
    path.write_bytes(content.encode(encoding))
    return str(path)


def test_csv_options(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id;when;price\n1;2/1/2023;n/a\n2;n/a;3.5\n")
    found = readers.read_csv(spark, path, "id int, when date, price double", separator=";", null_marker="n/a", date_layout="M/d/yyyy")
    assert rows(found) == [(1, datetime.date(2023, 2, 1), None), (2, None, 3.5)]


def test_bad_row_ends_the_job(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id\nx\n")
    with pytest.raises(Exception, match="MALFORMED"):
        readers.read_csv(spark, path, "id int").collect()


def test_bytes_that_are_no_text_are_kept_as_marks(spark, tmp_path):
    path = write(tmp_path / "a.csv", "name\ncafé\n", "latin-1")
    assert rows(readers.read_csv(spark, path, "name string")) == [("caf�",)]
    assert rows(readers.read_csv(spark, path, "name string", encoding="ISO-8859-1")) == [("café",)]


HEADER = "id,first_name,last_name,Ticker,Sector,Market,Stock Name,Market Cap,Purchase Price\n"


def test_monthly_trade_files(spark, tmp_path):
    write(tmp_path / "MOCK_DATA.csv", HEADER + "1,a,b,T1,S,M,N,$1.5M,$10.5\n2,a,b,T2,S,M,N,n/a,$3\n")
    write(tmp_path / "MOCK_DATA-12.csv", HEADER + "1,a,b,T3,S,M,N,$2B,$30000\n2,a,b,T4,S,M,N,$20K,n/a\n")
    write(tmp_path / "OTHER.csv", HEADER + "9,a,b,T9,S,M,N,$1,$1\n")
    found = trades.numbered_trades(trades.clean_trades(trades.read_trades(spark, str(tmp_path / "MOCK_DATA*.csv"))))
    assert rows(found, "trade_id", "file_date", "ticker", "market_cap", "purchase_price") == [
        (1, datetime.date(2023, 1, 1), "T1", 1_500_000, 10.5), (2, datetime.date(2023, 12, 1), "T3", 2_000_000_000, 30000.0),
    ]
    best = trades.monthly_trades(found)
    assert "trade_id" not in best.columns
    assert rows(best, "market_cap_category", "purchase_price_category", "rank") == [("Large", "Medium", 1), ("Small", "Small", 1)]


def test_country_files(spark, tmp_path):
    header = "Reporter,Partner,Product categories,Indicator Type,Indicator,1990,1991\n"
    names = list(trades.INDICATORS)
    write(tmp_path / "en_GBR_x.csv", header + f" Britain,France,All,Export,{names[0]},5,\nWorld,France,All,Export,{names[0]},1,1\n")
    write(tmp_path / "en_USA_x.csv", header + f"States,Nowhere,All,Import,{names[1]},,7\nStates,World,All,Import,{names[1]},8,8\n")
    places_path = write(tmp_path / "places.txt", 'ISO3 CODE;LABEL EN;geo_point_2d\nGBR;Britain;"54.5,-2.0"\nFRA;France;"46,2"\n')
    schema = "Reporter string, Partner string, `Product categories` string, `Indicator Type` string, Indicator string, `1990` string, `1991` string"
    trade = trades.clean_partner_trade(trades.read_partner_files(spark, str(tmp_path / "*.csv"), schema))
    places = trades.clean_places(readers.read_csv(spark, places_path, "`ISO3 CODE` string, `LABEL EN` string, geo_point_2d string", separator=";"))
    found = trades.partner_trade(trade, places)
    assert rows(found, "year", "reporting_country_name", "reporting_country_code", "reporting_country_latitude", "partner_country_iso3_code", *list(trades.INDICATORS.values())[:2]) == [
        (1990, "Britain", "GBR", 54.5, "FRA", 5.0, None), (1991, "States", "USA", None, None, None, 7.0),
    ]


def test_labelled_union(spark):
    one, two = spark.createDataFrame([(1, "x")], "a int, b string"), spark.createDataFrame([("y", 2)], "b string, a int")
    assert rows(readers.labelled_union({"Jan": one, "Feb": two}, "month"), "a", "b", "month") == [(1, "x", "Jan"), (2, "y", "Feb")]
    with pytest.raises(Exception):
        readers.stack([one, two.drop("b")]).collect()
    assert rows(readers.stack([one, two.drop("b")], fill_missing=True), "a", "b") == [(1, "x"), (2, None)]


def test_lookup(spark):
    table = lookups.inline_table(spark, [("a", 1)], "k string, v int")
    frame = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    assert rows(lookups.lookup(frame, table, "k"), "k", "v") == [(None, None), ("a", 1), ("z", None)]


def test_json_files(spark, tmp_path):
    frame = spark.createDataFrame([("Mon", 1), ("Tue", 2), ("Mon", 3)], "day string, n int")
    sinks.write_json_by_key(frame, "day", str(tmp_path / "by_day"))
    assert {name for name in os.listdir(tmp_path / "by_day") if name.startswith("day=")} == {"day=Mon", "day=Tue"}
    assert rows(spark.read.json(str(tmp_path / "by_day")), "day", "n") == rows(frame)
    sinks.write_json_tables({"one": frame, "two": frame.limit(1)}, str(tmp_path / "tables"))
    assert spark.read.json(str(tmp_path / "tables" / "one")).count() == 3


def test_json_documents(spark):
    frame = spark.createDataFrame([("Mon", 1), ("Tue", 2), ("Mon", 3)], "day string, n int")
    document = sinks.json_bundle({"all": frame, "none": frame.limit(0)})
    assert rows(document) == [("all", 1, '{"day":"Mon","n":1}'), ("all", 2, '{"day":"Mon","n":3}'), ("all", 3, '{"day":"Tue","n":2}')]
    grouped = rows(sinks.json_by_key(frame, "day", ["n"]))
    assert grouped == [("Mon", 1, '{"n":1}'), ("Mon", 2, '{"n":3}'), ("Tue", 1, '{"n":2}')]


def test_json_document_of_any_size(spark, tmp_path):
    document = sinks.json_bundle({"rows": spark.range(200_000)})
    assert document.count() == 200_000
    sinks.write_json_document(document, str(tmp_path / "document"))
    lines = [json.loads(line)["id"] for file in sorted((tmp_path / "document").glob("part-*")) for line in file.read_text().splitlines()]
    assert lines == list(range(200_000))


def test_scratch_is_in_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert build_session() is not None


def test_file_code(spark):
    frame = spark.createDataFrame([("en_GBR_AllProducts.csv",)], "f string")
    assert rows(frame.select(readers.file_code(F.col("f"), 3, 3))) == [("GBR",)]
    assert rows(frame.select(text.extract("f", r"(\d+)"))) == [(None,)]


def test_inferred_types(spark, tmp_path):
    lines = ["whole,part,day,flag,text,none,mixed", "1,1,2024-01-31,true,a,,1", "-20,2.5,2023-12-01,FALSE,2,,x", ",3e2,,,,,", "9007199254740993,4,2024-02-29,true,zz,,7"]
    (tmp_path / "a.csv").write_text("\n".join(lines))
    schema = readers.inferred_schema(spark, str(tmp_path))
    assert [(f.name, f.dataType.simpleString()) for f in schema] == [
        ("whole", "bigint"), ("part", "double"), ("day", "date"), ("flag", "boolean"), ("text", "string"), ("none", "string"), ("mixed", "string"),
    ]
    found = readers.read_csv(spark, str(tmp_path)).where("whole > 20").first()
    assert (found["whole"], found["part"], found["flag"]) == (9007199254740993, 4.0, True)


def test_a_late_value_widens_or_raises(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n\n" + "\n".join(map(str, range(2000))) + "\nlate\n")
    assert readers.read_csv(spark, str(tmp_path)).schema["n"].dataType.simpleString() == "string"
    narrow = readers.inferred_schema(spark, str(tmp_path), share=0.01)
    assert narrow["n"].dataType.simpleString() == "bigint"  # the late value was not drawn
    with pytest.raises(Exception, match="late"):
        readers.read_csv(spark, str(tmp_path), narrow).collect()


def test_differently_headed_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Store,"Sales"\nx,1\n"y, z",2\n')
    (tmp_path / "b.csv").write_text("*Sales,Unknown,*Store\n3,q,w\n")
    (tmp_path / "c.csv").write_text("Store\nv\n")
    names = {"Store": "store", "*Store": "store", "Sales": "sales", "*Sales": "sales"}
    found = readers.read_headed(spark, str(tmp_path), names, ["store", "sales", "model"])
    assert rows(found, "store", "sales", "model") == [("v", None, None), ("w", "3", None), ("x", "1", None), ("y, z", "2", None)]
    assert {r["file_path"][-5:] for r in found.collect()} == {"a.csv", "b.csv", "c.csv"}
    (tmp_path / "d.csv").write_text("Store,*Store\n1,2\n")
    with pytest.raises(Exception, match="two columns of one name"):
        readers.read_headed(spark, str(tmp_path), names, ["store"]).collect()


def test_one_scan_of_differently_headed_rows(spark):
    from tidyloom.operators import reshape

    frame = spark.createDataFrame([("Jan", ["1", "a"]), ("Feb", ["b", "2"]), ("Mar", ["3"])], "sheet string, cells array<string>")
    headers = {"Jan": ["Sales", "Store"], "Feb": ["*Store", "*Sales"], "Mar": ["Sales"]}
    names = {"Store": "store", "*Store": "store", "Sales": "sales", "*Sales": "sales"}
    found = reshape.harmonize_rows(frame, "sheet", "cells", headers, names, ["store", "sales", "model"])
    assert rows(found, "sheet", "store", "sales", "model") == [("Feb", "b", "2", None), ("Jan", "a", "1", None), ("Mar", None, "3", None)]
    with pytest.raises(ValueError, match="Jan"):
        reshape.harmonize_rows(frame, "sheet", "cells", {"Jan": ["Store", "*Store"]}, names, ["store"])


def test_encoding_by_file(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("né\nplain\n".encode())
    (tmp_path / "b.txt").write_bytes("né, ü\nplain\n".encode("latin-1"))
    found = readers.read_lines(spark, str(tmp_path))
    assert rows(found, "encoding", "line", "n_replaced") == [("ISO-8859-1", "né, ü", 2), ("ISO-8859-1", "plain", 0), ("UTF-8", "né", 0), ("UTF-8", "plain", 0)]


def test_labelled_rows(spark):
    frame = spark.createDataFrame([("F", 1), ("O", 2), ("X", 3)], "code string, n int")
    assert rows(readers.labelled_rows(frame, "sheet", {"Done": "F", "Open": "O"}, "code"), "sheet", "n") == [("Done", 1), ("Open", 2)]
