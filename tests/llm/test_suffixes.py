"""Repeated rows in op8_suffixes."""

from pyspark.sql import functions as F

from tidyloom.llm import suffixes


def test_a_repeated_row_is_one_document(spark):
    alone = "".join(f"word {i * i} " for i in range(60))
    shared = "a passage that stands in two documents and has more than one hundred bytes, so that the later one of them loses it. "
    rows = [(1, alone), (1, alone), (1, alone), (2, "begin " + shared + "x" * 40), (3, "other " + shared + "end"), (3, "other " + shared + "end")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for hot in (2, 10**9):
        found = suffixes.without_repeats(frame, hot_anchor=hot).select("doc_id", F.col("kept").cast("string")).collect()
        assert sorted(map(tuple, found)) == [(1, alone)] * 3 + [(2, "begin " + shared + "x" * 40)] + [(3, "otherend")] * 2
