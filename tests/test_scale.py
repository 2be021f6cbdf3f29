"""Long pages and tokens: the work grows with their length, not with its square."""

import time

from pyspark.sql import functions as F

from sheafline.operators import layout, review, tables


def test_long_page(spark):
    page = "\n".join(f"Điều {i}. Phạm vi" if i % 7 == 0 else f"| {i} | x |" if i % 11 == 0 else f"sinh viên khoa {i} nộp đơn và" for i in range(10_000))
    df = spark.createDataFrame([(1, page)], "doc_id int, text string")
    start = time.time()
    merged = df.select(layout.merge_lines("text").alias("t")).first()[0]
    assert merged.count("\n") > 1000 and "Điều 9996. Phạm vi" in merged
    low = df.select(tables.bold_headings("text").alias("t"), tables.even_columns("text").alias("u")).first()
    assert low.t == page and low.u.count("\n") == 9999
    assert time.time() - start < 60


def test_long_token(spark):
    lines = spark.createDataFrame([(1, "ab" * 50_000 + "canthox" + "ba" * 50_000), (2, None), (3, ""), (4, "Đại học Cần Thơ, hoc vu"), (4, "Đại học Cần Thơ, hoc vu")], "line_id int, line string")
    terms = spark.createDataFrame([("Cantho",), ("Học vụ",), ("x",), ("",), ("Học vụ",)], "term string")
    start = time.time()
    got = sorted(map(tuple, review.match_terms(lines, terms).select("line_id", "term").collect()))
    assert got == [(1, "Cantho"), (1, "x"), (4, "Học vụ")]
    assert time.time() - start < 60


def test_runs_and_tables_of_no_lines(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "\n"), (4, "| a |")], "i int, text string")
    got = {r.i: (r.a, r.b) for r in df.select("i", tables.even_columns("text").alias("a"), tables.bold_headings("text").alias("b")).collect()}
    assert got == {1: ("", ""), 2: ("", ""), 3: ("\n", "\n"), 4: ("| a |", "| a |")}


def test_merging_equals_a_loop(spark, each):
    """Against the same decision in a loop over the lines."""
    lines = ["Sinh viên khoa", "nộp đơn và", "được xét.", "Điều 1. Phạm vi", "a) mục", "tiếp theo,", "còn nữa", "HẾT CHƯƠNG NÀY", "viết tiếp"]
    pairs = [(a, b) for a in {*lines, *(f"{x} {y}" for x in lines for y in lines)} for b in lines]
    yes = spark.createDataFrame(pairs, "a string, b string").select("a", "b", layout.joins(F.col("a"), F.col("b")).alias("j")).collect()
    joins = {(r.a, r.b): r.j for r in yes}
    done = []
    for x in lines:
        if done and joins.get((done[-1], x), False):
            done[-1] += " " + x
        else:
            done.append(x)
    assert each(layout.merge_lines, ["\n".join(lines)])[0].split("\n") == done
