"""Queries over tables that the small ones don't stand for: large keys, missing values, odd texts."""

import time

import duckdb

from sheafline.functions import rules
from sheafline.operators import metadata, tables
from sheafline.queries import ORACLES, QUERIES


def both(spark, folder, name, table, rows):
    """Sorted rows of a query and of its SQL over a table made of a SELECT."""
    c = duckdb.connect()
    c.execute(f"COPY ({rows}) TO '{folder}/{table}.parquet'")
    c.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    got = QUERIES[name](spark, str(folder))
    want = c.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLES[name]})").fetchall()
    return sorted(tuple(map(str, r)) for r in got.collect()), sorted(tuple(map(str, r)) for r in want)


def test_first_success_of_large_part_keys(spark, tmp_path):
    rows = """SELECT i // 4 AS l_orderkey, i * 7919 % 250000 AS l_partkey, i * 31 % 5000 AS l_suppkey, CAST(1 + i * i % 7 AS INTEGER) AS l_linenumber,
      substr('ARN', CAST(1 + i % 3 AS INTEGER), 1) AS l_returnflag, substr('FO', CAST(1 + i % 5 % 2 AS INTEGER), 1) AS l_linestatus FROM range(4000) t(i)"""
    got, want = both(spark, tmp_path, "first_success", "lineitem", rows)
    assert len(got) > 900 and got == want


def test_embedded_metadata_of_a_long_section(spark):
    """A line of the section is read once, not once for each other line."""
    body = "# T\n## Metadata\n" + "\n".join(f"- Key {i % 600}: `v{i}`" for i in range(800)) + "\n## Extracted Text\n- Key 1: no"
    df = spark.createDataFrame([(body,), ("no such part",), (None,)], "body string")
    start = time.time()
    got = [r.m for r in df.select(metadata.embedded("body").alias("m")).collect()]
    assert time.time() - start < 60
    assert got == [{f"key {i}": f"v{i + 600 if i < 200 else i}" for i in range(600)}, {}, {}]


def test_long_table_is_looked_at_once(spark):
    """Rests of a table with a wide row below them are no candidates for text; the old form looked at all of them."""
    table = "\n".join(["| a b c | d e f | g |", "|---|---|---|", *(f"| {i} x y | words that go on {i} | z |" for i in range(3000))])
    false = "| abc def | two words |\n|---|---|\n| 1. a | |"
    df = spark.createDataFrame([(0, table), (1, false), (2, f"{table}\n{false}"), (3, None)], "i int, text string")
    start = time.time()
    got = [r.t for r in df.select("i", tables.repair_false_tables("text").alias("t")).orderBy("i").collect()]
    assert time.time() - start < 60
    assert got == [table, "abc def two words\n1. a", f"{table}\nabc def two words\n1. a", ""]


def test_repair_of_a_long_word(spark):
    """Patterns that try each start of a word run only where a text has what they need."""
    df = spark.createDataFrame([("a" * 200_000,), ("căn  cử tin dụng SVnộp Khoatổng",)], "text string")
    start = time.time()
    got = [r.t for r in df.select(rules.repair("text").alias("t")).collect()]
    assert time.time() - start < 60
    assert got == ["a" * 200_000, "Căn cứ tín dụng SV nộp Khoa tổng"]
