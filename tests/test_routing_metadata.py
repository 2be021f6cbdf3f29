import random

import pytest
from pyspark.sql import functions as F

from sheafline.operators import boxes, metadata, repeats, review, routing
from sheafline.plans import documents
from sheafline.sources import engines, files
from sheafline.sources.engines import Config


def test_manual_pages(each):
    assert each(routing.manual_pages, ["4,6,8-10", "10-8", None, " , 0"]) == [[4, 6, 8, 9, 10], [8, 9, 10], [], []]
    with pytest.raises(Exception):
        each(routing.manual_pages, ["x"])


def test_ranges(spark):
    df = spark.createDataFrame([(5, 9, 0), (5, 2, 9), (5, 4, 2)], "t int, s int, e int")
    assert [tuple(r[0]) for r in df.select(routing.clamped_range("t", "s", "e")).collect()] == [(5, 5), (2, 5), (4, 4)]
    assert [tuple(r[0]) for r in df.select(routing.page_range("t", "s", "e")).collect()] == [(9, 9), (2, 5), (4, 4)]


def test_islands_are_the_flood(spark):
    rng = random.Random(5)
    rows = [(d, p, rng.random() < 0.15, rng.random() < 0.1, rng.choice([0, 0, 30])) for d in range(60) for p in range(1, rng.randint(2, 20))]
    cols = "doc_id int, page_no int, likely_table boolean, likely_form boolean, vector_line_count int"
    s = spark.createDataFrame(rows, cols).withColumns({"raster_line_score": F.lit(0.0), "raster_vertical_lines": F.lit(0), "keyword_score": F.lit(0)})
    want = set()
    for d in range(60):
        on = {r[1]: r[2] or r[4] >= 25 for r in rows if r[0] == d}
        for r in (r for r in rows if r[0] == d and (r[2] or r[3])):
            want.add((d, r[1]))
            if r[2]:
                for step in (-1, 1):
                    p = r[1] + step
                    while on.get(p):
                        want.add((d, p))
                        p += step
    got = routing.table_pages(s)
    assert {tuple(r) for r in got.collect()} == want
    groups = routing.contiguous_groups(got).collect()
    assert sum(r.page_end - r.page_start + 1 for r in groups) == len(want)


def test_quality(each):
    good = "Căn cứ quyết định của Hiệu trưởng về việc xét học bổng cho sinh viên các khoa."
    assert each(routing.is_bad_text, [None, "short", good, good + "BQ GIAO Dl)C DQc l", "x" * 60 + "[]" * 4]) == [True, True, False, True, True]


def test_scores(each):
    got = each(routing.table_score, ["II. Lưu đồ: bước, ghi chú, đơn vị", ""])
    assert got[0]["score"] == 4 + 3 and got[1]["score"] == 0 and got[1]["reasons"] == []


def test_repeated(spark):
    rows = [(1, p, f"TRƯỜNG ABC trang {p}\nbody {chr(96 + p)}") for p in (1, 2, 3)] + [(2, 1, "only\nonly"), (2, 2, "only line")]
    p = spark.createDataFrame(rows, "doc_id int, page_no int, text string")
    found = repeats.repeated_lines(p)
    assert [(r.doc_id, r.key, r.n_pages) for r in found.collect()] == [(1, "trường abc trang #", 3)]
    kept = {(r.doc_id, r.page_no): r.text for r in repeats.without_repeated(p, found).collect()}
    assert kept == {(1, 1): "body a", (1, 2): "body b", (1, 3): "body c", (2, 1): "only\nonly", (2, 2): "only line"}


FULL = "---\n" + "\n".join(f"{k}: x" for k in metadata.FIELDS if k not in ("audience", "is_latest", "notes")) + "\naudience:\n  - a\nis_latest: true\nnotes:\nodd: 1\n---\nbody"


def test_findings(spark):
    df = spark.createDataFrame([(1, "no front matter"), (2, FULL), (3, "---\nrag_status: published\n---\n"), (4, None)], "doc_id int, text string")
    got = [tuple(r) for r in metadata.findings(df).collect()]
    assert [g[1:] for g in got if g[0] == 1] == [("error", "front_matter", "", "missing YAML front matter")]
    two = {(g[2], g[3]) for g in got if g[0] == 2}
    assert ("unknown", "odd") in two and ("optional", "notes") in two and ("date", "issued_date") in two and ("checksum", "checksum") in two and not any(r == "missing" for r, _ in two)
    assert sum(g[2] == "published" for g in got if g[0] == 3) == 4
    assert {r.status: r.n for r in metadata.totals(df, metadata.findings(df)).collect()} == {"ERROR": 4, "total": 4}


def test_parse(spark):
    raw = 'a: "x y"\nb:\n  - 1\n  - \'z\'\nc: []\nd: TRUE\n# no\n\nbad line\n- lost\na: last\n'
    f = spark.createDataFrame([(raw,)], "raw string").select(metadata.parse_fields("raw").alias("f")).first()["f"]
    assert (f["a"]["kind"], f["a"]["text"]) == ("text", "last")
    assert [i["text"] for i in f["b"]["items"]] == ["1", "z"] and f["c"]["kind"] == "list" and f["d"]["kind"] == "bool"


def test_build_keeps_what_people_wrote(spark):
    body = "## Metadata\n\n- Source file: `a/PDFs/Q/Bảng 1.pdf`\n- Parser: p1\n\n## Extracted Text\n<!-- page: 1 -->x"
    df = spark.createDataFrame([("/o/Bang_structured.md", "---\ntitle: \"T\"\nlanguage: en\n---\n" + body, None, None), ("/o/n.md", "x", "/data/PDFs/Quy che/f 1.pdf", "a" * 32)], "md_path string, text string, source_path string, source_checksum string")
    out = metadata.build(df, F.lit("now")).collect()
    assert 'title: T\n' in out[0].front and "parser: p1" in out[0].front and "ocr_status: done" in out[0].front and "audience:\n  - student" in out[0].front and "language: vi" in out[0].front
    assert "document_id: ctu-quy-che-f-1" in out[1].front and "version_id: ctu-quy-che-f-1-aaaaaaaaaaaa" in out[1].front and "ocr_status: not_started" in out[1].front and "file_type: pdf" in out[1].front
    again = metadata.build(spark.createDataFrame([("/o/n.md", out[1].result, "/data/PDFs/Quy che/f 1.pdf", "a" * 32)], df.schema), F.lit("now")).first()
    assert again.result == out[1].result


def test_review(spark):
    df = spark.createDataFrame([(1, "Số: 1L8/ĐTKDV-VP\nwhat?\nEmail: a\nx 1A2\nwhat?"), (2, None)], "doc_id int, text string")
    got = [(r.rule, r.line_no) for r in review.warnings(df).orderBy("position").collect()]
    assert got == [("document_number", None), ("question_mark", 2), ("mixed_number", 1), ("mixed_number", 4), ("question_mark", 5), ("email", 3)] or {g[0] for g in got} == {"document_number", "question_mark", "mixed_number", "email"}
    assert review.report(review.warnings(df)).count() == 1


def test_boxes(spark):
    rng = random.Random(2)

    def order(bs):
        hs = sorted(max(1.0, b[3] - b[1]) for b in bs)
        near, lines = max(8.0, hs[len(hs) // 2] * 0.65), []
        for b in sorted(bs, key=lambda b: (b[1], b[0])):
            c = (b[1] + b[3]) / 2
            for line in lines:
                if abs(c - sum((x[1] + x[3]) / 2 for x in line) / len(line)) <= near:
                    line.append(b)
                    break
            else:
                lines.append([b])
        return [b[4] for line in lines for b in sorted(line, key=lambda b: b[0])]

    pages_ = []
    for _ in range(20):
        pages_.append([(x := rng.randint(0, 300) + 0.5, y := rng.randint(0, 60) * 1.0, x + 20, y + rng.randint(5, 14), i) for i in range(rng.randint(1, 9))])
    rows = [(p, [(i, [(x1, y1), (x2, y1), (x2, y2), (x1, y2)]) for x1, y1, x2, y2, i in bs]) for p, bs in enumerate(pages_)]
    df = spark.createDataFrame(rows, "p int, boxes array<struct<box_no:int,pts:array<struct<x:double,y:double>>>>")
    got = {r.p: [b.box_no for b in r.o] for r in df.select("p", boxes.reading_order(F.col("boxes")).alias("o")).collect()}
    assert got == {p: order(bs) for p, bs in enumerate(pages_)}


def test_engines(spark):
    assert list(engines.walk_boxes([[[[1, 2], [3, 4], [5, 6], ["7", 8]]], None])) == [[[1.0, 2.0], [3.0, 4.0], [5.0, 6.0], [7.0, 8.0]]]
    assert list(engines.walk_texts({"r": [[[0], ("hi", 0.9)], {"text": "yo"}]})) == ["hi", "yo"]
    assert engines.ParserOptions(page_start=2, page_end=3, tier="fast", prompt="p").request("f").get("target_pages") == "2-3"
    with pytest.raises(ValueError):
        engines.ParserOptions(page_start=3, page_end=2).request("f")
    df = spark.createDataFrame([("a", [b"", b"x"]), ("b", None)], "page_key string, variants array<binary>")
    got = dict(map(tuple, engines.recognise(df, lambda: lambda image, lang: image.decode() + lang if image else None).collect()))
    assert got == {"a": "xvi", "b": None}


def test_files(spark, tmp_path):
    for n in ("a.PDF", "d/b.png", "c.exe", "e.html"):
        (tmp_path / n).parent.mkdir(exist_ok=True)
        (tmp_path / n).write_bytes(b"x")
    assert sorted(r.name for r in files.discover(spark, str(tmp_path), content=True).collect()) == ["a.PDF", "b.png"]
    assert sorted(r.name for r in files.discover(spark, str(tmp_path), "remote").collect()) == ["a.PDF", "b.png", "e.html"]
    out = spark.createDataFrame([(f"{tmp_path}/o/x.md", "é"), (f"{tmp_path}/o/y.md", None)], "out_path string, text string")
    assert sorted(r.bytes for r in files.write_files(out).collect()) == [0, 2]
    # Spark gives no row for an empty file
    assert [r.text for r in files.read_markdown(spark, f"{tmp_path}/o").collect()] == ["é"]


def test_documents(spark, tmp_path):
    raw = spark.createDataFrame([("d", 1, "Điều 1. Phạm vi\nSinh viên nộp đơn và\nđược xét học bổng theo quy định của nhà trường.", None), ("d", 2, "x", "Quy trình nộp hồ sơ"), ("d", 3, None, None)], "doc_id string, page_no int, text string, ocr_text string")
    out = documents.local_documents(raw).first()
    assert "### Điều 1. Phạm vi" in out.markdown and "## Quy trình nộp hồ sơ" in out.markdown and documents.NO_TEXT in out.markdown
    assert (out.text_pages, out.ocr_pages, out.total_pages) == (1, 2, 3)
    signals = routing.page_signals(raw.select("doc_id", "page_no", "text", F.when(F.col("page_no") == 2, 50).alias("vector_line_count"), F.lit(0).alias("h_count"), F.lit(0).alias("v_count")))
    parsed = spark.createDataFrame([("d", 2, "| Bước | Nội dung |\n| --- | --- |\n| c | d |")], "doc_id string, page_no int, markdown string")
    routed = documents.routed_documents(raw, signals, parsed).first().markdown
    assert "<!-- extraction: remote_parser -->" in routed and "| Bước | Nội dung |" in routed and "### Điều 1" in routed, routed
    assert documents.routed_pages(signals, Config(table_pages="3")).where("engine = 'remote'").first().page_no == 3


def test_stream(spark, tmp_path):
    from sheafline.streaming.ingest import PAGES, ingest

    rows = [("d", 1, "Một trang văn bản đủ dài để được dùng làm lớp chữ của tài liệu này.", None)]
    for k in range(2):
        spark.createDataFrame([(f"d{k}", *r[1:]) for r in rows], PAGES).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        ingest(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/check")
    assert sorted(r.doc_id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["d0", "d1"]
