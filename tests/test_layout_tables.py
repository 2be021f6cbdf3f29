import random

from pyspark.sql import functions as F

from sheafline.operators import layout, pages, tables


def test_headings(each):
    lines = ["7. Cho phép SV sử dụng các thiết bị điện:", "2. Nghiêm cấm các hành vi sau:", "1. Cơ sở thực hiện", "1. Mục đích:", "2.1 Thành phần hồ sơ", "I. LƯU ĐỒ", "1. Sinh viên nộp hồ sơ tại Phòng CTSV.", "a. Nếu hồ sơ thiếu thì yêu cầu bổ sung.", "a. Mục đích: Kết quả điểm rèn luyện được dùng", None]
    assert each(layout.heading_level, lines) == [None, None, 2, 2, 3, 2, None, None, None, None]
    assert each(layout.markdown_line, ["QUYẾT ĐỊNH", "Điều 5. X", "Chương II Y", "Mục 3 Z", "Quy trình xét", "Quy trình ........ 4", "<!-- x -->", ""]) == ["# QUYẾT ĐỊNH", "### Điều 5. X", "## Chương II Y", "### Mục 3 Z", "## Quy trình xét", "Quy trình ........ 4", "<!-- x -->", ""]


def test_merge(each):
    page = "Sinh viên nộp đơn và\nđược xét.\nĐiều 2. X\nHồ sơ gồm:\nĐơn xin học\nTÊN IN HOA DÀI\ntiếp theo"
    assert each(layout.merge_lines, [page, None, "\n\n"]) == ["Sinh viên nộp đơn và được xét.\nĐiều 2. X\nHồ sơ gồm:\n- Đơn xin học\nTÊN IN HOA DÀI\ntiếp theo", "", ""]
    assert each(lambda c: layout.merge_lines(c, True), ["Một dòng\nHai dòng"]) == ["Một dòng Hai dòng"]
    assert each(layout.to_markdown, ["Điều 2. X\na b."]) == ["### Điều 2. X a b."]


def test_rows(each):
    assert each(tables.row_cells, ["|a|  b  c | |", "x | y"]) == [["a", "b c", ""], ["x", "y"]]
    assert each(lambda c: tables.make_row(F.split(c, ","), F.lit(3)), ["a,b,c,d", "a"]) == ["| a | b | c d |", "| a |  |  |"]
    assert each(tables.is_separator, ["| --- | :--: |", "|---|", "a", None]) == [True, False, False, False]
    assert each(tables.is_row, ["|a|", "|---|", "|---|---|"]) == [True, True, False]


def test_headers(each):
    md = "| 1 | vi phạm nội quy lần | x |\n| --- | --- | --- |\n| 2 | b | c |"
    assert each(tables.repair_data_headers, [md, "a"]) == ["| TT | Nội dung | Cột 3 |\n| --- | --- | --- |\n| 1 | vi phạm nội quy lần | x |\n| 2 | b | c |", "a"]
    even = each(tables.even_columns, ["x\n|a|b|\n|--|--|\n|1|2|3|\ny\n|z|"])
    assert even == ["x\n| a | b |  |\n| --- | --- | --- |\n| 1 | 2 | 3 |\ny\n|z|"]
    assert each(tables.even_columns, even) == even


def test_carry(each):
    md = "<!-- page: 1 -->\n| TT | Ngành |\n| --- | --- |\n| 8 | A |\n<!-- page: 2 -->\n9 Công nghệ tài chính\nTổng cộng\n<!-- page: 3 -->\nother text here\n<!-- page: 4 -->\n10 B c"
    got = each(tables.carry_headers, [md])[0]
    assert "<!-- page: 2 -->\n| TT | Ngành |\n| --- | --- |\n| 9 | Công nghệ tài chính |\n|  | Tổng cộng |" in got
    assert got.endswith("other text here\n<!-- page: 4 -->\n10 B c")
    assert each(tables.carry_headers, ["no pages"]) == ["no pages"]


def test_forms(each):
    assert each(tables.form_layout, ["Nam □ Nữ", "tên ....... ", None]) == ["Nam [ ] Nữ", "tên ________ ", ""]
    assert each(tables.contents_lines, ["45. TÊN MỤC ________ 2", "a ____ 2"]) == ["45. TÊN MỤC 2", "a ____ 2"]
    assert each(tables.without_artifacts, [r"a $\rightarrow$ b &rarr; \* c", "bá[]o"]) == ["a → b → * c", "báo"]
    assert each(tables.bold_headings, ["**1.1 Mục**\n**1. Mục**\n|a|\n**2. x**"]) == ["##### 1.1 Mục\n#### 1. Mục\n|a|\n**2. x**"]
    assert each(tables.without_scanner_lines, ["Scanned with cs\nx \nCamScanner"]) == ["x"]


def test_titles_and_false_tables(each):
    md = "| TÊN BẢNG DÀI<br/>Bước | TÊN BẢNG DÀI<br/>Lưu đồ |\n| --- | --- |\n| a | b |"
    assert each(tables.hoist_titles, [md, "plain"]) == ["## TÊN BẢNG DÀI\n\n| Bước | Lưu đồ |\n| --- | --- |\n| a | b |", "plain"]
    false = "x\n| 1. abc | |\n| --- | --- |\n| d | e |\ny"
    assert each(tables.repair_false_tables, [false, "| Bước | |\n| --- | --- |"]) == ["x\n1. abc\nd e\ny", "| Bước | |\n| --- | --- |"]


def test_finish(spark):
    df = spark.createDataFrame([(1, "## Trang 11\n\n\n\n|a|b|\n|--|--|\n|1|\n"), (2, None), (3, "")], "id int, markdown string")
    got = {r.id: r.markdown for r in tables.finish(df).collect()}
    assert got == {1: "<!-- page: 11 -->\n\n| a | b |\n| --- | --- |\n| 1 | |\n", 2: "\n", 3: "\n"}
    parsed = {r.id: r.markdown for r in tables.parsed_markdown(spark.createDataFrame([(1, "Điều 1. Phạm  vi\r\nx")], "id int, markdown string")).collect()}
    assert parsed == {1: "## Điều 1. Phạm vi\nx\n"}


def test_markers(each, spark):
    assert each(pages.canonical_markers, ["## Trang 11 ", "<!-- page: 2 -->\n# trang 2\nx  ", None]) == ["<!-- page: 11 -->", "<!-- page: 2 -->\nx", ""]
    assert each(pages.strip_markers, ["## Trang 1\na"]) == ["a"]
    assert each(pages.clean_block, ["<!-- page: 1 -->\n\n\n\na\n\n---\n"]) == ["<!-- page: 1 -->\n\na"]


def test_split_is_the_inverse_of_assemble(spark):
    rng = random.Random(3)
    rows = [(d, p, f"text {rng.random()}") for d in range(4) for p in range(1, rng.randint(2, 6))]
    blocks = spark.createDataFrame(rows, "doc_id int, page_no int, t string").select("doc_id", "page_no", pages.page_block("page_no", "t").alias("block"))
    again = pages.split_pages(pages.assemble(blocks, blocks))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, blocks.collect()))
    gap = pages.assemble(spark.createDataFrame([(9, 1)], "doc_id int, page_no int"), blocks).first()["markdown"]
    assert gap.startswith("<!-- page: 1 -->\n\n[no content")


def test_assign_pages(spark):
    df = spark.createDataFrame([(1, "a", [3, 4]), (2, "<!-- page: 4 -->b<!-- page: 9 -->c", [3, 4]), (3, "<!-- page: 1 -->b<!-- page: 2 -->c<!-- page: 3 -->d", [7, 8])], "id int, md string, want array<int>")
    got = {r.id: r.m for r in df.select("id", pages.assign_pages("md", F.col("want"), "n").alias("m")).collect()}
    assert got == {1: {3: "<!-- page: 3 -->\n\na"}, 2: {4: "<!-- page: 4 -->\n\nn\n\nb"}, 3: {7: "<!-- page: 7 -->\n\nn\n\nb", 8: "<!-- page: 8 -->\n\nn\n\nc"}}
