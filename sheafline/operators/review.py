"""Warnings for people who review extracted text, and the search for an organisation's terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_line, match_key, split_lines, strip

# ---- fixed values: the organisation's terms, in order -----------------------------------------------------------------
TERMS = (
    "Đại học Cần Thơ", "Trường Đại học Cần Thơ", "Trường Công nghệ thông tin và truyền thông", "Phòng Đào tạo", "Phòng Công tác Sinh viên", "Công tác sinh viên", "Học vụ", "Học phần", "Sinh viên", "Điểm rèn luyện",
    "Miễn giảm học phí", "Tạm hoãn nghĩa vụ quân sự", "Vay vốn sinh viên", "Ngân hàng Chính sách xã hội", "Bộ Giáo dục và Đào tạo", "Bộ Tài chính", "Tờ khai thông tin", "Phụ lục", "Mẫu báo cáo", "Học sinh, sinh viên",
    "Học viên thạc sĩ", "Nghiên cứu sinh", "Giấy xác nhận sinh viên", "Đơn xin vắng thi", "Mở lớp học phần", "Biểu mẫu", "Quy định", "Quyết định", "Thông báo", "Công văn",
)
UNACCENTED = r"(?U)\b[Dd]ai hoc|[Cc]an [Tt]ho|[Ss]inh vien\b"
DOCUMENT_NUMBER = r"(?iU)\bSố\s*:\s*([A-Za-z0-9]+\s*/\s*[^\n]+)"
MIXED_NUMBER = r"(?U)\b[0-9]+[A-Za-z][0-9]+\b"
# -----------------------------------------------------------------------------------------------------------------------


def terms_in(line, terms=TERMS) -> Column:
    """The terms whose key occurs in the line's key, in order. The list is fixed and short: a filter, not a join."""
    key = match_key(line)
    pairs = F.array(*(F.struct(F.lit(t).alias("term"), match_key(F.lit(t)).alias("key")) for t in terms))
    return F.transform(F.filter(pairs, lambda p: (p["key"] != "") & F.contains(key, p["key"])), lambda p: p["term"])


def match_terms(lines: DataFrame, terms: DataFrame, part: int = 6) -> DataFrame:
    """(line's columns, term) for a table of terms (term) of any size: candidates by a part of the term, then the check.

    The part is the term's first ``part`` characters, or all of a shorter term, and a line is dealt by its distinct parts of
    the lengths that the terms have: an equi-join of rows in proportion to the line's length, and no product of the two."""
    keyed = terms.select("term", match_key("term").alias("key")).where("key != ''").withColumn("part", F.substring("key", 1, part)).distinct()
    lengths = sorted(r[0] for r in keyed.select(F.length("part")).distinct().collect())  # no more than ``part`` numbers
    # by an array of characters, as a substring is looked for from the start of its text
    source = lines.withColumn("_key", match_key("line")).withColumn("_chars", F.filter(F.split("_key", ""), lambda x: x != ""))
    cut = lambda n: F.when(F.size("_chars") >= n, F.transform(F.sequence(F.lit(0), F.size("_chars") - n), lambda i: F.concat(*(F.get(F.col("_chars"), i + k) for k in range(n))))).otherwise(F.array().cast("array<string>"))
    parts = F.array_distinct(F.concat(F.array().cast("array<string>"), *map(cut, lengths)))
    found = source.withColumn("part", F.explode(parts)).join(keyed, "part").where(F.contains(F.col("_key"), F.col("key")))
    return found.drop("_key", "_chars", "part", "key").distinct()


def term_warning(line) -> Column:
    """Up to three terms near a line that still shows signs of misreading; null without any."""
    found = terms_in(line)
    return F.when((F.size(found) > 0) & (F.contains(clean_line(line), F.lit("?")) | clean_line(line).rlike(UNACCENTED)), F.slice(found, 1, 3))


def warnings(docs: DataFrame, text: str = "text", terms: bool = False) -> DataFrame:
    """(doc_id, position, rule, line_no, message): document numbers with letters, lines with odd characters, addresses
    without @, and, if asked for, misread terms; of equal messages the first stays."""
    lines = F.transform(split_lines(text), lambda x, i: F.struct((i + 1).alias("no"), clean_line(x).alias("line")))
    full = F.filter(lines, lambda x: x["line"] != "")
    item = lambda rule, no, message: F.struct(F.lit(rule).alias("rule"), no.cast("int").alias("line_no"), message.alias("message"))
    said = lambda x, what: F.concat(F.lit("line "), x["no"].cast("string"), F.lit(f": {what}: "), x["line"])
    numbers = F.filter(F.transform(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(DOCUMENT_NUMBER), F.lit(1)), clean_line), lambda x: strip(F.get(F.split(x, "/"), 0)).rlike("[A-Za-z]"))
    none = F.array().cast("array<struct<rule:string,line_no:int,message:string>>")
    parts = [
        F.transform(numbers, lambda x: item("document_number", F.lit(None), F.concat(F.lit("document number may be misread: "), x))),
        F.flatten(F.transform(full, lambda x: F.concat(F.when(F.contains(x["line"], F.lit("?")), F.array(item("question_mark", x["no"], said(x, "a ? is left")))).otherwise(none), F.when(x["line"].rlike(MIXED_NUMBER), F.array(item("mixed_number", x["no"], said(x, "digits and letters mixed")))).otherwise(none)))),
        F.transform(F.filter(full, lambda x: x["line"].rlike("(?i)email") & ~F.contains(x["line"], F.lit("@"))), lambda x: item("email", x["no"], said(x, "an address without @"))),
    ]
    if terms:
        parts.append(F.flatten(F.transform(full, lambda x: F.when(term_warning(x["line"]).isNotNull(), F.array(item("term", x["no"], F.concat(F.lit("line "), x["no"].cast("string"), F.lit(": check the terms "), F.array_join(term_warning(x["line"]), ", "))))).otherwise(none))))
    return docs.select("doc_id", F.posexplode(F.array_distinct(F.concat(*(p.cast("array<struct<rule:string,line_no:int,message:string>>") for p in parts)))).alias("position", "w")).select("doc_id", "position", "w.*")


def report(found: DataFrame) -> DataFrame:
    """(doc_id, report): the warnings of each document as one text; documents without any have none."""
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "message"))), lambda x: F.concat(F.lit("- "), x["message"])), "\n")
    return found.groupBy("doc_id").agg(F.concat(F.lit("# OCR Review Report\n\n"), lines).alias("report"))
