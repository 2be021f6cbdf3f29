"""Tables and forms in Markdown: reading and writing rows, repairing headers, column counts, tables over several pages,
tables that are none, forms, contents and headings. Columns only; a document's lines are an array in its row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ODD_SPACES, any_within, clean_line, clean_text, clean_title, col, let, match_key, rstrip, split_lines, strip, sub, tidy_lines, title_key
from .pages import BOUNDARY, canonical_markers, is_boundary

# ---- fixed values -------------------------------------------------------------------------------------------------
SEPARATOR_LINE = r"(?U)^\s*\|?\s*:?-{2,}:?\s*(\|\s*:?-{1,}:?\s*)+\|?\s*$"
ROW_LINE = r"(?Ud)^\s*\|.*\|\s*$"
SCANNER_LINES = r"(?iU)^(?:scanned\s+with\s+(?:cs\s*)?camscanner|scanned\s+with\s+cs|camscanner)$"
INDEX = r"\d{1,3}|[IVXLCDM]+"
ACTIONS = r"(?iU)\b(?:KTX|khiển trách|cảnh cáo|buộc ra khỏi|vi phạm|phân loại|khối ngành|cấp học|công nghệ|thạc sĩ|đại học)\b"
DISCIPLINE, DISCIPLINE_HEADER = ("ktx", "khien trach", "canh cao", "buoc ra khoi", "vi pham"), ("TT", "Nội dung vi phạm", "Lần 1", "Lần 2", "Lần 3", "Ghi chú")
REPORT = ("doanh so", "du no", "khach hang", "phan loai")
COLUMN, INDEX_HEADER, TOTAL = "Cột", ("TT", "Nội dung"), "Tổng cộng"
HEADER_HINTS = ("bước", "lưu đồ", "nội dung", "công việc", "người", "thực hiện", "thời gian", "ghi chú", "đơn vị", "phối hợp", "biểu mẫu", "minh chứng", "hồ sơ")
SECTION_CELL = r"(?iU)^(?:\d+(?:\.\d+)*\.?\s+|[a-zA-Zà-ỹ]\.|[IVXLCDM]+\.|I+\.|V+\.)"
FORM = (
    (r"\.{6,}", "________"),
    (r"(?U)\s+…{2,}", " ________"),
    (r"(?iU)\b(Nam|Nữ|Có|Không)\s+[O0□☐]\b", "$1 [ ]"),
    (r"(?iU)[O0□☐]\s+(Nam|Nữ|Có|Không)\b", "[ ] $1"),
    (r"(?iU)(__+)\s+(Họ và tên|Ngày sinh|Giới tính|CCCD|Nơi cấp|Tên cơ sở|Hệ đào tạo|Ngành|Mã ngành|Loại hình đào tạo)", "$1\n$2"),
)
CONTENTS_LINE = r"(?Ud)^(\s*\d{1,3}\.\s+.+?)\s+(?:[_.·…]{3,}|(?:\s\.\s*){3,})\s*(\d{1,3})\s*$"
ARTIFACT_PATTERNS = ((r"\$\s*\\(?:to|rightarrow|Rightarrow)\s*\$", "→"), (r"\\rightarrow|&rarr;|&rightarrow;", "→"), (r"\\{2,}\*", "*"), (r"\\\*", "*"), (r"(?<=[A-Za-zÀ-ỹ])\[\](?=[A-Za-zÀ-ỹ])", ""))
ARTIFACTS = (
    ("thông bá[]", "thông báo"),
    ("thông bá có", "thông báo có"),
    ("số16/", "số 16/"),
    ("SVtrình", "SV trình"),
    ("SVtrong", "SV trong"),
    ("Khoatổng", "Khoa tổng"),
    ("ĐRLcấp", "ĐRL cấp"),
    ("PhòngCTSV", "Phòng CTSV"),
    ("đào tạo;sinh", "đào tạo; sinh"),
    ("có)theo", "có) theo"),
    ("Phòng Tài vụ,các", "Phòng Tài vụ, các"),
    ("Quốc Phòng", "Quốc phòng"),
    ("b.Phạm vi", "b. Phạm vi"),
    ("-Theo dõi", "- Theo dõi"),
    ("KP v kết thúc", "KP và kết thúc"),
)
HEADINGS = r"(?Ud)^(?:CHƯƠNG\s+[IVXLCDM]+\b|Chương\s+[IVXLCDM]+\b|Điều\s+\d+\.?\s+|PHỤ LỤC\s+|QUYẾT ĐỊNH\b|QUY ĐỊNH\b|QUY TRÌNH\b).*$"
HEADING_WORDS = ("CHƯƠNG", "Chương", "Điều", "PHỤ LỤC", "QUYẾT ĐỊNH", "QUY ĐỊNH", "QUY TRÌNH")
# -------------------------------------------------------------------------------------------------------------------


def _lines(c) -> Column:
    return F.split(F.coalesce(col(c), F.lit("")), "\n", -1)


def _join(lines: Column) -> Column:
    return F.array_join(lines, "\n")


def is_separator(c) -> Column:
    x = F.coalesce(col(c), F.lit(""))
    return F.contains(x, F.lit("--")) & F.contains(x, F.lit("|")) & x.rlike(SEPARATOR_LINE)


def is_row(c) -> Column:
    x = F.coalesce(col(c), F.lit(""))
    plain = x.startswith("|") & x.endswith("|") & (F.length(x) >= 2) & ~F.contains(x, F.lit("\n"))
    return F.contains(x, F.lit("|")) & (plain | x.rlike(ROW_LINE)) & ~is_separator(c)


def row_cells(c) -> Column:
    """The cells of a table row: one outer pipe taken off each side, white space collapsed."""
    # white space is collapsed in the whole row, if any of it is more than a blank
    odd = lambda x: F.contains(x, F.lit("  ")) | any_within(x, "\n" + ODD_SPACES)
    x = let(F.coalesce(col(c), F.lit("")), lambda x: F.when(odd(x), clean_line(x)).otherwise(strip(x)))
    return F.transform(F.split(sub(x, r"^\||\|$", ""), r"\|", -1), strip)


def starred_cells(c) -> Column:
    """As ``row_cells``, with spaces and stars stripped from each cell."""
    return F.transform(row_cells(c), lambda x: sub(x, r"^[ *]+|[ *]+$", ""))


def make_row(cells: Column, n: Column | None = None) -> Column:
    """A table row; with ``n`` columns short rows are padded and the rest of long ones goes to the last column."""
    def sized(x: Column) -> Column:
        longer = F.concat(F.slice(x, 1, F.greatest(n - 1, F.lit(0))), F.array(strip(F.array_join(F.slice(x, F.greatest(n, F.lit(1)), F.size(x)), " "))))
        return F.when(F.size(x) < n, F.concat(x, F.array_repeat(F.lit(""), n - F.size(x)))).when(F.size(x) > n, longer).otherwise(x)

    x = F.transform(cells, strip)
    return F.concat(F.lit("| "), F.array_join(x if n is None else let(x, sized), " | "), F.lit(" |"))


def make_separator(n: Column) -> Column:
    return F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), F.greatest(n, F.lit(1))), " | "), F.lit(" |"))


def _words(c: Column) -> Column:
    x = strip(c)
    return F.when(x == "", 0).otherwise(F.size(F.split(x, r"(?U)\s+")))


def is_data_header(cells: Column) -> Column:
    """Whether a header is really a row of data: an index, a sentence, and a word of the tables this happens to."""
    first, second = F.coalesce(F.get(cells, 0), F.lit("")), F.coalesce(F.get(cells, 1), F.lit(""))
    return (F.size(cells) >= 3) & strip(first).rlike(f"(?i)^(?:{INDEX})$") & (_words(second) >= 3) & F.array_join(cells, " ").rlike(ACTIONS)


def generic_header(cells: Column) -> Column:
    return let(match_key(F.array_join(cells, " ")), lambda key: _generic_header(cells, F.size(cells), key))


def _generic_header(cells: Column, n: Column, key: Column) -> Column:
    plain = lambda low: F.transform(F.sequence(F.lit(low), F.greatest(n, F.lit(low))), lambda i: F.concat(F.lit(f"{COLUMN} "), i.cast("string")))
    return (
        F.when((n == 6) & any_within(key, DISCIPLINE), F.array(*map(F.lit, DISCIPLINE_HEADER)))
        .when((n >= 10) & any_within(key, REPORT), plain(1))
        .when(n >= 3, F.concat(F.array(*map(F.lit, INDEX_HEADER)), plain(3)))
        .otherwise(plain(1))
    )


def _flat(lines: Column, make) -> Column:
    """Each line replaced by the array ``make(line, index)``."""
    return _join(F.flatten(F.transform(lines, make)))


def repair_data_headers(c) -> Column:
    """A row of data that stands as a header goes below a generic header of its own."""
    return let(F.coalesce(col(c), F.lit("")), lambda x: F.when(F.contains(x, F.lit("--")), let(_lines(x), _data_headers)).otherwise(x))


def _data_headers(lines: Column) -> Column:
    heads = F.transform(lines, lambda x, i: is_separator(F.get(lines, i + 1)) & is_row(x) & let(row_cells(x), is_data_header))
    return let(heads, lambda h: F.when(F.array_contains(h, True), _flat(lines, lambda x, i: _data_header(h, x, i))).otherwise(_join(lines)))


def _data_header(heads: Column, line: Column, at: Column) -> Column:
    def fixed(cells: Column) -> Column:
        header = generic_header(cells)
        n = F.greatest(F.size(header), F.size(cells))
        return F.array(make_row(header, n), make_separator(n), make_row(cells, n))

    empty = F.array().cast("array<string>")
    after = (at > 0) & is_separator(line) & F.coalesce(F.get(heads, at - 1), F.lit(False))
    return F.when(F.get(heads, at), let(row_cells(line), fixed)).when(after, empty).otherwise(F.array(line))


def _runs(lines: Column, member) -> Column:
    """array of struct(on, lines): maximal runs of neighbours by whether ``member(line)``."""
    def cut(lines: Column, marks: Column, starts: Column) -> Column:
        return F.transform(starts, lambda s, k: F.struct(F.get(marks, s).alias("on"), F.slice(lines, s + 1, F.coalesce(F.get(starts, k + 1), F.size(marks)) - s).alias("lines")))

    def run_starts(marks: Column) -> Column:
        places = F.when(F.size(marks) > 0, F.sequence(F.lit(0), F.size(marks) - 1)).otherwise(F.array().cast("array<int>"))
        return F.filter(places, lambda i: (i == 0) | (F.get(marks, i) != F.get(marks, i - 1)))

    return let(lines, lambda lines: let(F.transform(lines, member), lambda marks: let(run_starts(marks), lambda starts: cut(lines, marks, starts))))


def even_columns(c) -> Column:
    """All rows of a table (two lines or more that begin with a row) get the number of columns of its widest row."""
    in_table = lambda x: is_row(x) | is_separator(x)

    def even(block: Column) -> Column:
        # the cells of a row; null for a separator. All lines of a block are rows or separators
        cells = F.transform(block, lambda x: F.when(~is_separator(x), row_cells(x)))
        return let(cells, lambda cells: let(F.array_max(F.transform(cells, F.size)), lambda n: F.transform(cells, lambda x: F.when(x.isNull(), make_separator(n)).otherwise(make_row(x, n)))))

    def cut(run: Column, first: Column) -> Column:
        head, block = F.slice(run, 1, F.greatest(first - 1, F.lit(0))), F.slice(run, F.greatest(first, F.lit(1)), F.size(run))
        return F.when((first > 0) & (F.size(run) - first >= 1), F.concat(head, let(block, even))).otherwise(run)

    def fix(run: Column) -> Column:
        return let(F.array_position(F.transform(run, is_row), True).cast("int"), lambda first: cut(run, first))

    evened = lambda runs: _join(F.flatten(F.transform(runs, lambda r: F.when(r["on"], fix(r["lines"])).otherwise(r["lines"]))))
    return let(F.coalesce(col(c), F.lit("")), lambda x: F.when(F.contains(x, F.lit("|")), let(_runs(_lines(x), in_table), evened)).otherwise(x))


def has_header(block: Column) -> Column:
    lines = _lines(block)
    return F.exists(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: is_row(F.get(lines, i)) & is_separator(F.get(lines, i + 1)))


def last_header(block: Column) -> Column:
    """The cells of the block's last table header; null without one."""
    heads = let(_lines(block), lambda lines: F.filter(lines, lambda x, i: is_separator(F.get(lines, i + 1)) & is_row(x)))
    return let(heads, lambda h: F.when(F.size(h) > 0, row_cells(F.get(h, F.size(h) - 1))))


def _meaningful(x: Column) -> Column:
    # a boundary begins with <!-- or, in its old form, with #
    return let(strip(x), lambda s: (s != "") & ~s.startswith("<!--") & ~(s.startswith("#") & is_boundary(s)) & ~((F.length(s) <= 3) & s.rlike(r"(?U)^\d{1,3}$")))


def continues_table(block: Column) -> Column:
    """Whether a page's first line of substance looks like a table's next row."""
    first = strip(F.get(F.filter(let(block, split_lines), _meaningful), 0))
    return let(first, lambda x: is_row(x) | x.rlike(rf"(?iU)^(?:{INDEX}|{TOTAL})\s+\S+"))


def continued_row(c: Column, n: Column) -> Column:
    """A loose line as a row of ``n`` columns; null if it is none."""
    return let(clean_line(c), lambda s: _continued(s, n))


def _continued(s: Column, n: Column) -> Column:
    pattern = rf"(?iUd)^({INDEX})\s+(.+)$"
    row = F.when(is_row(s), make_row(row_cells(s), n)).when(s.rlike(pattern), make_row(F.array(F.regexp_extract(s, pattern, 1), F.regexp_extract(s, pattern, 2)), n)).when(s.rlike(rf"(?iU)^{TOTAL}\.?$"), make_row(F.array(F.lit(""), F.lit(TOTAL)), n))
    return F.when((s != "") & ~s.startswith("<!--") & ~s.startswith("#"), row)


def carry_headers(c) -> Column:
    """A page that goes on with the table of the page before, but has lost its header, gets it again.

    A fold over the page parts holds the last header and whether the part before was of a table; blank parts don't count.
    """
    return let(F.coalesce(col(c), F.lit("")), _carry)


def _carry(c: Column) -> Column:
    parts = F.transform(F.split(canonical_markers(c), BOUNDARY, -1), lambda p: F.struct(p.alias("text"), (strip(p) == "").alias("blank"), last_header(p).alias("head")))
    start = F.struct(F.lit(None).cast("array<string>").alias("head"), F.lit(False).alias("table"), F.array().cast("array<struct<text:string,head:array<string>>>").alias("done"))

    def step(acc: Column, p: Column) -> Column:
        return let(~p["blank"] & p["head"].isNull() & acc["table"] & acc["head"].isNotNull() & continues_table(p["text"]), lambda inherits: told(acc, p, inherits))

    def told(acc: Column, p: Column, inherits: Column) -> Column:
        item = F.struct(p["text"].alias("text"), F.when(inherits, acc["head"]).alias("head"))
        table = F.when(p["blank"], acc["table"]).otherwise(p["head"].isNotNull() | inherits)
        return F.struct(F.coalesce(p["head"], acc["head"]).alias("head"), table.alias("table"), F.concat(acc["done"], F.array(item)).alias("done"))

    def rewrite(p: Column) -> Column:
        return F.when(p["head"].isNull(), p["text"]).otherwise(let(_lines(p["text"]), lambda lines: let(F.array_position(F.transform(lines, _meaningful), True), lambda at: inherit(p, lines, at))))

    def inherit(p: Column, lines: Column, at: Column) -> Column:
        n = F.size(p["head"])
        new = F.transform(lines, lambda x, i: F.concat(F.when(i + 1 == at, F.array(make_row(p["head"], n), make_separator(n))).otherwise(F.array().cast("array<string>")), F.array(F.coalesce(continued_row(x, n), x))))
        return _join(F.flatten(new))

    done = F.aggregate(parts, start, step, lambda acc: acc["done"])
    return let(done, lambda d: F.when(F.size(d) <= 1, c).otherwise(F.array_join(F.transform(d, rewrite), "")))


def without_scanner_lines(c) -> Column:
    cut = lambda x: _join(F.transform(F.filter(split_lines(x), lambda y: ~clean_line(y).rlike(SCANNER_LINES)), rstrip))
    return let(F.coalesce(col(c), F.lit("")), lambda x: F.when(x.rlike("(?iU)camscanner|scanned"), cut(x)).otherwise(tidy_lines(x)))


def form_layout(c) -> Column:
    """Dots to placeholders, boxes to [ ], a form's labels on lines of their own."""
    # what at least one rule needs
    sign = r"(?iU)\.{6}|…|__|[O0□☐]\s+(?:Nam|Nữ|Có|Không)|(?:Nam|Nữ|Có|Không)\s+[O0□☐]"
    return let(F.coalesce(col(c), F.lit("")), lambda x: F.when(x.rlike(sign), reduce(lambda y, r: sub(y, *r), FORM, x)).otherwise(x))


def contents_lines(c) -> Column:
    """Leaders of numbered contents lines go; table lines are left as they are."""
    cut = lambda t: _join(F.transform(_lines(t), lambda x: F.when(x.rlike(CONTENTS_LINE) & ~is_row(x) & ~is_separator(x), F.concat(rstrip(F.regexp_extract(x, CONTENTS_LINE, 1)), F.lit(" "), F.regexp_extract(x, CONTENTS_LINE, 2))).otherwise(x)))
    return let(F.coalesce(col(c), F.lit("")), lambda t: F.when(t.rlike(r"(?Umd)^\s*\d{1,3}\.\s"), cut(t)).otherwise(t))


def without_artifacts(c) -> Column:
    # each pattern needs one of these
    x = let(F.coalesce(col(c), F.lit("")), lambda t: F.when(t.rlike(r"[\\&]|\[\]"), reduce(lambda x, r: sub(x, *r), ARTIFACT_PATTERNS, t)).otherwise(t))
    return reduce(lambda x, r: F.replace(x, F.lit(r[0]), F.lit(r[1])), ARTIFACTS, x)


def _in_table(lines: Column, member, inclusive_end: bool = True) -> Column:
    """Array of booleans: whether a table line stands at or before each line without a blank line between."""
    marks = F.transform(lines, lambda x: F.when(member(x), 1).when(strip(x) == "", 0).otherwise(-1))
    start = F.struct(F.lit(False).alias("on"), F.lit("").alias("all"))

    def step(acc: Column, m: Column) -> Column:
        on = F.when(m == 1, True).when(m == 0, False).otherwise(acc["on"])
        return F.struct(on.alias("on"), F.concat(acc["all"], F.when(on, "1,").otherwise("0,")).alias("all"))

    said = F.split(F.aggregate(marks, start, step, lambda acc: acc["all"]), ",")
    return let(said, lambda said: F.transform(F.slice(said, 1, F.size(said) - 1), lambda x: x == "1"))


def bold_headings(c) -> Column:
    """Numbered lines in bold become low headings; tables and comments are left alone."""
    ends = lambda x: F.when(F.contains(x, F.lit(" \n")) | x.endswith(" ") | any_within(x, ODD_SPACES), _join(F.transform(_lines(x), rstrip))).otherwise(x)
    return let(F.coalesce(col(c), F.lit("")), lambda x: F.when(F.contains(x, F.lit("**")), let(F.transform(_lines(x), rstrip), _bold)).otherwise(ends(x)))


def _bold(lines: Column) -> Column:
    inside = _in_table(lines, lambda x: is_row(strip(x)) | is_separator(strip(x)))
    deep, flat = r"(?Ud)^\*\*(\d+(?:\.\d+)+\s+.+?)\*\*\s*$", r"(?Ud)^\*\*(\d+\.\s+.+?)\*\*\s*$"

    def make(x: Column, in_table: Column) -> Column:
        s = strip(x)
        title = F.regexp_extract(s, deep, 1)
        low = F.concat(F.lit("##### "), sub(title, "[ :]+$", ""), F.when(rstrip(title).endswith(":"), ":").otherwise(""))
        return F.when(in_table | (s == "") | s.startswith("<!--"), x).when(s.rlike(deep), low).when(s.rlike(flat), F.concat(F.lit("#### "), strip(F.regexp_extract(s, flat, 1)))).otherwise(x)

    return _join(F.zip_with(lines, inside, make))


def _steps(df: DataFrame, column: str, steps) -> DataFrame:
    """One projection per step: the analyser sees each by itself, so long compositions stay within its limits."""
    for step in steps:
        df = df.withColumn(column, step(F.col(column)))
    return df


def finish(df: DataFrame, column: str = "markdown") -> DataFrame:
    """All repairs of finished Markdown in a column, in order."""
    steps = (without_scanner_lines, canonical_markers, without_artifacts, contents_lines, form_layout, bold_headings, repair_data_headers, even_columns, carry_headers, clean_text)
    return _steps(df, column, (*steps, lambda x: F.concat(x, F.lit("\n"))))


def repeated_title(cells: Column) -> Column:
    """struct(key, title): the text before a line break that most header cells share, two at least; null if none does.

    The key has 12 characters or more; at a tie the one that occurs first wins."""
    return let(cells, _repeated_title)


def _repeated_title(cells: Column) -> Column:
    cut = F.filter(F.transform(cells, lambda x: F.when(x.rlike(r"(?i)<br\s*/?>"), clean_title(F.get(F.split(x, r"(?i)<br\s*/?>", 2), 0)))), lambda x: x.isNotNull())
    return let(F.filter(F.transform(cut, lambda t: F.struct(title_key(t).alias("key"), t.alias("title"))), lambda x: F.length(x["key"]) >= 12), _counted_titles)


def _counted_titles(keyed: Column) -> Column:
    counted = F.transform(keyed, lambda x, i: F.struct(F.size(F.filter(keyed, lambda y: y["key"] == x["key"])).alias("n"), (-i).alias("at"), x["key"].alias("key"), x["title"].alias("title")))
    return let(F.array_max(counted), _best_title)


def _best_title(best: Column) -> Column:
    return F.when(best["n"] >= 2, F.struct(best["key"].alias("key"), best["title"].alias("title")))


def without_title(cell: Column, key: Column) -> Column:
    parts = F.split(cell, r"(?i)<br\s*/?>", 2)
    rest = strip(F.coalesce(F.get(parts, 1), F.lit("")))
    return F.when((F.size(parts) > 1) & (title_key(F.get(parts, 0)) == key) & (rest != ""), rest).otherwise(strip(cell))


def hoist_titles(c, lookback: int = 6) -> Column:
    """A table's title that is repeated in its header cells becomes a heading above it, unless one of the last lines has it."""
    return let(F.coalesce(col(c), F.lit("")), lambda x: F.when(x.rlike("(?i)<br") & F.contains(x, F.lit("--")), let(_lines(x), lambda lines: _hoist(lines, lookback))).otherwise(x))


def _hoist(lines: Column, lookback: int) -> Column:
    known = F.transform(lines, lambda x, i: F.struct(x.alias("line"), F.when(F.contains(x, F.lit("|")) & is_separator(F.get(lines, i + 1)), repeated_title(starred_cells(x))).alias("t")))

    def add(out: Column, x: Column) -> Column:
        cells = F.transform(starred_cells(x["line"]), lambda v: without_title(v, x["t"]["key"]))
        row = F.concat(F.lit("| "), F.array_join(F.transform(cells, lambda v: F.when(v == "", " ").otherwise(v)), " | "), F.lit(" |"))
        told = F.filter(out, lambda y: (strip(y) != "") & ~strip(y).startswith("<!--"))
        recent = F.slice(told, F.greatest(F.size(told) - (lookback - 1), F.lit(1)), lookback)
        there = F.exists(recent, lambda y: F.contains(title_key(strip(y)), x["t"]["key"]))
        gap = F.when((F.size(out) > 0) & (strip(F.coalesce(F.get(out, F.size(out) - 1), F.lit(""))) != ""), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
        above = F.when(there, F.array().cast("array<string>")).otherwise(F.concat(gap, F.array(F.concat(F.lit("## "), x["t"]["title"]), F.lit(""))))
        return F.when(x["t"].isNull(), F.concat(out, F.array(x["line"]))).otherwise(F.concat(out, above, F.array(row)))

    return _join(F.aggregate(known, F.array().cast("array<string>"), add))


def is_false_table(lines: Column) -> Column:
    """Whether a run of table lines is really text: no header word, at most two columns, and many empty cells, numbered
    first cells, or one or two words on the right."""
    return let(F.transform(F.filter(lines, lambda x: F.contains(x, F.lit("|")) & ~is_separator(x)), starred_cells), _is_false)


def _is_false(rows: Column) -> Column:
    return (F.size(rows) > 0) & (F.array_max(F.transform(rows, F.size)) <= 2) & let(F.flatten(rows), lambda cells: _is_text(rows, cells))


def _is_text(rows: Column, cells: Column) -> Column:
    right = F.filter(F.flatten(F.transform(rows, lambda r: F.slice(r, 2, F.size(r)))), lambda x: x != "")
    hinted = let(F.lower(F.array_join(cells, " ")), lambda x: any_within(x, HEADER_HINTS))
    empty = F.size(F.filter(cells, lambda x: x == "")) / F.greatest(F.size(cells), F.lit(1))
    numbered = F.exists(rows, lambda r: strip(F.get(r, 0)).rlike(SECTION_CELL))
    short = let(right, lambda right: F.size(F.filter(right, lambda x: _words(x) <= 2)) / F.greatest(F.size(right), F.lit(1)) >= 0.7)
    return ~hinted & ((empty >= 0.35) | numbered | short)


def plain_rows(lines: Column) -> Column:
    texts = F.transform(F.filter(lines, lambda x: ~is_separator(x)), lambda x: strip(F.array_join(F.filter(starred_cells(x), lambda v: v != ""), " ")))
    return F.filter(texts, lambda x: x != "")


def repair_false_tables(c) -> Column:
    """Runs of table lines that are no tables become text. If a run as a whole is a table, what remains of it after its
    first line is looked at again, and so on: the first rest that is none becomes text."""

    # a rest that is none has a separator, two lines at least, and no row of more than two cells: only these are looked at
    def bounds(run: Column) -> Column:
        def wide(x: Column) -> Column:
            return F.length(x) - F.length(F.replace(x, F.lit("|"), F.lit(""))) - x.startswith("|").cast("int") - x.endswith("|").cast("int") + 1 > 2

        seps = F.transform(run, is_separator)
        return let(seps, lambda seps: F.struct(
            F.array_max(F.transform(run, lambda x, i: F.when(~F.get(seps, i) & let(strip(x), wide), i + 1).otherwise(0))).alias("wide"), F.array_max(F.transform(seps, lambda x, i: F.when(x, i + 1).otherwise(0))).alias("sep")))

    def fix(run: Column) -> Column:
        return let(bounds(run), lambda b: let(F.least(b["sep"], F.size(run) - 1), lambda last: F.when(b["wide"] + 1 <= last, cut(run, b["wide"] + 1, last)).otherwise(run)))

    def cut(run: Column, low: Column, last: Column) -> Column:
        n = F.size(run)
        able = lambda i: ~strip(F.get(run, i - 1)).startswith("<!--") & is_false_table(F.slice(run, i, n))
        first = F.get(F.filter(F.sequence(low, last), able), 0)
        return let(first, lambda f: F.when(f.isNull(), run).otherwise(F.concat(F.slice(run, 1, f - 1), plain_rows(F.slice(run, f, n)))))

    fixed = lambda runs: _join(F.flatten(F.transform(runs, lambda r: F.when(r["on"], fix(r["lines"])).otherwise(r["lines"]))))
    return let(F.coalesce(col(c), F.lit("")), lambda x: F.when(F.contains(x, F.lit("--")) & F.contains(x, F.lit("|")), let(_runs(_lines(x), lambda y: F.contains(y, F.lit("|"))), fixed)).otherwise(x))


def parsed_markdown(df: DataFrame, column: str = "markdown", false_tables: bool = True) -> DataFrame:
    """The Markdown of a remote parser: titles hoisted, false tables undone, white space and headings set, then ``finish``."""
    steps = [lambda x: sub(F.coalesce(x, F.lit("")), "\r\n?", "\n"), hoist_titles, *([repair_false_tables] if false_tables else []), _spaced, _headed]
    return _steps(finish(_steps(df, column, steps), column), column, (lambda x: F.concat(strip(x), F.lit("\n")),))


def _spaced(c: Column) -> Column:
    return _join(F.transform(_lines(c), lambda y: F.when(F.contains(y, F.lit("|")) & y.rlike(r"(?Ud)^\s*\|?.+\|"), rstrip(y)).otherwise(strip(sub(y, "[ \t]{2,}|\t", " ")))))


def _headed(c: Column) -> Column:
    def head(y: Column, in_table: Column) -> Column:
        s = strip(y)
        return F.when(~in_table & (s != "") & ~s.startswith("#") & ~s.startswith("<!-- page:") & s.rlike(HEADINGS), F.concat(F.lit("## "), s)).otherwise(y)

    inside = lambda lines: _in_table(lines, lambda y: F.contains(y, F.lit("|")) & strip(y).rlike(r"(?Ud)^\|?.+\|"))
    headed = lambda x: let(_lines(x), lambda lines: _join(F.zip_with(lines, inside(lines), head)))
    return sub(let(F.coalesce(col(c), F.lit("")), lambda x: F.when(any_within(x, HEADING_WORDS), headed(x)).otherwise(x)), "\n{3,}", "\n\n")
