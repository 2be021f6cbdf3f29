"""Queries over noisy lines, pages and documents, with SQL that works each result out from the text.

The inputs have nulls, blank texts, ties and several misreadings to a line; Spark and DuckDB both run their SELECT.
"""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from .functions import rules
from .operators import boxes, metadata, pages, review, tables
from .plans import documents
from .queries import derived, digest, q_clean, q_line, q_strip, query, table
from .sources.engines import Config

NOISY = """
SELECT o_orderkey AS line_id, CASE CAST(o_orderkey % 29 AS INT)
  WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '   '
  WHEN 3 THEN concat('● Mục ( ', CAST(o_custkey % 90 AS STRING), ' ) , xem [ a ]  ; „b‟ — c')
  WHEN 4 THEN concat('Căn  cử quyết định, đảo tạo kỳ han ', CAST(o_custkey % 9 AS STRING), '; thạc sỹ đóng dầu')
  WHEN 5 THEN concat('TIN DỤNG: tin  dụng và bộ tài chính, bộ giáo dục và đào tạo ', o_orderstatus)
  WHEN 6 THEN concat('Theo số', CAST(o_custkey % 90 AS STRING), '/QĐ và Số16 ngày5 tháng 2')
  WHEN 7 THEN concat('Phòng CTSVthông báo SVnộp, Khoatổng hợp, đơn vịquản lý ', CAST(o_custkey % 7 AS STRING))
  WHEN 8 THEN concat('Khoa Luật? Trường Kinh tế', CAST(o_custkey % 9 AS STRING), ' ? Ban')
  WHEN 9 THEN concat('Truong Dai hoc Can Tho, Phong Dao tao P.  CTSV va DHCT ', CAST(o_custkey % 5 AS STRING))
  WHEN 10 THEN concat('Liên hệ abc', CAST(o_custkey % 90 AS STRING), '@ctu.edu.vn www. ctu.edu.vn')
  WHEN 11 THEN concat('Điện thoại: 0292 38', CAST(o_custkey % 90 + 10 AS STRING), ' 872 728 hoặc email')
  WHEN 12 THEN concat('Scanned with CamScanner', chr(10), 'dòng ', CAST(o_custkey % 50 AS STRING), chr(10), 'CamScanner', chr(10), chr(10), chr(10), chr(10), 'hết')
  WHEN 13 THEN concat('bước $', chr(92), 'rightarrow$ hai &rarr; ba ', chr(92), chr(92), '* bốn thông bá[] ', CAST(o_custkey % 5 AS STRING))
  WHEN 14 THEN concat('**1.1 Mục đích ', CAST(o_custkey % 5 AS STRING), '**', chr(10), '**2. Phạm vi**', chr(10), '| **3. Ô** | x |', chr(10), '**4. Trong bảng**', chr(10), chr(10), '**5. Ngoài**')
  WHEN 15 THEN concat('scanned with cs', chr(10), 'giữ  ', CAST(o_custkey % 5 AS STRING), chr(10), '  CamScanner  ', chr(10), 'x CamScanner')
  WHEN 16 THEN concat('a"b”c “d" ', CAST(o_custkey % 5 AS STRING), ' QĐsố CVHTvà')
  WHEN 17 THEN concat('<!-- page: ', CAST(o_custkey % 9 + 1 AS STRING), ' -->', chr(10), chr(10), 'thân ', o_orderstatus, chr(10), '<!-- page: 12 -->', chr(10), 'đuôi')
  WHEN 18 THEN concat('- Khoa ', CAST(o_custkey % 40 AS STRING), ' abc và KHOA 7 abc')
  WHEN 19 THEN concat('việt nam, nhà nước việt nam, chính phủ ', CAST(o_custkey % 9 AS STRING))
  WHEN 20 THEN concat('Nam □ Nữ ........ ', CAST(o_custkey % 9 AS STRING), ' ____ Ngày sinh')
  WHEN 21 THEN concat('(Qctu ', CAST(o_custkey % 9 AS STRING)) WHEN 22 THEN 'http://ctu' WHEN 23 THEN 'không có gì'
  WHEN 24 THEN concat('dòng ', chr(13), chr(10), ' hai', chr(9), chr(9), 'ba ', CAST(o_custkey % 9 AS STRING), chr(13), 'bốn')
  WHEN 25 THEN concat('CCD số ', CAST(o_custkey AS STRING), ' và việt nam') WHEN 26 THEN 'QUYET DINH, SINH VIEN HOC VU'
  WHEN 27 THEN concat('7. TÊN ........ ', CAST(o_custkey % 60 AS STRING)) ELSE concat('văn bản ', CAST(floor(o_totalprice) AS INT)) END AS line
FROM orders
"""

# ---- SQL of the rules: RE2 knows word borders in ASCII only, so letters beside a match are named ------------------------
_EDGE = r"[^\p{L}\p{M}\p{N}_]"


def _text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def q_rule(x: str, pattern: str, to: str, flags: str = "gi") -> str:
    """One rule; its word borders become groups of their own, and its groups move up."""
    front, back = pattern.startswith(r"\b"), pattern.endswith(r"\b")
    body = pattern.removeprefix(r"\b")
    body = body.removesuffix(r"\b") if back else body
    groups = len(re.findall(r"\((?!\?)", body))
    to = re.sub(r"\$(\d)", lambda m: "\\" + str(int(m[1]) + front), to)
    to = (r"\1" if front else "") + to + (f"\\{groups + front + 1}" if back else "")
    return f"regexp_replace({x}, {_text((f'(^|{_EDGE})' if front else '') + body + (f'($|{_EDGE})' if back else ''))}, {_text(to)}, '{flags}')"


def q_rules(x: str, table_: tuple) -> str:
    for pattern, to in table_:
        x = q_rule(x, pattern, to)
    return x


def q_glyphs(x: str) -> str:
    x = f"translate(coalesce({x}, ''), '●·▪—−„‟' || chr(61607) || chr(61485), '•••––“”•-')"
    x = f"replace(replace({x}, '''''', '\"'), '``', '\"')"
    x = rf"regexp_replace({x}, '\s+([,.;:!?])', '\1', 'g')"
    x = rf"regexp_replace({x}, '([(\[{{“])\s+', '\1', 'g')"
    return q_clean(rf"regexp_replace({x}, '\s+([)\]}}”])', '\1', 'g')")


def q_addresses(x: str) -> str:
    x = rf"regexp_replace(coalesce({x}, ''), '([A-Za-z0-9._%+\-]+)\s*[\(\[]?\s*(?:@|Q|O|0|©|ⓐ)\s*([A-Za-z0-9.\-]+\.(?:vn|com|edu\.vn|org|net))', '\1@\2', 'gi')"
    return rf"regexp_replace(regexp_replace(regexp_replace({x}, '(https?://)\s+', '\1', 'gi'), '(www\.)\s+', '\1', 'gi'), '\s+(/\S*)', '\1', 'g')"


def q_phones(x: str) -> str:
    """Of the first phone number of a text, which has no more than one."""
    p = r"(?is)^(.*?)(ĐT\s*:?\s*|Điện thoại\s*:?\s*)([0-9][0-9 .\-]{7,})(.*)$"
    part = lambda k: f"regexp_extract({x}, '{p}', {k})"
    return rf"CASE WHEN regexp_matches({x}, '{p}') THEN {part(1)} || {part(2)} || regexp_replace({part(3)}, '\s+', '', 'g') || {part(4)} ELSE {x} END"


def q_spaces(x: str) -> str:
    x = q_rule(f"coalesce({x}, '')", r"\b(số|Số)(\d)", "$1 $2", "g")
    x = q_rule(x, r"\b(ngày)(\d{1,2})\b", "$1 $2")
    x = rf"""regexp_replace(regexp_replace({x}, '([A-Za-zÀ-ỹ0-9])([“"])', '\1 \2', 'g'), '([”"])([A-Za-zÀ-ỹ0-9])', '\1 \2', 'g')"""
    for short in ("CTSV", "ĐRL", "CVHT", "QĐ", "BGH", "SV", "CTCT", "KHTH", "SQDB", "TTGDQP", "QK9"):
        x = q_rule(x, rf"\b({short})([A-Za-zÀ-ỹ])", "$1 $2", "g")
    return q_clean(q_rules(x, rules.GLUED))


def q_dashes(x: str) -> str:
    return rf"replace(regexp_replace(coalesce({x}, ''), '([A-Za-zÀ-ỹ0-9\)]+(?:\s+[A-Za-zÀ-ỹ0-9\)]+){{0,4}})\?\s+([A-ZĐÀ-Ỹ][A-Za-zÀ-ỹ0-9]+)', '\1 – \2', 'g'), ' ? ', ' – ')"


def q_user(x: str) -> str:
    return q_clean(rf"regexp_replace(replace(coalesce({x}, ''), 'abc', 'xyz$1'), '(khoa) (\d+)', '\2-\1', 'gi')")


def q_chain(source: str, key: str, column: str, steps) -> str:
    """A SELECT of (key, t): each step is a table of its own, so that no expression is repeated inside another."""
    parts = [f"s0 AS (SELECT {key}, {column} AS t FROM ({source}))"]
    parts += [f"s{i + 1} AS (SELECT {key}, {step('t')} AS t FROM s{i})" for i, step in enumerate(steps)]
    return f"WITH {', '.join(parts)} SELECT {key}, t FROM s{len(steps)}"


def q_general(x=None) -> tuple:
    return (q_glyphs, q_addresses, q_phones, lambda x: q_rules(x, rules.GENERAL), q_spaces, q_dashes, q_glyphs, lambda x: rf"regexp_replace(regexp_replace({x}, '(?im)^\s*Scanned\s+with\s+(?:cs\s*)?CamScanner\s*$', '', 'g'), '(?im)^\s*CamScanner\s*$', '', 'g')", q_clean)


USER = '{"replace": {"abc": "xyz$1"}, "regex_replace": [{"pattern": "(khoa) (\\\\d+)", "replacement": "\\\\2-\\\\1", "flags": "i"}, {"pattern": "(", "replacement": ""}]}'


def _noisy(spark, sf_dir):
    return derived(spark, sf_dir, NOISY)


def _out(t, c, name="line"):
    return t.select("line_id", c.alias(name))


# ---- rewrite rules --------------------------------------------------------------------------------------------------
@query(f"SELECT line_id, {q_glyphs('line')} AS line FROM ({NOISY})")
def fix_glyphs(spark, sf_dir):
    return _out(_noisy(spark, sf_dir), rules.fix_glyphs("line"))


@query(f"SELECT line_id, {q_rules(chr(99) + 'oalesce(line, ' + chr(39) * 2 + ')', rules.GENERAL)} AS line FROM ({NOISY})")
def fix_terms(spark, sf_dir):
    return _out(_noisy(spark, sf_dir), rules.fix_terms("line"))


@query(f"SELECT line_id, {q_spaces('line')} AS line FROM ({NOISY})")
def fix_spaces(spark, sf_dir):
    return _out(_noisy(spark, sf_dir), rules.fix_spaces("line"))


@query(f"SELECT line_id, {q_dashes('line')} AS line FROM ({NOISY})")
def fix_dashes(spark, sf_dir):
    return _out(_noisy(spark, sf_dir), rules.fix_dashes("line"))


@query(f"SELECT line_id, t AS line FROM ({q_chain(NOISY, 'line_id', 'line', q_general())})")
def general_layer(spark, sf_dir):
    return _out(_noisy(spark, sf_dir), rules.general_layer("line"))


@query(f"SELECT line_id, {q_clean(q_rules(chr(99) + 'oalesce(line, ' + chr(39) * 2 + ')', rules.TERMS))} AS line FROM ({NOISY})")
def terms_layer(spark, sf_dir):
    return _out(_noisy(spark, sf_dir), rules.terms_layer("line"))


@query(f"SELECT line_id, {q_user('line')} AS line FROM ({NOISY})")
def user_layer(spark, sf_dir):
    return _out(_noisy(spark, sf_dir), rules.user_layer("line", rules.UserRules.parse(USER)))


@query(rf"""SELECT line_id, regexp_matches({q_line('line')}, '(?i)\?|Email|ĐT|Điện thoại|www|http|\(Q|\sQ[A-Za-z0-9]|[A-Za-z0-9._%+\-]+\s+[QO0]\s*[A-Za-z0-9.\-]+\.(?:vn|com|edu\.vn)') AS odd FROM ({NOISY})""")
def is_suspicious(spark, sf_dir):
    return _out(_noisy(spark, sf_dir), rules.is_suspicious("line"), "odd")


@query(f"SELECT line_id, t AS line FROM ({q_chain(NOISY, 'line_id', 'line', (q_clean, *q_general(), lambda x: q_clean(q_rules(x, rules.TERMS)), q_user, q_clean))})")
def repair_text(spark, sf_dir):
    return _out(_noisy(spark, sf_dir), rules.repair("line", user=rules.UserRules.parse(USER)))


_A, _B = (q_chain(NOISY, "line_id", c, q_general()) for c in ("line", "CASE WHEN line_id % 5 = 0 THEN NULL ELSE replace(replace(line, '?', ' –'), 'abc', 'a@b.vn abcdef') END"))


@query(f"""SELECT line_id, CASE WHEN b <> '' AND ((contains(b, '@') AND NOT contains(a, '@')) OR length(b) - length(replace(b, '?', '')) < length(a) - length(replace(a, '?', ''))
  OR (length(b) > length(a) + 5 AND NOT contains(b, '?'))) THEN b ELSE a END AS text FROM (SELECT line_id, t AS a FROM ({_A})) JOIN (SELECT line_id, t AS b FROM ({_B})) USING (line_id)""")
def better_line(spark, sf_dir):
    second = F.when(F.col("line_id") % 5 != 0, F.replace(F.replace("line", F.lit("?"), F.lit(" –")), F.lit("abc"), F.lit("a@b.vn abcdef")))
    return _out(_noisy(spark, sf_dir), boxes.better_text("line", second), "text")


# ---- finished Markdown ----------------------------------------------------------------------------------------------
_SPLIT = r"string_split(regexp_replace(replace(replace(coalesce(line, ''), chr(13) || chr(10), chr(10)), chr(13), chr(10)), '\n$', ''), chr(10))"


@query(rf"""SELECT line_id, CASE WHEN coalesce(line, '') = '' THEN '' ELSE array_to_string(list_transform(list_filter({_SPLIT}, lambda x: NOT regexp_full_match({q_line('x')}, '(?i)(scanned\s+with\s+(cs\s*)?camscanner|scanned\s+with\s+cs|camscanner)')),
  lambda x: regexp_replace(x, '\s+$', '')), chr(10)) END AS line FROM ({NOISY})""")
def scanner_lines(spark, sf_dir):
    return _out(_noisy(spark, sf_dir), tables.without_scanner_lines("line"))


_ART = "coalesce(line, '')"
for _p, _t in ((r"\$\s*\\(to|rightarrow|Rightarrow)\s*\$", "→"), (r"\\rightarrow|&rarr;|&rightarrow;", "→"), (r"\\{2,}\*", "*"), (r"\\\*", "*"), (r"([A-Za-zÀ-ỹ])\[\]([A-Za-zÀ-ỹ])", r"\1\2")):
    _ART = f"regexp_replace({_ART}, '{_p}', '{_t}', 'g')"
for _p, _t in tables.ARTIFACTS:
    _ART = f"replace({_ART}, {_text(_p)}, {_text(_t)})"


@query(f"SELECT line_id, {_ART} AS line FROM ({NOISY})")
def artifacts(spark, sf_dir):
    return _out(_noisy(spark, sf_dir), tables.without_artifacts("line"))


# a line is in a table if of the lines up to it the last table line comes after the last blank one
_BOLD = rf"""WITH l AS (SELECT line_id, unnest({_SPLIT}) AS x, unnest(range(len({_SPLIT}))) AS i FROM ({NOISY}) WHERE coalesce(line, '') <> '' AND NOT contains(line, chr(13))),
m AS (SELECT line_id, i, regexp_replace(x, '\s+$', '') AS x, {q_strip('x')} AS s FROM l),
n AS (SELECT *, coalesce(max(CASE WHEN starts_with(s, '|') AND length(s) - length(replace(s, '|', '')) >= 2 THEN i END) OVER w, -1) > coalesce(max(CASE WHEN s = '' THEN i END) OVER w, -1) AS inside FROM m WINDOW w AS (PARTITION BY line_id ORDER BY i)),
o AS (SELECT line_id, i, CASE WHEN inside OR s = '' OR starts_with(s, '<!--') THEN x
  WHEN regexp_matches(s, '^\*\*(\d+(\.\d+)+\s+.+?)\*\*\s*$') THEN '##### ' || regexp_replace(regexp_extract(s, '^\*\*(\d+(\.\d+)+\s+.+?)\*\*\s*$', 1), '[ :]+$', '') || CASE WHEN ends_with(rtrim(regexp_extract(s, '^\*\*(\d+(\.\d+)+\s+.+?)\*\*\s*$', 1)), ':') THEN ':' ELSE '' END
  WHEN regexp_matches(s, '^\*\*(\d+\.\s+.+?)\*\*\s*$') THEN '#### ' || trim(regexp_extract(s, '^\*\*(\d+\.\s+.+?)\*\*\s*$', 1)) ELSE x END AS y FROM n)
SELECT line_id, string_agg(y, chr(10) ORDER BY i) AS line FROM o GROUP BY line_id"""


@query(_BOLD)
def bold_headings(spark, sf_dir):
    return _out(_noisy(spark, sf_dir).where("coalesce(line, '') != '' and not contains(line, '\\r')"), tables.bold_headings("line"))


# ---- pages ----------------------------------------------------------------------------------------------------------
@query(rf"""SELECT line_id, {q_strip(r"regexp_replace(array_to_string(list_transform(CASE WHEN coalesce(line, '') = '' THEN [] ELSE " + _SPLIT + r" END, lambda x: regexp_replace(x, '\s+$', '')), chr(10)), '<!--\s*page\s*:\s*\d+\s*-->', '', 'g')")} AS line FROM ({NOISY})""")
def stripped_markers(spark, sf_dir):
    return _out(_noisy(spark, sf_dir), pages.strip_markers("line"))


# blocks of two engines: of a page that both have, the remote one's; pages of neither get a placeholder
_BLOCKS = "SELECT l_orderkey AS doc_id, l_linenumber AS page_no, min(CASE WHEN l_returnflag = 'R' THEN concat('remote ', CAST(l_partkey AS STRING)) END) AS remote, min(CASE WHEN l_linestatus = 'F' THEN concat('local ', CAST(l_suppkey AS STRING)) END) AS local FROM lineitem GROUP BY l_orderkey, l_linenumber"


@query(f"SELECT doc_id, CAST(page_no AS BIGINT) AS page_no, coalesce(remote, local) AS block FROM ({_BLOCKS}) WHERE remote IS NOT NULL OR local IS NOT NULL")
def merged_blocks(spark, sf_dir):
    t = derived(spark, sf_dir, _BLOCKS)
    side = lambda c: t.where(F.col(c).isNotNull()).select("doc_id", "page_no", F.col(c).alias("block"))
    return pages.merge_blocks(side("local"), side("remote")).withColumn("page_no", F.col("page_no").cast("long"))


_GIVEN = "1, 3-4, , 6-5"


@query(f"""WITH raw AS (SELECT l_orderkey AS doc_id, l_linenumber AS page_no, min(l_returnflag) AS f, min(l_suppkey) AS k FROM lineitem GROUP BY ALL),
b AS (SELECT doc_id, page_no, '<!-- page: ' || page_no || ' -->' || chr(10) || chr(10) || CASE
  WHEN page_no IN (1, 3, 4, 5, 6) THEN CASE WHEN f = 'A' THEN '[this page could not be read]' ELSE '<!-- extraction: remote_parser -->' || chr(10) || chr(10) || 'bản gốc ' || k END
  ELSE '<!-- extraction: text -->' || chr(10) || chr(10) || 'Trang này có nội dung số ' || k || ' dài hơn ba mươi chữ cái.' END AS block FROM raw)
SELECT doc_id, md5(string_agg(block, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY page_no) || chr(10)) AS markdown FROM b GROUP BY doc_id""")
def routed_documents(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("page_no")).agg(F.min("l_returnflag").alias("f"), F.min("l_suppkey").alias("k"))
    raw = t.select("doc_id", "page_no", F.concat(F.lit("Trang này có nội dung số "), "k", F.lit(" dài hơn ba mươi chữ cái.")).alias("text"), F.lit(None).cast("string").alias("ocr_text"))
    parsed = t.where("f != 'A'").select("doc_id", "page_no", F.concat(F.lit("<!-- page: 9 -->\n\nbản gốc "), "k").alias("markdown"))
    config = Config(table_pages=_GIVEN, check_text=False, drop_repeated=False)
    return documents.routed_documents(raw, t.select("doc_id", "page_no"), parsed, config).select("doc_id", digest("markdown").alias("markdown"))


@query("SELECT o_orderkey AS doc_id, '# PDF / Image Text Document' || chr(10) || chr(10) || '## Metadata' || chr(10) || chr(10) || '- Source: ' || o_orderpriority || chr(10) || '- Pages: ' || coalesce(CAST(nullif(o_custkey % 4, 0) AS VARCHAR), '') || chr(10) || chr(10) || '## Extracted Text' || chr(10) AS head FROM orders")
def preamble(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), pages.preamble({"Source": F.col("o_orderpriority"), "Pages": F.nullif(F.col("o_custkey") % 4, F.lit(0))}).alias("head"))


# ---- metadata -------------------------------------------------------------------------------------------------------
EMBEDDED = """
SELECT o_orderkey AS doc_id, CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN 'no such part' ELSE concat('# T', chr(10), '## Metadata', chr(10), chr(10), '- Local parser: `tool ', CAST(o_custkey % 4 AS STRING), '`', chr(10), '-  CHECKSUM :  a:b ', chr(10), 'not a pair', chr(10),
  CASE WHEN o_orderkey % 2 = 0 THEN concat('- Table parser: remote', chr(10), '- checksum: last', chr(10)) ELSE '' END, '## Extracted Text', chr(10), '- local parser: not this one') END AS body FROM orders
"""
_PARSERS = "CASE WHEN body IS NULL OR NOT contains(body, '## Metadata') THEN NULL ELSE 'local=' || regexp_extract(body, '- Local parser: `([^`]*)`', 1) || CASE WHEN contains(body, '- Table parser: remote') THEN '; table_pages=remote' ELSE '' END END"


@query(f"SELECT doc_id, CASE WHEN body IS NULL OR NOT contains(body, '## Metadata') THEN NULL WHEN contains(body, '- checksum: last') THEN 'last' ELSE 'a:b' END AS checksum, {_PARSERS} AS parser, contains(coalesce(body, ''), '## Metadata') AS extracted FROM ({EMBEDDED})")
def embedded_metadata(spark, sf_dir):
    t = derived(spark, sf_dir, EMBEDDED).withColumn("m", metadata.embedded("body"))
    return t.select("doc_id", F.try_element_at("m", F.lit("checksum")).alias("checksum"), metadata.split_parser(F.col("m")).alias("parser"), metadata.looks_extracted("body", F.col("m")).alias("extracted"))


_KINDS = "CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'a/b.DOC' WHEN 2 THEN 'x.tiff' WHEN 3 THEN 'y.epub' WHEN 4 THEN 'none' ELSE 'p/q.md' END"


@query(f"SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN o_orderpriority WHEN 1 THEN 'docx' WHEN 2 THEN 'image' WHEN 3 THEN 'epub' WHEN 4 THEN '' ELSE 'md' END AS kind, CASE WHEN o_orderkey % 4 = 0 THEN 'd' || o_custkey ELSE 'd' || o_custkey || '-' || substr(md5(o_orderpriority), 1, 12) END AS version FROM orders")
def file_types(spark, sf_dir):
    t = table(spark, sf_dir, "orders").withColumn("path", F.expr(_KINDS)).withColumn("id", F.concat(F.lit("d"), "o_custkey"))
    return t.select("o_orderkey", metadata.file_type("path", "o_orderpriority").alias("kind"), metadata.version_id("id", F.when(F.col("o_orderkey") % 4 == 0, "").otherwise(F.md5("o_orderpriority"))).alias("version"))


_VALUES = "CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN concat('plain-', CAST(o_custkey AS STRING)) WHEN 3 THEN concat('two words ', o_orderstatus) WHEN 4 THEN 'a \"quote\" here' WHEN 5 THEN concat('back', chr(92), 'slash') ELSE 'mục lục' END"
_QUOTED = r"""CASE WHEN v IS NULL THEN '' WHEN regexp_full_match(v, '[A-Za-z0-9_.-]+') THEN ' ' || v ELSE ' "' || replace(replace(v, chr(92), chr(92) || chr(92)), '"', chr(92) || '"') || '"' END"""
_DUMPED = " || ".join(f"'{f}:' || " + ({"title": _QUOTED, "audience": f"CASE WHEN v IS NULL THEN ' []' ELSE chr(10) || '  -' || {_QUOTED} || chr(10) || '  - b' END", "is_latest": "CASE WHEN k % 2 = 0 THEN ' true' ELSE ' false' END"}.get(f, "''")) + " || chr(10)" for f in metadata.FIELDS)


@query(f"SELECT k AS o_orderkey, '---' || chr(10) || {_DUMPED} || '---' || chr(10) || chr(10) AS front FROM (SELECT o_orderkey AS k, {_VALUES} AS v FROM orders)")
def front_matter_text(spark, sf_dir):
    t = table(spark, sf_dir, "orders").withColumn("v", F.expr(_VALUES))
    audience = F.when(F.col("v").isNull(), F.array().cast("array<string>")).otherwise(F.array("v", F.lit("b")))
    return t.select("o_orderkey", metadata.dump({"title": F.col("v"), "is_latest": F.col("o_orderkey") % 2 == 0}, {"audience": audience}).alias("front"))


# ---- review ---------------------------------------------------------------------------------------------------------
_HITS = rf"""WITH n AS (SELECT line_id, {q_line('line')} AS s, line FROM ({NOISY}) WHERE line IS NOT NULL AND NOT contains(line, chr(10)) AND NOT contains(line, chr(13)))
SELECT line_id, 'question_mark' AS rule, 'line 1: a ? is left: ' || s AS message FROM n WHERE contains(s, '?')
UNION ALL SELECT line_id, 'mixed_number', 'line 1: digits and letters mixed: ' || s FROM n WHERE regexp_matches(s, '(^|{_EDGE})[0-9]+[A-Za-z][0-9]+($|{_EDGE})')
UNION ALL SELECT line_id, 'email', 'line 1: an address without @: ' || s FROM n WHERE regexp_matches(s, '(?i)email') AND NOT contains(s, '@')"""


@query(_HITS)
def review_messages(spark, sf_dir):
    """Whole messages of lines without a document number, which ``review_warnings`` has."""
    t = _noisy(spark, sf_dir).where("line is not null and not contains(line, '\n') and not contains(line, '\r')").withColumnRenamed("line_id", "doc_id")
    return review.warnings(t, "line").where("rule != 'document_number'").select(F.col("doc_id").alias("line_id"), "rule", "message")


@query(f"SELECT line_id, '# OCR Review Report' || chr(10) || chr(10) || string_agg('- ' || message, chr(10) ORDER BY CASE rule WHEN 'question_mark' THEN 1 WHEN 'mixed_number' THEN 2 ELSE 3 END) AS report FROM ({_HITS}) GROUP BY line_id")
def review_reports(spark, sf_dir):
    t = _noisy(spark, sf_dir).where("line is not null and not contains(line, '\n') and not contains(line, '\r')").withColumnRenamed("line_id", "doc_id")
    return review.report(review.warnings(t, "line").where("rule != 'document_number'")).withColumnRenamed("doc_id", "line_id")


# ---- routing --------------------------------------------------------------------------------------------------------
@query("SELECT l_orderkey AS doc_id, l_linenumber AS page_no, CASE WHEN l_linenumber IN (1, 3, 4, 5, 6) THEN 'remote' ELSE 'local' END AS engine FROM lineitem GROUP BY ALL")
def routed_by_list(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("page_no")).distinct()
    return documents.routed_pages(t, Config(table_pages=_GIVEN))
