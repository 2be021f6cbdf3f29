"""Document metadata as front matter: reading, building, writing, validating.

Read metadata is a map from key to struct(kind, text, items): kind is one of null, text, bool, list. So a missing key, an
empty value and a list stay apart, which the validation depends on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import any_within, col, file_ext, file_stem, first_non_empty, let, name_key, rstrip, slug, split_lines, strip, sub

# ---- fixed values -------------------------------------------------------------------------------------------------
FIELDS = ("document_id", "version_id", "title", "document_type", "domain", "department", "audience", "code", "issued_date", "effective_date", "expiry_date", "version", "is_latest", "validity_status", "replaces", "replaced_by", "collection_status", "ocr_status", "review_status", "rag_status", "source_url", "source_file", "file_type", "accessed_date", "language", "confidentiality", "priority", "citation_type", "chunking_strategy", "created_at", "updated_at", "checksum", "parser", "ocr_engine", "notes")
HUMAN_TEXT = ("title", "document_type", "domain", "department", "code", "version", "source_url", "confidentiality")
HUMAN_NULL = ("issued_date", "effective_date", "expiry_date", "replaces", "replaced_by", "accessed_date", "notes")
SOURCE_EXTS = (".pdf", ".doc", ".docx", ".png", ".jpg", ".jpeg", ".tif", ".tiff", ".bmp", ".webp", ".xlsx", ".csv", ".html")
FILE_TYPES = {".pdf": "pdf", ".doc": "docx", ".docx": "docx", ".md": "md", ".html": "html", ".png": "image", ".jpg": "image", ".jpeg": "image", ".tif": "image", ".tiff": "image", ".bmp": "image", ".webp": "image", ".xlsx": "xlsx", ".csv": "csv"}
ENUMS = {
    "collection_status": ("link_collected", "collected", "downloaded", "missing", "failed"),
    "ocr_status": ("not_started", "processing", "done", "failed", "need_review", "not_required"),
    "review_status": ("not_reviewed", "reviewing", "need_fix", "approved", "rejected"),
    "validity_status": ("unchecked", "valid", "expired", "replaced", "unknown"),
    "rag_status": ("not_indexed", "chunked", "embedded", "indexed", "published", "deactivated", "failed"),
    "document_type": ("noi_quy", "quy_trinh", "bieu_mau", "hoi_dap", "huong_dan", "huong_dan_metadata", "huong_dan_quan_tri", "huong_dan_theo_doi", "ghi_chu_nghien_cuu"),
    "file_type": ("pdf", "docx", "md", "html", "image", "xlsx", "csv", "url", "youtube"),
    "confidentiality": ("public", "internal", "restricted"),
    "priority": ("low", "medium", "high"),
    "citation_type": ("page", "section", "none"),
    "chunking_strategy": ("heading_aware_parent_child", "qa_based", "asset_based", "manual"),
}
REQUIRED = ("document_id", "version_id", "collection_status", "ocr_status", "review_status", "rag_status", "source_file", "file_type", "language", "priority", "citation_type", "chunking_strategy", "created_at", "updated_at", "checksum")
REVIEWED = ("title", "document_type", "domain", "department", "audience", "confidentiality")
OPTIONAL = ("code", "issued_date", "effective_date", "expiry_date", "version", "replaces", "replaced_by", "source_url", "accessed_date", "notes")
DATES = ("issued_date", "effective_date", "expiry_date", "accessed_date")
STEM_ENDS = ("_structured", "_rag_clean", "_clean", "_output")
OCR_SIGNS = ("## Extracted Text", "<!-- page:", "<!-- extraction:")
DEFAULTS = {"validity_status": "unchecked", "collection_status": "collected", "review_status": "not_reviewed", "rag_status": "not_indexed", "priority": "medium", "citation_type": "page", "chunking_strategy": "heading_aware_parent_child"}
# -------------------------------------------------------------------------------------------------------------------

VALUE = "struct<kind:string,text:string,items:array<struct<kind:string,text:string>>>"


def front_matter(c) -> Column:
    """struct(raw, body): the lines between a leading --- and the next ---, and what follows; raw is null without them."""
    x = F.coalesce(col(c), F.lit(""))
    pattern = r"(?s)\A---[ \t]*\r?\n(.*?)(?<=\n)[ \t]*---[ \t]*(?:\r?\n|\z)[\r\n]*(.*)\z"
    found = x.rlike(pattern)
    return F.struct(F.when(found, F.regexp_extract(x, pattern, 1)).alias("raw"), F.when(found, F.regexp_extract(x, pattern, 2)).otherwise(x).alias("body"))


def _scalar(x: Column) -> Column:
    """struct(kind, text) of a value: quotes are taken off, true and false are booleans, nothing is null."""
    quoted = x.rlike(r"""(?s)^"(?:.*)"$|^'(?:.*)'$""") & (F.length(x) >= 1)
    kind = F.when(x == "", "null").when(x == "[]", "list").when(quoted, "text").when(F.lower(x).isin("true", "false"), "bool").otherwise("text")
    text = F.when(x == "", F.lit(None)).when(quoted, F.substring(x, F.lit(2), F.greatest(F.length(x) - 2, F.lit(0)))).when(F.lower(x).isin("true", "false"), F.lower(x)).otherwise(x)
    return F.struct(kind.alias("kind"), text.alias("text"))


def parse_fields(raw) -> Column:
    """map key -> struct(kind, text, items) of front matter lines; the last value of a key wins, items belong to the key
    before them, and any other line ends that."""
    key, item = r"^([A-Za-z_][A-Za-z0-9_]*):(?:(?U)\s*(.*))?$", r"(?U)^\s*-\s*(.*)$"
    lines = F.filter(F.transform(split_lines(raw), rstrip), lambda x: (strip(x) != "") & ~strip(x).startswith("#"))
    start = F.struct(F.lit(None).cast("string").alias("key"), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast(f"array<{VALUE}>")).alias("all"))

    def step(acc: Column, x: Column) -> Column:
        is_item = x.rlike(item) & acc["key"].isNotNull()
        name = F.regexp_extract(x, key, 1)
        scalar = _scalar(strip(F.regexp_extract(x, key, 2)))
        none = F.array().cast("array<struct<kind:string,text:string>>")
        value = F.struct(scalar["kind"].alias("kind"), scalar["text"].alias("text"), none.alias("items"))
        held = F.try_element_at(acc["all"], acc["key"])
        added = _scalar(strip(F.regexp_extract(x, item, 1)))
        grown = F.struct(F.lit("list").alias("kind"), F.lit(None).cast("string").alias("text"), F.concat(F.when(held["kind"] == "list", held["items"]).otherwise(none), F.array(F.struct(added["kind"].alias("kind"), added["text"].alias("text")))).alias("items"))
        put = lambda k, v: F.map_concat(F.map_filter(acc["all"], lambda a, b: a != k), F.map_from_arrays(F.array(k), F.array(v.cast(VALUE))))
        is_key = x.rlike(key)
        return F.struct(
            F.when(is_item, acc["key"]).when(is_key, name).alias("key"),
            F.when(is_item, put(F.coalesce(acc["key"], F.lit("")), grown)).when(is_key, put(name, value)).otherwise(acc["all"]).alias("all"),
        )

    return F.when(col(raw).isNotNull(), F.aggregate(lines, start, step, lambda acc: acc["all"]))


def value_text(fields: Column, key: str) -> Column:
    """A value as text: empty for none, a list by commas."""
    v = F.try_element_at(fields, F.lit(key))
    return F.coalesce(F.when(v["kind"] == "list", F.array_join(F.transform(v["items"], lambda x: F.coalesce(x["text"], F.lit("None"))), ",")).otherwise(v["text"]), F.lit(""))


def is_empty(fields: Column, key: str) -> Column:
    v = F.try_element_at(fields, F.lit(key))
    return v.isNull() | (v["kind"] == "null") | ((v["kind"] == "list") & (F.size(v["items"]) == 0)) | ((v["kind"] == "text") & (v["text"] == ""))


def yaml_text(c: Column) -> Column:
    """A text as front matter writes it: bare if plain, else quoted with quotes and backslashes escaped."""
    escaped = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.when(c.isNull(), "").when(c.rlike(r"\A[A-Za-z0-9_.-]+\z"), c).otherwise(F.concat(F.lit('"'), escaped, F.lit('"')))


def dump(values: dict[str, Column], lists: dict[str, Column] | None = None) -> Column:
    """Front matter of all fields in order; null leaves the key alone, booleans are true or false."""
    lists = lists or {}
    lines = []
    for f in FIELDS:
        if f in lists:
            items = F.array_join(F.transform(lists[f], lambda x: F.concat(F.lit("  - "), yaml_text(x))), "\n")
            lines.append(F.when(F.size(lists[f]) > 0, F.concat(F.lit(f"{f}:\n"), items)).otherwise(F.lit(f"{f}: []")))
        else:
            v = values.get(f, F.lit(None)).cast("string")
            lines.append(F.when(v.isNull(), F.lit(f"{f}:")).otherwise(F.concat(F.lit(f"{f}: "), yaml_text(v))))
    return F.concat(F.concat_ws("\n", F.lit("---"), *lines, F.lit("---")), F.lit("\n\n"))


def embedded(c) -> Column:
    """map of the ``- key: value`` lines in a body's ``## Metadata`` section; keys in lower case, the last of a key wins."""
    return let(F.coalesce(col(c), F.lit("")), _embedded)


def _embedded(x: Column) -> Column:
    none = F.array().cast("array<struct<k:string,v:string>>")
    # every value is bound once: what a lambda names would be worked out again for each line
    return F.map_from_entries(F.when(F.contains(x, F.lit("## Metadata")), let(F.transform(split_lines(x), strip), _section)).otherwise(none))


def _section(lines: Column) -> Column:
    """The pairs of the lines from the section's heading to the next one."""
    pattern = r"(?Ud)^-\s*([^:]+):\s*(.*)\s*$"
    pair = lambda x: F.struct(F.lower(strip(F.regexp_extract(x, pattern, 1))).alias("k"), sub(strip(F.regexp_extract(x, pattern, 2)), "^`+|`+$", "").alias("v"))

    def until(rest: Column) -> Column:
        stop = F.array_position(F.transform(rest, lambda x: x.startswith("## ") & (x != "## Metadata")), True).cast("int")
        return let(stop, lambda n: F.when(n > 0, F.slice(rest, 1, n)).otherwise(rest))

    def last(pairs: Column) -> Column:
        return let(F.transform(pairs, lambda x: x["k"]), lambda keys: F.when(F.size(F.array_distinct(keys)) == F.size(keys), pairs).otherwise(F.filter(pairs, lambda x, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), x["k"]))))

    def within(start: Column) -> Column:
        rest = F.when(start > 0, F.slice(lines, F.greatest(start, F.lit(1)), F.size(lines))).otherwise(F.array().cast("array<string>"))
        return let(F.transform(F.filter(let(rest, until), lambda x: x.startswith("-") & x.rlike(pattern)), pair), last)

    return let(F.array_position(lines, "## Metadata").cast("int"), within)


def source_keys(md_path, meta: Column) -> Column:
    """Comparable names under which a document's source file may be stored, in order of preference."""
    stem = file_stem(md_path)
    cut = F.coalesce(*(F.when(F.lower(stem).endswith(e), F.substring(stem, F.lit(1), F.length(stem) - len(e))) for e in STEM_ENDS))
    named = [F.try_element_at(meta, F.lit(k)) for k in ("source name", "source file")]
    stems = F.filter(F.array(stem, cut, *(F.when(n != "", file_stem(n)) for n in named)), lambda x: x.isNotNull() & (x != ""))
    return F.array_distinct(F.transform(stems, name_key))


def match_sources(docs: DataFrame, files: DataFrame) -> DataFrame:
    """(doc_id, path): each document's source file: the first path (in order) whose name is one of the document's keys.

    ``docs`` is (doc_id, keys array<string>), ``files`` (path). An equi-join on the exploded keys and one aggregate."""
    names = files.where(file_ext("path").isin(*SOURCE_EXTS)).select("path", name_key(file_stem("path")).alias("key"))
    found = docs.select("doc_id", F.explode("keys").alias("key")).join(names, "key")
    return found.groupBy("doc_id").agg(F.min("path").alias("path"))


def file_type(path, existing=None, override: str | None = None) -> Column:
    if override:
        return F.lit(override)
    ext = file_ext(path)
    known = F.create_map(*(F.lit(x) for pair in FILE_TYPES.items() for x in pair))
    by_path = F.coalesce(F.try_element_at(known, ext), sub(ext, r"^\.+", ""))
    return F.coalesce(F.when(col(path).isNotNull(), by_path), col(existing) if existing is not None else F.lit(None), F.lit(""))


def document_id(source, md_path) -> Column:
    """``ctu``, the folder below PDFs (or else DOCX) of the source, and the stem, as one slug."""
    parts = F.split(F.coalesce(col(source), F.lit("")), "/")
    lowered = F.transform(parts, F.lower)
    pdfs, docx = F.array_position(lowered, "pdfs"), F.array_position(lowered, "docx")
    at = F.when(pdfs > 0, pdfs).otherwise(docx)
    folder = F.when((at > 0) & (at < F.size(parts)), slug(F.get(parts, at.cast("int"))))
    return F.concat_ws("-", F.lit("ctu"), folder, slug(file_stem(F.coalesce(col(source), col(md_path)))))


def version_id(doc_id, checksum) -> Column:
    sum_ = F.coalesce(col(checksum), F.lit(""))
    return F.when(sum_ == "", col(doc_id)).otherwise(F.concat(col(doc_id), F.lit("-"), F.substring(sum_, 1, 12)))


def split_parser(meta: Column) -> Column:
    """Both parsers of a document read by two engines; null if neither is told."""
    local, table = (F.try_element_at(meta, F.lit(k)) for k in ("local parser", "table parser"))
    parts = F.filter(F.array(F.when(local != "", F.concat(F.lit("local="), local)), F.when(table != "", F.concat(F.lit("table_pages="), table))), lambda x: x.isNotNull())
    return F.when(F.size(parts) > 0, F.array_join(parts, "; "))


def looks_extracted(body, meta: Column) -> Column:
    return (F.size(meta) > 0) | any_within(F.coalesce(col(body), F.lit("")), OCR_SIGNS)


def build(docs: DataFrame, now: Column | None = None, language: str = "vi", overwrite: bool = False, given: dict[str, str] | None = None) -> DataFrame:
    """Append ``front`` (the new front matter) and ``result`` (with the body) to ``docs`` (md_path, text, source_path,
    source_checksum; the last two may be null).

    Each field is the first that isn't empty of: what is ``given``, what the document has, what its embedded list says, a
    default. Fields that people fill are never made up; the version follows the checksum unless someone changed it."""
    given = given or {}
    t = docs.withColumn("_fm", front_matter("text"))
    t = t.withColumns({"_f": F.coalesce(parse_fields(F.col("_fm.raw")), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast(f"array<{VALUE}>"))), "_body": F.col("_fm.body")})
    t = t.withColumn("_m", embedded("_body"))
    f, m = F.col("_f"), F.col("_m")
    had = lambda k: F.when(~is_empty(f, k), value_text(f, k))
    told = lambda k: F.try_element_at(m, F.lit(k))
    arg = lambda k: F.lit(given.get(k)).cast("string")
    checksum = F.coalesce(F.col("source_checksum"), first_non_empty(told("checksum"), had("checksum")), F.lit(""))
    doc_id = F.coalesce(had("document_id"), document_id("source_path", "md_path"))
    t = t.withColumns({"_sum": checksum, "_id": doc_id})
    auto = F.when(had("checksum").isNotNull(), version_id("_id", had("checksum")))
    fresh = F.lit(overwrite) | had("version_id").isNull() | F.coalesce(had("version_id") == auto, F.lit(False))
    stamp = now if now is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")
    values = {k: F.coalesce(value_text(f, k), F.lit("")) for k in HUMAN_TEXT} | {k: had(k) for k in HUMAN_NULL}
    values |= {k: F.coalesce(had(k), F.lit(v)) for k, v in DEFAULTS.items()}
    values |= {
        "document_id": F.col("_id"),
        "version_id": F.when(fresh, version_id("_id", "_sum")).otherwise(had("version_id")),
        "is_latest": F.when(F.try_element_at(f, F.lit("is_latest"))["kind"] == "bool", value_text(f, "is_latest")).otherwise("false"),
        "ocr_status": first_non_empty(arg("ocr_status"), had("ocr_status"), F.when(looks_extracted("_body", m), "done").otherwise("not_started")),
        "source_file": F.coalesce(F.col("source_path"), had("source_file"), told("source file"), F.lit("")),
        "file_type": file_type("source_path", had("file_type"), given.get("file_type")),
        "language": F.lit(language or "vi"),
        "created_at": F.coalesce(had("created_at"), stamp),
        "updated_at": stamp,
        "checksum": F.col("_sum"),
        "parser": F.coalesce(first_non_empty(arg("parser"), had("parser"), told("parser"), split_parser(m)), F.lit("")),
        "ocr_engine": F.coalesce(first_non_empty(arg("ocr_engine"), had("ocr_engine"), told("ocr engine"), told("ocr engine for scan local")), F.lit("")),
    }
    for k in ("document_type", "confidentiality"):
        if given.get(k):
            values[k] = F.lit(given[k])
    audience = F.try_element_at(f, F.lit("audience"))
    items = F.when((audience["kind"] == "list") & (F.size(audience["items"]) > 0), F.transform(audience["items"], lambda x: F.coalesce(x["text"], F.lit("")))).when(~is_empty(f, "audience"), F.array(audience["text"])).otherwise(F.array(F.lit("student")))
    out = t.withColumn("front", dump(values, {"audience": items}))
    return out.withColumn("result", F.concat("front", "_body")).drop("_fm", "_f", "_body", "_m", "_sum", "_id")


def findings(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, severity, rule, field, message): what is wrong with each document's front matter."""
    t = docs.select("doc_id", F.coalesce(parse_fields(front_matter(text)["raw"]), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast(f"array<{VALUE}>"))).alias("f"))
    f = F.col("f")
    row = lambda sev, rule, field, message: F.struct(F.lit(sev).alias("severity"), F.lit(rule).alias("rule"), (field if isinstance(field, Column) else F.lit(field)).alias("field"), (message if isinstance(message, Column) else F.lit(message)).alias("message"))
    has = lambda k: F.map_contains_key(f, k)
    kind = lambda k: F.try_element_at(f, F.lit(k))["kind"]
    out = [F.when(~has(k), row("error", "missing", k, f"missing field: {k}")) for k in FIELDS]
    out += [F.when(has(k) & is_empty(f, k), row("error", "required", k, f"auto required field is empty: {k}")) for k in REQUIRED]
    out += [F.when(has(k) & is_empty(f, k), row("warning", "review", k, f"needs human review: {k} is empty")) for k in REVIEWED]
    out += [F.when(has(k) & is_empty(f, k), row("warning", "optional", k, f"optional human field is empty: {k}")) for k in OPTIONAL]
    items = F.try_element_at(f, F.lit("audience"))["items"]
    filled = has("audience") & ~is_empty(f, "audience")
    out.append(F.when(filled & (kind("audience") != "list"), row("error", "audience", "audience", "audience must be a list")).when(filled & F.exists(items, lambda x: (x["kind"] != "text") | (F.coalesce(x["text"], F.lit("")) == "")), row("error", "audience", "audience", "audience must contain non-empty strings")))
    out.append(F.when(has("is_latest") & (kind("is_latest") != "bool"), row("error", "is_latest", "is_latest", "is_latest must be true or false")))
    for k, allowed in ENUMS.items():
        v = F.try_element_at(f, F.lit(k))
        out.append(F.when(has(k) & ~is_empty(f, k), F.when(kind(k) != "text", row("error", "enum", k, f"{k} must be a string enum")).when(~v["text"].isin(*allowed), row("error", "enum", k, F.concat(F.lit(f"{k} has invalid enum: "), v["text"])))))
    checksum = value_text(f, "checksum")
    out.append(F.when((checksum != "") & ~checksum.rlike(r"\A[0-9a-fA-F]{32}\z"), row("error", "checksum", "checksum", "checksum must be a 32-character MD5 hex string")))
    out += [F.when((value_text(f, k) != "") & ~value_text(f, k).rlike(r"\A\d{4}-\d{2}-\d{2}\z"), row("error", "date", k, f"{k} must use YYYY-MM-DD")) for k in DATES]
    published = value_text(f, "rag_status") == "published"
    gates = (("ocr_status", ("done", "not_required"), "done or not_required"), ("review_status", ("approved",), "approved"), ("validity_status", ("valid",), "valid"), ("confidentiality", ("public",), "public"))
    out += [F.when(published & ~value_text(f, k).isin(*ok), row("error", "published", k, f"published document must have {k} {said}")) for k, ok, said in gates]
    known = F.array_compact(F.array(*out))
    unknown = F.transform(F.array_sort(F.filter(F.map_keys(f), lambda k: ~k.isin(*FIELDS))), lambda k: row("warning", "unknown", k, F.concat(F.lit("unknown field: "), k)))
    none = F.array(row("error", "front_matter", "", "missing YAML front matter"))
    return t.select("doc_id", F.explode(F.when(F.size(f) == 0, none).otherwise(F.concat(known, unknown))).alias("x")).select("doc_id", "x.*")


def totals(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(status, n): documents by their worst finding, and all of them as ``total``."""
    worst = found.groupBy("doc_id").agg(F.max((F.col("severity") == "error").cast("int")).alias("bad"))
    state = docs.select("doc_id").join(worst, "doc_id", "left").select(F.when(F.col("bad") == 1, "ERROR").when(F.col("bad") == 0, "WARN").otherwise("OK").alias("status"))
    return state.rollup("status").agg(F.count("*").alias("n")).select(F.coalesce("status", F.lit("total")).alias("status"), "n")
