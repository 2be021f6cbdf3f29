"""Jobs over files: discover, work out, write, and tell of each file what was done. ``python -m sheafline`` runs them.

A job gives one row per file (path, out_path, status, message). A file that can't be used is a row with status ``error``
and a message, and no reason for the others to stop. With ``dry_run`` all is worked out and nothing written. Files that
are already there count as ``skipped`` unless ``force``, so a job can be run again after a failure.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import UserRules, repair
from ..operators import metadata, pages, review, tables
from ..sources import files
from . import documents


def read_texts(spark: SparkSession, root: str) -> DataFrame:
    """(path, text) of the Markdown and text files below ``root``; text is null where the bytes are no UTF-8.

    Spark reads no rows from a file of no bytes, so such files are left as they are."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "content")
    kept = raw.where(F.lower("path").rlike(r"\.(md|markdown|txt)\z"))
    valid = F.call_function("is_valid_utf8", F.col("content").cast("string"))
    return kept.select(F.regexp_replace("path", r"\Afile:/+", "/").alias("path"), F.when(valid, F.col("content").cast("string")).alias("text"))


def settle(made: DataFrame, done: DataFrame | None, dry_run: bool, force: bool) -> DataFrame:
    """Write ``made`` (path, out_path, text, problem) and tell what was done with each file."""
    there = made.withColumn("_there", F.lit(False)) if done is None or force else made.join(done.select("out_path", F.lit(True).alias("_there")).distinct(), "out_path", "left")
    t = there.withColumn("status", F.when(F.col("problem").isNotNull(), "error").when(F.coalesce("_there", F.lit(False)), "skipped").otherwise("planned" if dry_run else "written"))
    out = t.select("path", "out_path", "status", F.coalesce("problem", F.lit("")).alias("message"))
    if dry_run:
        return out
    written = files.write_files(t.where("status = 'written'").select("out_path", "text"))
    return out.join(written, "out_path", "left").select("path", "out_path", "status", "message", F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes"))


def unreadable(text: Column) -> Column:
    return F.when(text.isNull(), "not UTF-8")


def existing(spark: SparkSession, root: str) -> DataFrame:
    """(out_path) of the Markdown files that are there."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).where(F.lower("path").endswith(".md"))
    return found.select(F.regexp_replace("path", r"\Afile:/+", "/").alias("out_path"))


def reclean(spark: SparkSession, root: str, force: bool = False, dry_run: bool = False) -> DataFrame:
    """Existing texts repaired again, each into ``<stem>_rag_clean.md`` beside it; results of the job are no input of it."""
    docs = read_texts(spark, root).where(~F.lower("path").endswith("_rag_clean.md"))
    made = documents.reclean(docs).select("path", files.cleaned_path("path").alias("out_path"), "text", unreadable(F.col("text")).alias("problem"))
    known = docs.select("path", F.col("text").isNull().alias("_bad"))
    made = made.join(known, "path").withColumn("problem", F.when(F.col("_bad"), "not UTF-8")).drop("_bad")
    return settle(made, existing(spark, root), dry_run, force)


def existing_path(path: Column, roots: list[str], found: DataFrame, docs: DataFrame) -> DataFrame:
    """``docs`` with the first of the places a relative ``path`` may mean (as it is, then below each root) that is a file of
    ``found`` (path); null if none is."""
    places = F.array(path, *(F.concat(F.lit(r.rstrip("/") + "/"), path) for r in roots))
    t = docs.withColumn("_row", F.monotonically_increasing_id()).select("*", F.posexplode_outer(places).alias("_rank", "_place"))
    hit = t.join(found.select(F.col("path").alias("_place"), F.lit(True).alias("_hit")).distinct(), "_place", "left")
    best = hit.groupBy("_row", *docs.columns).agg(F.min_by("_place", F.when(F.col("_hit"), F.col("_rank"))).alias("resolved"))
    return best.drop("_row")


def relative(path: Column, root: str) -> Column:
    """A path as metadata has it: below ``root`` relative to it, else as it is."""
    top = root.rstrip("/") + "/"
    return F.when(path.startswith(top), F.substring(path, F.lit(len(top) + 1), F.length(path))).otherwise(path)


def apply_metadata(spark: SparkSession, root: str, sources: str | None = None, now: Column | None = None, overwrite: bool = False, dry_run: bool = False, given: dict[str, str] | None = None) -> DataFrame:
    """Front matter built and put on each Markdown file; (path, status): ``changed``, ``same`` or ``error``.

    The source file is that named in the document if it is there, else the first whose name fits, with its checksum."""
    docs = read_texts(spark, root).where(F.lower("path").endswith(".md")).withColumnRenamed("path", "md_path")
    if sources:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(sources).select(F.regexp_replace("path", r"\Afile:/+", "/").alias("path"), F.md5("content").alias("source_checksum"))
        heads = docs.withColumn("_fm", metadata.front_matter("text")).select("md_path", metadata.parse_fields(F.col("_fm.raw")).alias("_f"), metadata.embedded(F.col("_fm.body")).alias("_m"))
        told = existing_path(F.col("told"), [sources], found, heads.select("md_path", F.try_element_at("_f", F.lit("source_file"))["text"].alias("told")))
        fitting = metadata.match_sources(heads.select(F.col("md_path").alias("doc_id"), metadata.source_keys("md_path", F.col("_m")).alias("keys")), found.select("path"))
        fitting = told.join(fitting, told["md_path"] == fitting["doc_id"], "left").select(F.col("md_path").alias("doc_id"), F.coalesce("resolved", "path").alias("path"))
        docs = docs.join(fitting, docs["md_path"] == fitting["doc_id"], "left").drop("doc_id").join(found, "path", "left").withColumn("source_path", relative(F.col("path"), sources)).drop("path")
    else:
        docs = docs.withColumns({"source_path": F.lit(None).cast("string"), "source_checksum": F.lit(None).cast("string")})
    built = metadata.build(docs.where("text is not null"), now, overwrite=overwrite, given=given)
    out = built.select(F.col("md_path").alias("path"), F.when(F.col("result") == F.col("text"), "same").otherwise("changed").alias("status"), "result")
    if not dry_run:
        files.write_files(out.where("status = 'changed'").select(F.col("path").alias("out_path"), F.col("result").alias("text"))).count()
    return out.select("path", "status").unionByName(docs.where("text is null").select(F.col("md_path").alias("path"), F.lit("error").alias("status")))


def validate(spark: SparkSession, root: str) -> DataFrame:
    """(path, status): OK, WARN or ERROR of each Markdown file; one that can't be read is an ERROR."""
    docs = read_texts(spark, root).where(F.lower("path").endswith(".md")).withColumnRenamed("path", "doc_id")
    return statuses(docs, metadata.findings(docs)).withColumnRenamed("doc_id", "path")


def statuses(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, status) by each document's worst finding."""
    worst = found.groupBy("doc_id").agg(F.max((F.col("severity") == "error").cast("int")).alias("_bad"))
    return docs.select("doc_id").join(worst, "doc_id", "left").select("doc_id", F.when(F.col("_bad") == 1, "ERROR").when(F.col("_bad") == 0, "WARN").otherwise("OK").alias("status"))


def exit_state(status: DataFrame, strict: bool = False) -> int:
    """1 if a document has an error, or with ``strict`` a warning, else 0."""
    return int(bool(status.where(F.col("status").isin("ERROR", *(("WARN",) if strict else ()))).limit(1).count()))


def save_parsed(answers: DataFrame, folder: str, false_tables: bool = True, user_rules: str = "", now: Column | None = None) -> DataFrame:
    """A remote parser's answers (source_path, markdown) as finished documents with metadata: (path, out_path, text, problem).

    An answer without any text is a problem of its file alone."""
    t = answers.select(F.col("source_path").alias("path"), F.coalesce("markdown", F.lit("")).alias("markdown"))
    done = tables.parsed_markdown(t, "markdown", false_tables).withColumn("markdown", repair("markdown", user=UserRules.parse(user_rules)))
    named = done.select("path", files.output_path("path", folder).alias("md_path"), F.concat("markdown", F.lit("\n")).alias("text"), F.col("path").alias("source_path"), F.lit(None).cast("string").alias("source_checksum"))
    built = metadata.build(named, now, given={"parser": "remote", "ocr_engine": "remote"})
    blank = F.trim(pages.strip_markers("text")) == ""
    return built.select("path", F.col("md_path").alias("out_path"), F.col("result").alias("text"), F.when(blank, "the answer has no text").alias("problem"))


def reports(docs: DataFrame) -> DataFrame:
    """(out_path, text): the review report of each document (doc_id, text, out_path) that has warnings."""
    found = review.report(review.warnings(docs, "text"))
    return docs.select("doc_id", "out_path").join(found, "doc_id").select(F.regexp_replace("out_path", r"\.md\z", "_review.md").alias("out_path"), F.col("report").alias("text"))


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="sheafline", description="Jobs over folders of Markdown files")
    parser.add_argument("job", choices=("reclean", "metadata", "validate"))
    parser.add_argument("root")
    parser.add_argument("--sources", help="folder of the source files, for metadata")
    parser.add_argument("--dry-run", action="store_true")
    parser.add_argument("--force", action="store_true", help="write what is there already, or fields that are filled")
    parser.add_argument("--strict", action="store_true", help="warnings count as errors")
    a = parser.parse_args(args)
    spark = spark or SparkSession.builder.getOrCreate()
    if a.job == "reclean":
        out = reclean(spark, a.root, a.force, a.dry_run)
    elif a.job == "metadata":
        out = apply_metadata(spark, a.root, a.sources, overwrite=a.force, dry_run=a.dry_run)
    else:
        out = validate(spark, a.root)
    out = out.select("status").persist()
    try:
        for r in out.groupBy("status").count().orderBy("status").collect():
            print(f"{r['status']}: {r['count']}")
        return exit_state(out, a.strict) if a.job == "validate" else int(bool(out.where("status = 'error'").limit(1).count()))
    finally:
        out.unpersist()


if __name__ == "__main__":
    sys.exit(main())
