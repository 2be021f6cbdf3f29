"""Files in and out: discovery by extension, whole texts, skipping what is done, writing one file per document.

Reading goes through Spark's own sources, so any store will do. Page images and remote parsers come in by ``Engine``.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import any_prefix, col, file_ext, file_name, file_stem, safe_name
from ..operators.routing import IMAGE_EXTS, OTHER_EXTS, PDF_EXTS

MARKDOWN_EXTS = (".md", ".markdown", ".txt")


def accepted(path, engine: str = "auto-page") -> Column:
    """Whether an engine takes the file: documents and images, and for the remote one other kinds as well."""
    return file_ext(path).isin(*PDF_EXTS, *IMAGE_EXTS, *(OTHER_EXTS if engine == "remote" else ()))


def discover(spark: SparkSession, root: str, engine: str = "auto-page", content: bool = False) -> DataFrame:
    """(path, name, stem, ext, length[, content, checksum]) of the files below ``root`` that the engine takes."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).where(accepted("path", engine))
    out = raw.select("path", file_name("path").alias("name"), file_stem("path").alias("stem"), file_ext("path").alias("ext"), "length", *(["content", F.md5("content").alias("checksum")] if content else []))
    return out


def read_markdown(spark: SparkSession, root: str, recursive: bool = False) -> DataFrame:
    """(md_path, text): one row per Markdown file."""
    reader = spark.read.option("wholetext", "true").option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", "*.md")
    return reader.text(root).select(F.input_file_name().alias("md_path"), F.col("value").alias("text"))


def output_path(source, folder: str, explicit: str | None = None) -> Column:
    """Where a document's Markdown goes: the explicit .md file, or ``<safe name>_structured.md`` in the folder."""
    if explicit and explicit.lower().endswith(".md"):
        return F.lit(explicit)
    return F.concat(F.lit((explicit or folder).rstrip("/") + "/"), safe_name(source), F.lit("_structured.md"))


def cleaned_path(source) -> Column:
    return F.concat(F.regexp_replace(col(source), r"[^/]*$", ""), file_stem(source), F.lit("_rag_clean.md"))


def not_done(docs: DataFrame, done: DataFrame, force: bool = False) -> DataFrame:
    """The rows of ``docs`` whose out_path isn't among ``done`` (out_path): an anti-join, so runs can be repeated."""
    return docs if force else docs.join(done.select("out_path").distinct(), "out_path", "left_anti")


def write_files(docs: DataFrame) -> DataFrame:
    """Write text to out_path on a file system that every executor mounts; (out_path, bytes). A file appears whole or not
    at all, and writing it again gives the same, so a task that is repeated does no harm. For stores use ``df.write``."""

    def run(batches: Iterable) -> Iterator:
        import pandas as pd

        for pdf in batches:
            sizes = []
            for path, text in zip(pdf["out_path"], pdf["text"]):
                os.makedirs(os.path.dirname(path), exist_ok=True)
                data = (text or "").encode()
                with open(f"{path}.{os.getpid()}.part", "wb") as f:
                    f.write(data)
                os.replace(f.name, path)
                sizes.append(len(data))
            yield pd.DataFrame({"out_path": pdf["out_path"], "bytes": sizes})

    return docs.select("out_path", "text").mapInPandas(run, "out_path string, bytes long")


def join_parsed_pages(pages: DataFrame) -> DataFrame:
    """(doc_id, markdown) of a remote parser's answer (doc_id, index, page, page_number, markdown): its page number is the
    first that is told of page, page_number and index."""
    no = F.coalesce("page", "page_number", F.col("index"))
    block = F.concat(F.lit("<!-- page: "), no.cast("string"), F.lit(" -->\n\n"), F.trim(F.coalesce("markdown", F.lit(""))))
    joined = pages.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("index", F.regexp_replace(block, r"(?U)\s+\z", "").alias("b")))), lambda x: x["b"]), "\n\n").alias("t"))
    return joined.select("doc_id", F.concat("t", F.lit("\n")).alias("markdown"))


def is_absolute(path) -> Column:
    return any_prefix(path, ("/", "file:", "hdfs:", "s3"))
