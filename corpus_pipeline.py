"""Five stages from raw documents to token ids: toxicity, quality rules, near-dedup, decontamination, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; ``run`` writes each stage's rows as
Parquet to the shared folder and reads them again. Stages but the last return the columns of documents, and no others
if a table has more. Empty tables pass through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.llm import bpe, decontam, minhash, quality, toxicity
from sheafline.llm.common import Scratch, spread, table
from sheafline.llm.queries import BPE_PATH

#: Most doc_ids that a stage sends to all executors to drop or keep rows; beyond it the rows are shuffled by doc_id.
SMALL = 200_000
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
_open: list[Scratch] = []


def scratch_of(spark: SparkSession, stage: str) -> Scratch:
    """Scratch tables of a stage, which ``run`` deletes once the stage's rows are written."""
    _open.append(Scratch(spark, f"pipeline-{stage}"))
    return _open[-1]


def without(docs: DataFrame, dropped: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of ``docs`` whose doc_id isn't one of ``dropped``; rows with a null doc_id stay."""
    ids = scratch.save(dropped.select("doc_id").where("doc_id is not null").distinct())
    few = ids.limit(SMALL + 1).count() <= SMALL
    return docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_anti").select(docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the field scores 0.5 or more go. A null or empty text stays; equal texts fare alike."""
    model = toxicity.fit(spark, docs, table(spark, sf_dir, "labels"), scratch_of(spark, "toxicity"))
    return toxicity.tag(spread(docs), model).where("predicted = 0").select(docs.columns)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or their group's cutoffs go; a null text counts as empty and fails."""
    return quality.judge(docs, scratch_of(spark, "quality")).where("kept").select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at a similarity of 0.8 on five-word shingles the smallest doc_id stays.

    Rows that share a doc_id are one document, of which the row with the smallest text stays. Rows with a null doc_id have
    no links; of equal ones among them one stays.
    """
    scratch = scratch_of(spark, "minhash")
    found = minhash.near_duplicates(spark, docs, scratch, size=5, percent=80)
    left = without(docs, found.where(~F.col("kept")), scratch)
    # ids alone tell whether some repeat, which is rare; only their rows are dealt by doc_id and compared
    again = scratch.save(docs.groupBy("doc_id").agg(F.count("*").alias("_n")).where("_n > 1").select(F.col("doc_id").alias("_id")))
    if not again.limit(1).count():
        return left
    same = F.col("doc_id").eqNullSafe(F.col("_id"))
    rows = left.join(again, same, "left_semi").withColumn("_text", F.struct(*(c for c in docs.columns if c != "doc_id")))
    one = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min("_text").alias("_text")).unionByName(rows.where("doc_id is null").select("doc_id", "_text").distinct())
    return left.join(again, same, "left_anti").unionByName(one.select("doc_id", "_text.*"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go; one with a null doc_id is told by its text."""
    scratch, items = scratch_of(spark, "decontam"), table(spark, sf_dir, "benchmark")
    left = without(docs, decontam.overlaps(docs.where("doc_id is not null"), items, scratch), scratch)
    if not docs.where("doc_id is null").limit(1).count():
        return left
    nameless = docs.where("doc_id is null").withColumn("_id", F.sha2("text", 256))
    found = decontam.overlaps(nameless.select(F.col("_id").alias("doc_id"), "text"), items, scratch).select(F.col("doc_id").alias("_id")).distinct()
    return left.where("doc_id is not null").unionByName(nameless.join(found, "_id", "left_anti").select(docs.columns))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The number of token ids of each document left, their digest and that of the decoded bytes; a null text has none."""
    return bpe.round_trip(spread(docs.select("doc_id", "text")), BPE_PATH, public_tokenizers.PATTERN)


STAGES = [("toxicity", drop_toxic), ("quality rules", keep_quality), ("MinHash near-dedup", drop_near_duplicates), ("benchmark decontamination", decontaminate), ("byte-level BPE", tokenize)]

#: Fitted fields, sketch similarities and token ids are not for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch, before = table(spark, sf_dir, "documents").select(COLUMNS), Scratch(spark, "pipeline"), None
    for _, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir))
        if before is not None:
            scratch.drop(before)
        while _open:
            _open.pop().clear()
        before = docs
    return docs
