"""Quality rules with thresholds that adapt to each language and source.

Each document's measures are integers. A mergeable quantile sketch per (lang, source) counts them in log-linear buckets
(exact below 64, relative width 1/32 above), so sketches of parts add up to the sketch of the whole, whatever the order.
A group's cutoff is an outlier fence over its own quartiles: median + reach * max(upper quartile - median, least spread).
Groups of fewer than ``least`` documents borrow the sketch of their language, and that of everything where the language
is as small; merging is adding the counts. The filter joins the cutoffs back: a few rows per language and source.

Defined results: a null text counts as empty; null lang or source is a group of its own; repeated rows are judged each;
an empty table gives no rows. Extra columns pass through; columns named as the new ones are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, add_text_columns, spread

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SYMBOLS = b"#*$%&|<>"
_WS = b" \t\n\x0b\x0c\r"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: measure: (numerator, denominator), in thousandths; the least spread of the fence, in the same unit.
MEASURES = {"symbols": ("n_symbols", "word_chars", 12), "dup_lines": ("n_dup_lines", "n_words", 5), "repeats": ("n_repeat_words", "n_words", 50), "word_length": ("word_chars", "n_words", 800)}


def count_text(text: str | None) -> tuple[int, int, int, int, int]:
    """COUNTS of one whole text; words are runs of characters other than ASCII white space."""
    data = (text or "").encode()
    words = data.split()
    n = len(words)
    if not n:
        return 0, 0, len(data) - len(data.translate(None, SYMBOLS)), 0, 0
    chars = len(text) - (len(data) - len(data.translate(None, _WS)))
    lines = [x for x in data.split(b"\n") if x.strip(_WS)]
    repeated = 0
    if n > 3:
        seen: dict[bytes, int] = {}
        ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
        k = len(seen)
        key = (ids[:-2] * k + ids[1:-1]) * k + ids[2:] if k < 2_000_000 else np.unique(np.stack([ids[:-2], ids[1:-1], ids[2:]], 1), axis=0, return_inverse=True)[1].ravel()
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(n - 2, bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        if twice.any():
            covered = np.zeros(n, bool)
            for k in range(3):
                covered[k : n - 2 + k] |= twice
            repeated = int(covered.sum())
    return n, chars, len(data) - len(data.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated


def with_counts(df: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """Append the counts of each whole text."""

    def make():
        return lambda texts: dict(zip(COUNTS, zip(*map(count_text, texts)))) if texts else {c: [] for c in COUNTS}

    return add_text_columns(df, text, [T.StructField(c, T.LongType()) for c in COUNTS], make, keep_text=keep_text)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def bucket(value: Column) -> Column:
    """The lowest value of the sketch's bucket that holds a nonnegative integer."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0)).cast("int")
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def measure(name: str) -> Column:
    over, under, _ = MEASURES[name]
    return F.when(F.col(under) > 0, F.expr(f"(1000 * {over}) div {under}")).otherwise(F.lit(0).cast("long"))


def sketches(counts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., measure, bucket, n): the sketches of all documents that pass the base rules. Sketches merge by adding n."""
    rows = F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), bucket(measure(m)).alias("bucket")) for m in MEASURES)))
    return counts.where(~base_failed()).select(*keys, rows.alias("r")).groupBy(*keys, "r.measure", "r.bucket").agg(F.count("*").alias("n"))


def quantiles(sketch: DataFrame, keys: list[str], points: dict[str, float]) -> DataFrame:
    """(keys..., measure, total, one column per point): the lowest bucket at which the share of the rows reaches the point.

    Works on sorted bucket arrays, of which the sketch's layout bounds the length (some 64 + 32 * 58 per measure).
    """
    rows = sketch.groupBy(*keys, "measure").agg(F.sum("n").alias("total"), F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("all"))

    def at(p: float) -> Column:
        state = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(None).cast("long").alias("value"))
        return F.aggregate("all", state, lambda acc, x: F.struct((acc["sum"] + x["n"]).alias("sum"), F.when(acc["value"].isNotNull(), acc["value"]).when((acc["sum"] + x["n"]) * 1000 >= F.col("total") * round(p * 1000), x["bucket"]).alias("value")))["value"]

    return rows.select(*keys, "measure", "total", *(at(p).alias(c) for c, p in points.items()))


def cutoffs(sketch: DataFrame, reach: int = 6, least: int = 200) -> DataFrame:
    """(lang, source, symbols, ...): the largest value of each measure that stays, per language and source."""
    own = sketch.groupBy("lang", "source", "measure", "bucket").agg(F.sum("n").alias("n"))
    points = {"q50": 0.5, "q75": 0.75}
    levels = []
    for keys in (["lang", "source"], ["lang"], []):
        merged = own.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
        levels.append(quantiles(merged, keys, points).select(*(F.col(k).alias(f"{k}_{len(keys)}") for k in keys), F.col("measure").alias(f"m_{len(keys)}"), *(F.col(c).alias(f"{c}_{len(keys)}") for c in ("total", *points))))
    by_source, by_lang, by_all = levels
    # joins on null-safe keys between tables of a few rows per group
    t = by_source.join(by_lang, F.col("lang_2").eqNullSafe(F.col("lang_1")) & (F.col("m_2") == F.col("m_1"))).join(by_all, F.col("m_2") == F.col("m_0"))
    pick = lambda c: F.when(F.col("total_2") >= least, F.col(f"{c}_2")).when(F.col("total_1") >= least, F.col(f"{c}_1")).otherwise(F.col(f"{c}_0"))
    spread_of = F.create_map(*(x for m, (_, _, s) in MEASURES.items() for x in (F.lit(m), F.lit(s).cast("long"))))[F.col("m_2")]
    t = t.select(F.col("lang_2").alias("lang"), F.col("source_2").alias("source"), F.col("m_2").alias("measure"), (pick("q50") + reach * F.greatest(pick("q75") - pick("q50"), spread_of)).alias("cutoff"))
    return t.groupBy("lang", "source").pivot("measure", list(MEASURES)).agg(F.first("cutoff"))


def judge(df: DataFrame, scratch: Scratch, text: str = "text", reach: int = 6, least: int = 200, keep_text: bool = True) -> DataFrame:
    """Append COUNTS, base_failed and kept. ``df`` has lang and source.

    Each document is counted once: the counts are written, with the text if it is to be kept, and read for the sketches
    (a few columns) and again for the verdict.
    """
    rows = scratch.save(with_counts(spread(df), text, keep_text))
    limits = scratch.save(cutoffs(scratch.save(sketches(rows, ["lang", "source"])), reach, least))
    renamed = limits.select(F.col("lang").alias("_cut_lang"), F.col("source").alias("_cut_source"), *(F.col(m).alias(f"_cut_{m}") for m in MEASURES))
    joined = rows.join(renamed, F.col("lang").eqNullSafe(F.col("_cut_lang")) & F.col("source").eqNullSafe(F.col("_cut_source")), "left")
    within = [F.coalesce(measure(m) <= F.col(f"_cut_{m}"), F.lit(True)) for m in MEASURES]
    ok = within[0]
    for w in within[1:]:
        ok = ok & w
    return joined.withColumns({"base_failed": base_failed(), "kept": ~base_failed() & ok}).drop("_cut_lang", "_cut_source", *(f"_cut_{m}" for m in MEASURES))
