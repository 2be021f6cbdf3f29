"""Benchmark decontamination by spaced seeds, in DataFrame operations only.

A spaced seed is a mask over neighbouring tokens: its hash ignores the positions the mask leaves out, so a hit survives
replaced tokens there. Every position of every document and benchmark item is hashed under each mask; equal hashes put a
document and an item on a diagonal (the difference of their positions). Around a hit the item is laid along its diagonal
and the best window of ``span`` tokens (the whole item if it is shorter) is counted: the pair overlaps if at least
``percent`` of the window's tokens are equal. So replaced tokens are tolerated by hash and by verification, while chance
hits on a few common words fall short.

The masks are lossless: whichever tokens of a window are replaced, as long as ``percent`` of them are equal, one mask at
least hits inside it. Shorter items have lighter masks, and an item's hashes are of its own length's masks only; documents
are hashed under the masks of the lengths that the benchmark has. Items of one to three tokens must be equal as a whole,
at any position of a document.

Tokens: runs of letters and digits, lower-cased.

Plan. Document tokens stay in their row: one explode yields positions, hashing and the probe of the benchmark's hash table
run in the same generated code, and only hits leave it. A hit takes along the tokens beside its block of the item, which are the same
for all hits of a diagonal there, so hits are made distinct before any is verified. The benchmark's table is broadcast if it holds at most
``broadcast_rows`` rows (checked by counting); beyond that hashes are shuffled, and texts are joined to the hits.

Defined results: a null or empty text or item overlaps nothing; rows with null ids are compared and carry the null;
repeated items are reported each, repeated documents once per doc_id; a document that overlaps an item on several diagonals
is one row, with its best window (ties are equal numbers); texts and items of any length are compared whole; either table
may be empty; columns besides the ids and texts are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, spread

#: (longest window, masks) in rising order; a mask is the offsets of the tokens that count. Every way to keep 75 % of a
#: window's tokens keeps a hit of one of its masks, as found by search and enumerated in the test.
MASKS = (
    (1, ((0,),)),
    (2, ((0, 1),)),
    (8, ((0, 1, 2), (0, 1, 3), (0, 2, 3))),
    (12, ((0, 1, 2, 4), (0, 3, 4, 5))),
    (13, ((0, 1, 2, 4, 5), (0, 1, 6, 8, 9), (0, 1, 3, 4, 5))),
)
#: Items of at least so many tokens are looked for at every position.
SHORTEST = 1


def masks_of(window: int, percent: int) -> tuple[tuple[int, ...], ...]:
    """Masks that miss no window of which ``percent`` is equal. Beyond MASKS: the run that so few replaced tokens must leave."""
    if percent >= 75:
        for longest, masks in MASKS:
            if window <= longest:
                return masks
    equal = -(-window * percent // 100)
    return (tuple(range(max(1, -(-equal // (window - equal + 1))))),)


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def seeds(hashes: str, pos: str, masks: dict[tuple[int, ...], Column]) -> Column:
    """The hash of the tokens from ``pos`` on under each mask whose condition holds; one that reaches beyond the end gives
    null. ``hashes`` names the array of the tokens' own hashes, so that each token is hashed once, whatever masks it is in."""
    return F.array(*(F.when(given & (F.col(pos) + mask[-1] < F.size(hashes)), F.xxhash64(F.lit(k), *(F.expr(f"{hashes}[{pos} + {o}]") for o in mask))) for k, (mask, given) in enumerate(masks.items())))


def hashed(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def item_seeds(items: DataFrame, masks: dict[tuple[int, ...], Column]) -> DataFrame:
    """(hash, item_no, item_pos) of the distinct token sequences ``items`` (item_no, item_words)."""
    at = items.select("item_no", "item_words", hashed(F.col("item_words")).alias("item_hashes"), F.explode(F.sequence(F.lit(0), F.size("item_words") - 1)).alias("item_pos"))
    return at.select("item_no", "item_pos", F.explode(seeds("item_hashes", "item_pos", masks)).alias("hash")).where("hash is not null")


def near(words: str, pos: str, item_pos: str, span: int) -> list[Column]:
    """(from, near) of a hit: the document's tokens beside a block of the item laid along the hit's diagonal, and
    ``span`` - 1 more at either side. They depend on the diagonal and block alone, so hits that say the same are equal rows."""
    width = 2 * span
    block = F.floor(F.col(item_pos) / width).cast("int")
    shift = F.col(pos) - F.col(item_pos)
    low = F.greatest(F.lit(0), -shift, block * width - (span - 1))
    return [low.alias("from"), F.slice(words, shift + low + 1, block * width + width + span - 1 - low).alias("near")]


def best_window(near: str, items: str, start: str, span: int) -> tuple[Column, Callable[[], Column]]:
    """The most equal tokens in any ``span`` tokens of the item (all of a shorter one), whose tokens from ``start`` on are
    laid beside ``near``: first the column ``_marks`` of equal tokens, then what makes the result of it."""
    marks = F.transform(F.sequence(F.lit(0), F.least(F.size(near), F.size(items) - F.col(start)) - 1), lambda k: F.when(F.get(F.col(near), k) == F.get(F.col(items), k + F.col(start)), 1).otherwise(0))
    width = F.least(F.lit(span), F.size(items))
    state = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"), F.lit(0).alias("at"))

    def slide(acc: Column, x: Column) -> Column:
        now = acc["now"] + x - F.when(acc["at"] >= width, F.get(F.col("_marks"), acc["at"] - width)).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(acc["most"], now).alias("most"), (acc["at"] + 1).alias("at"))

    return marks, lambda: F.aggregate("_marks", state, slide, lambda acc: acc["most"])


def overlaps(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, span: int = 13, percent: int = 75, broadcast_rows: int = 1_000_000) -> DataFrame:
    """(doc_id, item_id, matched, of): the pairs that overlap, with the best window's equal tokens and its length."""
    sequences = benchmark.select("item_id", tokens(F.col("text")).alias("item_words")).where(F.size("item_words") > 0)
    owners = sequences.select(F.xxhash64("item_words").alias("item_no"), "item_id", "item_words")
    items = scratch.save(owners.groupBy("item_no").agg(F.first("item_words").alias("item_words")))
    width = F.least(F.lit(span), F.size("item_words"))
    # at most ``span`` lengths, and of their masks only those that the benchmark needs
    windows = sorted(r[0] for r in items.select(width).distinct().collect())
    used = {mask: [n for n in windows if mask in masks_of(n, percent)] for n in windows for mask in masks_of(n, percent)}
    table = scratch.save(item_seeds(items, {mask: width.isin(*ns) for mask, ns in used.items()}))
    probes = dict.fromkeys(used or {(0,): []}, F.lit(True))
    few = table.limit(broadcast_rows + 1).count() <= broadcast_rows
    words = spread(docs.select("doc_id", "text")).select("doc_id", tokens(F.col("text")).alias("words")).withColumn("hashes", hashed(F.col("words")))
    # a hit leaves the generated code with the tokens beside its block of the item, never with the whole document's
    beside = near("words", "pos", "item_pos", span)
    if few:
        found = words.select("doc_id", "words", "hashes", F.posexplode("hashes").alias("pos", "_h")).select("doc_id", "words", "pos", F.explode(seeds("hashes", "pos", probes)).alias("hash"))
        hits = found.join(F.broadcast(table), "hash").select("doc_id", "item_no", *beside)
    else:
        keyed = words.withColumn("row", F.xxhash64("doc_id", "words"))
        found = keyed.select("row", "hashes", F.posexplode("hashes").alias("pos", "_h")).select("row", "pos", F.explode(seeds("hashes", "pos", probes)).alias("hash")).where("hash is not null")
        # equal rows have equal hits, and each of them meets one of these
        hits = found.join(table, "hash").select("row", "pos", "item_no", "item_pos").distinct().join(keyed, "row").select("doc_id", "item_no", *beside)
    # an overlap of many hits is verified once a block, and chance hits end here: only pairs that overlap are grouped
    hits = hits.distinct().join(F.broadcast(items) if few else items, "item_no")
    marks, most = best_window("near", "item_words", "from", span)
    scored = hits.withColumn("_marks", marks).select("doc_id", "item_no", most().alias("matched"), width.alias("of"))
    pairs = scored.where(F.col("matched") * 100 >= F.col("of") * percent).groupBy("doc_id", "item_no").agg(F.max("matched").alias("matched"), F.max("of").alias("of"))
    return pairs.join(owners.select("item_no", "item_id"), "item_no").select("doc_id", "item_id", "matched", "of")
