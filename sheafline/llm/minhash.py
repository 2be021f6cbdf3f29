"""Near-duplicate documents: fast similarity sketches, banding, exact verification, connected components.

Sketch (Dahlgaard, Knudsen and Thorup, "Fast Similarity Sketching", FOCS 2017). There are t coordinates and 2t rounds.
In round i < t every element of the set is thrown into a hashed coordinate, in round t + j all are thrown into coordinate
j; each keeps the least i + value, and rounds stop once no coordinate is empty. So every coordinate fills, and the number
of equal coordinates of two sketches is concentrated about t times the Jaccard similarity as it is for t minima.

Plan. Equal sets collapse to their smallest doc_id first, so copies cost one row each from then on. Representatives are
dealt by bands of the sketch. All buckets with the same smallest member become one group, so a document comes once into a
group however many bands it shares with that member, and every two members of a bucket still meet. The members' full sets
are dealt by group, and one task compares all pairs of its group exactly, as popcounts of bit rows over the shingles that
two or more of them have; it emits a spanning forest of the links that hold, at most a row per member. No pair is a row
anywhere, and no candidate is judged by its sketch. Groups of more than ``large`` members, or of more shingles than
``weight``, are cut to blocks, and each two blocks are compared as a group of their own, so their work is dealt over many
tasks; a member's row then goes to each other block. Components of all forests together are made once, at the end.

Lost per pair of similarity s: only where no band is equal, (1 - s^6)^36, which is 4e-8 at 0.85 and 2e-5 at 0.8.

Defined results: a null or empty text, or one without words, has no shingles, no links, and is its own component; fewer
words than a shingle make one shingle; rows with a null doc_id take no part in links and get component_id null, kept
true; repeated rows of one doc_id count as one document and keep all their rows; of equal similarities none is preferred,
every link counts; an empty table gives no rows. Texts of any length are compared on all their shingles. Extra columns
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BoundedCache, Scratch, add_text_columns, components, slices, spread

ROWS, BANDS = 6, 36
COORDINATES = ROWS * BANDS
#: Most ids that are broadcast: eight bytes each, some 40 MB as a hash table.
FEW = 1_000_000
#: Bytes of a group's bit rows that are made at once.
BITS = 32 << 20
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_M1, _M2, _M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class _WordHash(BoundedCache):
    def make(self, word: bytes) -> int:
        return xxhash.xxh64_intdigest(word)


def shingle_hashes(text: str | None, words: _WordHash, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles; A-Z lower-cased, words split at ASCII white space."""
    found = (text or "").encode().translate(_LOWER).split()
    n = len(found)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, found), np.uint64, n)
    k = min(size, n)
    out = np.full(n - k + 1, k, np.uint64)
    for j in range(k):
        out = mix(out * _M3 + h[j : n - k + 1 + j])
    return np.unique(out)


def sketch(sets: list[np.ndarray], t: int = COORDINATES) -> np.ndarray:
    """One row of t 64-bit coordinates for each nonempty set; rows of empty sets are zero."""
    out = np.zeros((len(sets), t), np.uint64)
    live = np.array([i for i, s in enumerate(sets) if len(s)], np.int64)
    low = np.uint64((1 << 54) - 1)
    for r in range(2 * t):
        if not len(live):
            break
        sizes = np.array([len(sets[i]) for i in live])
        row = np.repeat(np.arange(len(live)), sizes)
        h = mix(np.concatenate([sets[i] for i in live]) + np.uint64((r + 1) * int(_M3) & 0xFFFFFFFFFFFFFFFF))
        to = (h >> np.uint64(32)) % np.uint64(t) if r < t else np.full(len(h), r - t, np.uint64)
        value = (np.uint64(r) << np.uint64(54)) | (mix(h + _M2) & low)  # the round outweighs the value: round + value / 2^54
        cell = row * t + to.astype(np.int64)
        best = np.full(len(live) * t, np.iinfo(np.uint64).max, np.uint64)
        np.minimum.at(best, cell, value)
        held = out[live]
        held = np.where(held == 0, np.where(best.reshape(-1, t) == np.iinfo(np.uint64).max, 0, best.reshape(-1, t) + np.uint64(1)), held)
        out[live] = held
        live = live[(held == 0).any(axis=1)]
    return out


FIELDS = [T.StructField("n_shingles", T.LongType()), T.StructField("_set_hash", T.BinaryType()), T.StructField("_bands", T.ArrayType(T.LongType()))]


def band_keys(full: np.ndarray) -> np.ndarray:
    """A 64-bit key per band of each sketch; equal bands have equal keys, and no two bands share theirs."""
    keys = np.zeros((len(full), BANDS), np.uint64)
    for j in range(ROWS):
        keys = mix(keys * _M3 + full[:, j::ROWS] + np.uint64(j))
    return mix(keys + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def with_sketches(df: DataFrame, size: int, text: str = "text") -> DataFrame:
    """Replace the text by n_shingles, _set_hash (128 bits of the set) and _bands (a key per band); null without shingles."""

    def make():
        words = _WordHash()

        def run(texts: list) -> dict:
            sets = [shingle_hashes(t, words, size) for t in texts]
            keys = band_keys(sketch(sets))
            return {"n_shingles": [len(s) for s in sets], "_set_hash": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], "_bands": [x.tolist() if len(s) else None for x, s in zip(keys, sets)]}

        return run

    return add_text_columns(df, text, FIELDS, make, keep_text=False)


def linked(ids: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between members: pairs (a, b) with 100 * intersection >= percent * union.

    Exact for every pair: shingles of one member only are left out of intersections, all others are columns of bit rows,
    made for ``BITS`` bytes of columns at a time.
    """
    n, sizes = len(ids), np.array([len(s) for s in sets])
    if n == 2:
        x, y = sorted(sets, key=len)
        both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
        return [(ids[0], ids[1])] if 100 * both >= percent * (int(sizes.sum()) - both) and ids[0] != ids[1] else []
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(count > 1) - 1
    many = count[column] > 1
    row, column = np.repeat(np.arange(n), sizes)[many], number[column[many]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    columns = int(number[-1]) + 1
    both, wide = np.zeros((n, n), np.int32), max(64, min(BITS // n, columns + 63) // 64 * 64)
    for low in range(0, columns, wide):
        part = slice(*np.searchsorted(column, (low, low + wide)))
        cells = np.zeros((n, wide), bool)
        cells[row[part], column[part] - low] = True
        bits = np.packbits(cells, axis=1).view(np.uint64)
        for i in range(n - 1):
            both[i, i + 1 :] += np.bitwise_count(bits[i] & bits[i + 1 :]).sum(1, dtype=np.int32)
    out, root = [], np.arange(n)
    for i in range(n - 1):
        near = i + 1 + np.flatnonzero(100 * both[i, i + 1 :].astype(np.int64) >= percent * (sizes[i] + sizes[i + 1 :] - both[i, i + 1 :]))
        while len(near := near[root[near] != root[i]]):
            out.append((ids[i], ids[near[0]]))
            root[root == root[near[0]]] = root[i]
    return [x for x in out if x[0] != x[1]]


def forests(members: DataFrame, percent: int) -> DataFrame:
    """(a, b): links among the ``members`` (key, doc_id, _set) of each key.

    Rows come sorted by key within a partition, so a task holds one group at a time.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, sets = None, [], []

        def done() -> pa.RecordBatch:
            found = linked(ids, sets, percent) if len(ids) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([min(x) for x in found], pa.int64()), pa.array([max(x) for x in found], pa.int64())], names=["a", "b"])

        for batch in batches:
            for key, doc, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if key != now:
                    yield done()
                    now, ids, sets = key, [], []
                ids.append(doc)
                sets.append(np.frombuffer(data.as_py(), np.uint64))
        yield done()

    return members.select("key", "doc_id", "_set").repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")


def in_blocks(members: DataFrame, groups: DataFrame, large: int, weight: int) -> DataFrame:
    """``members`` (low, doc_id, _set) with a key of the group, or of two of its blocks; any two members share a key.

    ``groups`` (low, members, shingles) names those that are cut. A block has about a 16th of the group's members, but no
    less than half of ``large`` and no more than 1,500, and about half of ``weight`` shingles at most.
    """
    block = F.least(F.greatest(F.col("members") / 16, F.lit(large / 2)), F.lit(1500.0))
    cut = groups.select("low", F.greatest(F.ceil(F.col("members") / block), F.ceil(2 * F.col("shingles") / weight), F.lit(3)).cast("int").alias("_blocks"))
    dealt = members.join(cut, "low", "left").withColumn("_block", F.pmod(F.xxhash64("doc_id"), "_blocks").cast("int"))
    others = F.when(F.col("_blocks").isNull(), F.array(F.lit(-1))).otherwise(F.filter(F.sequence(F.lit(0), F.col("_blocks") - 1), lambda k: k != F.col("_block")))
    paired = dealt.select("low", "doc_id", "_set", "_block", F.explode(others).alias("_other"))
    return paired.select(F.xxhash64("low", F.least("_block", "_other"), F.greatest("_block", "_other")).alias("key"), "doc_id", "_set")


def near_duplicates(spark: SparkSession, docs: DataFrame, scratch: Scratch, size: int = 5, percent: int = 80, large: int = 600, weight: int = 2_000_000) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketched = scratch.save(with_sketches(spread(docs), size))
    live = sketched.where("doc_id is not null and n_shingles > 0")
    repeated = _repeats(live)
    classes = scratch.save(live.groupBy("_set_hash").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("_n"), F.first("_bands").alias("_bands")))
    keys = classes.select(F.col("rep").alias("doc_id"), "_n", F.explode("_bands").alias("key"))
    lows = keys.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("key", "low")
    # buckets of one member are most of them, and go here
    shared = scratch.save(keys.join(lows, "key").select("low", "doc_id", "_n").distinct())
    sizes = shared.groupBy("low").agg(F.count("*").alias("members"), F.sum("_n").alias("shingles"))
    groups = scratch.save(sizes.where((F.col("members") > large) | (F.col("shingles") > weight)))
    sets = scratch.save(sets_of(docs, scratch.save(shared.select("doc_id").distinct()), size, repeated))
    links = forests(in_blocks(shared.select("low", "doc_id").distinct().join(sets, "doc_id"), groups, large, weight), percent)
    if repeated:  # rows that share a doc_id hang together besides
        same = live.select("doc_id", "_set_hash").join(classes.select("_set_hash", "rep"), "_set_hash").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")).where("a < b")
        links = links.unionByName(same)
    final = components(spark, scratch.save(links), scratch)
    byclass = classes.select("_set_hash", "rep").join(final, F.col("rep") == F.col("node"), "left").select("_set_hash", F.coalesce("root", "rep").alias("_root"))
    out = sketched.join(byclass, "_set_hash", "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("_root", "doc_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def sets_of(docs: DataFrame, needed: DataFrame, size: int, repeated: bool) -> DataFrame:
    """(doc_id, _set) of the ``docs`` that are ``needed`` (doc_id), a row per distinct set of a doc_id."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _WordHash()
        for batch in batches:
            for start, n in slices(pc.binary_length(batch.column(1)), 2 << 20):
                part = batch.slice(start, n)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([shingle_hashes(t, words, size).tobytes() for t in part.column(1).to_pylist()], pa.binary())], names=["doc_id", "_set"])

    # so few ids go to every executor and no text is shuffled; of more the texts are dealt by doc_id
    few = needed.limit(FEW + 1).count() <= FEW
    out = docs.join(F.broadcast(needed) if few else needed, "doc_id", "left_semi").mapInArrow(run, "doc_id long, _set binary").where("octet_length(_set) > 0")
    return out.distinct() if repeated else out


def _repeats(live: DataFrame) -> bool:
    """Whether some doc_id stands for more than one row."""
    return bool(live.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").limit(1).count())
