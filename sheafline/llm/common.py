"""Helpers shared by the operators of this subpackage: shared scratch tables, Arrow column maps, connected components."""

from __future__ import annotations

import atexit
import ctypes
import gc
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

_local_scratch: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``). Where that is unset a temporary one, for a local master only."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if at:
        return at.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _local_scratch:
        _local_scratch.append(tempfile.mkdtemp(prefix="sheafline-"))
        atexit.register(shutil.rmtree, _local_scratch[0], True)
    return _local_scratch[0]


def bound_batches(spark: SparkSession, limit: int = 16 << 20) -> None:
    """Lower the session's bytes per Arrow batch where they are Spark's default of 64 MB: each core holds such a batch in
    the JVM and again in Python."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, "67108864b") in ("67108864b", "64m", "67108864"):
        spark.conf.set(key, str(limit))


def release() -> None:
    """Give memory that a finished task leaves free back to the system; workers live on for the next task."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:
        pass  # another C library


_kept: dict = {}


def keep_one(key, make: Callable):
    """What ``make()`` gives, kept in this worker for its next tasks; only one such object is held at a time."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


class Scratch:
    """Written tables in the shared folder: they cut lineage and outlive a lost executor."""

    def __init__(self, spark: SparkSession, name: str):
        bound_batches(spark)
        self.spark, self.root, self.count = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", 0

    def save(self, df: DataFrame) -> DataFrame:
        self.count += 1
        at = f"{self.root}/{self.count}"
        df.write.parquet(at)
        out = self.spark.read.schema(df.schema).parquet(at)
        out._scratch_path = at
        return out

    def drop(self, df: DataFrame) -> None:
        """Delete a saved table that nothing will read again."""
        self._delete(df._scratch_path)

    def clear(self) -> None:
        """Delete all of them."""
        self._delete(self.root)

    def _delete(self, at: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


class BoundedCache(dict):
    """What ``make`` gives for a key (str or bytes), remembered within about ``limit`` bytes.

    Two generations: once the young one holds half of the limit it becomes the old one, and what is asked again moves to
    the new young one, so frequent keys stay and rare ones go.
    """

    #: Bytes of an entry besides the key: dictionary slots, object headers, a small value.
    entry, limit = 160, 32 << 20

    def __init__(self):
        super().__init__()
        self.held, self.old = 0, {}

    def make(self, key):
        raise NotImplementedError

    def weight(self, key, value) -> int:
        return len(key) + self.entry

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        n = self.weight(key, value)
        if n > self.limit >> 5:
            return value  # one long key doesn't push out all others
        self.held += n
        if self.held > self.limit >> 1:
            self.old = dict(self)
            self.clear()
            self.held = n
        self[key] = value
        return value


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows over all cores if the scan has fewer splits than cores (small files); a large scan is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def slices(lengths: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """(start, count) of runs of rows with at most ``limit`` bytes, one row at least."""
    start, held = 0, 0
    for i, n in enumerate(lengths.to_pylist()):
        if i > start and held + (n or 0) > limit:
            yield start, i - start
            start, held = i, 0
        held += n or 0
    if start < len(lengths):
        yield start, len(lengths) - start


def add_text_columns(df: DataFrame, text: str, fields: list[T.StructField], make: Callable[[], Callable[[list], dict]], limit: int = 2 << 20, keep_text: bool = True, keeps: bool = False) -> DataFrame:
    """Append columns computed from ``text``; every other column passes through unchanged, ``text`` only with ``keep_text``.

    ``make()`` is called once per task and gives a function from a list of texts (None for null) to a dict of column lists.
    It sees whole texts, at most about ``limit`` bytes of them at once, so memory is bounded by that or the longest text.
    Columns of ``df`` that bear a new column's name are replaced. Without ``keeps`` the task first drops what an earlier
    operator kept in its worker.
    """
    df = df.drop(*(f.name for f in fields))
    at = df.columns.index(text)
    passing = [i for i in range(len(df.columns)) if keep_text or i != at]
    schema = T.StructType([*(df.schema.fields[i] for i in passing), *fields])
    names = schema.names
    kinds = [to_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.set_threshold(200_000, 20, 20)  # the caches hold many small objects, none of them cyclic
        if not keeps:
            _kept.clear()
        fn = make()
        for batch in batches:
            for start, n in slices(pc.binary_length(batch.column(at)), limit):
                part = batch.slice(start, n)
                made = fn(part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in passing), *(pa.array(made[f.name], k) for f, k in zip(fields, kinds))], names=names)
        del fn
        release()

    bound_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def held_out(df: DataFrame, folds: int, fold: int):
    """True where crc32 of the doc_id as text leaves ``fold`` modulo ``folds``; a null doc_id is never held out."""
    return F.coalesce(F.crc32(df["doc_id"].cast("string").cast("binary")) % folds == fold, F.lit(False))


def components(spark: SparkSession, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root): the smallest node reachable over the undirected ``edges`` (a, b); nodes without an edge are absent.

    Alternates large-star and small-star steps (Kiveris et al., 2014), each written to the shared folder, until a step
    changes nothing. Rows per step stay within the number of edges, and each step is grouped by node with partial
    aggregation: the star's neighbours are never gathered into a list.
    """

    def digest(df: DataFrame):
        return df.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()

    current = scratch.save(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct())
    before = digest(current)
    while before[0]:
        # large star: each neighbour above a node is hung on the node's smallest neighbour (or on itself)
        around = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = around.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node's smaller neighbours, and the node, are hung on the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u")
        small = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        after = scratch.save(small)
        now = digest(after)
        scratch.drop(current)
        current = after
        if now == before:
            break
        before = now
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
