"""What the operators share: tables written in the shared folder, Arrow batches in bounded slices, sorted runs."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldspark.session import checkpoint_root

#: Text bytes that a Python worker handles at once.
SLICE_BYTES = 1 << 20
#: Bytes of a batch on its way between Spark and a Python worker while a table is written, where Spark's own default is 64 MB.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "8m"

_held: dict = {}


def held(key: object, build: Callable[[], object]):
    """A large object that a Python worker keeps between tasks: the latest one only, as workers outlive a step."""
    if key not in _held:
        _held.clear()
        _held[key] = build()
    return _held[key]


def give_back() -> None:
    """Hand freed memory back to the system: Python workers outlive a step and share an executor's memory with its heap."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def in_batches(df: DataFrame, step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema, keeps: bool = False) -> DataFrame:
    """``mapInArrow`` whose step, if it ``keeps`` nothing, starts without the ``held`` object of an earlier one."""

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            _held.clear()
        try:
            yield from step(batches)
        finally:
            give_back()

    return df.mapInArrow(bounded, schema)


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's ``spark.checkpoint.dir``; a local one only where that is unset on one machine."""
    fallback = None
    if spark.conf.get("spark.checkpoint.dir", None) is None and spark.conf.get("spark.master", "").split("[")[0] == "local":
        fallback = tempfile.mkdtemp(prefix="run-")
    return f"{checkpoint_root(spark, fallback)}/{name}-{uuid.uuid4().hex}"


def landed(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write a table in the shared folder and read it back, so that nothing before it runs again.

    Python workers get small batches meanwhile, unless the session names a bound itself.
    """
    spark, path = df.sparkSession, f"{folder}/{name}"
    own = spark.conf.get(BATCH_SETTING, None)
    spark.conf.set(BATCH_SETTING, own or BATCH_BYTES)
    try:
        df.write.parquet(path)
    finally:
        if own is None:
            spark.conf.unset(BATCH_SETTING)
    return spark.read.schema(df.schema).parquet(path)


def quoted(name: str) -> Column:
    """A column by its whole name, whatever characters that holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_column(name: str = "text") -> Column:
    """A text with null as empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def numbered_rows(docs: DataFrame, folder: str) -> tuple[DataFrame, bool]:
    """``row``, a number of its own for each row, rising with ``doc_id`` (null first), and the row itself as the struct ``it``.

    Unique identifiers are their own numbers; the flag tells whether they are. Otherwise the rows are sorted in ranges and written
    with a number; rows equal in identifier follow one another in order of their text's hash.
    """
    spark = docs.sparkSession
    rows = docs.select(quoted("doc_id").cast("long").alias("row"), F.struct(*map(quoted, docs.columns)).alias("it"))
    total, distinct = rows.agg(F.count("*"), F.countDistinct("row")).first()
    if total == distinct:
        return rows, True
    order = [F.col("row"), F.xxhash64("it.text")]
    dealt = rows.repartitionByRange(partitions_for(spark), *order).sortWithinPartitions(*order)
    return landed(dealt.select(F.monotonically_increasing_id().alias("row"), "it"), folder, "rows"), False


#: Bits of a ``RowBits`` mask, which bounds what is broadcast: 64 to a row of its table.
MASK_BITS = 1 << 24


class RowBits:
    """A mask of some rows, by a hash of their number: a bit that is not set tells that a row is surely not among them.

    It spares a shuffle to most rows where few are looked for. Its size is fixed; with very many rows it tells
    nothing any more, and then all of them are shuffled, with the same result.
    """

    def __init__(self, chosen: DataFrame, folder: str, name: str):
        """``chosen``: a written table with column ``row``."""
        self.chosen = chosen.select("row")
        bits = self.chosen.select(self._bit("row").alias("bit")).groupBy(F.expr("bit div 64").alias("word"))
        self.words = landed(bits.agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 AS int))")).alias("bits")), folder, name)

    @staticmethod
    def _bit(row: str) -> Column:
        return F.pmod(F.xxhash64(row), F.lit(MASK_BITS))

    def _marked(self, rows: DataFrame) -> DataFrame:
        """Adds ``maybe``, true for every chosen row and few others."""
        words = F.broadcast(self.words.withColumnsRenamed({"word": "mask_word", "bits": "mask_bits"}))
        bit = self._bit("row")
        joined = rows.withColumn("mask_bit", bit).join(words, F.expr("mask_bit div 64") == F.col("mask_word"), "left")
        maybe = F.coalesce(F.expr("getbit(mask_bits, cast(mask_bit % 64 AS int))") == 1, F.lit(False))
        return joined.withColumn("maybe", maybe).drop("mask_bit", "mask_word", "mask_bits")

    def maybe(self, rows: DataFrame) -> DataFrame:
        """The rows without most of those that are not chosen."""
        return self._marked(rows).where("maybe").drop("maybe")

    def drop(self, rows: DataFrame) -> DataFrame:
        """The rows that are not chosen."""
        marked = self._marked(rows)
        return marked.where("not maybe").union(marked.where("maybe").join(self.chosen, "row", "left_anti").select(*marked.columns)).drop("maybe")


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``most`` bytes of one text column, or one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = batch.column(column)
        sizes = np.asarray(pc.binary_length(sizes).fill_null(0)).astype(np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(int(np.searchsorted(ends, before + most, "right")), start + 1)
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column, one after another, and n + 1 offsets into them; null is empty."""
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    size = int(offsets[-1] - offsets[0])
    data = np.frombuffer(data, np.uint8, size, int(offsets[0])) if size else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def neighbour_runs(
    df: DataFrame, keys: list[str], order: list[Column], partitions: int, splitters: list[str] | None = None
) -> DataFrame:
    """Sort by ``keys`` and ``order`` and number the runs of equal keys, without gathering a run in one task.

    Sampled splitters over ``splitters`` (default: the keys) and ``order`` deal the rows out in ranges, so a run
    with many rows spreads over neighbouring ranges. Each sorted range is streamed and each row compared
    with the one before it. Adds ``run`` (a number, unique for a run within its range, rising in sort order),
    ``head`` (first row of the run in its range) and ``edge``. Rows with ``edge`` are extra: they hold only the keys and
    the run of the first and the last run of a range, for ``crossing``. Null keys equal each other.
    """
    splitters = splitters or keys
    dealt = df.repartitionByRange(partitions, *splitters, *order)
    extra = [c for c in splitters if c not in keys]
    dealt = dealt.sortWithinPartitions(*[F.col(c) for c in extra], *keys, *order).withColumn("__part", F.spark_partition_id())
    schema = T.StructType(
        [T.StructField(f.name, f.dataType) for f in df.schema.fields]
        + [T.StructField("run", T.LongType()), T.StructField("head", T.BooleanType()), T.StructField("edge", T.BooleanType())]
    )
    columns = df.columns

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        run, part = -1, 0
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            new = np.zeros(n, bool)
            for k in keys:
                c = batch.column(k)
                if n > 1:
                    a, b = c.slice(1), c.slice(0, n - 1)
                    same = pc.equal(a, b).fill_null(False)
                    if c.null_count:
                        same = pc.or_(same, pc.and_(pc.is_null(a), pc.is_null(b)))
                    new[1:] |= ~np.asarray(same)
            start = [batch.column(k).slice(0, 1).to_pylist() for k in keys]
            new[0] = last is None or start != [c.to_pylist() for c in last]
            last = [pa.array(batch.column(k).slice(n - 1, 1).to_pylist(), batch.column(k).type) for k in keys]
            part = int(batch.column("__part")[0].as_py()) << 33
            runs = part + run + np.cumsum(new)
            run += int(new.sum())
            if first is None:
                first = [pa.array(c, batch.column(k).type) for c, k in zip(start, keys)]
                types = [batch.column(c).type for c in columns]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(runs), pa.array(new), pa.array(np.zeros(n, bool))],
                [*columns, "run", "head", "edge"],
            )
        if first is not None:
            for key, at in ((first, part), (last, part + run))[: 1 + (run > 0)]:
                known = dict(zip(keys, key))
                yield pa.RecordBatch.from_arrays(
                    [*(known.get(c, pa.nulls(1, t)) for c, t in zip(columns, types)), pa.array([at]), pa.array([False]), pa.array([True])],
                    [*columns, "run", "head", "edge"],
                )

    return in_batches(dealt, number, schema)


def crossing(numbered: DataFrame, keys: list[str]) -> DataFrame:
    """Runs that go on from an earlier range: ``run`` and ``whole``, the first of the runs with the same keys.

    At most two rows for each range, which is what makes it fit for a broadcast.
    """
    edges = numbered.where("edge").select("run", F.struct(*keys).alias("__key"))
    firsts = edges.groupBy("__key").agg(F.min("run").alias("whole"), F.collect_list("run").alias("runs"))
    return firsts.where(F.size("runs") > 1).select(F.explode("runs").alias("run"), "whole").where("run > whole")


def partitions_for(spark: SparkSession, least: int = 1) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), least)


def discard(spark: SparkSession, folder: str, name: str) -> None:
    """Remove a table that ``landed`` wrote, once all that is read from it has been landed itself."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
