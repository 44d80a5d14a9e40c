"""What the operators share: stored steps, byte-bounded slices of Arrow text, linked components."""

from __future__ import annotations

import contextlib
import os
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextvars import ContextVar
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
SLICE_BYTES = 1 << 20
ARROW_BYTES = "4m"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names for stored steps; the warehouse where none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stored"


@contextlib.contextmanager
def step_settings(spark: SparkSession) -> Iterator[None]:
    """For jobs that end in a table: their shuffle files go with them, Arrow batches stay small."""
    wanted = {FREE_SHUFFLES: "true", BATCH_BYTES: ARROW_BYTES}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# Tables stored since the innermost ``stored_alone`` began; None outside of one.
_ON_THE_WAY: ContextVar[list[str] | None] = ContextVar("on_the_way", default=None)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: lineage is cut there."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    if (passed := _ON_THE_WAY.get()) is not None:
        passed.append(path)
    with step_settings(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_alone(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """The frame that ``make`` returns, stored; tables stored on the way to it are removed after that.

    They are this call's own (their names are drawn anew for each), and the frame returned reads
    none of them, so executors lost later cost nothing that they held.
    """
    passed: list[str] = []
    outer = _ON_THE_WAY.set(passed)
    try:
        df = make()
        _ON_THE_WAY.reset(outer)
        return stored(df, name)
    finally:
        if _ON_THE_WAY.get() is passed:
            _ON_THE_WAY.reset(outer)
        for path in passed:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def importable(spark: SparkSession) -> None:
    """Python workers find this package where the driver does, if that folder is there too.

    Batches sent to them are kept small, also in the job that writes a query's result: a batch lies
    outside of the heap several times over. A size that the session names itself stays.
    """
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, ARROW_BYTES)
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def one_text_each(texts: DataFrame) -> DataFrame:
    """Rows that share an id as one row with the greatest of their texts."""
    repeated = texts.groupBy("id").agg(F.count("*").alias("held")).where("held > 1").select("id")
    if repeated.isEmpty():
        return texts
    merged = texts.join(repeated, "id", "left_semi").groupBy("id").agg(F.max("text").alias("text"))
    return texts.join(repeated, "id", "left_anti").unionByName(merged)


MOST_BROADCAST = 64 << 20


def small(df: DataFrame, most: int = 2_000_000, size: Column | None = None) -> DataFrame:
    """``df`` for a broadcast join, or as it is.

    It is broadcast where it has at most ``most`` rows (ids and numbers) or, with ``size``, the bytes
    of a row, where these sum up to at most ``MOST_BROADCAST``.
    """
    if size is not None:
        return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= MOST_BROADCAST else df
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def fresh(name: str, taken: Iterable[str]) -> str:
    """``name``, with as many underscores after it as keep it apart from the names taken."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name += "_"
    return name


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column one after the other, and the n + 1 offsets of its rows."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows of at most ``most`` bytes of text; a longer text is a run alone."""
    _, offsets = text_bytes(batch.column(column))
    begin = 0
    while begin < len(offsets) - 1:
        end = int(np.searchsorted(offsets, offsets[begin] + most, "right")) - 1
        end = max(begin + 1, end)
        yield batch.slice(begin, end - begin)
        begin = end


def mixed(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads every input bit over the 64 output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Polynomial hashes modulo 2**64 of any byte ranges of one text, from prefix sums."""

    BASE = 0x9E3779B97F4A7C15 | 1
    _cache: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray, seed: int = 0):
        values, powers, inverses = self._tables(seed, len(data))
        sums = np.empty(len(data) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(values[data] * powers[: len(data)], out=sums[1:])
        self.sums, self.inverses = sums, inverses

    @classmethod
    def _tables(cls, seed: int, length: int):
        held = cls._cache.get(seed)
        if held is None or len(held[1]) < length + 1:
            size = max(length + 1, SLICE_BYTES + 1)
            base = (cls.BASE + 2 * seed * 0xD6E8FEB86659FD93) % 2**64
            with np.errstate(over="ignore"):
                values = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(cls.BASE) + np.uint64(seed))
                tables = [values]
                for b in (base, pow(base, -1, 2**64)):
                    steps = np.full(size, b, np.uint64)
                    steps[0] = 1
                    tables.append(np.cumprod(steps))
            held = tuple(tables)
            cls._cache = {**cls._cache, seed: held} if size <= SLICE_BYTES + 1 else cls._cache
        return held

    def ranges(self, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the bytes from ``begins`` up to ``ends``."""
        with np.errstate(over="ignore"):
            return mixed((self.sums[ends] - self.sums[begins]) * self.inverses[begins])


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
    """Begins and ends of the maximal runs of word bytes; a run ends with its row.

    Returns begins, ends and the number of the first word of each row (n + 1 numbers).
    """
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = is_word[data]
    here, before = inside[1:-1], inside[:-2].copy()
    edges = offsets[:-1][offsets[:-1] < len(data)]
    before[edges] = False
    begins = np.flatnonzero(here & ~before)
    after = inside[2:].copy()
    edges = offsets[1:][offsets[1:] > 0] - 1
    if len(data):
        after[edges] = False
    ends = np.flatnonzero(here & ~after) + 1
    return begins, ends, np.searchsorted(begins, offsets)


RUN_EDGES = 1 << 20


def spanning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) as fewer ones with the same components: in runs, each node with the smallest it reaches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= RUN_EDGES:
            yield _stars(held)
            held = []
    if held:
        yield _stars(held)


def _stars(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    both = pa.concat_arrays([x.column(c) for c in ("a", "b") for x in held]).dictionary_encode()
    order = pa.compute.sort_indices(both.dictionary)
    ids = both.dictionary.take(order)
    rank = np.empty(len(ids), np.int64)
    rank[np.asarray(order)] = np.arange(len(ids))
    u, v = np.split(rank[np.asarray(both.indices)], 2)
    label = np.arange(len(ids))
    while len(u):
        np.minimum.at(label, np.maximum(u, v), np.minimum(u, v))
        while (label[label] != label).any():
            label = label[label]
        u, v = label[u], label[v]
        u, v = u[u != v], v[u != v]
    rest = np.flatnonzero(label != np.arange(len(ids)))
    return pa.RecordBatch.from_arrays([ids.take(pa.array(rest)), ids.take(pa.array(label[rest]))], ["a", "b"])


def components(edges: DataFrame, name: str) -> DataFrame:
    """The smallest reachable id of every id in ``edges`` (columns a, b): node, component."""
    now = smallest_reached(edges, name)
    return now.unionByName(now.select(F.col("component").alias("node"), "component").distinct())


def smallest_reached(edges: DataFrame, name: str, rounds: int = 60) -> DataFrame:
    """Of every id in ``edges`` (columns a, b) that reaches a smaller one, the smallest: node, component.

    In every round tasks reduce their edges to spanning ones; then each node's larger neighbours,
    then its smaller ones, are connected to the smallest of all; only minima per node are gathered, so
    a node with many links is no large group. Rounds are stored in the shared folder and end when
    every node has its edge to the smallest id and no other.
    """
    importable(edges.sparkSession)
    kind = edges.schema["a"].dataType.simpleString()

    def apart(df: DataFrame) -> DataFrame:
        return df.where("a is not null and b is not null and a <> b").select("a", "b")

    def ordered(df: DataFrame) -> DataFrame:
        return apart(df).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def star(df: DataFrame, both: bool) -> DataFrame:
        pairs = df.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if both:
            pairs = pairs.unionByName(df.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        joined = pairs.join(least, "u")
        if both:
            return ordered(joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")))
        own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        return ordered(joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(own))

    def settled(df: DataFrame) -> bool:
        ends = df.select(F.col("a").alias("u"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            df.select(F.col("b").alias("u"), F.lit(0).alias("up"), F.lit(1).alias("down"))
        )
        held = ends.groupBy("u").agg((F.sum("up") + F.max("down")).alias("held"))
        return (held.agg(F.max("held")).first()[0] or 0) < 2

    now = edges
    for _ in range(rounds):
        now = stored(apart(now).mapInArrow(spanning, f"a {kind}, b {kind}"), f"{name}-edges")
        now = stored(star(star(now, True), False), f"{name}-links")
        if settled(now):
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    raise RuntimeError("the components did not settle")
