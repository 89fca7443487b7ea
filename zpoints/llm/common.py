"""Helpers shared by the operators: tables, saved intermediate results, labels, hashing, components."""

from __future__ import annotations

import atexit
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zpoints.session import checkpoint_dir

#: A word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_saved: dict[str, SparkSession] = {}


def _remove_saved() -> None:
    for path, spark in _saved.items():
        try:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jvm.org.apache.hadoop.conf.Configuration()).delete(p, True)
        except Exception:  # the JVM is gone: nothing is left to delete with
            return


def save(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as parquet into the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` but keeps columns and statistics,
    survives the loss of executors, and later jobs read only the columns they need.
    The table is removed when the driver exits.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._saved_path = path
    if not _saved:
        atexit.register(_remove_saved)
    _saved[path] = spark
    return out


def discard(df: DataFrame) -> None:
    """Delete a saved table whose readers have all finished."""
    spark, path = df.sparkSession, getattr(df, "_saved_path", None)
    if path:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        _saved.pop(path, None)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever its extra columns are called."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True for the rows whose labels are never learned: crc32 of the id as text, modulo 5, is 0."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """(doc_id, text, y) of at most ``max_rows`` labelled rows outside the held-out fold.

    The rows are the first by a hash of doc_id, so the choice is the same on
    every run. Only ids and labels are sorted; the bounded list of chosen ids
    is broadcast to the documents, whose texts are not shuffled.
    """
    picked = (
        labels.select("doc_id", F.col(label).cast("double").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    )
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")


# --------------------------------------------------------------------------- hashing of words

def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser on uint64 arrays."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_PRIME = np.uint64(0x9E3779B97F4A7C15)


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte offsets of the words in UTF-8 bytes."""
    space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
    return edge[0::2], edge[1::2]


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word: four 8-byte lanes at most are read at once, word by word in numpy.

    Bytes are read as little-endian 64-bit lanes; a lane past the end of the
    word is masked. Longer words loop over further lanes for the words that have them.
    """
    n = len(start)
    out = mix64((end - start).astype(np.uint64) + _PRIME)
    if n == 0:
        return out
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.lib.stride_tricks.sliding_window_view(padded, 8)
    at, live = start.copy(), np.arange(n)
    while len(live):
        left = end[live] - at[live]
        lane = np.ascontiguousarray(lanes[at[live]]).view("<u8").reshape(-1)
        short = np.minimum(left, 8).astype(np.uint64)
        mask = np.where(short == 8, np.uint64(0xFFFFFFFFFFFFFFFF),
                        (np.uint64(1) << (np.minimum(short, np.uint64(7)) * np.uint64(8))) - np.uint64(1))
        out[live] = mix64((out[live] * _PRIME) ^ (lane & mask))
        at[live] += 8
        live = live[left > 8]
    return out


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of every run of ``k`` consecutive entries (len(h) - k + 1 of them)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * _PRIME + h[i:i + n]
    return mix64(out)


# --------------------------------------------------------------------------- connected components

def components(edges: DataFrame, label: str, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of an undirected edge table (a, b); component is the least node reachable.

    Large-star and small-star rounds on Spark: every node hands its larger
    neighbours to its least neighbour, until the edge table is a set of
    stars. Rounds are logarithmic in practice. Each round is written to the
    shared folder, so no lineage grows; nothing but a count reaches the driver.
    A hub's neighbours stay separate rows (window minimum), so no task holds them at once.
    """
    from pyspark.sql import Window

    pairs = save(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .where("u <> v").distinct(), f"{label}-e")
    last = None
    for _ in range(max_rounds):
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = F.least(F.col("u"), F.min("v").over(Window.partitionBy("u")))
        large = (both.withColumn("m", least).where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        own_least = F.min("v").over(Window.partitionBy("u"))
        small = large.withColumn("m", own_least)
        small = (small.select("u", F.col("m").alias("v"))
                 .union(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct())
        done = save(small, f"{label}-r")
        mark = done.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(pairs)
        pairs = done
        if tuple(mark) == last:
            break
        last = tuple(mark)
    else:
        raise RuntimeError(f"components: no fixed point after {max_rounds} rounds")
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


LONG, INT, DOUBLE, STRING, BOOL, BINARY = (T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(),
                                           T.BooleanType(), T.BinaryType())


def schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])
