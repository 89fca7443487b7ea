"""Near-duplicate documents by ProbMinHash sketches of weighted shingles, banding and verification.

A document is a weighted set: its runs of five words, each with weight
1 + ln(count), at most MOST_WEIGHT. Every element is a Poisson process whose
rate is its weight; an arrival falls into a random register, and a register
keeps the element that came first. Two documents agree in a register with the
probability Jaccard similarity of their weighted sets. An element's arrivals
stop as soon as the next one is later than every register of its document
(early termination).

Weights only rank candidates; duplicates are decided by plain Jaccard
similarity. As all weights lie in [1, MOST_WEIGHT], a common element holds a
register with a probability of at least 1 / (MOST_WEIGHT * size of the union),
whatever is repeated how often on either side, so plain similarity >= t means
weighted similarity >= t / MOST_WEIGHT. Bands and the agreement asked for in
step 3 are derived from this floor: a pair at the floor shares no band with a
probability of at most MISS.

Registers are banded. Links are found without listing the pairs of a bucket:

1. Equal texts are one class, represented by its row with the least doc_id. A
   document is a (doc_id, text); nodes are numbers of rows, so rows that share a doc_id never share a node.
2. Every member of a bucket is verified against the bucket's least member, and
   verified pairs give components.
3. Only buckets that still hold several components are looked at again. The
   members of a bucket's largest component, usually nearly all, are sent once,
   in chunks of bounded size; the few others are copied to each chunk, and
   meet one another in chunks of their own. These rows carry sketches, no
   texts. Documents that agree well enough with one of another component then
   fetch their texts to the same chunks, pairs are verified there, and only
   links that join two components leave them.

Verification takes the whole texts: Jaccard similarity of the two sets of
shingles, at or above the threshold. Components are the classes of near
duplicates; their least doc_id is the class id.

Defined cases: a text of one to four words is one shingle; a null text or one
without words links with nothing and is a class of its own; rows with a null
doc_id take no part and return a null class; rows that repeat a doc_id with the same text are one
document; with different texts they are documents of their own, which may be in different classes, and of
a class whose least doc_id they share the one with the least digest of its text is kept; an
empty table gives an empty result. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BINARY, DOUBLE, LONG, components, fresh, mix64, rolling, save, schema, word_hashes, word_spans

_STEP = np.uint64(0xD1342543DE82EF95)
_STRIDE = 0xD1342543DE82EF95

#: The weight of a shingle however often it is repeated; a shingle that occurs once weighs 1.
MOST_WEIGHT = 1.1
#: Numbers of rows inside one task.
TASK_BITS = 36
#: The chance that a pair at the weighted floor shares no band.
MISS = 1e-4


def weighted_floor(threshold: float) -> float:
    """The least weighted similarity of two documents whose plain similarity reaches ``threshold``."""
    return threshold / MOST_WEIGHT


def rows_of_band(threshold: float, registers: int) -> int:
    """The most registers a band may have so that pairs at the weighted floor are missed with probability <= MISS."""
    floor = weighted_floor(threshold)
    fits = [r for r in (8, 4, 2, 1) if registers % r == 0 and (1 - floor**r) ** (registers // r) <= MISS]
    if not fits:
        raise ValueError(f"{registers} registers are too few for a threshold of {threshold}")
    return fits[0]


def shingles(texts: list[str], k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(index of the text, hash) of every run of k words of every text; a text of fewer words has one run."""
    raw = [t.encode("utf-8") for t in texts]
    data = np.frombuffer(b" ".join(raw), np.uint8)
    ends = np.cumsum([len(r) + 1 for r in raw])
    start, end = word_spans(data)
    doc = np.searchsorted(ends, start, side="right")
    h = word_hashes(data, start, end)
    run = rolling(h, k)
    whole = doc[:len(run)] == doc[k - 1:] if len(run) else np.zeros(0, bool)
    at, value = doc[:len(run)][whole], run[whole]
    n = np.bincount(doc, minlength=len(texts))
    few = np.flatnonzero((n > 0) & (n < k))
    if len(few):
        first = np.cumsum(n) - n
        short = [rolling(h[first[i]:first[i] + n[i]], int(n[i]))[0] for i in few]
        at, value = np.concatenate([at, few]), np.concatenate([value, np.array(short, np.uint64)])
    return at, value


def weighted_sets(texts: list[str], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, element, weight) with weight 1 + ln(count) up to MOST_WEIGHT, sorted by text and element."""
    at, value = shingles(texts, k)
    order = np.lexsort((value, at))
    at, value = at[order], value[order]
    if not len(at):
        return at, value, np.zeros(0)
    first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (value[1:] != value[:-1])]))
    count = np.diff(np.concatenate([first, [len(at)]]))
    return at[first], value[first], np.minimum(1 + np.log(count), MOST_WEIGHT)


def probminhash(at: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, registers: int) -> np.ndarray:
    """The n x registers sketch: the element whose arrival came first in each register (0 for an empty set)."""
    when = np.full(n * registers, np.inf)
    who = np.zeros(n * registers, np.uint64)
    x = np.zeros(len(at))
    t = 0
    while len(at):
        t += 1
        h = mix64(element + np.uint64(t * _STRIDE & 0xFFFFFFFFFFFFFFFF))
        x = x - np.log(((h >> np.uint64(11)) + np.uint64(1)).astype(float) * 2.0**-53) / weight
        slot = at * registers + (h & np.uint64(registers - 1)).astype(np.int64)
        np.minimum.at(when, slot, x)
        won = when[slot] == x
        who[slot[won]] = element[won]
        live = x < when.reshape(n, registers).max(axis=1)[at]
        at, element, weight, x = at[live], element[live], weight[live], x[live]
    return who.reshape(n, registers)


def _pieces(texts: list[str], chars: int):
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars or i == len(texts) - 1:
            yield at, i + 1
            at, size = i + 1, 0


def sketch(docs: DataFrame, *, k: int = 5, registers: int = 128, band_rows: int = 4) -> DataFrame:
    """(doc_id, text_key, rid, bands, registers as 16-bit remainders) of every row with an id.

    ``rid`` numbers the rows, ``bands`` is null for a text without words.
    """
    def run(batches):
        at_row = 0
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            base = (batch.column(2)[0].as_py() << TASK_BITS) + at_row if len(texts) else 0
            at_row += len(texts)
            for lo, hi in _pieces(texts, 2_000_000):
                part = texts[lo:hi]
                at, element, weight = weighted_sets(part, k)
                who = probminhash(at, element, weight, len(part), registers)
                grouped = who.reshape(len(part), -1, band_rows)
                key = np.arange(grouped.shape[1], dtype=np.uint64)[None, :] * _STEP
                for r in range(band_rows):
                    key = mix64(key * _STEP + grouped[:, :, r])
                some = np.bincount(at, minlength=len(part)) > 0
                bands = [b if ok else None for b, ok in zip(key.astype(np.int64), some)]
                small = (mix64(who) & np.uint64(0xFFFF)).astype("<u2")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo),
                     pa.array([hashlib.md5(t.encode("utf-8")).digest() for t in part], pa.binary()),
                     pa.array(np.arange(base + lo, base + hi)), pa.array(bands, pa.list_(pa.int64())),
                     pa.array([s.tobytes() for s in small], pa.binary())],
                    ["doc_id", "text_key", "rid", "bands", "registers"])

    out = schema(doc_id=LONG, text_key=BINARY, rid=LONG, bands=T.ArrayType(LONG), registers=BINARY)
    return (docs.where("doc_id IS NOT NULL")
            .select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.spark_partition_id().cast("long").alias("part"))
            .mapInArrow(run, out))


def text_key(text: str = "text"):
    """The digest of a text that sketches carry; a null text counts as empty."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def verify(pairs: DataFrame, texts: DataFrame, *, threshold: float, k: int) -> DataFrame:
    """The pairs (a, b) whose whole texts have Jaccard similarity of shingles >= threshold. ``texts``: node, text."""
    one = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    other = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def run(batches):
        kept: dict[int, tuple[str, np.ndarray]] = {}

        def elements(i, text):
            hit = kept.get(i)
            if hit is None or hit[0] != text:
                if len(kept) > 64:
                    kept.clear()
                hit = kept[i] = (text, np.unique(shingles([text], k)[1]))
            return hit[1]

        for batch in batches:
            a, b, text_a, text_b = (batch.column(i).to_pylist() for i in range(4))
            value = []
            for i, j, s, t in zip(a, b, text_a, text_b):
                x, y = elements(i, s or ""), elements(j, t or "")
                both = len(np.intersect1d(x, y, assume_unique=True))
                value.append(both / max(len(x) + len(y) - both, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(value, pa.float64())],
                                             ["a", "b", "similarity"])

    joined = pairs.select("a", "b").join(one, "a").join(other, "b").select("a", "b", "text_a", "text_b")
    return (joined.mapInArrow(run, schema(a=LONG, b=LONG, similarity=DOUBLE))
            .where(F.col("similarity") >= threshold))


def _agreeing(pdf: pd.DataFrame, least: float) -> list[tuple[float, int, int]]:
    """(agreement, i, j): rows of a group that are of different components and agree in ``least`` of the registers.

    Rows of side 0 are held against those of side 1, and those of side 1
    against one another where the group says so. A pair is left to the first band that it shares.
    """
    regs = np.stack([np.frombuffer(r, "<u2") for r in pdf["registers"]])
    bands = np.stack(pdf["bands"].to_numpy())
    nth = int(np.argmax(bands[0] == pdf["band"].iloc[0]))
    comp, side = pdf["component"].to_numpy(), pdf["side"].to_numpy()
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    cols = np.concatenate([left, right]) if pdf["within"].iloc[0] else left
    place = np.arange(len(cols)) - len(left)  # of the columns that are rows of side 1
    found = []
    for at in range(0, len(right), 64):  # bounded blocks of pairs
        rows = right[at:at + 64]
        ok = (comp[rows][:, None] != comp[cols][None, :]) & (
            (place[None, :] < 0) | (place[None, :] > np.arange(at, at + len(rows))[:, None]))
        i, j = (x[k] for x, k in zip((rows, cols), np.nonzero(ok)))
        for b in range(nth):
            if not len(i):
                break
            later = bands[i, b] != bands[j, b]
            i, j = i[later], j[later]
        if len(i):
            agree = (regs[i] == regs[j]).mean(axis=1)
            near = agree >= least
            found += zip(agree[near].tolist(), i[near].tolist(), j[near].tolist())
    return found


def _wanted(least: float):
    """Of a group of sketches: the nodes that agree with one of another component."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = sorted({m for _, i, j in _agreeing(pdf, least) for m in (i, j)})
        return pdf.iloc[rows]
    return run


def _cross_links(k: int, threshold: float, least: float):
    """Of a group of documents: verified links between different components, a forest of them at most.

    Best agreement is verified first, on the whole texts; a pair that is connected by then is not needed.
    """
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node").reset_index(drop=True)
        ids, comp = pdf["node"].to_numpy(), pdf["component"].to_numpy()
        parent = {c: c for c in comp.tolist()}

        def root(c):
            while parent[c] != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        sets: dict[int, np.ndarray] = {}
        out = []
        for _, i, j in sorted(_agreeing(pdf, least), key=lambda x: -x[0]):
            a, b = root(int(comp[i])), root(int(comp[j]))
            if a == b:
                continue
            for m in (i, j):
                if m not in sets:
                    sets[m] = np.unique(shingles([pdf["text"].iloc[m] or ""], k)[1])
            x, y = sets[i], sets[j]
            if min(len(x), len(y)) < threshold * max(len(x), len(y)):
                continue
            both = len(np.intersect1d(x, y, assume_unique=True))
            if both >= threshold * (len(x) + len(y) - both):
                parent[max(a, b)] = min(a, b)
                out.append((int(ids[i]), int(ids[j])))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")
    return run


def _dealt(placed: DataFrame, block: int) -> DataFrame:
    """Members of the buckets that hold several components -> (band, component, node, side, gi, gj, within).

    Groups (gi, gj) pair chunk gi of the largest component with chunk gj of
    the others; with gi = 0 the others of the chunk are also held against one
    another, and groups with gi < 0 pair two different chunks of the others.
    """
    per = placed.groupBy("band", "component").agg(F.count("*").alias("n"))
    info = (per.groupBy("band").agg(F.count("*").alias("kinds"), F.max(F.struct("n", "component")).alias("big"), F.sum("n").alias("all"))
            .where("kinds > 1").select("band", F.col("big.component").alias("most"),
                                       F.ceil(F.col("big.n") / block).cast("int").alias("cb"),
                                       F.ceil((F.col("all") - F.col("big.n")) / block).cast("int").alias("co")))
    rows = placed.join(info, "band").withColumn("big", F.col("component") == F.col("most"))
    spread = F.pmod(F.xxhash64("node"), F.when(F.col("big"), F.col("cb")).otherwise(F.col("co")).cast("long")).cast("int")
    rows = rows.withColumn("c", spread)
    return rows.selectExpr("band", "component", "node", """inline(CASE WHEN big
        THEN transform(sequence(0, co - 1), j -> struct(0 AS side, c AS gi, j AS gj, c = 0 AS within))
        ELSE concat(transform(sequence(0, cb - 1), i -> struct(1 AS side, i AS gi, c AS gj, i = 0 AS within)),
                    transform(filter(sequence(0, co - 1), j -> j <> c),
                              j -> struct(IF(j < c, 1, 0) AS side, -1 - least(c, j) AS gi, greatest(c, j) AS gj, false AS within)))
        END)""")


def _classes(docs: DataFrame, threshold: float, k: int, registers: int, band_rows: int | None, block: int,
             slack: float) -> DataFrame:
    """(doc_id, text_key, class_id, kept) of every row with an id."""
    band_rows = band_rows or rows_of_band(threshold, registers)
    least = weighted_floor(threshold) - slack
    sk = save(sketch(docs, k=k, registers=registers, band_rows=band_rows), "pmh-sketch")
    texts_of = save(sk.where("bands IS NOT NULL").groupBy("text_key").agg(F.min(F.struct("doc_id", "rid")).alias("rep"))
                    .select("text_key", F.col("rep.rid").alias("node"), F.col("rep.doc_id").alias("rep_id")), "pmh-texts-of")
    reps = texts_of.join(sk.select("rid", "bands", "registers"), F.col("node") == F.col("rid"))
    members = reps.select("node", "rep_id", F.explode("bands").alias("band")).distinct()
    by_band = Window.partitionBy("band")
    # the leader has the least doc_id: originals tend to come before their copies, which are more like them than like one another
    buckets = save(members.withColumns({"leader": F.min(F.struct("rep_id", "node")).over(by_band)["node"], "n": F.count("*").over(by_band)})
                   .where("n > 1").drop("rep_id"), "pmh-buckets")
    needed = buckets.select("node").distinct().join(texts_of, "node")
    own = docs.select(F.col("doc_id").cast("long").alias("rep_id"), text_key().alias("text_key"), F.col("text").alias("text"))
    # rows equal in doc_id and text lie together after the join: one of them is enough
    texts = save(own.join(needed, ["rep_id", "text_key"]).groupBy("rep_id", "text_key")
                 .agg(F.first("node").alias("node"), F.first("text").alias("text")).select("node", "text"), "pmh-texts")
    stars = buckets.where("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
    links = save(verify(stars, texts, threshold=threshold, k=k).select("a", "b"), "pmh-links")
    first = save(components(links, "pmh"), "pmh-first")

    placed = (buckets.where("n > 2").join(first.withColumnRenamed("node", "named"), F.col("node") == F.col("named"), "left")
              .select("band", "node", F.coalesce("component", "node").alias("component")))
    sketches = reps.select("node", "bands", "registers")
    dealt = _dealt(placed, block).join(sketches, "node")
    group = ["band", "gi", "gj"]
    out = T.StructType([T.StructField("node", LONG), T.StructField("band", LONG), T.StructField("component", LONG),
                        T.StructField("side", T.IntegerType()), T.StructField("gi", T.IntegerType()),
                        T.StructField("gj", T.IntegerType()), T.StructField("within", T.BooleanType()),
                        T.StructField("bands", T.ArrayType(LONG)), T.StructField("registers", BINARY)])
    wanted = save(dealt.select(out.names).groupBy(*group).applyInPandas(_wanted(least), out), "pmh-wanted")
    late = save(wanted.join(texts, "node").groupBy(*group).applyInPandas(_cross_links(k, threshold, least), schema(a=LONG, b=LONG))
                .distinct(), "pmh-late")
    name = lambda c: first.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
    bridges = (late.join(name("a"), "a", "left").join(name("b"), "b", "left")
               .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    second = components(bridges, "pmh2") if not late.isEmpty() else None
    if second is not None:
        second = second.select(F.col("node").alias("component"), F.col("component").alias("final"))
        first = first.unionByName(second.select(F.col("component").alias("node"), "component")
                                  .join(first.select("node"), "node", "left_anti"))
        first = first.join(second, "component", "left").select("node", F.coalesce("final", "component").alias("component"))
    # only linked texts have a component; a class is named after its least doc_id
    linked = first.join(texts_of, "node").select("component", "text_key", "rep_id")
    named = linked.groupBy("component").agg(F.min(F.struct("rep_id", "text_key")).alias("least"))
    found = linked.join(named, "component").select("text_key", "least")
    # without links the texts equal to one's own are the class; a text without words is one by itself
    heads = texts_of.join(found, "text_key", "left").select("text_key", F.coalesce("least", F.struct("rep_id", "text_key")).alias("head"))
    rows = sk.select("doc_id", "text_key").join(heads, "text_key", "left")
    head = F.coalesce("head", F.struct(F.col("doc_id").alias("rep_id"), "text_key"))
    return rows.select("doc_id", "text_key", head["rep_id"].alias("class_id"),
                       ((F.col("doc_id") == head["rep_id"]) & (F.col("text_key") == head["text_key"])).alias("kept"))


def near_duplicates(docs: DataFrame, *, threshold: float = 0.8, k: int = 5, registers: int = 128,
                    band_rows: int | None = None, block: int = 512, slack: float = 0.2) -> DataFrame:
    """(doc_id, class_id, kept) of every row of ``docs``; kept marks the document with the least doc_id of its class.

    ``band_rows``: registers of a band, by default as :func:`rows_of_band` derives them (4 at a threshold of 0.8).
    ``slack``: in step 3, pairs are verified if their sketches agree in at least ``weighted_floor(threshold) - slack``
    of the registers; with 128 registers that is more than five standard deviations below the floor.
    """
    found = _classes(docs, threshold, k, registers, band_rows, block, slack).select("doc_id", "class_id", "kept")
    nameless = docs.where("doc_id IS NULL").select(F.col("doc_id").cast("long"), F.lit(None).cast("long").alias("class_id"))
    return found.unionByName(nameless.withColumn("kept", F.lit(True)))


def drop_near_duplicates(docs: DataFrame, *, threshold: float = 0.8, k: int = 5, registers: int = 128,
                         band_rows: int | None = None, block: int = 512, slack: float = 0.2) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each class (rows without an id all stay), all columns kept."""
    name, key = fresh(docs, "gone"), fresh(docs, "gone_key")
    gone = (_classes(docs, threshold, k, registers, band_rows, block, slack).where("NOT kept")
            .select(F.col("doc_id").alias(name), F.col("text_key").alias(key)).distinct())
    return docs.join(gone, (F.col("doc_id") == F.col(name)) & (text_key() == F.col(key)), "left_anti")
