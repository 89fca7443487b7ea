"""Mix sources to target weights by a time-varying curriculum. DataFrame operations only.

Every source has a weight and a schedule: over training time t in [0, 1] its
rate is ``weight * (1 + slope * (2 t - 1))``, so the integral over the whole
run is the weight. A source's cumulative demand is
``D(t) = target * ((1 - slope) t + slope t^2)``; a document that starts at word
``c`` of its source's stream is wanted when ``D(t) = c``, and the inverse of D
gives its training position. Documents are range-sorted by position.

A source's stream is its documents in the order of a hash of doc_id, repeated;
whole documents are taken: the curriculum is run over every epoch of the
stream, and a copy is in the mix if the demand reaches its middle word before
the end of training. Word offsets are prefix sums in two steps (per
bucket of the hash, then inside a bucket), so a source with any share of the
rows is spread over ``16 ** bucket_digits`` groups.

``mix_sources`` plans the documents, with their texts where it is asked to carry
them; ``mix_digests`` runs such a plan: every copy is put with its text in its place
of the training order, and what the mix holds of a document is counted there.
``training_order`` returns these rows as documents.

Defined cases: a null or empty text has size 0 and takes nothing; a null
source is a source of its own, last in order; a null doc_id hashes like the
empty text; rows that repeat an id follow each other in the stream and count
one by one; an empty table gives an empty result. Columns other than doc_id,
text and source are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, fresh, save

SLOPES = (0.6, 0.0, -0.6)


def _key(c: str) -> list[Column]:
    return [F.col(c).isNull().alias("no_source"), F.coalesce(F.col(c), F.lit("")).alias("source_key")]


def source_targets(per_source: DataFrame, weights: Sequence[float], share: float, cap: float,
                   slopes: Sequence[float] = SLOPES) -> DataFrame:
    """Water filling over one row per source (no_source, source_key, source_size).

    target = least(level * weight, cap * source_size), with the level at which
    the targets add up to ``share`` of all sizes: what a capped source cannot
    take is shared by weight among the others until none is above its cap.
    """
    order = Window.orderBy("no_source", "source_key")
    pick = lambda xs: F.element_at(F.array(*[F.lit(float(x)) for x in xs]),
                                   ((F.col("nth") - 1) % len(xs) + 1).cast("int"))
    s = (per_source.withColumn("nth", F.row_number().over(order))
         .withColumns({"weight": pick(weights), "slope": pick(slopes)})
         .withColumn("most", cap * F.col("source_size")))
    everything = Window.partitionBy()
    rising = Window.orderBy(F.col("most") / F.col("weight"), "nth").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumns({
        "budget": share * F.sum("source_size").over(everything),
        "spent": F.coalesce(F.sum("most").over(rising), F.lit(0.0)),
        "heavy": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(rising), F.lit(0.0)),
    }).withColumn("level", (F.col("budget") - F.col("spent")) / F.col("heavy"))
    s = s.withColumn("open_level", F.when(F.col("most") > F.col("level") * F.col("weight"), F.col("level")))
    s = s.withColumn("level", F.max("open_level").over(everything))  # of the first that is open; later ones are lower
    return s.select("no_source", "source_key", "source_size", "slope",
                    F.least(F.col("most"), F.coalesce(F.col("level") * F.col("weight"), F.col("most"))).alias("target"))


def position(offset: Column, target: Column, slope: Column) -> Column:
    """The time at which cumulative demand reaches ``offset``: the inverse of target * ((1 - a) t + a t^2)."""
    c = F.when(target > 0, F.least(offset / target, F.lit(1.0))).otherwise(F.lit(0.0))
    root = F.sqrt(F.greatest((1 - slope) * (1 - slope) + 4 * slope * c, F.lit(0.0)))
    return F.when((F.abs(slope) < 1e-12) | (c == 0), c).otherwise(2 * c / ((1 - slope) + root))


def curriculum(offset: Column, size: Column, source_size: Column, target: Column, slope: Column, epochs: int) -> Column:
    """Training times of a document's copies, in order: one for every epoch of the source's stream in which the
    demand reaches the document's middle word while training lasts (at time 1 it has reached ``target``)."""
    def time(e: int) -> Column:
        start = e * source_size + offset
        return F.when(start + size / 2 <= target, position(start, target, slope))
    return F.filter(F.array(*[time(e) for e in range(epochs)]), lambda t: t.isNotNull())


def mix_sources(docs: DataFrame, *, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0,
                slopes: Sequence[float] = SLOPES, bucket_digits: int = 3, carry: Sequence[str] = ()) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken, stream_offset, slope, positions,
    position, and the columns of ``carry`` (text, or any of the documents' own that is none of these).

    ``positions`` are the training times of the copies that the curriculum
    takes of the document (at most ``ceil(cap)``), ``copies`` their number,
    ``taken = copies * size``, ``position`` the first time (null if none). A
    copy is taken when the demand reaches its middle word, so at any time a
    source's words differ from its demand by about a document, and at the end
    from its target by at most half a document.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.regexp_count(text, F.lit(WORD)).cast("long").alias("size")
    bucketed = lambda rows: rows.select(
        "*", *_key("source"), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("turn")
    ).withColumn("bucket", F.substring("turn", 1, bucket_digits))
    sizes = bucketed(save(docs.select("doc_id", "source", size), "mix-sizes"))
    per_bucket = sizes.groupBy("no_source", "source_key", "bucket").agg(F.sum("size").alias("words"))
    per_source = per_bucket.groupBy("no_source", "source_key").agg(F.sum("words").alias("source_size"))
    targets = source_targets(per_source, weights, share, cap, slopes)
    before = (Window.partitionBy("no_source", "source_key").orderBy("bucket")
              .rowsBetween(Window.unboundedPreceding, -1))
    starts = (per_bucket.withColumn("bucket_offset", F.coalesce(F.sum("words").over(before), F.lit(0)))
              .drop("words").join(targets, ["no_source", "source_key"]))
    inside = (Window.partitionBy("no_source", "source_key", "bucket").orderBy("turn", "doc_id", "size", *carry)
              .rowsBetween(Window.unboundedPreceding, -1))
    rows = bucketed(docs.select("doc_id", "source", size, *carry)) if carry else sizes
    out = rows.join(starts, ["no_source", "source_key", "bucket"]).withColumn(
        "stream_offset", F.col("bucket_offset") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    out = out.withColumn("positions", curriculum(F.col("stream_offset"), F.col("size"), F.col("source_size"),
                                                 F.col("target"), F.col("slope"), int(-(-cap // 1))))
    out = out.withColumn("copies", F.size("positions"))
    return out.select(
        "doc_id", "source", "size", "source_size", F.col("target").cast("double").alias("target"), "copies",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"), "stream_offset", "slope", "positions",
        F.get("positions", F.lit(0)).alias("position"), *carry)


def mix_digests(mixed: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies, position) of every document, counted in the mix itself.

    ``mixed`` is the result of :func:`mix_sources` that carries the text. Every copy travels with its text to its
    place: copies are range-sorted by training time, their words counted there and the mix's table of contents (row,
    time, words) written in that order; a document's figures are the sums of its rows in it. Documents without a copy
    go along without a text, after the end of the training.
    """
    known = ["row", "doc_id", "size", "source_size", "target"]
    copies = (mixed.withColumn("row", F.monotonically_increasing_id())
              .select(*known, "text", F.posexplode_outer("positions").alias("epoch", "at"))
              .withColumn("text", F.when(F.col("at").isNotNull(), F.coalesce("text", F.lit("")))))
    order = [F.col("at").asc_nulls_last(), "doc_id", "row", "epoch"]
    contents = save(copies.repartitionByRange(*order[:3]).sortWithinPartitions(*order)
                    .select(*known, "at", F.regexp_count("text", F.lit(WORD)).cast("long").alias("words")), "mix-contents")
    return (contents.groupBy(*known)
            .agg(F.coalesce(F.sum("words"), F.lit(0).cast("long")).alias("taken"), F.count("at").cast("int").alias("copies"),
                 F.min("at").alias("position"))
            .select(*known[1:], "taken", "copies", "position"))


def _row_key(size: str) -> list[Column]:
    """What the mix knows of a row; rows that are equal in it have interchangeable plans."""
    return [F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id_key"),
            *_key("source"), F.col(size).alias("words")]


def training_order(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The documents' own columns, one row for each copy the mix takes, range-sorted by training position.

    ``mixed`` is the result of :func:`mix_sources` for the same rows. Every row
    gets a plan of its own: rows are matched by doc_id, source and size (null
    matches null), and rows equal in these, which follow each other in the
    stream, by their number. The numbers are counted per slice of the saved
    rows, then inside a slice, so equal rows are spread over as many groups as
    there were tasks that wrote them.
    """
    row, size, epoch, at = (fresh(docs, c) for c in ("row", "words", "epoch", "at"))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = save(docs.withColumns({row: F.monotonically_increasing_id(),
                                  size: F.regexp_count(text, F.lit(WORD)).cast("long")}), "mix-rows")
    equal = ["no_id", "id_key", "no_source", "source_key", "words"]
    plans = save(mixed.select(*_row_key("size"), "stream_offset", "positions")
                 .dropDuplicates([*equal, "stream_offset"]), "mix-plans")  # only rows of no words share an offset
    numbered = rows.select(F.col(row).alias("row"), *_row_key(size)).withColumn("slice", F.shiftright("row", 33))
    before = Window.partitionBy(*equal).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (numbered.groupBy(*equal, "slice").agg(F.count("*").alias("n"))
              .withColumn("skipped", F.coalesce(F.sum("n").over(before), F.lit(0)))
              .join(plans.groupBy(*equal).agg(F.min("stream_offset").alias("first")), equal)
              .select(*equal, "slice", (F.col("first") + F.col("skipped") * F.col("words")).alias("start")))
    inside = Window.partitionBy(*equal, "slice").orderBy("row")
    plan = (numbered.join(starts, [*equal, "slice"])
            .withColumn("stream_offset", F.col("start") + (F.row_number().over(inside) - 1) * F.col("words"))
            .join(plans, [*equal, "stream_offset"])
            .select(F.col("row").alias(row), F.posexplode("positions").alias(epoch, at)))
    return (rows.join(plan, row).repartitionByRange(at, "doc_id", row).sortWithinPartitions(at, "doc_id", row, epoch)
            .select(*docs.columns))
