"""Mixing sources to target weights along a training curriculum, in DataFrame operations only.

1. Targets: each source gets words in proportion to its weight, at most `cap` times its own size; what a source
   cannot give is shared again by weight until none is above its cap.
2. A source's documents lie on a line in the order of a content hash, each as long as its number of words. The
   source gives the first `target` words of that line, which starts again when it is used up.
3. The weight of a source changes linearly over the training, from `start` to `end` of its schedule. The integral
   of the schedule is the source's cumulative demand; the training position of a document is the time at which the
   demand reaches the document's place on the line (the integral inverted, in closed form).
4. Documents are range-sorted by position.

A hot source is no hot task: its line is cut into hash buckets of about `BUCKET_ROWS` rows, and the running total
inside a bucket starts at the bucket's offset, which is summed from one row for each bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import WORD, fresh, ranked, stored

# Buckets that one task adds up.
RANGE_BUCKETS = 4096
BUCKET_ROWS = 512
WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
# Weight at the start and the end of the training, as multiples of the source's mean weight.
SCHEDULE = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def content_key(doc_id: str, text: str) -> Column:
    """A hash of id and text; null ids are told apart by their text."""
    return F.md5(F.concat_ws("|", F.col(doc_id).cast("string"), F.col(text)))


def _cycle(values: Sequence[float], rank: Column) -> Column:
    """The value of the list, repeated without end, at place `rank`."""
    return F.element_at(F.array(*map(F.lit, values)), (rank % len(values) + 1).cast("int"))


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP
) -> DataFrame:
    """Targets of the sources. `sizes`: source, source_size, source_rows; adds rank, weight, target.

    Sources are ranked by code point, null last. The loop is over one number, the words for each unit of weight: it
    can only grow, since sources only go over their cap. Each round is one aggregate over the sources.
    """
    order = [F.col("source").asc_nulls_last()]
    known = stored(ranked(sizes, order, "rank").withColumn("weight", _cycle(weights, F.col("rank"))), "sources")
    limit, weight = F.col("source_size") * float(cap), F.col("weight")
    total = known.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    level = 0.0
    while True:
        full = weight * F.lit(level) > limit
        row = known.agg(
            F.sum(F.when(full, limit).otherwise(0.0)).alias("given"),
            F.sum(F.when(full, 0.0).otherwise(weight)).alias("open"),
        ).first()
        if not row["open"]:
            break
        raised = (share * total - row["given"]) / row["open"]
        if raised <= level:
            break
        level = raised
    return known.withColumn("target", F.least(limit, weight * F.lit(level)))


def position(done: Column, start: Column, end: Column) -> Column:
    """The time in [0, 1] at which the share `done` of a source's demand is met.

    The weight at time t is start + (end - start) t, divided by its mean. Its integral is a parabola; this is the
    inverse, in the form that also holds for a constant weight.
    """
    mean = (start + end) / 2
    first, slope = start / mean, (end - start) / mean
    return F.coalesce(F.try_divide(2 * done, first + F.sqrt(first * first + 2 * slope * done)), F.lit(0.0))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    schedule: Sequence[tuple[float, float]] = SCHEDULE,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row for each document: doc_id, size, source_size, target, taken, passes, in order of position.

    `passes` lists the times the document is used: `pass` (from 0), `words` taken from its start, `position`. Only
    the last document of a source's line is taken in part. Null text: size 0. Null source: a source of its own,
    ranked last. Documents without words take nothing and have no pass. Repeated rows are documents like others.
    `carry` names more columns of `docs` to return; others are ignored. An empty table gives an empty result. The order depends on nothing but doc_id and
    text, so reruns agree.
    """
    carried = [f"carried_{i}" for i in range(len(carry))]
    sized = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"),
        content_key(doc_id, text).alias("key"), *[F.col(c).alias(to) for c, to in zip(carry, carried)],
    )
    sized = stored(sized, "sizes")
    sizes = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows")
    )
    sources = stored(source_targets(sizes, weights, share, cap), "targets").withColumnRenamed("source", "of")
    found = sized.join(sources, F.col("source").eqNullSafe(F.col("of")))
    # Hash buckets in key order, so that buckets and keys sort alike.
    buckets = F.ceil(F.col("source_rows") / BUCKET_ROWS)
    part = F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * buckets / float(2**32))
    found = found.withColumn("bucket", part)
    # What lies before a bucket: the ranges of buckets before its own, and the buckets of its range before it. So a
    # source that holds most rows is summed up by many tasks, and its ranges, one for two million rows, by one.
    offsets = found.groupBy("rank", "bucket").agg(F.sum("size").alias("bucket_size"))
    offsets = offsets.withColumn("range", F.floor(F.col("bucket") / RANGE_BUCKETS))

    def before(of: str, by: Window) -> Column:
        return F.coalesce(F.sum(of).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    ranges = offsets.groupBy("rank", "range").agg(F.sum("bucket_size").alias("range_size"))
    ranges = ranges.select("rank", "range", before("range_size", Window.partitionBy("rank").orderBy("range")).alias("earlier"))
    within = before("bucket_size", Window.partitionBy("rank", "range").orderBy("bucket"))
    offsets = offsets.withColumn("within", within).join(ranges, ["rank", "range"])
    offsets = offsets.select("rank", "bucket", (F.col("earlier") + F.col("within")).alias("offset"))
    inside = Window.partitionBy("rank", "bucket").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = found.join(offsets, ["rank", "bucket"]).withColumn(
        "begin", F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    )

    size, target = F.col("size"), F.col("target")
    starts, ends = ([s[i] for s in schedule] for i in (0, 1))

    def one_pass(number):
        begin = F.col("begin") + number * F.col("source_size")
        words = F.greatest(F.lit(0), F.least(size, F.round(target).cast("long") - begin))
        start, end = _cycle(starts, F.col("rank")), _cycle(ends, F.col("rank"))
        return F.struct(
            number.alias("pass"), words.alias("words"), position(F.try_divide(begin, target), start, end).alias("position")
        )

    numbers = [F.lit(i).cast("long") for i in range(int(-(-cap // 1)))]
    passes = F.filter(F.array(*map(one_pass, numbers)), lambda p: p["words"] > 0)
    taken = F.aggregate("passes", F.lit(0).cast("long"), lambda n, p: n + p["words"])
    mixed = placed.withColumn("passes", passes).withColumn("taken", taken)
    mixed = mixed.select("doc_id", "size", "source_size", "target", "taken", "passes", "key", *carried)
    # The key spreads documents without a position over many ranges.
    return mixed.orderBy(F.get("passes", F.lit(0))["position"].asc_nulls_last(), "key").drop("key").withColumnsRenamed(dict(zip(carried, carry)))


def mixed_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of `docs` in training order, one for each pass, with the columns of `docs`.

    A document that is taken in part keeps the text up to its last word taken. Rows that agree in all columns are
    one row that counts several times: the mix is joined to the distinct rows, so copies are never paired.
    """
    row, key, at, words, place, size = fresh(docs.columns, "row", "key", "at", "words", "place", "size")
    known = docs.withColumn(row, F.xxhash64(*docs.columns)).withColumn(key, content_key(doc_id, text))
    plan = mix(known, doc_id=doc_id, text=text, carry=(row, key), **options)
    uses = plan.select(row, key, F.col("size").alias(size), F.explode("passes").alias(at)).select(
        row, key, size, F.col(at)["words"].alias(words), F.col(at)["position"].alias(place)
    )
    chosen = known.dropDuplicates([row, key]).join(uses, [row, key])
    # Each word with the white space before it; only evaluated for documents taken in part.
    pieces = F.regexp_extract_all(F.col(text), F.lit(f"[\\x20\\x09-\\x0D]*{WORD}"), F.lit(0))
    prefix = F.array_join(F.slice(pieces, F.lit(1), F.col(words).cast("int")), "")
    cut = F.when(F.col(words) < F.col(size), prefix).otherwise(F.col(text))
    return chosen.withColumn(text, cut).orderBy(place, key).select(*docs.columns)
