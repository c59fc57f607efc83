"""Exact top-k inner products by a three-phase uniform threshold.

The dimensions are cut into `LISTS` groups; in each group a query has one score list over all candidates, and a
candidate's score is the sum of its entries.

1. Gather: every block of candidates sends, for each query, the exact scores of the candidates at the top of its local
   lists, and the smallest and largest entry of each list. The k-th best score of all that is gathered is a lower bound of the
   final k-th score.
2. Cutoff: a candidate that reaches the bound must reach, in one list at least, an equal share of what the bound leaves above
   the lists' smallest entries. These shares go to the blocks with the queries. A list is multiplied again only for the
   queries whose largest entry there reaches the share, and only entries that reach it count.
3. Resolve: what these candidates lack, their entries in the other lists, is worked out for them alone. Those that
   reach the bound are kept; the k best remain.

Queries and candidates meet in blocks, query blocks against candidate blocks, as matrix products. The cutoffs go
to the tasks with their query block, not to the driver. Of equal vectors only the k + 1 smallest ids can ever be in
a result, so each group of copies is cut down to them first, in partial steps before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import stored

K = 20
LISTS = 2
CANDIDATES_PER_BLOCK = 4096
QUERIES_PER_BLOCK = 1024
# Candidate blocks that one task holds against a query block.
GROUP = 4
COPY_SALTS = (64, 8, 1)
SCALE = 64
# Integers up to these are exact in the two floating types that matrix products are fast in.
EXACT = ((1 << 24, np.float32), (1 << 53, np.float64))
LONG = (-(1 << 63), (1 << 63) - 1)


def quantized(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id and floor(scale * x) of each component, without vectors that are null or hold null, NaN or infinity.

    Components are whole numbers in doubles, so that any finite input keeps its size.
    """
    x = F.transform(embedding, lambda v: v.cast("double"))
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    rows = vectors.select(F.col(vec_id).alias("vec_id"), x.alias("x")).where(F.col("vec_id").isNotNull() & F.col("x").isNotNull())
    rows = rows.where(F.forall("x", finite))
    return rows.select("vec_id", F.transform("x", lambda v: _floor(v * scale)).alias("x"))


def _floor(v):
    # A double of 2^52 or more has no fraction, and may lie beyond the range of a long.
    return F.when(F.abs(v) < float(1 << 52), F.floor(v).cast("double")).otherwise(v)


BLOCK_NAMES = ["serial", "dim", "ids", "kind", "matrix"]


def _blocks(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pack rows (group, vec_id, x) into blocks of at most `size` vectors of one dimension."""
    held: dict[int, tuple[list, list]] = {}
    serial = 0

    def row(dim: int) -> pa.RecordBatch:
        ids, xs = held.pop(dim)
        matrix = np.array(xs, dtype=np.float64).reshape(len(ids), dim)
        widest = np.abs(matrix).max(initial=0)
        kind = next((k for k in ("int8", "int16", "int32") if widest <= np.iinfo(k).max), "float64")
        values = [serial, dim, np.array(ids, dtype=np.int64).tobytes(), kind, matrix.astype(kind).tobytes()]
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.string(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=BLOCK_NAMES)

    for batch in batches:
        for vec_id, x in zip(batch.column(0).to_pylist(), batch.column(1)):
            values = x.values.to_numpy(zero_copy_only=False)
            ids, xs = held.setdefault(len(values), ([], []))
            ids.append(vec_id)
            xs.append(values)
            if len(ids) >= size:
                yield row(len(values))
                serial += 1
    for dim in list(held):
        yield row(dim)
        serial += 1


def blocks(rows: DataFrame, size: int, prefix: str) -> DataFrame:
    """Blocks of about `size` vectors: dim, and with the prefix: ids, kind (of the numbers), matrix, block."""
    # Dealt out in turn, so that blocks are alike; the number of partitions follows the number of vectors.
    even = rows.select("vec_id", "x").repartition(max(1, -(-rows.count() // size)))
    packed = even.mapInArrow(partial(_blocks, size), "serial long, dim int, ids binary, kind string, matrix binary")
    packed = packed.withColumn("block", F.xxhash64(F.spark_partition_id(), "serial")).drop("serial")
    return stored(packed.withColumnsRenamed({n: f"{prefix}_{n}" for n in ("ids", "kind", "matrix", "block")}), prefix)


def first_copies(rows: DataFrame, k: int) -> DataFrame:
    """The rows (vec_id, x) without those that have k others with the same x and a smaller id.

    Copies are compared by a 128-bit hash. A group is cut down in steps, each over fewer groups of hash buckets, so
    that no task gets more than a few hundred copies.
    """
    once = rows.dropDuplicates(["vec_id", "x"])
    keys = once.select("vec_id", F.xxhash64("x").alias("a"), F.xxhash64(F.lit("x"), "x").alias("b"))
    for salts in COPY_SALTS:
        group = Window.partitionBy("a", "b", F.pmod(F.xxhash64("vec_id"), F.lit(salts))).orderBy("vec_id")
        keys = keys.withColumn("n", F.row_number().over(group)).where(F.col("n") <= k).drop("n")
    return once.join(keys.select("vec_id").distinct(), "vec_id", "left_semi")


def _typed(q: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices in the fastest type that is exact for their products; beyond doubles, Python integers."""
    bound = float((np.abs(q).max(initial=0) * np.abs(c).max(initial=0)) * q.shape[1])
    kind = next((kind for limit, kind in EXACT if bound < limit), None)
    if kind is None:
        return tuple(np.array([[int(v) for v in row] for row in m], dtype=object).reshape(m.shape) for m in (q, c))
    return q.astype(kind), c.astype(kind)


def _lists(dim: int, lists: int) -> list[slice]:
    """The dimensions of each list; vectors of no dimension have one empty list."""
    cuts = np.linspace(0, dim, min(lists, max(dim, 1)) + 1).astype(int)
    return [slice(a, b) for a, b in zip(cuts, cuts[1:])]


def _entries(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """One list: entries of queries by candidates."""
    return q @ c.T


def _missing(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Entries of pairs of rows."""
    return (q * c).sum(axis=1)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for row in batch.to_pylist():
            q_ids, c_ids = (np.frombuffer(row[n], dtype=np.int64) for n in ("q_ids", "c_ids"))
            q, c = (
                np.frombuffer(row[f"{n}_matrix"], dtype=row[f"{n}_kind"]).reshape(len(ids), row["dim"]).astype(np.float64)
                for n, ids in (("q", q_ids), ("c", c_ids))
            )
            yield row, q_ids, c_ids, q, c


def _long(scores) -> pa.Array:
    """Scores as longs; what lies beyond the range takes its end."""
    if getattr(scores, "dtype", None) == object:
        return pa.array([min(max(int(s), LONG[0]), LONG[1]) for s in scores], pa.int64())
    return pa.array(np.clip(scores, -(2.0**62), 2.0**62).astype(np.int64), pa.int64())


def _top(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest of each row, in no order."""
    if scores.shape[1] <= k:
        return np.broadcast_to(np.arange(scores.shape[1]), scores.shape)
    if scores.dtype == object:
        return np.argsort(-scores, axis=1, kind="stable")[:, :k]
    return np.argpartition(scores, scores.shape[1] - k, axis=1)[:, -k:]


GATHERED = "q_block long, c_block long, query_ids array<long>, best array<array<long>>, least array<array<long>>, most array<array<long>>"


def _gather(k: int, lists: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phase 1, a row for each pair of blocks: for each query the scores of the local leaders, and the ends of its lists."""
    longs = pa.list_(pa.list_(pa.int64()))
    for row, q_ids, c_ids, q, c in _pairs(batches):
        q, c = _typed(q, c)
        parts = [_entries(q[:, s], c[:, s]) for s in _lists(row["dim"], lists)]
        # One more than k, for a query that meets itself.
        leaders = np.concatenate([_top(p, k + 1) for p in parts], axis=1)
        best = []
        for i, query in enumerate(q_ids.tolist()):
            places = np.unique(leaders[i])
            places = places[c_ids[places] != query]
            scores = sum(p[i, places] for p in parts)
            best.append(_long(np.sort(scores)[::-1][:k]).to_pylist())
        ends = [[_long(end(p)).to_pylist() for p in parts] for end in (lambda p: p.min(axis=1), lambda p: p.max(axis=1))]
        least, most = (list(map(list, zip(*e))) for e in ends)
        values = [[row["q_block"]], [row["c_block"]], [q_ids.tolist()], [best], [least], [most]]
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), longs, longs, longs]
        names = ["q_block", "c_block", "query_ids", "best", "least", "most"]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds)], names=names)


def _sufficient(q, c, most: list[list], shares: list[list], lists: list[slice]) -> list[np.ndarray]:
    """Phase 2: for each list the entries that reach the share, as (number of the query, place, entry), by the first two.

    A list is multiplied only for queries whose largest entry in it, known from phase 1, reaches the share."""
    found = []
    for number, dims in enumerate(lists):
        share = np.array([s[number] for s in shares], dtype=np.float64)
        able = np.flatnonzero(np.array([m[number] for m in most], dtype=np.float64) >= share)
        if not len(able):
            found.append((np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, q.dtype)))
            continue
        part = _entries(q[able][:, dims], c[:, dims])
        rows, places = np.nonzero(part >= share[able][:, None])
        found.append((able[rows], places, part[rows, places]))
    return found


def _scores(q, c, found: list[tuple], lists: list[slice]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phase 3: the scores of the candidates found in any list: known entries, and the missing ones worked out."""
    n = len(c)
    keys = [i * n + places for i, places, _ in found]
    every = np.unique(np.concatenate(keys))
    i, places = every // max(n, 1), every % max(n, 1)
    scores = np.zeros(len(every), dtype=q.dtype)
    for dims, own, (_, _, entries) in zip(lists, keys, found):
        at = np.searchsorted(every, own)
        lacking = np.ones(len(every), dtype=bool)
        lacking[at] = False
        scores[at] += entries
        scores[lacking] += _missing(q[i[lacking]][:, dims], c[places[lacking]][:, dims])
    return i, places, scores


def _resolve(k: int, lists: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phases 2 and 3 for a pair of blocks: its own k best of each query among those that reach the bound."""
    for row, q_ids, c_ids, q, c in _pairs(batches):
        order = {query: i for i, query in enumerate(row["cut_ids"])}
        at = [order[query] for query in q_ids.tolist()]
        q, c = _typed(q, c)
        dims = _lists(row["dim"], lists)
        # `most` has the queries of the block in their order. With fewer than k candidates in all, or numbers beyond doubles, every entry is sufficient.
        no_bound = [row["bounds"][i] is None or q.dtype == object for i in at]
        low = [[-np.inf] * len(dims) if free else row["shares"][i] for i, free in zip(at, no_bound)]
        i, places, scores = _scores(q, c, _sufficient(q, c, row["most"], low, dims), dims)
        bounds = np.array([-np.inf if free else row["bounds"][n] for n, free in zip(at, no_bound)], dtype=np.float64)
        keep = (scores >= bounds[i]).astype(bool) & (c_ids[places] != q_ids[i])
        found = sorted(zip(i[keep].tolist(), (-scores[keep]).tolist(), c_ids[places[keep]].tolist()))
        first = [0, *(j for j in range(1, len(found)) if found[j][0] != found[j - 1][0])]
        ends = [*first[1:], len(found)]
        kept = [f for a, b in zip(first, ends) for f in found[a : min(b, a + k)]]  # ties to smaller ids
        values = [[int(q_ids[f[0]]) for f in kept], [f[2] for f in kept], _long(np.array([-f[1] for f in kept], dtype=q.dtype)).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in values], names=["query_id", "vec_id", "score"])


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K, lists: int = LISTS) -> DataFrame:
    """The k best candidates of each query by inner product: query_id, rank (from 1), vec_id, score.

    Both tables hold vec_id and x, as `quantized` gives them. A query does not find the row with its own id; ties go
    to the smaller vec_id; fewer than k candidates are all returned. Vectors of other lengths than the query's are no
    candidates. Repeated rows of one id count once. Scores beyond the range of a long take its end. Without queries or
    without candidates the result is empty.
    """
    c_blocks = blocks(first_copies(candidates, k + 1), CANDIDATES_PER_BLOCK, "c")
    q_blocks = blocks(queries.dropDuplicates(["vec_id", "x"]), QUERIES_PER_BLOCK, "q")
    # Candidate blocks stay where their group is; each query block goes once to every group.
    groups = max(1, -(-c_blocks.count() // GROUP))
    c_blocks = c_blocks.withColumn("group", F.pmod("c_block", F.lit(groups)))

    def met(q: DataFrame) -> DataFrame:
        return q.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))).join(c_blocks, ["dim", "group"])

    gathered = stored(met(q_blocks).mapInArrow(partial(_gather, k, lists), GATHERED), "gathered")
    of_query = gathered.select("q_block", F.explode(F.arrays_zip("query_ids", "best", "least")).alias("of"))
    of_query = of_query.select("q_block", F.col("of.query_ids").alias("query_id"), "of.best", "of.least")
    every = of_query.select("query_id", "q_block", F.explode_outer("best").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id", "q_block").orderBy(F.col("score").desc_nulls_last()))
    bounds = every.withColumn("n", place).where(F.col("n") <= k).groupBy("query_id", "q_block").agg(
        F.when(F.count("score") == k, F.min("score")).alias("bound")
    )
    least = of_query.select("query_id", "q_block", F.posexplode("least").alias("list", "least"))
    least = least.groupBy("query_id", "q_block", "list").agg(F.min("least").alias("least"))
    least = least.groupBy("query_id", "q_block").agg(F.sort_array(F.collect_list(F.struct("list", "least"))).alias("least"))
    floor = F.aggregate("least", F.lit(0).cast("decimal(38,0)"), lambda n, s: (n + s["least"]).cast("decimal(38,0)"))
    # What the bound leaves above the lists' smallest entries, in equal shares, rounded down.
    share = F.floor((F.col("bound").cast("decimal(38,0)") - floor) / F.size("least"))
    cut = bounds.join(least, ["query_id", "q_block"], "left").select(
        "q_block", F.struct("query_id", "bound", F.transform("least", lambda s: (s["least"] + share).cast("double")).alias("share")).alias("cut")
    )
    # At most a block of queries in each row.
    cut = cut.groupBy("q_block").agg(F.collect_list("cut").alias("cuts"))
    cut = cut.select("q_block", F.col("cuts.query_id").alias("cut_ids"), F.col("cuts.bound").alias("bounds"), F.col("cuts.share").alias("shares"))
    ends = gathered.select("q_block", "c_block", "most")
    pairs = met(q_blocks.join(cut, "q_block")).join(ends, ["q_block", "c_block"])
    found = pairs.mapInArrow(partial(_resolve, k, lists), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
