"""Near duplicates by consistent weighted sampling over TF-IDF shingles, banded, verified by weighted Jaccard.

1. Statistics. Document frequencies of five-word shingles over all documents go into a count-min sketch of fixed
   size, whose error is a fixed share of the number of documents, whatever that is.
2. Signatures. Improved consistent weighted sampling draws `HASHES` samples from each weighted shingle set: two
   documents share a sample with the probability of their weighted Jaccard similarity. Equal texts become one node.
3. Bands. Nodes that share all samples of a band meet in a bucket. A bucket emits a star around its most typical
   member, and what a maximum spanning forest by agreement of the signatures needs beyond it; in a small bucket also
   each member's `NEAREST` nearest: a fixed number of edges a member, and no pairs of all with all. Buckets over
   `BUCKET_ROWS` are worked on in parts by a hash, and the parts' centres meet again.
4. Verification. Rounds take the best open edges of each node, first one, then four times as many each time, compute the
   weighted Jaccard similarity of the whole texts, and join classes by those that reach it, until no edge between
   two classes is left untested.
5. Finer bands. Edges that fail say nothing of the pairs they stood for. Members of buckets that emitted less than all
   their pairs and still hold several classes get a second, longer signature of `LONG_HASHES` samples, and meet again in
   its `LONG_BANDS` finer bands. There each member names its `NEAREST` nearest of other classes; of two classes the
   `PAIR_EDGES` best edges are verified. This goes on while it finds links. The work grows with the members.
6. Those buckets are then gone through all members with all, unless `exhaustive` is turned off: it is the exact way for what
   the caps of steps 3 to 5 leave out. Blocks of members meet two by two, with their texts, and a pair that agrees in
   `PLAUSIBLE` samples is verified where it meets, in the first bucket it shares. Only links that join two classes leave a
   task, fewer than it has members: no rows are made for pairs. The time alone grows with the square of a bucket.

The weight of a shingle is its count times ln(1 + N / (df + N)). The smoothing by N keeps weights within a factor
of 1.7: with less of it the shared text of a group of thousands of copies would weigh next to nothing against one
changed word, and the copies would not be found.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache, partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import fresh, stored

SHINGLE = 5
SIMILARITY = 0.8
BAND_ROWS = 3
BANDS = 16
HASHES = BANDS * BAND_ROWS
# Signatures of two texts at the threshold agree in fewer samples than this about once in 10,000 times.
PLAUSIBLE = 27
# Centres of parts of one bucket are compared on less evidence: they stand for others.
PLAUSIBLE_CENTRES = 16
SKETCH_ROWS, SKETCH_BITS = 4, 16
# Variates of each kind in a pool. A shingle draws three places, so there are 2^39 different draws; small pools stay in
# the processor's cache.
POOL_BITS = 13
# Labels of nodes, two hashes of 16 bytes each, are broadcast up to so many.
BROADCAST_ROWS = 200_000
BUCKET_ROWS = 512
CUTS = 8
# In a bucket of up to so many, each member is also linked to its nearest few.
SMALL_BUCKET, NEAREST = 32, 4
# Sub-keys by which a bucket of more centres than `BUCKET_ROWS` is split: `REFINE_BYTES` signature bytes each.
REFINE, REFINE_BYTES = 24, 4
# The second signature, for members of buckets that are not settled by a star, and the least agreement that is followed:
# three standard deviations below the threshold.
LONG_HASHES, LONG_BANDS = 256, 32
LONG_LEAST = int(LONG_HASHES * SIMILARITY - 3 * (LONG_HASHES * SIMILARITY * (1 - SIMILARITY)) ** 0.5)
PAIR_EDGES = 16
# When buckets are gone through again, blocks of about so many times `BUCKET_ROWS` members, or so many bytes of text, meet
# two by two.
BLOCK = 4
BLOCK_BYTES = 8 << 20
WORDS_AT_ONCE = 200_000
PHI = np.uint64(0x9E3779B97F4A7C15)


def _times_phi(n: int) -> np.uint64:
    return np.uint64(n * int(PHI) % (1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    """The finisher of a 64-bit hash: every bit of the input reaches every bit of the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(words: list[str]) -> np.ndarray:
    import xxhash

    # Hashing a word takes less time than looking it up.
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), dtype=np.uint64)


def shingles(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a text in ascending order, and their counts. A text of fewer than five words is one
    shingle; a text without words has none. Words are what white space separates."""
    words = (text or "").split()
    if not words:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    h = _word_hashes(words)
    n = max(1, len(h) - SHINGLE + 1)
    value = np.zeros(n, dtype=np.uint64)
    for i in range(min(SHINGLE, len(h))):
        value = value * PHI + h[i : i + n]
    return np.unique(_mix(value + np.uint64(min(SHINGLE, len(h)))), return_counts=True)


# Sketch of document frequencies.


def _cells(u: np.ndarray) -> Iterator[np.ndarray]:
    """Cells of each row: the rows take different bits of one hash."""
    mixed = _mix(u + _times_phi(1))
    for row in range(SKETCH_ROWS):
        yield ((mixed >> np.uint64(SKETCH_BITS * row)) & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table, n = np.zeros((SKETCH_ROWS, 1 << SKETCH_BITS), dtype=np.int64), 0
    held: list[np.ndarray] = []

    def add() -> None:
        if held:
            for row, cells in enumerate(_cells(np.concatenate(held))):
                table[row] += np.bincount(cells, minlength=1 << SKETCH_BITS)
            held.clear()

    for batch in batches:
        for text in batch.column(0):
            u = shingles(text.as_py())[0]
            if len(u):
                n += 1
                held.append(u)
            if len(held) >= 200:
                add()
    add()
    rows = [*table, np.array([n], dtype=np.int64)]
    names = ["row", "content"]
    yield pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int32()), pa.array([r.tobytes() for r in rows])], names=names)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for row, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts = np.frombuffer(content, dtype=np.int64)
            sums[row] = sums[row] + counts if row in sums else counts
    contents = [sums[r].tobytes() for r in sums]
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(contents, pa.binary())], names=["row", "content"])


def sketch(docs: DataFrame) -> bytes:
    """Document frequencies over all texts. 2 MB, whatever the number of documents; the last 8 bytes are N."""
    schema = "row int, content binary"
    parts = docs.select("text").mapInArrow(_sketch, schema)
    found = {r["row"]: bytes(r["content"]) for r in parts.repartition(SKETCH_ROWS + 1, "row").mapInArrow(_added, schema).collect()}
    empty = bytes(8 << SKETCH_BITS)
    return b"".join(found.get(r, empty) for r in range(SKETCH_ROWS)) + found.get(SKETCH_ROWS, bytes(8))


@lru_cache(maxsize=2)
def _tables(counts: bytes) -> tuple[np.ndarray, int]:
    return np.frombuffer(counts[:-8], dtype=np.int64).reshape(SKETCH_ROWS, -1), int.from_bytes(counts[-8:], "little")


def weights(u: np.ndarray, tf: np.ndarray, counts: bytes) -> np.ndarray:
    table, n = _tables(counts)
    df = np.min([table[row][cells] for row, cells in enumerate(_cells(u))], axis=0) if len(u) else np.zeros(0)
    return tf * np.log1p(n / (df + max(n, 1)))


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], counts: bytes) -> float:
    """Weighted Jaccard: the sum of the smaller weights by the sum of the larger ones. 0 without shingles."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    wa, wb = weights(*a, counts), weights(*b, counts)
    _, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(wa[ia], wb[ib]).sum()
    return float(both / (wa.sum() + wb.sum() - both))


# Signatures.


@lru_cache(maxsize=1)
def _variates() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pools of the variates of the sampling: r and ln c with r, c ~ Gamma(2, 1), and beta ~ U(0, 1)."""
    random = np.random.Generator(np.random.PCG64(5))
    n = 1 << POOL_BITS
    return tuple(x.astype(np.float32) for x in (random.gamma(2, 1, n), np.log(random.gamma(2, 1, n)), random.random(n)))


def _samples(sets: list[tuple[np.ndarray, np.ndarray]], counts: bytes, numbers: range) -> np.ndarray:
    """Samples of these numbers of weighted sets, none of them empty, as 64-bit hashes.

    A shingle draws its variates from the pools by a hash of itself and the number of the sample, so it draws the
    same ones in every document. With weight S: t = floor(ln S / r + beta), ln a = ln c - r (t - beta + 1); the
    shingle of smallest a, with its t, is the sample.
    """
    sizes = np.array([len(u) for u, _ in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    u = np.concatenate([u for u, _ in sets])
    # Rounded, so that a weight has one logarithm wherever it stands in the array.
    log_s = np.round(np.log(weights(u, np.concatenate([tf for _, tf in sets]), counts)), 5).astype(np.float32)
    pool_r, pool_c, pool_beta = _variates()
    samples = np.empty((len(sets), len(numbers)), dtype=np.uint64)
    x, place = np.empty_like(u), np.empty_like(u)
    at_place, mask = place.view(np.int64), np.uint64((1 << POOL_BITS) - 1)
    r, beta, t, log_a = (np.empty(len(u), dtype=np.float32) for _ in range(4))
    for at_k, k in enumerate(numbers):
        np.add(u, _times_phi(2 * k + 1), out=x)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        np.right_shift(x, np.uint64(32), out=place)
        x ^= place
        x *= np.uint64(0x94D049BB133111EB)
        # The upper bits of the upper three of the four 16-bit parts of each number.
        for end, pool, out in ((64, pool_r, r), (48, pool_beta, beta), (32, pool_c, log_a)):
            np.right_shift(x, np.uint64(end - POOL_BITS), out=place)
            place &= mask
            pool.take(at_place, out=out, mode="clip")
        np.divide(log_s, r, out=t)
        t += beta
        np.floor(t, out=t)
        np.subtract(t, beta, out=beta)
        beta += 1
        beta *= r
        log_a -= beta
        least = np.minimum.reduceat(log_a, starts)
        at = np.flatnonzero(log_a == np.repeat(least, sizes))
        at = at[np.searchsorted(at, starts)]  # the first, so the smallest shingle, of each set
        samples[:, at_k] = _mix(u[at] + t[at].astype(np.int64).astype(np.uint64) * PHI + np.uint64(k))
    return samples


def _banded(samples: np.ndarray, bands: int) -> tuple[np.ndarray, np.ndarray]:
    """Bands (one 64-bit key each) and samples (one byte each)."""
    keys = np.zeros((len(samples), bands), dtype=np.uint64)
    for i in range(samples.shape[1] // bands):
        keys = _mix(keys * PHI + samples[:, i :: samples.shape[1] // bands] + np.arange(bands, dtype=np.uint64))
    return keys.view(np.int64), (samples >> np.uint64(56)).astype(np.uint8)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], counts: bytes, long: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Bands and samples of weighted sets, none of them empty. The long signature has samples of its own."""
    numbers = range(HASHES, HASHES + LONG_HASHES) if long else range(HASHES)
    return _banded(_samples(sets, counts, numbers), LONG_BANDS if long else BANDS)


SIGNED = "node binary, bands array<long>, sig binary"


def _sign(counts: bytes, long: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def flush(digests, sets) -> pa.RecordBatch:
        bands, samples = signatures(sets, counts, long)
        return pa.RecordBatch.from_arrays(
            [pa.array(digests, pa.binary()), pa.array(list(bands), pa.list_(pa.int64())), pa.array([s.tobytes() for s in samples])],
            names=["node", "bands", "sig"],
        )

    for batch in batches:
        digests, sets, size = [], [], 0
        done: set[bytes] = set()
        for digest, text in zip(batch.column(0), batch.column(1)):
            digest = digest.as_py()
            if digest is None or digest in done:  # copies inside a batch are signed once
                continue
            done.add(digest)
            found = shingles(text.as_py())
            if len(found[0]):
                digests.append(digest)
                sets.append(found)
                size += len(found[0])
            if size >= WORDS_AT_ONCE:
                yield flush(digests, sets)
                digests, sets, size = [], [], 0
        if sets:
            yield flush(digests, sets)


# Buckets.


def _forest(sig: np.ndarray, least: int) -> tuple[list[tuple[int, int, int]], list[int], bool]:
    """Edges (i, j, agreement) of a bucket, its centres, and whether it has more pairs that agree in `least` samples.

    A maximum spanning forest over pairs that agree in `least` samples tells its groups. Each has a star around the
    member nearest to the most common samples. A small group keeps the edges of its tree and of nearest members,
    a large one those of members that the star does not reach.
    """
    n = len(sig)
    tree = np.full(n, -1)
    best, parent = np.full(n, -1), np.zeros(n, dtype=np.int64)
    edges: dict[tuple[int, int], int] = {}
    roots = ends = 0
    for _ in range(n):
        open_ = np.where(tree < 0, best, -2)
        v = int(open_.argmax())
        if best[v] >= least:
            tree[v] = tree[parent[v]]
            edges[min(v, parent[v]), max(v, parent[v])] = int(best[v])
        else:
            tree[v] = roots
            roots += 1
        agree = (sig == sig[v]).sum(axis=1)
        agree[v] = -1
        ends += int((agree >= least).sum())
        if n <= SMALL_BUCKET:
            near = np.argpartition(agree, -NEAREST)[-NEAREST:] if n > NEAREST else np.arange(n)
            edges.update({(min(v, u), max(v, u)): int(agree[u]) for u in near.tolist() if agree[u] >= least})
        nearer = agree > best
        best[nearer], parent[nearer] = agree[nearer], v
    centres = []
    for root in range(roots):
        members = np.flatnonzero(tree == root)
        if len(members) < 3:
            centres.append(int(members[0]))
            continue
        own = sig[members]
        common = np.array([np.bincount(own[:, k], minlength=256).argmax() for k in range(own.shape[1])])
        centre = int(members[(own == common).sum(axis=1).argmax()])
        centres.append(centre)
        star = {
            v: agree
            for v, agree in zip(members.tolist(), (own == sig[centre]).sum(axis=1).tolist())
            if v != centre and agree >= least
        }
        if len(members) > SMALL_BUCKET:
            # The star alone, but for members that are too far from its centre.
            reached = {centre, *star}
            edges = {(i, j): a for (i, j), a in edges.items() if tree[i] != root or i not in reached or j not in reached}
        edges.update({(min(v, centre), max(v, centre)): agree for v, agree in star.items()})
    return [(i, j, a) for (i, j), a in edges.items()], centres, 2 * len(edges) < ends


FOUND = "a binary, b binary, agree int, key long, sig binary, again boolean"


def _edges(least: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (a < b, agree), the centres of parts of large buckets (a, key, sig) for the next level, and the keys of
    buckets with more pairs than edges (key, again).

    Input, sorted: key, part, node, sig, parts."""
    out: list[list] = [[] for _ in range(6)]

    def flush() -> pa.RecordBatch:
        kinds = [pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.binary(), pa.bool_()]
        names = ["a", "b", "agree", "key", "sig", "again"]
        made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)
        for c in out:
            c.clear()
        return made

    def add(*row) -> None:
        for c, x in zip(out, row):
            c.append(x)

    key, nodes, sigs = None, [], []

    def work() -> None:
        parts = key[2]
        if len(nodes) == 1:
            if parts > 1:  # of a large bucket: passed on; else there is no one to meet
                add(nodes[0], None, None, key[0], sigs[0], False)
                add(None, None, None, key[0], None, True)
            return
        table = np.frombuffer(b"".join(sigs), dtype=np.uint8).reshape(len(nodes), -1)
        edges, centres, more = _forest(table, least)
        for i, j, agree in edges:
            a, b = sorted((nodes[i], nodes[j]))
            add(a, b, agree, None, None, False)
        if parts > 1:
            for i in centres:
                add(nodes[i], None, None, key[0], sigs[i], False)
        if parts > 1 or more:
            add(None, None, None, key[0], None, True)

    for batch in batches:
        for k, part, node, sig, parts in zip(*(c.to_pylist() for c in batch.columns)):
            if (k, part, parts) != key:
                if nodes:
                    work()
                key, nodes, sigs = (k, part, parts), [], []
            nodes.append(node)
            sigs.append(sig)
        if len(out[0]) > 10_000:
            yield flush()
    if nodes:
        work()
    yield flush()


def _worked(rows: DataFrame, least: int) -> DataFrame:
    """`rows`: key, part, parts, node, sig."""
    near = rows.repartition("key", "part").sortWithinPartitions("key", "part", "parts")
    return near.select("key", "part", "node", "sig", "parts").mapInArrow(partial(_edges, least), FOUND)


def candidate_edges(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges a, b, agree between `nodes` (node, bands, sig), each pair once; and the keys of buckets with more
    pairs than these."""
    rows = nodes.select("node", "sig", F.explode("bands").alias("key"))
    large = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BUCKET_ROWS)
    parts = F.coalesce(F.ceil(F.col("n") / BUCKET_ROWS), F.lit(1)).cast("long")
    rows = rows.join(_side(stored(large, "large")), "key", "left").withColumn("parts", parts)
    # A few ways to cut, shared by bands: a pair is not kept apart by chance in all of them, and a star comes back in
    # several bands instead of a new one in each.
    part = F.pmod(F.xxhash64("node", F.pmod("key", F.lit(CUTS))), F.col("parts"))
    found = stored(_worked(rows.select("key", "node", "sig", "parts", part.alias("part")), PLAUSIBLE), "bucket-edges")
    left = found.where("again").select("key").distinct()
    centres = found.where(F.col("key").isNotNull() & ~F.col("again")).select("key", F.col("a").alias("node"), "sig")
    sizes = centres.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    centres = centres.join(sizes, "key")
    # Too many centres: a bucket of texts that have little in common. More samples split it, without losing pairs.
    places = [[(7 * i + 13 * j + i * j) % HASHES for j in range(REFINE_BYTES)] for i in range(REFINE)]
    # Those that are still too large are cut into parts; their keys are among the ones that finer bands go through.
    finer = [F.xxhash64("key", F.lit(i), *[F.substring("sig", p + 1, 1) for p in ps]) for i, ps in enumerate(places)]
    keys = F.when(F.col("n") > BUCKET_ROWS, F.array(*finer)).otherwise(F.array("key"))
    centres = centres.select("node", "sig", F.explode(keys).alias("key"))
    sizes = centres.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BUCKET_ROWS).cast("long").alias("cuts"))
    part = F.pmod(F.xxhash64("node", F.pmod("key", F.lit(CUTS))), F.col("cuts"))
    centres = centres.join(sizes, "key").select("node", "sig", "key", part.alias("part"), F.lit(1).cast("long").alias("parts"))
    met = _worked(centres, PLAUSIBLE_CENTRES)
    edges = found.where(F.col("key").isNull()).unionByName(met.where(F.col("key").isNull()))
    return edges.groupBy("a", "b").agg(F.max("agree").alias("agree")), left


def _across(least: int, take: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The `take` best pairs (a < b, agree) of each member of a group with members of other classes, and a row
    without nodes if it has more.

    Input, sorted: key, i, j, own (the number of the member's block, i or j), node, sig, class."""
    key, rows = None, []
    out: list[tuple] = []

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out)) or [[], [], []]
        out.clear()
        kinds = [pa.binary(), pa.binary(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["a", "b", "agree"])

    def work() -> Iterator[pa.RecordBatch]:
        i, j = key[1:]
        numbers: dict[bytes, int] = {}
        kind = np.array([numbers.setdefault(r[3], len(numbers)) for r in rows])
        if len(numbers) < 2:
            return
        table = np.frombuffer(b"".join([r[2] for r in rows]), dtype=np.uint8).reshape(len(rows), -1)
        own = np.array([r[0] for r in rows])
        more = False
        for v in range(len(rows)):
            others = np.flatnonzero((kind != kind[v]) & ((own != own[v]) | (i == j)))
            agree = (table[others] == table[v]).sum(axis=1)
            near = np.flatnonzero(agree >= least)
            if len(near) > take:
                more = True
                near = near[np.argpartition(agree[near], -take)[-take:]]
            else:  # the other one names this pair too, unless it has more
                near = near[(others[near] > v) | more]
            out.extend((*sorted((rows[v][1], rows[u][1])), n) for u, n in zip(others[near].tolist(), agree[near].tolist()))
            if len(out) > 10_000:  # all pairs of two blocks are too many to hold
                yield flush()
        if more:
            out.append((None, None, None))

    for batch in batches:
        for k, i, j, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if (k, i, j) != key:
                if rows:
                    yield from work()
                key, rows = (k, i, j), []
            rows.append(row)
        if len(out) > 10_000:
            yield flush()
    if rows:
        yield from work()
    yield flush()


def _met(members: DataFrame, size: Column, *carried: str) -> DataFrame:
    """The `members` (key, node, sig, class) of buckets of several classes, in blocks that meet two by two: key, i, j, own,
    node, sig, class, carried. `size` is the number of bytes that a member brings along.

    Each pair of members meets in one group: that of their two blocks."""
    held = F.count(F.lit(1)).alias("n"), F.sum(size).alias("size"), F.min("class").alias("low"), F.max("class").alias("high")
    sizes = members.groupBy("key").agg(*held).where(F.col("low") != F.col("high")).select("key", "n", "size")
    blocks = F.ceil(F.greatest(F.col("n") / (BLOCK * BUCKET_ROWS), F.col("size") / BLOCK_BYTES)).cast("long")
    rows = members.join(sizes.select("key", F.least(blocks, F.col("n")).alias("blocks")), "key")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "sig", "class", *carried)
    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def edges_across(members: DataFrame, take: int) -> DataFrame:
    """a, b, agree: for each of `members` (key, node, sig, class) the `take` best pairs with other classes of its
    bucket that are plausible, and rows without nodes where there are more."""
    near = _met(members, F.lit(0))
    return near.mapInArrow(partial(_across, PLAUSIBLE, take), "a binary, b binary, agree int")


def _linked(counts: bytes, least: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links a < b that join the classes of a group wherever two texts reach the similarity.

    Every pair of members of two classes that agrees in `PLAUSIBLE` samples is compared, unless it shares an earlier
    band, where it is compared instead, or earlier links joined the two classes.

    Input, sorted: key, i, j, own (the number of the member's block, i or j), node, sig, class, band, bands, text."""
    key, rows = None, []
    out: list[tuple[bytes, bytes]] = []

    def work() -> None:
        numbers: dict[bytes, int] = {}
        kind = np.array([numbers.setdefault(r[3], len(numbers)) for r in rows])
        if len(numbers) < 2:
            return
        own, band, bands = np.array([r[0] for r in rows]), rows[0][4], np.array([r[5] for r in rows])
        table = np.frombuffer(b"".join([r[2] for r in rows]), dtype=np.uint8).reshape(len(rows), -1)
        sets = [shingles(r[6]) for r in rows]
        sizes = np.array([len(u) for u, _ in sets])
        words = np.concatenate([u for u, _ in sets])
        weight = np.split(weights(words, np.concatenate([tf for _, tf in sets]), counts), np.cumsum(sizes)[:-1])
        different, at = np.unique(words, return_inverse=True)
        places, sums, mine = np.split(at, np.cumsum(sizes)[:-1]), np.array([w.sum() for w in weight]), np.zeros(len(different))
        for v in range(len(rows) - 1):
            near = v + 1 + np.flatnonzero((kind[v + 1 :] != kind[v]) & ((own[v + 1 :] != own[v]) | (key[1] == key[2])))
            near = near[(table[near] == table[v]).sum(axis=1) >= PLAUSIBLE]
            near = near[(bands[near] == bands[v]).argmax(axis=1) == band]
            if not len(near):
                continue
            mine[places[v]] = weight[v]
            less = np.minimum(mine[np.concatenate([places[u] for u in near])], np.concatenate([weight[u] for u in near]))
            mine[places[v]] = 0
            both = np.add.reduceat(less, np.cumsum(sizes[near]) - sizes[near])
            for u in near[both >= (least - 1e-6) * (sums[v] + sums[near] - both)].tolist():
                # Sums in another order differ in the last digits: the pair is judged like any other.
                if kind[u] != kind[v] and similarity(sets[v], sets[u], counts) >= least:
                    kind[kind == kind[u]] = kind[v]
                    out.append((min(rows[v][1], rows[u][1]), max(rows[v][1], rows[u][1])))

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out)) or [[], []]
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], names=["a", "b"])

    for batch in batches:
        for k, i, j, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if (k, i, j) != key:
                if rows:
                    work()
                key, rows = (k, i, j), []
            rows.append(row)
        if len(out) > 10_000:
            yield flush()
    if rows:
        work()
    yield flush()


def links_across(members: DataFrame, counts: bytes, least: float) -> DataFrame:
    """a, b: links that join the classes of `members` (key, band, node, sig, bands, class, text), enough to leave no
    plausible pair of a bucket that reaches the similarity in two classes."""
    near = _met(members, F.octet_length("text"), "band", "bands", "text")
    return near.mapInArrow(partial(_linked, counts, least), "a binary, b binary").distinct()


# Finer bands.


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each member of a group its nearest few of other classes: a < b, their classes, agree.

    Input, sorted: key, part, node, sig, class."""
    key, rows = None, []
    out: list[tuple] = []

    def work() -> None:
        numbers: dict[bytes, int] = {}
        kind = np.array([numbers.setdefault(r[2], len(numbers)) for r in rows])
        if len(numbers) < 2:
            return
        table = np.frombuffer(b"".join([r[1] for r in rows]), dtype=np.uint8).reshape(len(rows), -1)
        pairs = {}
        for v in range(len(rows)):
            others = np.flatnonzero(kind != kind[v])
            agree = (table[others] == table[v]).sum(axis=1)
            near = np.argpartition(agree, -NEAREST)[-NEAREST:] if len(agree) > NEAREST else np.arange(len(agree))
            pairs.update({(min(v, u), max(v, u)): n for u, n in zip(others[near].tolist(), agree[near].tolist()) if n >= LONG_LEAST})
        # No more than two classes keep of all their edges: those of a large class all name the same few others.
        between: dict[tuple[bytes, bytes], list[tuple]] = {}
        for (u, v), n in pairs.items():
            u, v = sorted((u, v), key=lambda i: rows[i][0])
            low, high = sorted((rows[u][2], rows[v][2]))
            between.setdefault((low, high), []).append((-n, rows[u][0], rows[v][0]))
        for (low, high), edges in between.items():
            out.extend((a, b, low, high, -n) for n, a, b in heapq.nsmallest(PAIR_EDGES, edges))

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out)) or [[]] * 5
        out.clear()
        kinds = [pa.binary()] * 4 + [pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["a", "b", "low", "high", "agree"])

    for batch in batches:
        for k, part, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if (k, part) != key:
                if rows:
                    work()
                key, rows = (k, part), []
            rows.append(row)
        if len(out) > 10_000:
            yield flush()
    if rows:
        work()
    yield flush()


def named_edges(members: DataFrame) -> DataFrame:
    """a, b: the edges between classes that `members` (node, bands, sig, class; the long signature) name.

    A member keeps its `NEAREST` best over all bands, and two classes their `PAIR_EDGES` best."""
    rows = members.select(F.explode("bands").alias("key"), "node", "sig", "class")
    held = F.count(F.lit(1)).alias("n"), F.min("class").alias("low"), F.max("class").alias("high")
    sizes = rows.groupBy("key").agg(*held).where(F.col("low") != F.col("high")).select("key", "n")
    cuts = F.ceil(F.col("n") / BUCKET_ROWS)
    part = F.pmod(F.xxhash64("node", "key"), cuts).alias("part")
    near = rows.join(sizes, "key").select("key", part, "node", "sig", "class")
    near = near.repartition("key", "part").sortWithinPartitions("key", "part")
    found = near.mapInArrow(_named, "a binary, b binary, low binary, high binary, agree int")
    each = found.groupBy("a", "b", "low", "high").agg(F.max("agree").alias("agree"))
    best = Window.partitionBy("low", "high").orderBy(F.desc("agree"), "a", "b")
    few = stored(each.withColumn("n", F.row_number().over(best)).where(F.col("n") <= PAIR_EDGES).drop("n"), "named")
    ends = few.select(F.explode(F.array("a", "b")).alias("node"), "a", "b", "agree")
    own = Window.partitionBy("node").orderBy(F.desc("agree"), "a", "b")
    return ends.withColumn("n", F.row_number().over(own)).where(F.col("n") <= NEAREST).select("a", "b").distinct()


# Verification.


def _verify(counts: bytes, least: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    remembered: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}

    def of(node: bytes, text: str) -> tuple[np.ndarray, np.ndarray]:
        if node not in remembered:
            if len(remembered) > 200:
                remembered.clear()
            remembered[node] = shingles(text)
        return remembered[node]

    for batch in batches:
        keep, found = [], []
        for i, (a, b, x, y) in enumerate(zip(*batch.columns)):
            s = similarity(of(a.as_py(), x.as_py()), of(b.as_py(), y.as_py()), counts)
            if s >= least:
                keep.append(i)
                found.append(s)
        at = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(found, pa.float64())], names=["a", "b", "similarity"])


def verified(pairs: DataFrame, texts: DataFrame, counts: bytes, least: float) -> DataFrame:
    """The pairs a, b that reach the similarity. `texts`: node, text. Pairs and texts meet in equi-joins.

    Few pairs go to the texts, so that no more than their own texts are shuffled."""
    side = _side(pairs.select("a", "b"))
    one, two = (texts.join(side, F.col("node") == F.col(n)).select("a", "b", F.col("text").alias(f"{n}_text")) for n in "ab")
    met = one.join(two, ["a", "b"]).select("a", "b", "a_text", "b_text")
    return met.mapInArrow(partial(_verify, counts, least), "a binary, b binary, similarity double").distinct()


def _side(df: DataFrame) -> DataFrame:
    """A stored side of a join: broadcast up to `BROADCAST_ROWS` counted rows of two short values, else shuffled."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def components(edges: DataFrame) -> DataFrame:
    """node, class: the smallest node of each connected component of the edges a, b.

    Each round gives a node the smallest label among its own and its neighbours', and then the label of that label.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")), "both-ways")
    first = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("class"))
    labels = stored(first.select("node", F.least("class", "node").alias("class")), "labels")
    while True:
        side = _side(labels.select(F.col("node").alias("of"), F.col("class").alias("of_class")))
        near = both.join(side, both["b"] == F.col("of")).select(F.col("a").alias("node"), F.col("of_class").alias("class"))
        own = labels.select("node", "class", F.col("class").alias("old"))
        least = near.withColumn("old", F.lit(None).cast("binary")).union(own).groupBy("node").agg(
            F.min("class").alias("class"), F.max("old").alias("old")
        )
        jumped = least.join(side, least["class"] == F.col("of"), "left").select(
            "node", F.least("class", "of_class").alias("class"), "old"
        )
        found = stored(jumped.withColumn("moved", F.col("class") != F.col("old")), "labels")
        labels = found.select("node", "class")
        if found.where("moved").isEmpty():
            return labels


def _texts(rows: DataFrame, firsts: DataFrame, needed: DataFrame) -> DataFrame:
    """node, text of the nodes `n` in `needed`."""
    needed = stored(needed.join(firsts, F.col("n") == F.col("node")).select("n", "first_id"), "needed")
    # One row of each text, found by its id: copies do not meet in one task.
    same = (rows["node"] == F.col("n")) & rows["doc_id"].eqNullSafe(F.col("first_id"))
    return stored(rows.join(_side(needed), same).select("node", "text"), "texts")


def _labelled(nodes: DataFrame, labels: DataFrame | None) -> DataFrame:
    """`nodes` with their class: by the labels, or else themselves."""
    if labels is None:
        return nodes.withColumn("class", F.col("node"))
    side = _side(labels.select(F.col("node").alias("of"), F.col("class").alias("of_class")))
    found = nodes.join(side, F.col("node") == F.col("of"), "left")
    return found.select(*nodes.columns, F.coalesce("of_class", "node").alias("class"))


def relabelled(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """node, class once the edges a, b link the classes of `labels` (node, class).

    Classes are joined, not their members: an edge is one between two classes, and those within a class are left out. So a
    large class costs no more than a small one, however many edges made it."""
    if labels is None:
        return components(links)
    one = _labelled(links.select(F.col("a").alias("node"), "b"), labels).select(F.col("class").alias("a"), F.col("b").alias("node"))
    two = _labelled(one, labels).select("a", F.col("class").alias("b"))
    linked = components(two.where(F.col("a") != F.col("b")).distinct())
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    alone = ends.join(labels.select("node"), "node", "left_anti").withColumn("class", F.col("node"))
    side = _side(linked.select(F.col("node").alias("of"), F.col("class").alias("of_class")))
    found = labels.unionByName(alone).join(side, F.col("class") == F.col("of"), "left")
    return stored(found.select("node", F.coalesce("of_class", "class").alias("class")), "labels")


def classes(
    docs: DataFrame, least: float = SIMILARITY, doc_id: str = "doc_id", text: str = "text", exhaustive: bool = True
) -> DataFrame:
    """One row for each document: doc_id, node (hash of the text), class_id, class_node.

    Documents are in one class if a chain of texts leads from one to the other, each weighted-Jaccard similar to the
    next by `least` or more. `class_id` is the smallest doc_id of the class and `class_node` the text hash that goes
    with it. Equal texts are one class; a null text or one without words is like no other, except that copies of it
    are one class. Null ids: a class without any id has a null class_id. Repeated rows give repeated results. Other
    columns are ignored; an empty table gives an empty result. Every plausible pair of a bucket is tested; without
    `exhaustive`, large buckets are left with the pairs that finer bands name.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("node", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    counts = sketch(rows)
    signed = stored(rows.select("node", "text").mapInArrow(partial(_sign, counts, False), SIGNED), "signatures")
    nodes = stored(signed.groupBy("node").agg(F.first("bands").alias("bands"), F.first("sig").alias("sig")), "nodes")
    firsts = stored(rows.groupBy("node").agg(F.min("doc_id").alias("first_id")), "firsts")
    pool, left = candidate_edges(nodes)
    pool = stored(pool, "pool")
    each = nodes.select("node", "sig", "bands", F.posexplode("bands").alias("band", "key"))
    left = stored(each.join(_side(left), "key", "left_semi"), "left")
    # All texts that any step compares are looked up at once.
    ends = [df.select(F.col(c).alias("n")) for df, c in ((pool, "a"), (pool, "b"), (left, "node"))]
    texts = _texts(rows, firsts, reduce(DataFrame.union, ends).distinct())
    labels, tested, take = None, None, 1
    open_ = pool
    while not open_.isEmpty():
        ends = open_.select("a", "b", F.explode(F.array("a", "b")).alias("node"), "agree")
        best = Window.partitionBy("node").orderBy(F.desc("agree"), "a", "b")
        picked = stored(ends.withColumn("n", F.row_number().over(best)).where(F.col("n") <= take).select("a", "b").distinct(), "picked")
        tested = picked if tested is None else tested.union(picked)
        good = stored(verified(picked, texts, counts, least).select("a", "b"), "links")
        labels = relabelled(labels, good)
        one, two = (_side(labels.select(F.col("node").alias(f"{n}_node"), F.col("class").alias(f"{n}_class"))) for n in "ab")
        rest = open_.join(picked, ["a", "b"], "left_anti")
        rest = rest.join(one, F.col("a") == F.col("a_node"), "left").join(two, F.col("b") == F.col("b_node"), "left")
        apart = F.coalesce("a_class", "a") != F.coalesce("b_class", "b")
        open_ = stored(rest.where(apart).select("a", "b", "agree"), "open")
        take *= 4
    def tried(pairs: DataFrame) -> bool:
        """Verify `pairs`, none of them tested before, and join the classes they link. Whether there are any links."""
        nonlocal labels, tested
        tested = pairs if tested is None else tested.union(pairs)
        good = stored(verified(pairs, texts, counts, least).select("a", "b"), "links")
        if good.isEmpty():
            return False
        labels = relabelled(labels, good)
        return True

    def new(pairs: DataFrame) -> DataFrame:
        return stored(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "picked")

    if not left.isEmpty():
        several = _labelled(left, labels).groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high"))
        several = several.where(F.col("low") != F.col("high")).select("key")
        unsettled = stored(left.join(several, "key", "left_semi").select(F.col("node").alias("n")).distinct(), "unsettled")
        whole = texts.join(_side(unsettled), F.col("node") == F.col("n")).select("node", "text")
        long = whole.mapInArrow(partial(_sign, counts, True), SIGNED)
        long = stored(long.dropDuplicates(["node"]), "long-signatures")
        while True:
            picked = new(named_edges(_labelled(long, labels)))
            if picked.isEmpty() or not tried(picked):
                break
        if exhaustive:
            members = _labelled(left.join(several, "key", "left_semi"), labels).join(whole.dropDuplicates(["node"]), "node")
            links = stored(links_across(members, counts, least), "links")
            if not links.isEmpty():
                labels = relabelled(labels, links)
    member = firsts.withColumnsRenamed({"node": "of"})
    if labels is None:
        known = member.select("of", "first_id", F.col("of").alias("class"))
    else:
        known = member.join(labels, F.col("of") == F.col("node"), "left").select("of", "first_id", F.coalesce("class", "of").alias("class"))
    # Nulls last: an id names the class if any member has one.
    first = F.min(F.struct(F.col("first_id").isNull().alias("none"), "first_id", "of"))
    named = known.groupBy("class").agg(first.alias("f"), F.count(F.lit(1)).alias("n_texts"))
    named = known.select("of", "class").join(named, "class").select("of", F.col("f.first_id").alias("class_id"), F.col("f.of").alias("class_node"), "n_texts")
    found = rows.select("doc_id", "node").join(stored(named, "classes"), F.col("node") == F.col("of"))
    return found.select("doc_id", "node", "class_id", "class_node", "n_texts")


def one_of_each(
    docs: DataFrame, least: float = SIMILARITY, doc_id: str = "doc_id", text: str = "text", exhaustive: bool = True
) -> DataFrame:
    """The rows of `docs` that stand for their class: the one of smallest doc_id, with all its columns.

    A class without any id keeps one of its rows, and so does a class whose smallest id comes several times with equal
    text. Null and empty texts are one class, of which one row stays. An empty table stays empty. `exhaustive`: as for
    `classes`.
    """
    node, keep_node, keep_id = fresh(docs.columns, "node", "keep_node", "keep_id")
    found = classes(docs, least, doc_id, text, exhaustive)
    chosen = found.groupBy("class_node").agg(F.first("class_id").alias(keep_id)).withColumnRenamed("class_node", keep_node)
    rows = docs.withColumn(node, F.unhex(F.md5(F.coalesce(text, F.lit("")))))
    same = (F.col(node) == F.col(keep_node)) & F.col(doc_id).eqNullSafe(F.col(keep_id))
    return rows.join(chosen, same).dropDuplicates([node]).select(*docs.columns)
