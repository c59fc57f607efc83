"""Conversation prefix trie: a node table behind a minimal perfect hash.

Each distinct sequence of first turns is a node. Its digest is a sum of hashes of (position, turn), four lanes modulo
2^32, so the digests of all prefixes are running sums, and a conversation of any length can be spread over many tasks.
That nodes of one digest are the same sequence is checked: they must agree in their parent's digest and in the SHA-256
of their last turn; if not, digests are made again with another salt.

Neighbouring nodes that the same conversations share form a run, with one slot. Runs are dealt to shards by the topmost
node above them that few conversations share, so a shard holds whole subtrees of bounded size. In a shard a minimal
perfect hash gives each run's last digest a slot of its own; what is looked up is compared with the digest stored there.
Counts are scattered into flat arrays by slot, parents become parent slots, and totals are added to them level by level
from the deepest up. Nodes above all subtrees are shared by many conversations each; there are at most TOP_NODES of
them, and they make a last table of the same kind, which starts from the totals of the subtrees.

Defined results: rows of a null conv_id take no part; null roles and texts are empty; turns go by turn (null first),
equal ones by the digest of role and text, and repeated rows are repeated turns. An empty table gives no nodes, not even
a root. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import ship_package, stored
from lakemart.operators.joins import spread_join

# A node of more members than this, or than its share of the rows over TOP_NODES, is above the sharded subtrees.
FEW_MEMBERS, TOP_NODES = 32, 200_000
SHARD_RUNS = 50_000
SALTS = 4
LOW = 0xFFFFFFFF
NODE = ["depth", "d1", "d2"]
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


# --- turns ---------------------------------------------------------------------------------------------------------


def numbered(conversations: DataFrame) -> DataFrame:
    """The turns of each conversation in order: conv_id, pos (from 0), turn_sha (binary), n_bytes (of the text).

    Rows are dealt by ranges of (conv_id, turn), so a conversation of any length is shared between tasks.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    identity = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("at"),
        F.unhex(F.sha2(identity, 256)).alias("turn_sha"), F.octet_length(text).cast("long").alias("n_bytes"),
    )
    counted = running(turns.withColumn("one", F.lit(1).cast("long")), ["at", "turn_sha"], ["one"], "turns")
    return counted.select("conv_id", (F.col("sum_one") - 1).alias("pos"), "turn_sha", "n_bytes")


def _inside(keys: list[str], values: list[str], schema: pa.Schema):
    """Running sums of `values` within each conv_id of a sorted partition."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carried = None, np.zeros(len(values), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            table = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            conv = table["conv_id"].to_numpy(zero_copy_only=False)
            own = np.column_stack([table[v].to_numpy(zero_copy_only=False) for v in values])
            sums = np.cumsum(own, axis=0)
            first = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
            before = np.where(first[:, None] > 0, sums[first - 1], 0)
            if conv[0] == last:
                before[0] -= carried
            sums -= np.repeat(before, np.diff(np.r_[first, len(conv)]), axis=0)
            last, carried = conv[-1], sums[-1].copy()
            found = [table[k] for k in keys] + [pa.array(sums[:, i]) for i in range(len(values))]
            yield pa.RecordBatch.from_arrays(found, schema=schema)

    return rows


def running(df: DataFrame, order: list[str], values: list[str], label: str) -> DataFrame:
    """`df` with `sum_<value>`: sums of the long columns `values` from the conversation's first row to this one.

    One shuffle by ranges of (conv_id, *order). A conversation can continue from one range into the next, but only one
    for each range does; the sums that it brings along are a table of one row for each range, which is broadcast.
    """
    ship_package(df.sparkSession)
    sums = [f"sum_{v}" for v in values]
    ranges = df.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id())
    ranges = ranges.sortWithinPartitions("conv_id", *order)
    kinds = {"binary": pa.binary(), "bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    schema = pa.schema([(c, kinds[t]) for c, t in ranges.dtypes] + [(s, pa.int64()) for s in sums])
    ddl = ", ".join([f"{c} {t}" for c, t in ranges.dtypes] + [f"{s} bigint" for s in sums])
    found = stored(ranges.mapInArrow(_inside(ranges.columns, values, schema), ddl), label)
    # The last conversation of each range with its sums there: sums within a range grow, so the largest are the last.
    last = found.groupBy("part").agg(F.max("conv_id").alias("conv_id"))
    ends = found.join(F.broadcast(last), ["part", "conv_id"]).groupBy("part", "conv_id").agg(*[F.max(s).alias(s) for s in sums])
    along = Window.partitionBy("conv_id").orderBy("part")
    following = F.lead("part").over(Window.orderBy("part"))  # over one row for each range
    brought = ends.select(following.alias("part"), "conv_id", *[F.sum(s).over(along).alias(f"_{s}") for s in sums])
    joined = found.join(F.broadcast(brought.where("part IS NOT NULL")), ["part", "conv_id"], "left")
    return joined.withColumns({s: F.col(s) + F.coalesce(f"_{s}", F.lit(0)) for s in sums}).drop("part", *[f"_{s}" for s in sums])


# --- nodes ---------------------------------------------------------------------------------------------------------


def _lanes(salt: int) -> dict[str, Column]:
    words = [F.xxhash64(F.lit(2 * salt + k), "pos", "turn_sha") for k in (0, 1)]
    return {
        "l1": words[0].bitwiseAND(F.lit(LOW)), "l2": F.shiftrightunsigned(words[0], 32),
        "l3": words[1].bitwiseAND(F.lit(LOW)), "l4": F.shiftrightunsigned(words[1], 32),
    }


def _word(low: Column, high: Column) -> Column:
    return low.bitwiseAND(F.lit(LOW)).bitwiseOR(F.shiftleft(high.bitwiseAND(F.lit(LOW)), 32))


def prefixes(turns: DataFrame, salt: int = 0) -> DataFrame:
    """Each turn with the digest of the prefix that it ends: conv_id, depth, d1, d2, its parent's p1, p2, and bytes."""
    lanes = _lanes(salt)
    summed = running(turns.withColumns(lanes), ["pos"], [*lanes, "n_bytes"], "prefixes")
    total, own = (lambda k: F.col(f"sum_l{k}")), (lambda k: F.col(f"l{k}"))
    return summed.select(
        "conv_id", (F.col("pos") + 1).alias("depth"), "turn_sha", "n_bytes", F.col("sum_n_bytes").alias("path_bytes"),
        _word(total(1), total(2)).alias("d1"), _word(total(3), total(4)).alias("d2"),
        _word(total(1) - own(1), total(2) - own(2)).alias("p1"), _word(total(3) - own(3), total(4) - own(4)).alias("p2"),
    )


def _distinct(found: DataFrame) -> DataFrame:
    same = [F.min(c).eqNullSafe(F.max(c)) for c in ("p1", "p2", "turn_sha")]
    return found.groupBy(*NODE).agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"), F.min("p1").alias("p1"), F.min("p2").alias("p2"),
        F.min("n_bytes").alias("n_bytes"), F.min("path_bytes").alias("path_bytes"), (same[0] & same[1] & same[2]).alias("sound"),
    )


def verified_nodes(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The prefixes of `turns` and the nodes they make, with digests of which no two sequences share one."""
    for salt in range(SALTS):
        found = prefixes(turns, salt)
        nodes = stored(_distinct(found), "nodes")
        if not nodes.where("NOT sound").limit(1).collect():
            return found, nodes.drop("sound")
    raise ValueError(f"prefix digests collide with {SALTS} salts")


# --- the node table of a shard -------------------------------------------------------------------------------------


def _mixed(words: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes of rows of 64-bit words."""
    with np.errstate(over="ignore"):
        out = np.full(len(words), np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1), dtype=np.uint64)
        for column in words.T:
            out = (out ^ column) * np.uint64(0xBF58476D1CE4E5B9)
            out = (out ^ (out >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            out ^= out >> np.uint64(32)
    return out


class MinimalPerfectHash:
    """Slots 0 to n - 1 for n distinct keys (rows of 64-bit words), one each.

    Level by level, a key that is alone in its place of a bit array keeps it; the others go on to the next, smaller
    array. A slot is the rank of the place among all places kept. `slots` compares the key found with the one asked for.
    """

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.keys = np.empty_like(keys)
        left, base = np.arange(len(keys)), 0
        while len(left):
            size = 2 * len(left)
            place = (_mixed(keys[left], len(self.levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            ranks = base + np.cumsum(alone) - alone
            kept = alone[place]
            self.keys[ranks[place[kept]]] = keys[left[kept]]
            self.levels.append((alone, ranks))
            left, base = left[~kept], base + int(alone.sum())
            if len(self.levels) > 200:
                raise ValueError("keys of a minimal perfect hash must be distinct")

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for keys that the table does not hold."""
        out, open_ = np.full(len(keys), -1, dtype=np.int64), np.arange(len(keys))
        for level, (alone, ranks) in enumerate(self.levels):
            if not len(open_):
                break
            place = (_mixed(keys[open_], level) % np.uint64(len(alone))).astype(np.int64)
            hit = alone[place]
            out[open_[hit]] = ranks[place[hit]]
            open_ = open_[~hit]
        found = np.flatnonzero(out >= 0)
        wrong = (self.keys[out[found]] != keys[found]).any(axis=1)
        out[found[wrong]] = -1
        return out


RUN = "conv_id long, n long, n_children long, n_leaves long, below long, parent_conv_id long"
_RUN_SCHEMA = pa.schema([(c.split()[0], pa.int64()) for c in RUN.split(", ")])


def _accumulated(table: pa.Table) -> pa.Table:
    """Totals of the runs of one shard. A run whose parent is elsewhere gets no parent_conv_id."""
    number = lambda name: table.column(name).to_numpy().astype(np.int64)
    words = lambda *names: np.column_stack([number(c) for c in names]).view(np.uint64)
    hash_ = MinimalPerfectHash(words("bottom", "d1", "d2"))
    slot = hash_.slots(words("bottom", "d1", "d2"))
    size = len(slot)

    def scattered(values: np.ndarray) -> np.ndarray:
        out = np.empty(size, dtype=np.int64)
        out[slot] = values
        return out

    conv, n, bottom, weight = map(scattered, (number("conv_id"), number("n"), number("bottom"), number("weight")))
    children, leaves, below = map(scattered, (number("more_children"), number("more_leaves"), number("more_below")))
    up = np.column_stack([number("top") - 1, number("p1"), number("p2")]).view(np.uint64)
    parent = scattered(hash_.slots(up))
    inner = parent >= 0
    children += np.bincount(parent[inner], minlength=size)
    leaves[children == 0] = 1
    order = np.argsort(-bottom, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(bottom[order])) + 1):
        level = level[inner[level]]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(below, parent[level], below[level] + weight[level])
    parent_conv = pa.array(conv[np.where(inner, parent, 0)], mask=~inner)
    columns = [pa.array(a) for a in (conv, n, children, leaves, below)] + [parent_conv]
    return pa.Table.from_arrays(columns, schema=_RUN_SCHEMA)


# --- the trie ------------------------------------------------------------------------------------------------------


def _runs(nodes: DataFrame) -> DataFrame:
    """Nodes that the same conversations share: those of one smallest member and one count are neighbours on its path."""
    runs = nodes.groupBy("conv_id", "n").agg(
        F.min("depth").alias("top"), F.max("depth").alias("bottom"),
        F.min_by("p1", "depth").alias("p1"), F.min_by("p2", "depth").alias("p2"),
        F.max_by("d1", "depth").alias("d1"), F.max_by("d2", "depth").alias("d2"),
        F.max("path_bytes").alias("low_bytes"), F.min(F.col("path_bytes") - F.col("n_bytes")).alias("high_bytes"),
    )
    weight = (F.col("n") - 1) * (F.col("low_bytes") - F.col("high_bytes"))
    none = F.lit(0).cast("long")
    return runs.withColumns({"weight": weight, "more_children": none, "more_leaves": none, "more_below": none})


def _added() -> list[Column]:
    """What runs add to the node that they hang on."""
    return [
        F.count(F.lit(1)).alias("n_children"), F.coalesce(F.sum("n_leaves"), F.lit(0)).alias("n_leaves"),
        F.coalesce(F.sum(F.col("below") + F.col("weight")), F.lit(0)).alias("below"),
    ]


def _totals(found: DataFrame, nodes: DataFrame, root_conv: int) -> DataFrame:
    """The runs with their totals."""
    spark = nodes.sparkSession
    rows = nodes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    few = max(FEW_MEMBERS, -(-rows // TOP_NODES))
    # Above the subtrees: every such node has more than `few` of the rows, so there are at most TOP_NODES.
    above = stored(nodes.where(F.col("n") > few).select(*NODE, F.col("conv_id").alias("above_conv")), "above")
    runs = stored(_runs(nodes), "runs")
    outside = found.join(F.broadcast(above), NODE, "left").where("above_conv IS NULL")
    anchors = outside.groupBy("conv_id").agg(F.min_by("d1", "depth").alias("a1"), F.min_by("d2", "depth").alias("a2"))
    small = runs.where(F.col("n") <= few)
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-runs.count() // SHARD_RUNS))
    dealt = small.join(anchors, "conv_id").withColumn("shard", F.pmod(F.xxhash64("a1", "a2"), F.lit(shards)))
    ship_package(spark)
    subtrees = stored(dealt.drop("a1", "a2").groupBy("shard").applyInArrow(_accumulated, RUN), "subtrees")
    # What hangs on the nodes above, added up for each of them; depth 0 is the root.
    hanging = subtrees.where("parent_conv_id IS NULL").drop("parent_conv_id").join(
        small.select("conv_id", "n", "weight", (F.col("top") - 1).alias("depth"), "p1", "p2"), ["conv_id", "n"]
    )
    upper = F.broadcast(above.select("depth", F.col("d1").alias("p1"), F.col("d2").alias("p2"), "above_conv"))
    hung = hanging.join(upper, ["depth", "p1", "p2"], "left")
    started = hung.groupBy(F.col("depth").alias("bottom"), F.col("p1").alias("d1"), F.col("p2").alias("d2")).agg(*_added())
    plain = runs.where(F.col("n") > few).drop("more_children", "more_leaves", "more_below")
    upper_runs = plain.join(started, ["bottom", "d1", "d2"], "left").fillna(0, ["n_children", "n_leaves", "below"])
    upper_runs = upper_runs.withColumnsRenamed({"n_children": "more_children", "n_leaves": "more_leaves", "below": "more_below"})
    upper_found = stored(upper_runs.groupBy(F.lit(0).alias("shard")).applyInArrow(_accumulated, RUN), "upper")
    names = ["conv_id", "n", "n_children", "n_leaves", "below", "parent_conv_id"]
    lower_parents = hung.select("conv_id", "n", F.coalesce("above_conv", F.lit(root_conv)).alias("outer"))
    lower = subtrees.join(lower_parents, ["conv_id", "n"], "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "outer")
    )
    top = upper_found.withColumn("parent_conv_id", F.coalesce("parent_conv_id", F.lit(root_conv)))
    both = lower.select(names).unionByName(top.select(names))
    sides = ["top", "bottom", "low_bytes", "weight"]
    return stored(both.join(runs.select("conv_id", "n", *sides), ["conv_id", "n"]), "totals")


def _ends(found: DataFrame, ids: DataFrame) -> DataFrame:
    """For each node: SHA-256 of the ids, in order, of the conversations that end there; turnless ones end at the root.

    Ids are dealt by ranges and joined to one string for each range and node, so a node where many conversations end
    is gathered by many tasks; one task then hashes its strings one after the other.
    """
    last = found.groupBy("conv_id").agg(
        F.max("depth").alias("depth"), F.max_by("d1", "depth").alias("d1"), F.max_by("d2", "depth").alias("d2")
    )
    zero = F.lit(0).cast("long")
    ends = ids.join(last, "conv_id", "left").select("conv_id", *[F.coalesce(c, zero).alias(c) for c in NODE])
    parts = ends.repartitionByRange(*NODE, "conv_id").withColumn("part", F.spark_partition_id())
    listed = F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))
    strings = parts.groupBy(*NODE, "part").agg(F.array_join(listed, ",").alias("ids"))

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, out = None, None, []
        for batch in batches:
            for row in batch.to_pylist():
                here = (row["depth"], row["d1"], row["d2"])
                if here == node:
                    state.update(b",")
                else:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = here, hashlib.sha256()
                state.update(row["ids"].encode())
            yield _end_rows(out)
            out = []
        if node is not None:
            yield _end_rows([(*node, state.hexdigest())])

    ship_package(ids.sparkSession)
    gathered = strings.repartition(*NODE).sortWithinPartitions(*NODE, "part")
    return gathered.mapInArrow(hashed, "depth long, d1 long, d2 long, ends_sha256 string")


def _end_rows(rows: list[tuple]) -> pa.RecordBatch:
    schema = pa.schema([*[(c, pa.int64()) for c in NODE], ("ends_sha256", pa.string())])
    columns = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


TRIE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string"
)


def prefix_nodes(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """The trie of `turns` (conv_id, pos from 0, turn_sha, n_bytes) over the conversations `ids` (conv_id, each once).

    One row for each node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (bytes that the subtree saves by sharing), ends_sha256.
    """
    spark = turns.sparkSession
    ids = stored(ids.select(F.col("conv_id").cast("long")), "members")
    members = ids.agg(F.min("conv_id").alias("first"), F.count(F.lit(1)).alias("n")).first()
    if not members["n"]:
        return spark.createDataFrame([], TRIE)
    found, nodes = verified_nodes(turns)
    totals = _totals(found, nodes, members["first"])
    root = totals.where("top = 1").agg(*_added()).first()
    joined = spread_join(
        nodes, totals.withColumnsRenamed({"conv_id": "run_conv", "n": "run_n"}), ["conv_id", "n"], ["run_conv", "run_n"], "inner"
    )
    after = F.col("low_bytes") - (F.col("path_bytes") - F.col("n_bytes"))
    table = joined.select(
        *NODE, "conv_id", F.when(F.col("depth") == F.col("top"), F.col("parent_conv_id")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(F.col("depth") == F.col("bottom"), F.col("n_children")).otherwise(1).alias("n_children"),
        "n_leaves", ((F.col("n") - 1) * after + F.col("below")).alias("saved_tokens"),
    )
    of_root = {
        **dict.fromkeys(NODE, 0), "conv_id": members["first"], "parent_conv_id": None, "n_convs": members["n"],
        "n_children": root["n_children"], "n_leaves": max(root["n_leaves"], 1), "saved_tokens": root["below"],
    }
    top = spark.range(1).select(*[F.lit(v).cast("long").alias(c) for c, v in of_root.items()])
    every = table.unionByName(top).join(_ends(found, ids), NODE, "left")
    return every.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )


# --- conversations rebuilt on shared openings ----------------------------------------------------------------------

GROUP, LONGEST_OPENING = 5, 9


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like their group's first: their turns (as `prefix_nodes` takes them) and their ids.

    Conversation c takes the first h turns of conversation c - c % 5 and goes on with its own turns after its first h,
    where h is the CRC-32 of the decimal id, modulo 9.
    """
    turns = numbered(conversations)
    ids = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long")).distinct()
    opening = F.crc32(F.col("conv_id").cast("string")) % LONGEST_OPENING
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    heads = turns.where((base == F.col("conv_id")) & (F.col("pos") < LONGEST_OPENING - 1))
    heads = stored(heads.withColumnRenamed("conv_id", "base"), "heads")
    others = ids.where(base != F.col("conv_id")).select("conv_id", base.alias("base"), opening.alias("h"))
    taken = heads.join(others, "base").where("pos < h").select("conv_id", "pos", "turn_sha", "n_bytes")
    # Own turns after the opening, set behind it: it is shorter than h if the group's first conversation is.
    own = turns.withColumn("h", F.when(base == F.col("conv_id"), F.lit(0)).otherwise(opening)).where("pos >= h")
    shorter = others.join(heads.groupBy("base").agg(F.count(F.lit(1)).alias("n")), "base", "left")
    shorter = shorter.select(F.col("conv_id").alias("short_conv"), F.greatest(F.col("h") - F.coalesce("n", F.lit(0)), F.lit(0)).alias("gap"))
    moved = spread_join(own, shorter.where("gap > 0"), ["conv_id"], ["short_conv"], "left")
    own = moved.select("conv_id", (F.col("pos") - F.coalesce("gap", F.lit(0))).alias("pos"), "turn_sha", "n_bytes")
    return own.unionByName(taken), ids
