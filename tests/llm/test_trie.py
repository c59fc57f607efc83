"""The prefix trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from lakemart.llm import trie

TURNS = "conv_id long, turn long, role string, text string"


def turn_key(role, text):
    role, text = (role or "").encode(), (text or "").encode()
    return hashlib.sha256(str(len(role)).encode() + b":" + role + text).digest()


def originals(rows):
    """conv_id -> its turns in order, as (role, text)."""
    out = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            out.setdefault(conv, []).append((turn is not None, turn or 0, turn_key(role, text), role or "", text or ""))
    return {c: [t[3:] for t in sorted(turns)] for c, turns in out.items()}


def rebuilt(turns):
    out = {}
    for c, own in turns.items():
        h, base = zlib.crc32(str(c).encode()) % 9, c - int(np.fmod(c, 5))
        out[c] = own if base == c else turns.get(base, [])[:h] + own[h:]
    return out


def by_hand(paths):
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[b] for b in below) if below else 1
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[b] for b in below)
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(
        (
            min(found), len(node), min(members[node[:-1]]) if node else None, len(found), len(children.get(node, [])),
            leaves[node], saved[node], sha(c for c in found if len(paths[c]) == len(node)),
        )
        for node, found in members.items()
    )


def check(spark, rows, extra=""):
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    found = trie.prefix_nodes(*trie.rebuilt(df.selectExpr("*", extra) if extra else df))
    assert sorted(map(tuple, found.collect()), key=lambda r: r[:2]) == sorted(by_hand(rebuilt(originals(rows))), key=lambda r: r[:2])


def family(seed, n, alphabet=3, longest=12):
    random_ = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(random_.randint(1, longest)):
            rows.append((c, t, random_.choice(["user", "assistant"]), random_.choice(["", "é", "long text", "x"][:alphabet])))
    return rows


@pytest.mark.parametrize("few", [1, 3, 32])
def test_dense_trie(spark, monkeypatch, few):
    """Many shared prefixes; the fewer members a subtree may have, the more nodes stand above the subtrees."""
    monkeypatch.setattr(trie, "FEW_MEMBERS", few)
    check(spark, family(1, 150))


def test_bounded_nodes_above(spark, monkeypatch):
    monkeypatch.setattr(trie, "FEW_MEMBERS", 1)
    monkeypatch.setattr(trie, "TOP_NODES", 10)
    monkeypatch.setattr(trie, "SHARD_RUNS", 7)
    check(spark, family(2, 150))


def test_copies_of_one_conversation(spark):
    """A third of all conversations are equal, and one is as long as all others together."""
    same = [(c, t, "user", f"turn {t}") for c in range(0, 500, 5) for t in range(4)]
    other = [(c, t, "user", f"turn {t}" if t < 2 else f"{c} {t}") for c in range(1, 400, 3) for t in range(3) if c % 5]
    long = [(1000 + c, t, "assistant", f"long {t}") for c in (0, 5) for t in range(1500)]
    check(spark, same + other + long)


def test_awkward_rows(spark):
    rows = [
        (None, 0, "user", "no id"), (0, None, None, None), (0, 0, "user", "b"), (0, 0, "user", "a"), (0, 0, "user", "a"),
        (3, 0, "user", "only own"), (7, 0, "user", "base is absent"), (-3, 1, "user", "negative"), (-10, 0, "", ""),
        (-9, 0, "user", "x" * 100_000), (2**62, 0, "user", "large"), (12, 0, "ab", "c"), (13, 0, "a", "bc"),
    ]
    check(spark, rows)
    check(spark, rows, "1 AS depth")
    assert trie.prefix_nodes(*trie.rebuilt(spark.createDataFrame([], TURNS))).count() == 0
    found = trie.prefix_nodes(*trie.rebuilt(spark.createDataFrame([(7, 0, "user", "turnless, as its base is absent")], TURNS)))
    opening = zlib.crc32(b"7") % 9
    assert found.count() == (1 if opening else 2)


def test_conversation_over_many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(spark, [(c, t, "user", f"{t}") for c in (0, 10) for t in range(400)] + family(4, 20))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_collision_is_found(spark, monkeypatch):
    """With lanes that hold nothing every node of one depth has the same digest, which is refused."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(trie, "_lanes", lambda salt: {f"l{k}": F.lit(0).cast("long") for k in (1, 2, 3, 4)})
    df = spark.createDataFrame([(0, 0, "user", "a"), (5, 0, "user", "b")], TURNS)
    with pytest.raises(ValueError, match="collide"):
        trie.prefix_nodes(*trie.rebuilt(df))


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 20_000])
def test_minimal_perfect_hash(n):
    keys = np.random.default_rng(5).integers(0, 2**63, size=(n, 3)).astype(np.uint64)
    table = trie.MinimalPerfectHash(keys)
    assert sorted(table.slots(keys)) == list(range(n))
    others = np.random.default_rng(6).integers(0, 2**63, size=(500, 3)).astype(np.uint64)
    assert (table.slots(others) == -1).all()
