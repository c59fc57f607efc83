"""Near duplicates against brute force over all pairs, large groups, awkward inputs."""

import random
from itertools import combinations

import corpus_pipeline
import numpy as np
import pytest
from llm.conftest import AWKWARD, WORDS, prose

from lakemart.llm import neardup, queries


def edited(text, changes, seed):
    random_ = random.Random(seed)
    words = text.split()
    for _ in range(changes):
        words[random_.randrange(len(words))] = random_.choice(WORDS) + "x"
    return " ".join(words)


def by_hand(rows, counts):
    sets = {i: neardup.shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(sorted(sets), 2):
        if neardup.similarity(sets[i], sets[j], counts) >= neardup.SIMILARITY:
            a, b = sorted((find(i), find(j)))
            parent[b] = a
    return {i: find(i) for i in sets}


def corpus():
    rows = []
    for g in range(25):
        base = prose(g, 200)
        rows += [(100 * g, base), *[(100 * g + k, edited(base, k, 31 * g + k)) for k in range(1, 5)]]
    return rows + [(9000 + i, prose(500 + i, 100) + " " + prose(77, 60)) for i in range(30)]


@pytest.mark.parametrize("bucket", [neardup.BUCKET_ROWS, 3])
def test_against_brute_force(docs, monkeypatch, bucket):
    monkeypatch.setattr(neardup, "BUCKET_ROWS", bucket)  # 3: parts, centres and finer keys
    rows = corpus()
    df = docs(*rows, extra="1 AS class_id")
    want = by_hand(rows, neardup.sketch(df))
    found = {r["doc_id"]: r["class_id"] for r in neardup.classes(df).collect()}
    assert found == want and len(set(want.values())) < len(want)
    kept = neardup.one_of_each(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))


def test_a_large_group_of_copies(docs):
    base = prose(3, 300)
    rows = [(i, base) for i in range(300)] + [(1000 + i, edited(base, 1 + i % 3, i)) for i in range(600)]
    found = neardup.classes(docs(*rows, (5000, prose(4, 300)))).collect()
    assert {(r["class_id"], r["doc_id"] == 5000) for r in found} == {(0, False), (5000, True)}


def family(seed, n, pairs, slots=60, changed=12):
    """Texts of one template with two choices in each fourth place, and near copies of the first few."""
    random_ = random.Random(seed)
    places = [[" ".join(f"{seed}s{s}o{o if s % 4 == 0 else 0}w{k}" for k in range(5)) for o in range(2)] for s in range(4 * slots)]
    picks = [[random_.randrange(2) for _ in range(slots)] for _ in range(n)]
    for p in picks[:pairs]:
        other = random_.sample(range(slots), changed)
        picks.append([1 - o if s in other else o for s, o in enumerate(p)])
    return [(1000 * seed + i, " ".join(c[p[s // 4]] for s, c in enumerate(places))) for i, p in enumerate(picks)]


@pytest.mark.parametrize("bucket", [neardup.BUCKET_ROWS, 10])
def test_pairs_within_a_family_of_template_texts(docs, monkeypatch, bucket):
    monkeypatch.setattr(neardup, "BUCKET_ROWS", bucket)  # 10: the family is cut into parts and blocks
    rows = family(1, 100, 30)
    df = docs(*rows)
    want = by_hand(rows, neardup.sketch(df))
    assert len(rows) - 40 < len(set(want.values())) <= len(rows) - 30
    assert {r["doc_id"]: r["class_id"] for r in neardup.classes(df, exhaustive=True).collect()} == want


@pytest.mark.parametrize("size, pairs, seed", [(100, 40, 2), (600, 120, 3), (2000, 200, 4)])
def test_recall_in_families_of_template_texts(docs, monkeypatch, size, pairs, seed):
    """Without the exhaustive search: links of 0.8 or more that were found, and pairs that were verified for it."""
    rows = family(seed, size, pairs, changed=9)
    df = docs(*rows)
    counts = neardup.sketch(df)
    tested = []
    verify = neardup.verified

    def counted(edges, *rest):
        tested.append(edges.count())
        return verify(edges, *rest)

    monkeypatch.setattr(neardup, "verified", counted)
    found = {r["doc_id"]: r["class_id"] for r in neardup.classes(df).collect()}
    sets = {i: neardup.shingles(t) for i, t in rows}
    first = 1000 * seed
    planted = [(first + i, first + size + i) for i in range(pairs)]
    linked = [p for p in planted if neardup.similarity(sets[p[0]], sets[p[1]], counts) >= neardup.SIMILARITY]
    caught = sum(found[a] == found[b] for a, b in linked)
    print(f"family of {size}: {caught} of {len(linked)} links, {sum(tested)} pairs verified")
    assert len(linked) > pairs / 2 and caught >= 0.95 * len(linked)
    assert sum(tested) <= 25 * len(rows)


@pytest.mark.parametrize("bucket", [neardup.BUCKET_ROWS, 10])
def test_no_plausible_pair_of_a_bucket_is_left_out(spark, monkeypatch, bucket):
    monkeypatch.setattr(neardup, "BUCKET_ROWS", bucket)
    sigs = np.zeros((100, neardup.HASHES), dtype=np.uint8)
    for i in range(1, 100):  # 30 samples agree with the centre, those of each two neighbours 40
        sigs[i, (i // 2 + np.arange(18)) % neardup.HASHES] = 1 + i // 2
        sigs[i, (i // 2 + np.arange(8)) % neardup.HASHES] += 100 * (i % 2)
    nodes = [(bytes([i]), [7], s.tobytes()) for i, s in enumerate(sigs)]
    found, left = neardup.candidate_edges(spark.createDataFrame(nodes, "node binary, bands array<long>, sig binary"))
    edges = {(r["a"][0], r["b"][0]) for r in found.collect()}
    if [r["key"] for r in left.collect()] == [7]:
        members = spark.createDataFrame([(7, n, s, n) for n, _, s in nodes], "key long, node binary, sig binary, class binary")
        edges |= {(r["a"][0], r["b"][0]) for r in neardup.edges_across(members, 1000).collect()}
    agree = (sigs[:, None] == sigs[None]).sum(axis=2)
    assert {(i, j) for i, j in combinations(range(100), 2) if agree[i, j] >= neardup.PLAUSIBLE} <= edges
    assert len([1 for i in range(2, 99, 2) if agree[i, i + 1] == 40]) == 49


def test_signatures_estimate_similarity(docs):
    rows = corpus()
    counts = neardup.sketch(docs(*rows))
    sets = [neardup.shingles(t) for _, t in rows]
    _, samples = neardup.signatures(sets, counts)
    pairs = [(i, j) for i, j in combinations(range(len(sets)), 2) if i // 5 == j // 5 and j < 125]
    true = np.array([neardup.similarity(sets[i], sets[j], counts) for i, j in pairs])
    seen = np.array([(samples[i] == samples[j]).mean() for i, j in pairs])
    assert abs((seen - true).mean()) < 0.02 and np.abs(seen - true).max() < 0.3
    alone, together = neardup.signatures(sets[7:8], counts), neardup.signatures(sets[3:20], counts)
    assert (alone[0][0] == together[0][4]).all() and (alone[1][0] == together[1][4]).all()


def test_sketch_counts_documents(docs):
    rows = corpus()
    counts = neardup.sketch(docs(*rows, (1, None), (2, "")))
    table, n = neardup._tables(counts)
    assert n == len(rows)
    df = {}
    for _, t in rows:
        for x in neardup.shingles(t)[0].tolist():
            df[x] = df.get(x, 0) + 1
    u = np.array(sorted(df), dtype=np.uint64)
    got = np.min([table[row][cells] for row, cells in enumerate(neardup._cells(u))], axis=0)
    true = np.array([df[x] for x in u.tolist()])
    assert (got >= true).all() and (got - true).mean() < 0.05


def test_awkward_rows(docs):
    found = neardup.classes(docs(*AWKWARD)).collect()
    assert len(found) == len(AWKWARD)
    by_id = {}
    for r in found:
        by_id.setdefault(r["doc_id"], set()).add(r["class_id"])
    assert by_id[4] == {4} and by_id[5] == {4} and by_id[6] == {6} and by_id[9] == {9}
    # Null and empty texts are copies of one empty text; white space alone is another text.
    assert by_id[1] == {1} and by_id[2] == {1} and by_id[3] == {3} and by_id[None] == {1, None}
    kept = neardup.one_of_each(docs(*AWKWARD, extra="1 AS node"))
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["None", "1", "3", "4", "6", "7", "8", "9"])
    assert neardup.classes(docs()).collect() == [] and neardup.one_of_each(docs()).collect() == []


def test_components(spark):
    chain = [(bytes([i]), bytes([i + 1])) for i in range(10, 60)] + [(b"\x01", b"\x02"), (b"\x01", b"\x03")]
    random.Random(1).shuffle(chain)
    found = {bytes(r["node"]): bytes(r["class"]) for r in neardup.components(spark.createDataFrame(chain, "a binary, b binary")).collect()}
    assert set(found.values()) == {b"\x0a", b"\x01"} and len(found) == 54 and found[b"\x3c"] == b"\x0a"


@pytest.mark.parametrize("stage", [False, True])
def test_the_queries_test_every_plausible_pair(spark, docs, monkeypatch, stage):
    """Parts of ten members and finer bands that name nobody: what the caps leave out is found by going through all."""
    monkeypatch.setattr(neardup, "BUCKET_ROWS", 10)
    monkeypatch.setattr(neardup, "LONG_LEAST", neardup.LONG_HASHES + 1)
    rows = family(1, 100, 30)
    df = docs(*rows)
    want = by_hand(rows, neardup.sketch(df))
    kept = corpus_pipeline.near_dedup(spark, df, "") if stage else neardup.one_of_each(df, exhaustive=True)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))
    if not stage:
        monkeypatch.setattr(queries, "read", lambda *_: df)
        assert {r["doc_id"]: r["class_id"] for r in queries.op1_weighted_minhash(spark, "").collect()} == want


def test_across_names_every_pair_once_unless_there_are_more(spark):
    sigs = np.zeros((40, neardup.HASHES), dtype=np.uint8)
    members = [(7, bytes([i]), s.tobytes(), bytes([i % 20])) for i, s in enumerate(sigs)]
    df = spark.createDataFrame(members, "key long, node binary, sig binary, class binary")
    pairs = [(i, j) for i, j in combinations(range(40), 2) if i % 20 != j % 20]
    every = [(r["a"][0], r["b"][0]) for r in neardup.edges_across(df, 100).collect()]
    assert sorted(every) == pairs
    some = [r["a"] for r in neardup.edges_across(df, 2).collect()]
    assert None in some and 40 <= len(some) <= 81


def test_only_classes_are_joined(spark, monkeypatch):
    joined = []
    components = neardup.components
    monkeypatch.setattr(neardup, "components", lambda edges: joined.append(edges.count()) or components(edges))
    node = lambda i: bytes([i])
    frame = lambda pairs, names: spark.createDataFrame([(node(a), node(b)) for a, b in pairs], f"{names[0]} binary, {names[1]} binary")
    labels = frame([(i, 1 if i < 50 else 50) for i in range(1, 60)], ("node", "class"))
    links = frame([(i, i + 1) for i in range(1, 49)] + [(i, 59) for i in range(2, 40)] + [(0, 58), (70, 71)], "ab")
    found = {r["node"][0]: r["class"][0] for r in neardup.relabelled(labels, links).collect()}
    assert found == {**{i: 0 for i in range(60)}, 70: 70, 71: 70} and joined == [3]


def test_the_default_leaves_no_cap_without_an_exact_way(docs, monkeypatch):
    """Without any option, where parts of ten members and finer bands name nobody."""
    monkeypatch.setattr(neardup, "BUCKET_ROWS", 10)
    monkeypatch.setattr(neardup, "LONG_LEAST", neardup.LONG_HASHES + 1)
    rows = family(1, 100, 30)
    df = docs(*rows)
    want = by_hand(rows, neardup.sketch(df))
    assert {r["doc_id"]: r["class_id"] for r in neardup.classes(df).collect()} == want
    assert sorted(r["doc_id"] for r in neardup.one_of_each(df).collect()) == sorted(set(want.values()))


@pytest.mark.parametrize("block_bytes", [neardup.BLOCK_BYTES, 20_000])
def test_pairs_of_a_bucket_are_verified_where_they_meet(spark, docs, monkeypatch, block_bytes):
    """Rows that leave the tasks are links between classes, fewer than members, whatever the number of pairs."""
    monkeypatch.setattr(neardup, "BLOCK_BYTES", block_bytes)  # 20,000: blocks of about ten texts
    rows = family(1, 60, 30, changed=9) + [(5000 + i, edited(prose(9, 200), 1 + i % 2, i)) for i in range(40)]
    counts = neardup.sketch(docs(*rows))
    sets = [neardup.shingles(t) for _, t in rows]
    bands, samples = neardup.signatures(sets, counts)
    node = lambda i: i.to_bytes(2, "big")
    members = [(int(k), at, node(i), s.tobytes(), [int(b) for b in bs], node(i), rows[i][1])
               for i, (bs, s) in enumerate(zip(bands, samples)) for at, k in enumerate(bs)]
    df = spark.createDataFrame(members, "key long, band int, node binary, sig binary, bands array<long>, class binary, text string")
    links = [(r["a"], r["b"]) for r in neardup.links_across(df, counts, neardup.SIMILARITY).collect()]
    pairs = [(i, j) for i, j in combinations(range(len(rows)), 2) if set(bands[i].tolist()) & set(bands[j].tolist())]
    plausible = [p for p in pairs if (samples[p[0]] == samples[p[1]]).sum() >= neardup.PLAUSIBLE]
    good = [(node(i), node(j)) for i, j in plausible if neardup.similarity(sets[i], sets[j], counts) >= neardup.SIMILARITY]
    assert set(links) <= set(good) and len(links) < len(plausible) / 4
    joined = {(r["node"], r["class"]) for r in neardup.components(spark.createDataFrame(links, "a binary, b binary")).collect()}
    assert joined == {(r["node"], r["class"]) for r in neardup.components(spark.createDataFrame(good, "a binary, b binary")).collect()}


def test_the_texts_are_looked_up_once(docs, monkeypatch):
    labels = []
    stored = neardup.stored
    monkeypatch.setattr(neardup, "stored", lambda df, label: labels.append(label) or stored(df, label))
    monkeypatch.setattr(neardup, "BUCKET_ROWS", 10)
    neardup.classes(docs(*family(1, 100, 30)), exhaustive=True).collect()
    assert labels.count("texts") == 1 and "across" not in labels
