"""Mixing: targets, passes, positions and awkward inputs."""

import pytest
from llm.conftest import AWKWARD, prose

from lakemart.llm import mixing


def water(sizes, weights, total, cap):
    """Targets by hand: share out, cut at the cap, share the excess again."""
    target, open_ = {s: 0.0 for s in sizes}, set(sizes)
    while open_:
        left = total - sum(target[s] for s in sizes if s not in open_)
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > cap * sizes[s]}
        target.update({s: cap * sizes[s] if s in over else share[s] for s in open_})
        if not over:
            return target
        open_ -= over
    return target


def corpus(docs, n=300, **kw):
    """A third of all rows in one source; one source without a name, one with a single short document."""
    rows = [(i, prose(i, 5 + i % 37), "hot" if i % 3 == 0 else [None, "b", "c", "d", "é"][i % 5]) for i in range(n)]
    return docs(*rows, (n, "one two", "tiny"), **kw)


def test_targets_and_taken(docs, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    df = corpus(docs, extra="1 AS size")
    found = mixing.mix(df).collect()
    source = {r["doc_id"]: r["source"] for r in df.collect()}
    sizes = {}
    for r in found:
        sizes[source[r["doc_id"]]] = sizes.get(source[r["doc_id"]], 0) + r["size"]
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = water(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}, 1.5 * sum(sizes.values()), 2)
    for s in names:
        mine = [r for r in found if source[r["doc_id"]] == s]
        assert mine[0]["target"] == pytest.approx(want[s]) and mine[0]["source_size"] == sizes[s]
        assert sum(r["taken"] for r in mine) == pytest.approx(want[s], abs=1)
        assert all(r["taken"] <= 2 * r["size"] for r in mine)
    order = [r["passes"][0]["position"] for r in found if r["passes"]]
    assert order == sorted(order) and 0 <= order[0] and order[-1] < 1
    assert sorted(map(str, found)) == sorted(map(str, mixing.mix(df.repartition(5)).collect()))


def test_position_inverts_the_integral(spark):
    from pyspark.sql import functions as F

    for start, end in mixing.SCHEDULE:
        df = spark.range(11).select((F.col("id") / 10).alias("x"))
        df = df.withColumn("t", mixing.position(F.col("x"), F.lit(start), F.lit(end)))
        for r in df.collect():
            first, slope = start / ((start + end) / 2), (end - start) / ((start + end) / 2)
            assert first * r["t"] + slope * r["t"] ** 2 / 2 == pytest.approx(r["x"])


def test_texts_follow_the_mix(docs):
    df = corpus(docs, extra="1 AS words")
    out = mixing.mixed_texts(df)
    assert out.columns == df.columns
    words = {}
    for r in out.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(r["text"].split())
    assert words == {r["doc_id"]: r["taken"] for r in mixing.mix(df).collect() if r["taken"]}


def test_awkward_rows(docs):
    rows = [(*r, s) for r in AWKWARD for s in (None, "a")]
    found = mixing.mix(docs(*rows)).collect()
    assert len(found) == len(rows)
    assert all(r["taken"] == 0 and not r["passes"] for r in found if r["size"] == 0)
    total = sum(r["size"] for r in found)
    # Two sources of one size, of weight 3 and 1: the first is full, the second takes the rest.
    assert sum(r["taken"] for r in found) == pytest.approx(1.5 * total, abs=2)
    texts = mixing.mixed_texts(docs(*rows))
    assert sum(len(r["text"].split()) for r in texts.collect()) == pytest.approx(1.5 * total, abs=2)
    assert mixing.mix(docs()).collect() == [] and mixing.mixed_texts(docs()).collect() == []
    assert {r["taken"] for r in mixing.mix(docs((1, None), (2, ""))).collect()} == {0}


def test_plans_run_no_python(docs):
    for df in (mixing.mix(corpus(docs, 30)), mixing.mixed_texts(corpus(docs, 30))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_ranges_of_buckets_add_up(docs, monkeypatch):
    """Positions do not depend on how many rows a bucket and how many buckets a range has."""
    df = docs(*[(i, prose(i, 5 + i % 40), "ab"[i % 10 == 0]) for i in range(300)])
    want = sorted(map(str, mixing.mix(df).collect()))
    monkeypatch.setattr(mixing, "RANGE_BUCKETS", 3)
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 4)
    assert sorted(map(str, mixing.mix(df).collect())) == want
