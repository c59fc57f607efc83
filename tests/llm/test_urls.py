"""URL rules and the cascade."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemart.llm import urls

RULES = (urls.Rule("allow", "org", "/"), urls.Rule("block", "a.org", "/x"), urls.Rule("allow", "a.org", "/xy/"))
LISTED = ["bad.com/", "badly.com/", "bad.com/", None, "in.no.page/", "a.org/x", "good.de/", "É.com/nothing"]


def judged(spark, pages, listed=LISTED):
    listed = spark.createDataFrame([(k,) for k in listed], "key string")
    df = spark.createDataFrame(pages, "page_id long, url string, verdict string")
    return sorted((tuple(r) for r in urls.judge(df, RULES, listed).collect()), key=str)


PAGES = [
    (1, "http://B.A.org/xy/z?q#f", None), (2, "https://a.org/x#y", "no"), (3, "x://aa.org/x", None), (4, "http://org", None),
    (5, None, None), (6, "no scheme", None), (7, "http://bad.com/p", None), (8, "http://www.bad.com?x", None),
    (8, "http://www.bad.com?x", None), (9, "http://good.bad.de/bad.com/", None), (None, "http://badly.com", None),
    (10, "http://É.com/\n/x", None), (11, "://", None),
]
WANT = [
    (1, "b.a.org", "/xy/z", "a.org/xy/", "allow"), (2, "a.org", "/x", "a.org/x", "block"),
    (3, "aa.org", "/x", "org/", "allow"), (4, "org", "", None, "allow"), (5, "", "", None, "allow"),
    (6, "", "", None, "allow"), (7, "bad.com", "/p", None, "block"), (8, "www.bad.com", "", None, "block"),
    (8, "www.bad.com", "", None, "block"), (9, "good.bad.de", "/bad.com/", None, "allow"),
    (None, "badly.com", "", None, "block"), (10, "É.com", "/\n/x", None, "allow"), (11, "", "", None, "allow"),
]


@pytest.mark.parametrize("limit", [urls.MAX_BYTES, 3])
def test_judge(spark, monkeypatch, limit):
    monkeypatch.setattr(urls, "MAX_BYTES", limit)  # 3: in slices
    assert judged(spark, PAGES) == sorted(WANT, key=str)
    assert judged(spark, []) == [] and judged(spark, [], []) == []
    assert {r[4] for r in judged(spark, PAGES[6:8], [])} == {"allow"}
    assert {r[4] for r in judged(spark, PAGES[6:8], ["bad.com/p", "www.bad.com"])} == {"block"}
    long = [(1, "http://x.com/" + "y" * 100_000, None), (2, "http://x.com/" + "y" * 99_999, None)]
    assert [r[4] for r in judged(spark, long, ["x.com/" + "y" * 100_000])] == ["block", "allow"]


def test_slices_judge_alike(spark, monkeypatch):
    """Many slices, each with a cascade of its own, against plain membership; the list is not told by spelling."""
    random = np.random.default_rng(4)
    hosts = [f"h{i}.example{i % 7}.net" for i in range(400)]
    pages = [(i, f"http://{hosts[random.integers(400)]}/p{random.integers(5)}", None) for i in range(3000)]
    listed = [f"{h}/" for h in random.choice(hosts, 60, replace=False)] + [f"{h}/p3" for h in random.choice(hosts, 90)] + ["example3.net/"]
    known = set(listed)

    def blocked(url):
        rest = url.split("://")[1]
        host = rest.split("/")[0]
        return rest in known or f"{host}/" in known or f"{host.split('.', 1)[1]}/" in known

    want = {i: "block" if blocked(u) else "allow" for i, u, _ in pages}
    built = []
    cascade = urls.cascade
    monkeypatch.setattr(urls, "cascade", lambda keys: built.append(cascade(keys)) or built[-1])
    for limit in (urls.MAX_BYTES, 100):
        monkeypatch.setattr(urls, "MAX_BYTES", limit)
        built.clear()
        assert {r[0]: r[4] for r in judged(spark, pages, listed)} == want
        assert (len(built) > 1) == (limit == 100) and all(len(levels) > 1 for levels in built)


def test_the_cascade_decides(spark, monkeypatch):
    """Without its second level the cascade would block pages that are not listed."""
    pages = [(i, f"http://h{i}.net/", None) for i in range(2000)]
    listed = [f"h{i}.net/" for i in range(0, 2000, 9)]
    right = judged(spark, pages, listed)
    cascade = urls.cascade
    monkeypatch.setattr(urls, "cascade", lambda keys: cascade(keys)[:1])
    assert sum(r[4] == "block" for r in right) == len(listed) < sum(r[4] == "block" for r in judged(spark, pages, listed))


@pytest.mark.parametrize("share, sent", [(0.0, 1 << 24), (0.01, 1 << 24), (0.5, 1 << 24), (0.5, 0), (1.0, 0)])
def test_cascade_makes_no_mistake(spark, monkeypatch, share, sent):
    monkeypatch.setattr(urls, "SENT_BYTES", sent)  # 0: bitmaps meet on executors
    keys = spark.range(20_000).select((F.rand(1) < share).alias("listed"), urls.key_hashes(F.col("id").cast("string")).alias("h"))
    keys = keys.select("h.a", "h.b", "listed").cache()
    levels = urls.cascade(keys)
    rows = keys.toPandas()
    assert (urls.contains(levels, rows.a.to_numpy(), rows.b.to_numpy()) == rows.listed.to_numpy()).all()
    assert share in (0.0, 1.0) or len(levels) > 1
    n = int(rows.listed.sum())
    assert sum(len(level.content) for level in levels) <= 2 * urls.expected_bytes(n, len(rows) - n) + 64 * len(levels)


def test_levels_know_their_keys():
    random = np.random.default_rng(1)
    a, b = random.integers(-(2**63), 2**63 - 1, (2, 1000))
    table = next(iter(urls._partial_bits(*urls.shape(1000, 0.5, 0), [_Batch(a, b)])))
    level = urls.Level(*urls.shape(1000, 0.5, 0), table.column(1)[0].as_py())
    assert level.contains(a, b).all()


class _Batch:
    def __init__(self, *columns):
        import pyarrow as pa

        self.columns = [pa.array(c) for c in columns]

    def column(self, i):
        return self.columns[i]
