"""Decision lists: statistics against plain Python, learning on labelled rows, awkward inputs."""

import random
import re

from llm.conftest import AWKWARD, prose
from pyspark.sql import functions as F

from lakemart.llm import quality


def by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = {}
    for w in windows:
        counts[w] = counts.get(w, 0) + 1
    covered = {j for i, w in enumerate(windows) if counts[w] > 1 for j in range(i, i + 8)}
    n = len(words)
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
        n < 20 or 100 * len(covered) > 30 * n,
    )


def test_statistics(docs):
    random_ = random.Random(3)
    rows = [*AWKWARD, (50, "a\nb\na\n\n \na"), (51, "# * $ ünï 😀 x"), (52, " ".join("abcdefgh" * 2))]
    rows += [(100 + i, " ".join(random_.choice("ab") for _ in range(random_.randint(0, 40)))) for i in range(60)]
    found = quality.with_statistics(docs(*rows)).select("text", *quality.BASE).collect()
    for row in found:
        assert tuple(row)[1:] == by_hand(row["text"]), row["text"]


def junk(i):
    return prose(i, 60).replace(".", " | |")


def labelled(spark, bad, good):
    return spark.createDataFrame([(i, 0, 0) for i in bad] + [(i, 1, 0) for i in good], "doc_id long, quality int, toxic int")


def test_learned_rules_reject_unseen_junk_and_keep_the_rest(spark, docs):
    rows = [(i, prose(i, 60)) for i in range(200)] + [(1000 + i, junk(i)) for i in range(80)]
    labels = labelled(spark, range(1000, 1060), range(150))
    found = {r["doc_id"]: r for r in quality.rate(docs(*rows), labels).collect()}
    assert all(found[i]["kept"] for i in range(200))
    assert not any(found[i]["kept"] or found[i]["base_failed"] for i in range(1060, 1080))
    assert found[1060]["rule"] == 1
    kept = quality.keep_good(docs(*rows, extra="7 AS kept"), labels)
    assert kept.columns[-1] == "kept" and {r["doc_id"] for r in kept.collect()} == set(range(200))


def test_labels_without_a_pattern_give_no_rule(spark, docs):
    rows = [(i, prose(i, 60)) for i in range(120)]
    found = quality.rate(docs(*rows), labelled(spark, range(0, 120, 2), range(1, 120, 2)))
    assert found.where("NOT kept").count() == 0


def test_without_labels_the_base_decides(spark, docs):
    for labels in (labelled(spark, [], []), labelled(spark, [], [4]), labelled(spark, [4], [])):
        found = quality.rate(docs(*AWKWARD, extra="1 AS n_words"), labels)
        assert found.where("kept = base_failed").count() == 0 and found.count() == len(AWKWARD)
        assert quality.rate(docs(), labels).collect() == []
        assert quality.keep_good(docs(), labels).collect() == []


def test_main_path_runs_no_python(spark, docs):
    labels = labelled(spark, range(1000, 1060), range(150))
    rows = [(i, prose(i, 60)) for i in range(20)]
    for df in (quality.rate(docs(*rows), labels), quality.keep_good(docs(*rows), labels)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_repeated_words_of_a_long_text(docs):
    text = " ".join(["one two three"] * 20_000)
    assert quality.with_statistics(docs((1, text))).select(F.col("n_repeat_words")).first()[0] == 60_000
