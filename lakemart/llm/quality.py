"""Quality rules as learned decision lists, in DataFrame operations only.

Base statistics and shares are native expressions over the whole text. Sequential covering then learns rules that
reject: a rule is a conjunction of thresholds, grown one condition at a time by information gain on two thirds of
the labelled rows and pruned on the rest. Every step is one aggregate over all labelled rows that returns counts
per feature and bin, at most `len(FEATURES) * (BINS + 1)` rows; no labelled row is collected. The list becomes one
conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import SPACE, bind, fresh, stored

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
FEATURES = (
    "n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "stop_share",
    "digit_share", "distinct_share",
)
BINS = 24
MAX_RULES = 8
MAX_CONDITIONS = 3
# A rule must reject this share of bad rows at least, on rows it was not grown on.
MIN_PRECISION = 0.98
MIN_SUPPORT = 3


def repeated_window_words(hashes: Column) -> Column:
    """Words inside a window of `WINDOW` words that occurs twice or more. `hashes`: one 64-bit hash for each word.

    Windows are compared by a 64-bit hash of their word hashes. Texts without a repeated window, nearly all, stop
    after one distinct count. For the others (window, place) pairs are sorted, so that equal windows are
    neighbours, and the places found are swept once: n log n, also for a long text of one repeated line.
    """

    def marked(windows: Column) -> Column:
        pairs = F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))

        def places(s: Column) -> Column:
            def same(a: Column, b: Column) -> Column:
                return F.coalesce(F.get(s, a)["w"] == F.get(s, b)["w"], F.lit(False))

            found = F.filter(s, lambda _, i: same(i, i - 1) | same(i, i + 1))
            return F.sort_array(F.transform(found, lambda p: p["i"]))

        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))

        def sweep(acc: Column, i: Column) -> Column:
            more = F.least(F.lit(WINDOW), i - acc["last"])
            return F.struct((acc["n"] + more).cast("long").alias("n"), i.alias("last"))

        return F.aggregate(bind(pairs, places), start, sweep, lambda acc: acc["n"])

    def count(h: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(1), F.size(h) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(h, i, WINDOW)))
        repeated = bind(
            windows, lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), marked(w)).otherwise(F.lit(0).cast("long"))
        )
        return F.when(F.size(h) >= WINDOW, repeated).otherwise(F.lit(0).cast("long"))

    return bind(hashes, count)


def statistics(text: Column) -> Column:
    """A struct of the base statistics and the features of a whole text. Null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))

    def counted(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.concat_ws("", w)).cast("long").alias("word_chars"),
            F.size(F.array_distinct(w)).alias("n_distinct"),
            repeated_window_words(F.transform(w, lambda x: F.xxhash64(x))).alias("n_repeat_words"),
        )

    def dup_lines(found: Column) -> Column:
        duplicates = F.size(found) - F.size(F.array_distinct(found))
        return F.struct(F.size(found).alias("n_lines"), duplicates.cast("long").alias("n_dup_lines"))

    def times(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)).cast("long")

    counts, per_line = bind(words, counted), bind(lines, dup_lines)
    return F.struct(
        counts.alias("words"), per_line.alias("lines"), times("[#*$%&|<>]").alias("n_symbols"),
        times("\\p{Lu}").alias("n_upper"), times("[.!?]").alias("n_stops"), times("[0-9]").alias("n_digits"),
    )


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and the `FEATURES` columns.

    The columns must not exist in `docs`; `rate` picks free names itself.
    """
    found = fresh(docs.columns, "found")[0]
    s = F.col(found)
    n, chars = s["words"]["n_words"], s["words"]["word_chars"]
    per = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    columns = {
        "n_words": n, "word_chars": chars, "n_symbols": s["n_symbols"], "n_dup_lines": s["lines"]["n_dup_lines"],
        "n_repeat_words": s["words"]["n_repeat_words"],
        "base_failed": (n < MIN_WORDS) | (100 * s["words"]["n_repeat_words"] > MAX_REPEAT_PERCENT * n),
        "mean_word": per(chars, n), "symbol_share": per(s["n_symbols"], n),
        "dup_line_share": per(s["lines"]["n_dup_lines"], s["lines"]["n_lines"]),
        "repeat_share": per(s["words"]["n_repeat_words"], n), "upper_share": per(s["n_upper"], chars),
        "stop_share": per(s["n_stops"], n), "digit_share": per(s["n_digits"], chars),
        "distinct_share": per(s["words"]["n_distinct"], n),
    }
    return docs.withColumn(found, statistics(F.col(text))).withColumns(columns).drop(found)


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def column(self) -> Column:
        return F.col(self.feature) > self.cut if self.above else F.col(self.feature) <= self.cut


@dataclass(frozen=True)
class Rule:
    """Reject when all conditions hold. `bad` and `good` are the rows it met in the pruning set."""

    conditions: tuple[Condition, ...]
    bad: int
    good: int

    def column(self) -> Column:
        return _all(self.conditions)


@dataclass(frozen=True)
class DecisionList:
    rules: tuple[Rule, ...] = ()

    def number(self) -> Column:
        """The number, from 1, of the first rule that fits; 0 if none does."""
        out = F.when(F.lit(False), F.lit(0))
        for i, rule in enumerate(self.rules, 1):
            out = out.when(rule.column(), F.lit(i))
        return out.otherwise(F.lit(0))

    def keeps(self) -> Column:
        return self.number() == 0


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c.column()
    return out


def fit(labelled: DataFrame, label: str = "bad", key: str = "key") -> DecisionList:
    """Learn a list from rows with the `FEATURES` columns, a boolean `label` and a `key` that splits the folds.

    Rows with a null label are left out. Without rows of both classes the list is empty and rejects nothing.
    """
    rows = labelled.where(F.col(label).isNotNull()).select(
        *FEATURES, F.col(label).alias("bad"), (F.pmod(F.xxhash64(key), F.lit(3)) == 0).alias("held")
    )
    rows = stored(rows, "labelled")
    steps = [i / BINS for i in range(1, BINS)]
    # Half of the cuts follow the bad rows: they are few, and are what rules must find.
    by_class = [rows.where(c).approxQuantile(list(FEATURES), steps, 0.001) for c in ("bad", "not bad")]
    cuts = {f: sorted({*by_class[0][i], *by_class[1][i]}) for i, f in enumerate(FEATURES)}
    if not all(by_class[0]) or not all(by_class[1]):
        return DecisionList()
    bins = [_bin(F.col(f), cuts[f]).alias(f"bin_{f}") for f in FEATURES]
    rows = stored(rows.select("*", *bins), "binned")
    covered, rules = F.lit(False), []
    while len(rules) < MAX_RULES:
        rule = _prune(rows.where(F.col("held") & ~covered), _grow(rows.where(~F.col("held") & ~covered), cuts))
        if rule is None:
            break
        rules.append(rule)
        covered = covered | rule.column()
    return DecisionList(tuple(rules))


def _bin(value: Column, cuts: list[float]) -> Column:
    """How many of the cuts lie below the value."""
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: value > cut))


def _grow(rows: DataFrame, cuts: dict[str, list[float]]) -> tuple[Condition, ...]:
    found: tuple[Condition, ...] = ()
    while len(found) < MAX_CONDITIONS:
        at = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"bin_{f}").alias("bin")) for f in FEATURES]))
        counts = rows.where(_all(found)).select("bad", at.alias("at")).groupBy("at.feature", "at.bin").agg(
            F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good")
        )
        table: dict[str, dict[int, tuple[int, int]]] = {f: {} for f in FEATURES}
        for r in counts.collect():  # features * bins rows at most
            table[r["feature"]][r["bin"]] = (r["bad"], r["good"])
        bad, good = (sum(v[i] for v in table[FEATURES[0]].values()) for i in (0, 1))
        if not bad or not good:
            break
        best, best_gain = None, 1e-9
        for f in FEATURES:
            low_bad = low_good = 0
            for i, cut in enumerate(cuts[f]):
                more = table[f].get(i, (0, 0))
                low_bad, low_good = low_bad + more[0], low_good + more[1]
                for above, p, n in ((False, low_bad, low_good), (True, bad - low_bad, good - low_good)):
                    if p:
                        gain = p * (math.log2(p / (p + n)) - math.log2(bad / (bad + good)))
                        if gain > best_gain:
                            best, best_gain = Condition(f, above, cut), gain
        if best is None or best in found:
            break
        found = (*found, best)
    return found


def _prune(rows: DataFrame, conditions: tuple[Condition, ...]) -> Rule | None:
    """The prefix of the conditions that does best on rows they were not grown on, if it does well enough."""
    if not conditions:
        return None
    counts = []
    for k in range(1, len(conditions) + 1):
        fits = _all(conditions[:k])
        counts += [F.count_if(fits & F.col("bad")).alias(f"p{k}"), F.count_if(fits & ~F.col("bad")).alias(f"n{k}")]
    row = rows.agg(*counts).first()
    options = [(row[f"p{k}"], row[f"n{k}"], k) for k in range(1, len(conditions) + 1)]
    p, n, k = max(options, key=lambda o: ((o[0] - o[1]) / max(1, o[0] + o[1]), o[0], -o[2]))
    if p < MIN_SUPPORT or p < MIN_PRECISION * (p + n):
        return None
    return Rule(conditions[:k], p, n)


def labelled_rows(stats: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Statistics of the labelled documents with `bad` (quality 0) and `key`. Null ids or labels match nothing."""
    known = labels.select(F.col("doc_id").alias("key"), (F.col("quality") == 0).alias("bad"))
    return stats.join(known, stats[doc_id] == known["key"])


def rate(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: doc_id, the base statistics, base_failed, kept, rule.

    `kept` is false if the base rules fail or a learned rule fits (its number is in `rule`, else 0). Null and empty
    texts have no words and fail the base. Repeated rows are rated alike. Without labels of both classes only the
    base decides. Other columns are ignored; an empty table gives an empty result.
    """
    stats = stored(with_statistics(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))).drop("text"), "statistics")
    rules = fit(labelled_rows(stats, labels))
    kept = ~F.col("base_failed") & rules.keeps()
    return stats.select("doc_id", *BASE, kept.alias("kept"), rules.number().alias("rule"))


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that `rate` keeps, with their columns. The rules are learned from the labelled rows first."""
    at, rows = fresh(docs.columns, "stats")[0], docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    known = labels.select(F.col("doc_id").alias("key"), (F.col("quality") == 0).alias("bad"))
    rules = fit(with_statistics(rows.join(known, rows["doc_id"] == known["key"])))
    inner = F.struct(*[F.col(c) for c in ("base_failed", *FEATURES)])
    stats = with_statistics(docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(text).alias("text")))
    stats = stats.select("row", inner.alias(at)).select("row", f"{at}.*").where(~F.col("base_failed") & rules.keeps())
    return stats.select(*[F.col("row")[c].alias(c) for c in docs.columns])
