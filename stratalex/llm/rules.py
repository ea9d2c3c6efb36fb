"""Quality rules: a learned decision list over text statistics, in DataFrame functions only.

Statistics of every whole text are built-in expressions. From labelled statistics, sequential covering grows one
conjunction of thresholds at a time for the rejected class (the condition of greatest information gain is added
until no kept row is covered), prunes it on rows set aside, and removes what it covers; a rule that is not precise
enough on rows set aside ends the list. The list becomes one ordered conditional expression, run by Spark.

Defined cases: a null text has no words and fails the base rules; so does an empty one; no usable label gives an empty
list, which keeps all that the base rules keep; null labels and null ids are not learned from; equal rows give equal
rows; very long texts are read whole; other columns are left aside.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import cut, pick

SPACES = r"[\x20\x09-\x0D]+"
NO_SPACE = r"[^\x20\x09-\x0D]"
#: Labelled rows learned from at most, those least by a hash of doc_id.
SAMPLE = 20_000
FEATURES = ("n_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share", "mark_share", "distinct_share")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(w: Column, n: Column) -> Column:
    """Words inside three-word windows that occur twice or more. Equal windows meet by sorting their hashes."""
    hashes = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        repeated = let(ordered, lambda o: F.transform(F.filter(o, lambda x, k: (x["h"] == F.get(o, k - 1)["h"]) | (x["h"] == F.get(o, k + 1)["h"])), lambda x: x["i"]))
        new = let(F.sort_array(repeated), lambda at: F.transform(at, lambda i, k: F.when(k == 0, F.lit(3)).otherwise(F.least(F.lit(3), i - F.get(at, k - 1)))))
        return F.aggregate(new, F.lit(0), lambda a, x: a + x)

    return F.when(n < 3, F.lit(0)).otherwise(let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))))


def statistics(df: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: dict[str, str] | None = None) -> DataFrame:
    """doc_id, the base statistics (long), base_failed and FEATURES (double)."""
    taken = pick(df, doc_id=doc_id, text=text, **(keep or {}))
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))

    def count(pattern: str) -> Column:
        return F.char_length(F.regexp_replace(body, pattern, "")).cast("long")

    by_word = let(
        F.array_remove(F.split(body, SPACES), ""),
        lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"), _repeat_words(w, F.size(w)).cast("long").alias("n_repeat_words"), F.size(F.array_distinct(w)).alias("n_distinct")),
    )
    lines = let(F.filter(F.split(body, "\n"), lambda line: line.rlike(NO_SPACE)), lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    first = taken.select("doc_id", *(keep or {}), by_word.alias("w"), lines.alias("l"), count(r"[^#*$%&|<>]+").alias("n_symbols"), count(r"[^\p{Lu}]+").alias("n_upper"), count(r"[^0-9]+").alias("n_digits"), count(r"[^!?]+").alias("n_marks"))
    words, chars = F.greatest(F.col("w.n_words"), F.lit(1)), F.greatest(F.col("w.word_chars"), F.lit(1))
    features = (F.col("w.n_words"), F.col("w.word_chars") / words, F.col("n_symbols") / chars, F.col("l.n_dup_lines") / F.greatest(F.col("l.n_lines"), F.lit(1)), F.col("w.n_repeat_words") / words, F.col("n_upper") / chars, F.col("n_digits") / chars, F.col("n_marks") / chars, F.col("w.n_distinct") / words)
    failed = (F.col("w.n_words") < 50) | (100 * F.col("w.n_repeat_words") > 50 * F.col("w.n_words"))
    base = ("w.n_words", "w.word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words")
    return first.select("doc_id", *(keep or {}), *base, failed.alias("base_failed"), F.struct(*[f.cast("double").alias(n) for n, f in zip(FEATURES, features, strict=True)]).alias("features"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, rows: np.ndarray) -> np.ndarray:
        column = rows[:, FEATURES.index(self.feature)]
        return column > self.threshold if self.above else column <= self.threshold

    def column(self) -> Column:
        value = F.col("features")[self.feature]
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, rows: np.ndarray) -> np.ndarray:
    out = np.ones(len(rows), dtype=bool)
    for condition in rule:
        out &= condition.holds(rows)
    return out


@dataclass(frozen=True)
class DecisionList:
    """Rules that reject, in order; what none covers is kept."""

    rules: list[Rule] = field(default_factory=list)

    def keeps(self) -> Column:
        out = None
        for rule in self.rules:
            condition = rule[0].column()
            for more in rule[1:]:
                condition = condition & more.column()
            out = F.when(condition, F.lit(False)) if out is None else out.when(condition, F.lit(False))
        return F.lit(True) if out is None else out.otherwise(F.lit(True))

    def __str__(self) -> str:
        return "\n".join(" and ".join(map(str, r)) + ": reject" for r in self.rules) or "keep all"


def _cuts(values: np.ndarray) -> np.ndarray:
    found = np.unique(values)
    if len(found) > 48:
        found = np.unique(np.quantile(found, np.linspace(0, 1, 48)))
    return (found[1:] + found[:-1]) / 2


def _grow(rows: np.ndarray, reject: np.ndarray, longest: int) -> Rule:
    rule, inside = (), np.ones(len(rows), dtype=bool)
    while len(rule) < longest and (~reject[inside]).any():
        p, n = reject[inside].sum(), (~reject[inside]).sum()
        best = (1e-9, None)
        for name in FEATURES:
            column = rows[inside, FEATURES.index(name)]
            for threshold in _cuts(column).tolist():
                for above in (True, False):
                    held = column > threshold if above else column <= threshold
                    p1, n1 = (held & reject[inside]).sum(), (held & ~reject[inside]).sum()
                    if p1:
                        gain = p1 * (np.log2(p1 / (p1 + n1)) - np.log2(p / (p + n)))
                        if gain > best[0]:
                            best = (gain, Condition(name, above, threshold))
        if best[1] is None:
            break
        rule += (best[1],)
        inside &= best[1].holds(rows)
    return rule


def learn(rows: np.ndarray, labels: np.ndarray, precision: float = 0.9, longest: int = 4, most: int = 16, least: int = 5) -> DecisionList:
    """rows: FEATURES of labelled texts; labels: 0 reject, 1 keep. Every third row is set aside for pruning."""
    reject, aside = labels == 0, np.arange(len(labels)) % 3 == 2
    rules: list[Rule] = []
    left = np.ones(len(labels), dtype=bool)
    while len(rules) < most and (reject & left & ~aside).sum() >= least:
        grow, prune = left & ~aside, left & aside
        rule = _grow(rows[grow], reject[grow], longest)

        def worth(r: Rule, prune: np.ndarray = prune) -> float:
            inside = covers(r, rows[prune])
            p, n = (inside & reject[prune]).sum(), (inside & ~reject[prune]).sum()
            return (p - n) / (p + n) if p + n else -1.0

        if not rule:
            break
        rule = max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (worth(r), len(r)))
        inside = covers(rule, rows) & left
        if inside.sum() < least or reject[inside].mean() < precision or (worth(rule) + 1) / 2 < precision:
            break
        rules.append(rule)
        left &= ~inside
    return DecisionList(rules)


def fit(documents: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> DecisionList:
    """Learns from at most `sample` labelled rows whose crc32(doc_id) is no multiple of five and that pass the base rules."""
    order = [F.xxhash64("doc_id"), "doc_id", "label"]
    usable = pick(labels, doc_id="doc_id", label=label).where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0))
    usable = cut(usable.orderBy(*order).limit(sample), "labelled")
    texts = pick(documents, doc_id="doc_id", text="text").join(F.broadcast(usable), "doc_id")  # at most `sample` keys
    found = statistics(texts, keep={"label": "label"}).select("doc_id", "label", "base_failed", "features").orderBy(*order, "features").limit(sample).collect()
    known = [r for r in found if not r["base_failed"]]  # as a filter this would go below the join, over every document
    if not known:
        return DecisionList()
    return learn(np.array([list(r["features"]) for r in known]), np.array([r["label"] for r in known]))


def judge(documents: DataFrame, rules: DecisionList, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds kept to the statistics: false if the base rules fail, else the list's verdict."""
    return statistics(documents, doc_id, text).withColumn("kept", ~F.col("base_failed") & rules.keeps())
