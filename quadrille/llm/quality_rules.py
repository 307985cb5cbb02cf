"""Quality rules: statistics of a text and learned decision lists over them, native DataFrame expressions throughout.

`with_statistics` adds the statistics. `learn` takes labelled statistics and grows and prunes, rule by rule, conjunctions
of thresholds that single out the rejected class, by sequential covering; what a rule covers leaves the training rows.
`verdict` turns the list into one ordered chain of Spark conditional expressions.

Expressions see arrays only through zip_with and transform over the array itself, never through an outer array inside a
lambda, so nothing is computed once per element that belongs to the row. Everything is linear in a text's length but for
one sort of its three-word windows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import native_words

#: Labelled rows that a list is learned from, at most: those with the least hash of the id.
MAX_LABELLED = 6000
LEAST_PRECISION = 0.9
MAX_RULES = 16
MAX_CONDITIONS = 4
THRESHOLDS = 48

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", "upper_share", "digit_share", "mark_share", "bang_share", "line_words")


def with_statistics(df: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the learner's shares, under a prefix.

    A null text counts as empty: zero everywhere. Shares of an empty text are 0.
    """
    p = prefix
    text = F.coalesce(df[f"`{text_col}`"], F.lit(""))
    count = lambda chars: F.char_length("_q_text") - F.char_length(F.translate("_q_text", chars, ""))
    out = df.withColumn("_q_text", text).withColumn("_q_words", native_words(F.col("_q_text")))
    out = out.withColumns(
        {
            f"{p}n_words": F.size("_q_words").cast("long"),
            f"{p}word_chars": F.char_length(F.array_join("_q_words", "")).cast("long"),
            f"{p}n_symbols": count("#*$%&|<>").cast("long"),
            "_q_lines": F.filter(F.split("_q_text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
            "_q_distinct": F.size(F.array_distinct("_q_words")),
            "_q_upper": F.regexp_count("_q_text", F.lit(r"\p{Lu}")),
            "_q_digits": count("0123456789"),
            "_q_marks": count(".,;:?()\"'-_/\\=+[]{}@"),
            "_q_bangs": count("!"),
            "_q_windows": F.zip_with(
                F.zip_with("_q_words", F.slice("_q_words", 2, F.greatest(F.size("_q_words"), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b)),
                F.slice("_q_words", 3, F.greatest(F.size("_q_words"), F.lit(1))),
                lambda ab, c: F.concat(ab, F.lit(" "), c),
            ),
        }
    ).drop("_q_text", "_q_words")
    # windows with their places, equal ones side by side; concat() with what lies behind the end is null
    out = out.withColumn("_q_sorted", F.sort_array(F.filter(F.transform("_q_windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: x["w"].isNotNull()))).drop("_q_windows")
    again = F.zip_with("_q_sorted", F.slice("_q_sorted", 2, F.greatest(F.size("_q_sorted"), F.lit(1))), lambda a, b: F.when(a["w"] == b["w"], F.array(a["i"], b["i"])))
    out = out.withColumn("_q_at", F.array_sort(F.array_distinct(F.flatten(F.array_compact(again))))).drop("_q_sorted")
    steps = F.zip_with("_q_at", F.slice("_q_at", 2, F.greatest(F.size("_q_at"), F.lit(1))), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
    out = out.withColumns(
        {
            f"{p}n_dup_lines": (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long"),
            f"{p}n_repeat_words": F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x),
            "_q_n_lines": F.size("_q_lines"),
        }
    ).drop("_q_lines", "_q_at")
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a).cast("double") / F.col(b)).otherwise(0.0)
    n, chars = f"{p}n_words", f"{p}word_chars"
    return out.withColumns(
        {
            f"{p}mean_word": share(chars, n),
            f"{p}symbol_share": share(f"{p}n_symbols", chars),
            f"{p}dup_line_share": share(f"{p}n_dup_lines", "_q_n_lines"),
            f"{p}repeat_share": share(f"{p}n_repeat_words", n),
            f"{p}distinct_share": share("_q_distinct", n),
            f"{p}upper_share": share("_q_upper", chars),
            f"{p}digit_share": share("_q_digits", chars),
            f"{p}mark_share": share("_q_marks", chars),
            f"{p}bang_share": share("_q_bangs", chars),
            f"{p}line_words": share(n, "_q_n_lines"),
        }
    ).drop("_q_n_lines", "_q_distinct", "_q_upper", "_q_digits", "_q_marks", "_q_bangs")


def base_failed(prefix: str = "") -> Column:
    n, again = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (n < 50) | (100 * again > 50 * n)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: np.ndarray, names: tuple[str, ...]) -> np.ndarray:
        column = x[:, names.index(self.feature)]
        return column > self.threshold if self.above else column <= self.threshold

    def column(self, prefix: str) -> Column:
        c = F.col(prefix + self.feature)
        return c > self.threshold if self.above else c <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, x: np.ndarray, names: tuple[str, ...]) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for c in rule:
        out &= c.holds(x, names)
    return out


def _grow(x: np.ndarray, bad: np.ndarray, names: tuple[str, ...]) -> Rule:
    """Add the condition of most information gain until no accepted row is covered."""
    rule: Rule = ()
    inside = np.ones(len(x), dtype=bool)
    while len(rule) < MAX_CONDITIONS and (~bad & inside).any():
        p0, n0 = (bad & inside).sum(), (~bad & inside).sum()
        best, gain = None, 1e-9
        for f, name in enumerate(names):
            values = x[inside, f]
            cuts = np.unique(np.quantile(values[bad[inside]], np.linspace(0, 1, THRESHOLDS)))
            order = np.sort(values)
            after = np.minimum(np.searchsorted(order, cuts, side="right"), len(order) - 1)
            above = (cuts + order[after]) / 2  # halfway to the next value
            before = np.maximum(np.searchsorted(order, cuts, side="left") - 1, 0)
            below = (cuts + order[before]) / 2
            for up, marks in ((False, above), (True, below)):
                for t in marks:
                    hit = inside & (x[:, f] > t if up else x[:, f] <= t)
                    p, n = (bad & hit).sum(), (~bad & hit).sum()
                    if p and (p, n) != (p0, n0):
                        g = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
                        if g > gain:
                            best, gain = Condition(name, up, float(t)), g
        if best is None:
            break
        rule += (best,)
        inside &= best.holds(x, names)
    return rule


def _prune(rule: Rule, x: np.ndarray, bad: np.ndarray, names: tuple[str, ...]) -> Rule:
    """The beginning of the rule that is worth most on rows it wasn't grown on."""
    best, worth = rule, -2.0
    for k in range(len(rule), 0, -1):
        hit = covers(rule[:k], x, names)
        p, n = (bad & hit).sum(), (~bad & hit).sum()
        w = (p - n) / (p + n) if p + n else -1.0
        if w > worth or w == worth and p + n:
            best, worth = rule[:k], w
    return best


def learn_list(x: np.ndarray, bad: np.ndarray, names: tuple[str, ...] = FEATURES, least_precision: float = LEAST_PRECISION) -> list[Rule]:
    """Ordered rules that reject. Without rows of both classes there are none. Rows' order doesn't matter beyond the split."""
    rules: list[Rule] = []
    fold = np.arange(len(x)) % 3
    while len(rules) < MAX_RULES and bad.sum() >= 3 and (~bad).any():
        grow, test = fold != 0, fold == 0
        if not bad[grow].any():
            break
        rule = _grow(x[grow], bad[grow], names)
        if not rule:
            break
        rule = _prune(rule, x[test], bad[test], names)
        hit = covers(rule, x, names)
        if (bad & hit).sum() < 3 or (bad & hit).sum() < least_precision * hit.sum():
            break
        rules.append(rule)
        x, bad, fold = x[~hit], bad[~hit], fold[~hit]
    return rules


def learn(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_labelled: int = MAX_LABELLED, label_col: str = "quality") -> list[Rule]:
    """Learn from at most `max_labelled` labelled rows, those with the least hash of their id; label 0 is what to reject.

    Ids with labels of both kinds and rows without an id or label teach nothing. Only the sample's statistics reach the driver.
    """
    ids = labels.select(F.col(f"`{id_col}`").alias("_q_id"), F.col(f"`{label_col}`").cast("int").alias("_q_label")).dropna()
    ids = ids.groupBy("_q_id").agg(F.min("_q_label").alias("_q_label"), F.max("_q_label").alias("_q_most")).where("_q_label = _q_most").drop("_q_most")
    ids = ids.orderBy(F.xxhash64("_q_id"), "_q_id").limit(max_labelled)
    docs = df.select(df[f"`{id_col}`"].alias("_q_id"), df[f"`{text_col}`"].alias("text")).join(F.broadcast(ids), "_q_id")  # at most max_labelled pairs
    rows = with_statistics(docs).select("_q_id", "_q_label", *FEATURES).orderBy(F.xxhash64("_q_id"), "_q_id").limit(2 * max_labelled).collect()
    if not rows:
        return []
    x = np.array([r[2:] for r in rows], dtype=float)
    return learn_list(x, np.array([r[1] == 0 for r in rows]))


def verdict(rules: list[Rule], prefix: str = "") -> Column:
    """True to keep: the first rule that holds rejects."""
    chain = F.when(base_failed(prefix), F.lit(False))
    for rule in rules:
        holds = rule[0].column(prefix)
        for c in rule[1:]:
            holds &= c.column(prefix)
        chain = chain.when(holds, F.lit(False))
    return chain.otherwise(F.lit(True))


def judge(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """Per row: doc_id, the base statistics, base_failed, kept.

    Null and empty texts have no words, so they fail the base. Repeated rows and null ids are kept as rows; an empty
    table gives none; without labels only the base decides; other columns are ignored.
    """
    rules = learn(df, labels, id_col, text_col) if rules is None else rules
    stats = with_statistics(df.select(df[f"`{id_col}`"].alias("doc_id"), df[f"`{text_col}`"].alias("text")))
    return stats.select("doc_id", *BASE, base_failed().alias("base_failed"), verdict(rules).alias("kept"))


def keep_good(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """Rows that the list keeps, with the columns they came with."""
    rules = learn(df, labels, id_col, text_col) if rules is None else rules
    # the row number keeps the filter from being pushed below the statistics, which would compute them over and over
    judged = with_statistics(df, text_col, "_q_s_").withColumns({"_q_keep": verdict(rules, "_q_s_"), "_q_row": F.monotonically_increasing_id()})
    return judged.where("_q_keep and _q_row >= 0").select(*[F.col(f"`{c}`") for c in df.columns])
