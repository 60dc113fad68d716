"""Quality rules: decision lists learned by sequential covering, applied as one ordered conditional expression.

Statistics of texts, learning and verdicts are built-in expressions and aggregations. The driver sees counts per rule
candidate, never rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import written

# What separates words, and which characters are symbols.
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3

# The statistics that rules put thresholds on: shares of the text, so that they mean the same for texts of any length.
FEATURES = {
    "n_words": "n_words",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "mark_share": "n_marks / greatest(word_chars, 1)",
    "distinct_share": "n_distinct / greatest(n_words, 1)",
}


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Counts for each whole text, added as columns; a null text has none of anything. ``docs`` keeps its rows and columns.

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_lines`` (with a word), ``n_dup_lines`` (equal to an earlier line),
    ``n_repeat_words`` (in a window of three words that occurs twice or more in the text), ``n_upper``, ``n_digits``,
    ``n_marks`` (exclamation and question marks), ``n_distinct`` (different words). Columns of these names are replaced.

    Everything happens inside the row. Windows are told apart by a 64-bit hash of their words. Only a text in which some
    window occurs twice is sorted to find where.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    split = F.array_remove(F.split(F.translate(value, SPACE, " " * len(SPACE)), " "), "")
    lines = F.filter(F.split(value, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = docs.withColumns({"_words": split, "_lines": lines, "_value": value})
    n = F.size("_words")
    windows = F.when(
        n >= WINDOW,
        F.transform(F.sequence(F.lit(1), n - WINDOW + 1), lambda i: F.xxhash64(F.slice("_words", i, WINDOW))),
    ).otherwise(F.array().cast("array<bigint>"))
    rows = rows.withColumn("_windows", windows)
    some_twice = F.size(F.array_distinct("_windows")) < F.size("_windows")
    rows = rows.withColumn(
        "_sorted",
        F.when(some_twice, F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    )
    # Equal windows are neighbours now; both of a pair count.
    pairs = F.zip_with(
        F.slice("_sorted", F.lit(1), F.size("_sorted") - 1),
        F.slice("_sorted", F.lit(2), F.size("_sorted") - 1),
        lambda a, b: F.when(a["h"] == b["h"], F.array(*[x["i"] + k for x in (a, b) for k in range(WINDOW)])).otherwise(
            F.array().cast("array<int>")
        ),
    )
    repeated = F.when(F.col("_sorted").isNull(), 0).otherwise(F.size(F.array_distinct(F.flatten(pairs))))
    joined = F.array_join("_words", "")
    counts = {
        "n_words": n,
        "word_chars": F.length(joined),
        "n_symbols": F.length(joined) - F.length(F.translate(joined, SYMBOLS, "")),
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": repeated,
        "n_upper": F.regexp_count(joined, F.lit(r"\p{Lu}")),
        "n_digits": F.regexp_count(joined, F.lit("[0-9]")),
        "n_marks": F.regexp_count(joined, F.lit("[!?]")),
        "n_distinct": F.size(F.array_distinct("_words")),
    }
    rows = rows.withColumns({k: v.cast("long") for k, v in counts.items()})
    return rows.drop("_words", "_lines", "_value", "_windows", "_sorted")


def base_failed() -> Column:
    """The fixed base rule over ``text_statistics``: too few words, or more than half of them in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Test:
    """One threshold: the feature is at least the value (``above``), or below it."""

    feature: str
    above: bool
    value: float

    def column(self) -> Column:
        x = F.expr(FEATURES[self.feature])
        return x >= F.lit(self.value) if self.above else x < F.lit(self.value)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.value:.6g}"


@dataclass(frozen=True)
class Rule:
    """Texts that pass every test are rejected."""

    tests: tuple[Test, ...]

    def column(self) -> Column:
        holds = F.lit(True)
        for test in self.tests:
            holds = holds & test.column()
        return holds

    def __str__(self) -> str:
        return " and ".join(map(str, self.tests))


@dataclass(frozen=True)
class DecisionList:
    """Rules in the order in which they were learned; what none of them covers is kept."""

    rules: tuple[Rule, ...] = ()
    counts: tuple[tuple[int, int], ...] = field(default=(), compare=False)

    def verdict(self) -> Column:
        """The number of the first rule that holds, from 1, or 0: one conditional expression in the rules' order."""
        out = None
        for number, rule in enumerate(self.rules, 1):
            out = F.when(rule.column(), number) if out is None else out.when(rule.column(), number)
        return F.lit(0) if out is None else out.otherwise(0)


def learn_rules(
    labelled: DataFrame,
    label: str = "quality",
    key: str = "doc_id",
    max_rules: int = 8,
    max_tests: int = 3,
    cuts: int = 24,
    min_precision: float = 0.95,
    min_cover: int = 5,
) -> DecisionList:
    """Sequential covering: grow a conjunction, prune it, take out what it covers, and begin again.

    ``labelled`` has the columns of ``text_statistics`` and a label, 0 for texts to reject. Rows whose label is null are
    left out. Two thirds of the rows, by a hash of ``key``, grow rules and the rest prune them and judge them. A rule is
    grown by the threshold of the highest information gain over its predecessor, and its last tests are cut off as long
    as that does not lower (wrong - right) on the pruning rows. Learning ends when a rule's precision on the pruning rows is
    under ``min_precision`` or it covers fewer than ``min_cover`` of them. Without labels of both kinds there are no rules.

    Thresholds are ``cuts`` quantiles of each feature over the rows labelled 0, and as many over the others. Each step is
    one aggregation over all labelled rows that brings back two counts per threshold.
    """
    rows = labelled.filter(F.col(label).isNotNull()).select(
        (F.col(label) == 0).alias("_bad"),
        (F.pmod(F.xxhash64(key), F.lit(3)) < 2).alias("_grow"),
        *[F.expr(x).cast("double").alias(name) for name, x in FEATURES.items()],
    )
    rows = written(rows, "labelled")
    shares = [k / (cuts + 1) for k in range(1, cuts + 1)]
    kinds = rows.groupBy("_bad").agg(*[F.percentile_approx(name, shares, 10_000).alias(name) for name in FEATURES]).collect()
    if len(kinds) < 2:
        return DecisionList()
    values = {name: sorted({v for r in kinds for v in r[name]}) for name in FEATURES}
    # A feature's code is how many of its thresholds it reaches, so "at least the k-th" is "code of k or more".
    def code(name: str) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, values[name])), lambda v: v <= F.col(name))).alias(name)

    coded = rows.select("_bad", "_grow", *map(code, FEATURES))
    # Rows of equal codes and label act alike, so they are counted once for all steps.
    coded = written(coded.groupBy("_bad", "_grow", *FEATURES).agg(F.count(F.lit(1)).alias("_n")), "coded")

    def holds(tests: tuple[Test, ...]) -> Column:
        out = F.lit(True)
        for t in tests:
            code = F.col(t.feature)
            at = values[t.feature].index(t.value) + 1
            out = out & ((code >= at) if t.above else (code < at))
        return out

    def counts(df: DataFrame) -> dict[tuple[str, int], tuple[int, int]]:
        """(right, wrong) by feature and code."""
        pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("f"), F.col(n).alias("c")) for n in FEATURES])).alias("p")
        got = df.select("_bad", "_n", pairs).groupBy("p.f", "p.c")
        got = got.agg(F.sum(F.when(F.col("_bad"), F.col("_n"))).alias("r"), F.sum(F.when(~F.col("_bad"), F.col("_n"))).alias("w"))
        return {(x["f"], x["c"]): (x["r"] or 0, x["w"] or 0) for x in got.collect()}

    def gain(before: tuple[int, int], now: tuple[int, int]) -> float:
        if not now[0] or not before[0]:
            return 0.0
        return now[0] * (math.log2(now[0] / sum(now)) - math.log2(before[0] / sum(before)))

    rules: list[Rule] = []
    seen: list[tuple[int, int]] = []
    left = coded
    while len(rules) < max_rules:
        tests: tuple[Test, ...] = ()
        while len(tests) < max_tests:
            table = counts(left.filter(F.col("_grow") & holds(tests)))
            total = [sum(v[k] for (f, _), v in table.items() if f == "n_words") for k in (0, 1)]
            before = (total[0], total[1])
            if not before[0] or not before[1]:
                break
            best: tuple[float, Test | None] = (0.0, None)
            for name in FEATURES:
                below = [0, 0]
                for at, value in enumerate(values[name], 1):
                    got = table.get((name, at - 1), (0, 0))
                    below = [below[0] + got[0], below[1] + got[1]]
                    above = (before[0] - below[0], before[1] - below[1])
                    for is_above, now in ((True, above), (False, (below[0], below[1]))):
                        worth = gain(before, now)
                        if worth > best[0] + 1e-9:
                            best = (worth, Test(name, is_above, value))
            if best[1] is None:
                break
            tests = (*tests, best[1])
        if not tests:
            break
        # Prune: every shorter beginning of the rule is judged at once on the other rows.
        starts = [tests[:k] for k in range(1, len(tests) + 1)]
        judge = left.filter(~F.col("_grow")).agg(
            *[F.sum(F.when(holds(s) & F.col("_bad"), F.col("_n")).otherwise(0)).alias(f"r{k}") for k, s in enumerate(starts)],
            *[F.sum(F.when(holds(s) & ~F.col("_bad"), F.col("_n")).otherwise(0)).alias(f"w{k}") for k, s in enumerate(starts)],
        ).first()
        scored = [(judge[f"r{k}"] or 0, judge[f"w{k}"] or 0) for k in range(len(starts))]
        worth = [((r - w) / (r + w) if r + w else -1.0) for r, w in scored]
        k = max(range(len(starts)), key=lambda i: (worth[i], -i))
        right, wrong = scored[k]
        if right < min_cover or right < min_precision * (right + wrong):
            break
        rules.append(Rule(starts[k]))
        seen.append((right, wrong))
        left = left.filter(~holds(starts[k]))
    return DecisionList(tuple(rules), tuple(seen))


def judged(stats: DataFrame, rules: DecisionList) -> DataFrame:
    """``text_statistics`` with ``base_failed``, ``rule`` (the first that holds, or 0) and ``kept``."""
    return stats.withColumns({"base_failed": base_failed(), "rule": rules.verdict()}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("rule") == 0)
    )


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that neither the base rule nor a rule learned from ``labels`` rejects, with all their columns.

    Statistics of all documents are written, without texts, to learn from those that have a label, and worked out again in
    the pass that filters. So no text is shuffled, whatever the number of labels. Columns named like a statistic are put aside meanwhile.
    """
    given = docs.select(F.struct(*docs.columns).alias("_row"), F.col(doc_id).alias("_doc_id"), F.col(text).alias("_text"))
    known = written(text_statistics(given.drop("_row"), "_text").drop("_text"), "known")
    learned = learn_from(known.withColumnRenamed("_doc_id", doc_id), labels, doc_id)
    # A filter on plain columns would be moved below the statistics, with all of their expressions in it, time and again.
    seen = judged(text_statistics(given, "_text"), learned)
    return seen.withColumn("kept", F.col("kept") & (F.monotonically_increasing_id() >= 0)).filter("kept").select("_row.*")


def learn_from(stats: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality") -> DecisionList:
    """Learn from the documents that have a label. Several labels of one document count one row each."""
    marks = labels.filter(F.col(label).isNotNull()).select(F.col(doc_id).alias("_id"), F.col(label).alias("_label"))
    joined = stats.join(marks, F.col(doc_id) == F.col("_id"))
    return learn_rules(joined, label="_label", key=doc_id)
