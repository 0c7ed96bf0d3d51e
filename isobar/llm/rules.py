"""Quality rules: learned decision lists over text statistics.

Sequential covering learns rules that reject.  A rule is a conjunction of
thresholds on per-document statistics, grown condition by condition on two
thirds of the labelled rows by information gain and pruned on the rest.  The
list is emitted as one ordered Spark CASE expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.llm.common import written
from isobar.llm.textstats import text_stats

#: About so many labelled rows are learned from, drawn by hash of the id.
SAMPLE_ROWS = 20_000
#: Cut points tried per statistic, conditions per rule, rules per list.
CUTS, CONDITIONS, RULES = 48, 4, 12
#: A rule must reject with this precision on the rows it was pruned on, and cover so many.
PRECISION, SUPPORT = 0.9, 4
SEED = 11

#: The statistics that rules may test, as shares that do not depend on length.
FEATURES = {
    "words": "n_words",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "bangs_per_word": "n_bangs / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "duplicate_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeated_word_share": "n_repeat_words / greatest(n_words, 1)",
    "stutter_share": "n_stutter / greatest(n_words, 1)",
}


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.cut if self.above else x[self.feature] <= self.cut

    def column(self) -> Column:
        return F.expr(f"({FEATURES[self.feature]}) {'>' if self.above else '<='} {self.cut!r}D")

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for c in rule:
        out &= c.holds(x)
    return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    rule: Rule = ()
    inside = np.ones(len(bad), bool)
    while len(rule) < CONDITIONS and bad[inside].any() and not bad[inside].all():
        base = np.log2(bad[inside].mean())
        best: tuple[float, Condition | None] = (1e-9, None)
        for name, v in x.items():
            order = np.sort(np.unique(v[inside]))
            cuts = np.unique(np.quantile(v[inside], np.linspace(0, 1, CUTS + 1), method="lower"))
            # also midway between the rejects' range and the rest, however few they are
            cuts = np.unique(np.concatenate([cuts, order[:CUTS]]))
            for cut in cuts.tolist():
                for above in (True, False):
                    hit = inside & (v > cut if above else v <= cut)
                    p = int(bad[hit].sum())
                    if p:
                        gain = p * (np.log2(p / int(hit.sum())) - base)
                        if gain > best[0]:
                            best = gain, Condition(name, above, float(cut))
        if best[1] is None:
            break
        rule += (best[1],)
        inside &= best[1].holds(x)
    return rule


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The prefix of the rule with the best (rejects - others) / covered."""
    def worth(r: Rule) -> float:
        hit = covers(r, x, len(bad))
        return (2 * bad[hit].mean() - 1) if hit.any() else -1.0
    return max((rule[:k] for k in range(len(rule), 0, -1)), key=worth, default=())


def learn(x: dict[str, np.ndarray], bad: np.ndarray, fold: np.ndarray) -> list[Rule]:
    """Ordered rejecting rules; rows with fold 0 prune, the others grow."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    while len(rules) < RULES:
        g, p = left & (fold != 0), left & (fold == 0)
        if bad[g].sum() < SUPPORT:
            break
        rule = _grow({k: v[g] for k, v in x.items()}, bad[g])
        rule = _prune(rule, {k: v[p] for k, v in x.items()}, bad[p])
        hit = covers(rule, x, len(bad)) & left
        if not rule or bad[hit].sum() < SUPPORT or bad[hit].mean() < PRECISION or (
                (hit & p).any() and bad[hit & p].mean() < PRECISION):
            break
        rules.append(rule)
        left &= ~hit
    return rules


def verdict(rules: list[Rule]) -> Column:
    """True keeps: the first rule that holds rejects, otherwise the text stays."""
    out = None
    for rule in rules:
        holds = rule[0].column()
        for c in rule[1:]:
            holds = holds & c.column()
        out = F.when(holds, F.lit(False)) if out is None else out.when(holds, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def fit(stats: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """A decision list from about ``sample_rows`` labelled rows of ``stats`` (a written table).

    Ids without label, null labels and null ids are not used; an id labelled
    twice counts once, with its larger label.  Without labels the list is empty.
    """
    lab = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
           .groupBy(F.col("doc_id").alias("label_id")).agg(F.max("quality").cast("int").alias("label"))
           .withColumn("draw", F.xxhash64(F.lit(SEED), "label_id")))
    n = lab.count()
    if n > sample_rows:
        lab = lab.where(F.col("draw") < F.lit(int((sample_rows / n * 2 - 1) * (1 << 63))))
    rows = (stats.where(F.col("doc_id").isNotNull()).join(lab, F.col("doc_id") == F.col("label_id"))
            .dropDuplicates(["doc_id"])
            .select("label", "draw", *[F.expr(e).cast("double").alias(k) for k, e in FEATURES.items()])
            .toPandas().sort_values("draw"))  # bounded by sample_rows
    x = {k: rows[k].to_numpy() for k in FEATURES}
    return learn(x, rows["label"].to_numpy() == 0, np.arange(len(rows)) % 3)


def apply(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics, base_failed and kept of every row of docs.

    Null and empty texts have no words and fail the base rule.  Repeated rows
    get equal verdicts.  Empty tables are fine.
    """
    stats = written(text_stats(docs), "text-stats")
    rules = fit(stats, labels)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return stats.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"))
