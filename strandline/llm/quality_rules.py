"""Quality rules: a decision list learnt by sequential covering, run as Spark conditional expressions.

Rules are conjunctions of thresholds on integer rates of a text's statistics.  Each rule grows on two
thirds of the labelled sample by FOIL gain until it covers no good text or gains nothing, then is
pruned on the other third from its last condition while precision does not fall; rows it covers go,
and the next rule grows, until a rule would be right less than `least_precision` of the time.
The list is ordered: the first rule that holds decides; else the text is kept.

The labelled sample is bounded (`max_rows` rows of six numbers).  Statistics cover every whole text.
A null or empty text has no word and fails the base rule (n_words < 50).  Repeated rows are judged each alike; other columns
are ignored.  An empty table gives an empty result; without labels only the base rule rejects.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import map_texts
from .labelled import remainder
from .text_stats import structure

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Integer rates: name, SQL over the statistics.
RATES = {
    "words": "n_words",
    "chars_per_kword": "(1000 * word_chars) div greatest(n_words, 1)",
    "symbols_per_kword": "(1000 * n_symbols) div greatest(n_words, 1)",
    "dup_lines_per_kword": "(1000 * n_dup_lines) div greatest(n_words, 1)",
    "repeats_per_kword": "(1000 * n_repeat_words) div greatest(n_words, 1)",
}
BASE_FAILED = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"


@dataclass(frozen=True)
class Condition:
    rate: str
    at_least: bool
    value: int

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.rate] >= self.value if self.at_least else x[self.rate] < self.value

    def column(self) -> Column:
        return F.col(self.rate) >= self.value if self.at_least else F.col(self.rate) < self.value


Rule = tuple[Condition, ...]


def _covers(rule: Rule, x: dict) -> np.ndarray:
    hit = np.ones(len(next(iter(x.values()))), bool)
    for c in rule:
        hit &= c.holds(x)
    return hit


def _grow(x: dict, bad: np.ndarray, cuts: int) -> Rule:
    rule: list[Condition] = []
    inside = np.ones(len(bad), bool)
    while bad[inside].sum() and (~bad[inside]).any():
        p, n = bad[inside].sum(), inside.sum()
        best, gain = None, 1e-9
        for rate, values in x.items():
            for v in np.unique(np.quantile(values[inside], np.linspace(0.01, 0.99, cuts)).astype(np.int64) + 1):
                for up in (True, False):
                    hit = inside & (values >= v if up else values < v)
                    q = bad[hit].sum()
                    if q and q * (np.log2(q / hit.sum()) - np.log2(p / n)) > gain:
                        best, gain = Condition(rate, up, int(v)), q * (np.log2(q / hit.sum()) - np.log2(p / n))
        if best is None or len(rule) == 4:
            break
        rule.append(best)
        inside &= best.holds(x)
    return tuple(rule)


def _precision(rule: Rule, x: dict, bad: np.ndarray) -> float:
    hit = _covers(rule, x)
    return (bad[hit].sum() + 1) / (hit.sum() + 2)


def learn(x: dict[str, np.ndarray], bad: np.ndarray, least_precision: float = 0.8, most_rules: int = 12, cuts: int = 40, seed: int = 11) -> list[Rule]:
    """Ordered rules that reject; x: rates, bad: the label of each row is 0."""
    rng = np.random.default_rng(seed)
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    while bad[left].sum() >= 5 and len(rules) < most_rules:
        ids = rng.permutation(np.flatnonzero(left))
        a, b = ids[: 2 * len(ids) // 3], ids[2 * len(ids) // 3 :]
        grown = _grow({k: v[a] for k, v in x.items()}, bad[a], cuts)
        held = {k: v[b] for k, v in x.items()}
        while len(grown) > 1 and _precision(grown[:-1], held, bad[b]) >= _precision(grown, held, bad[b]):
            grown = grown[:-1]
        if not grown or _precision(grown, held, bad[b]) < least_precision:
            break
        rules.append(grown)
        left &= ~_covers(grown, x)
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The number (from 1) of the first rule that holds, as one conditional expression; null if none does."""
    out = F.lit(None).cast("int")
    for i, rule in reversed(list(enumerate(rules, 1))):
        every = rule[0].column()
        for c in rule[1:]:
            every = every & c.column()
        out = F.when(every, F.lit(i)).otherwise(out)
    return out


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the five statistics of each whole text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_texts(docs, ["doc_id"], lambda d, o: list(structure(d, o).values()), f"doc_id {kind}, " + ", ".join(f"{k} bigint" for k in STATS))


def with_rates(stats: DataFrame) -> DataFrame:
    return stats.withColumns({k: F.expr(v) for k, v in RATES.items()})


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, n: int = 5, fold: int = 0) -> list[Rule]:
    """Learn from a bounded sample of labelled rows that pass the base rule; documents of the fold, for measuring, are never learnt from."""
    marks = labels.where(F.col("quality").isNotNull() & (remainder(n) != fold)).groupBy("doc_id").agg((F.avg("quality") < 0.5).alias("bad")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    sample = statistics(docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id", "left_semi")).join(F.broadcast(marks), "doc_id")
    rows = with_rates(sample.where(f"not ({BASE_FAILED})")).select("doc_id", "bad", *RATES).toPandas().sort_values(["doc_id", *RATES], kind="stable")
    return learn({k: rows[k].to_numpy(np.int64) for k in RATES}, rows["bad"].to_numpy(bool)) if len(rows) else []


def apply_rules(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    out = with_rates(statistics(docs)).withColumn("rule", verdict(rules)).withColumn("base_failed", F.expr(BASE_FAILED))
    return out.select("doc_id", *STATS, "base_failed", (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"), "rule")


def quality_rules(docs: DataFrame, labels: DataFrame, **bounds) -> DataFrame:
    """Per row of docs: doc_id, the statistics, base_failed, kept and the rule that rejected it."""
    return apply_rules(docs, fit(docs, labels, **bounds))
