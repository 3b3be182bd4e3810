"""Learned decision lists over text statistics, from DataFrame functions only.

Sequential covering: on labelled rows, split by a hash into a growing and a
pruning part, a rule grows one threshold condition at a time (the one with the
best FOIL gain on the growing rows), is pruned back to the prefix of conditions
that separates the pruning rows best, and is kept if it is precise enough
there; the rows it covers leave, and the next rule is learned on the rest. All
counts are grouped sums over binned statistics, so each step returns a table of
(statistics x bins) rows whatever the number of labelled rows. The list is
applied as one conditional expression: the first rule that holds rejects.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage
from .textstats import fresh, with_text_stats


@dataclass(frozen=True)
class Condition:
    stat: str
    op: str  # ">=" or "<"
    cut: float


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    covered: int
    wrong: int

    def text(self) -> str:
        return " and ".join(f"{c.stat} {c.op} {c.cut:.6g}" for c in self.conditions)


def ratios(s: Column) -> dict[str, Column]:
    """Length-free statistics from the counts of a text; short texts are drawn
    towards zero by the added constants."""
    n, chars = s["n_words"] + F.lit(10.0), s["word_chars"] + F.lit(50.0)
    return {
        "symbols_per_word": s["n_symbols"] / n,
        "exclamations_per_word": s["n_excl"] / n,
        "upper_share": s["n_upper"] / chars,
        "digit_share": s["n_digits"] / chars,
        "repeated_word_share": (s["n_words"] - s["n_distinct"]) / n,
        "repeated_window_share": s["n_repeat_words"] / n,
        "duplicate_line_share": s["n_dup_lines"] / (s["n_lines"] + F.lit(2.0)),
        "chars_per_word": s["word_chars"] / n,
        "punctuation_per_word": s["n_punct"] / n,
    }


def learn(labelled: DataFrame, stats: dict[str, Column], label: Column, key: Column, bins: int = 32,
          max_rules: int = 8, max_conditions: int = 3, min_covered: int = 4, min_precision: float = 0.95) -> list[Rule]:
    """Decision list for the rows with ``label`` 0 (the class the rules reject).

    ``bins`` quantiles of each class give the candidate thresholds (midway between
    neighbouring ones). Rows without a label are left out. With no row of either
    class there is nothing to separate and the list is empty.
    """
    names = list(stats)
    base = cut_lineage(labelled.select(
        (label == 0).alias("bad"), (F.pmod(F.xxhash64(key), F.lit(3)) != 0).alias("grow"),
        *[c.cast("double").alias(k) for k, c in stats.items()]).where(F.col("bad").isNotNull()))
    probs = [i / bins for i in range(bins + 1)]
    marks = base.groupBy("bad").agg(*[F.percentile_approx(k, probs, 10000).alias(k) for k in names]).collect()
    if len(marks) < 2:
        return []
    cuts = {}
    for k in names:
        v = sorted({x for row in marks for x in row[k] or ()})
        cuts[k] = [(a + b) / 2 for a, b in zip(v, v[1:])]
    binned = cut_lineage(base.select("bad", "grow", *[
        sum((F.when(F.col(k) >= c, 1).otherwise(0) for c in cuts[k]), F.lit(0)).alias(k) for k in names]))

    def holds(conds) -> Column:
        out = F.lit(True)
        for k, op, i in conds:
            out = out & ((F.col(k) > i) if op == ">=" else (F.col(k) <= i))
        return out

    def counts(left: Column) -> dict:
        """(statistic, bin) -> {(grow, bad): rows} of the rows that are left."""
        long = binned.where(left).select("bad", "grow", F.explode(F.array(*[
            F.struct(F.lit(k).alias("k"), F.col(k).alias("b")) for k in names])).alias("e"))
        out: dict = defaultdict(lambda: defaultdict(int))
        for r in long.groupBy("e.k", "e.b", "bad", "grow").count().collect():
            out[r["k"], r["b"]][r["grow"], r["bad"]] += r["count"]
        return out

    def side(table: dict, k: str, op: str, i: int) -> dict:
        """Rows by (grow, bad) for which the condition holds."""
        out: dict = defaultdict(int)
        for (name, b), cell in table.items():
            if name == k and (b > i if op == ">=" else b <= i):
                for c, n in cell.items():
                    out[c] += n
        return out

    rules: list[Rule] = []
    left = F.lit(True)
    while len(rules) < max_rules:
        conds: list = []
        reached: list[dict] = []
        while len(conds) < max_conditions:
            table = counts(left & holds(conds))
            total = side(table, names[0], "<=", len(cuts[names[0]]))
            p0, n0 = total[True, True], total[True, False]
            if p0 < min_covered or n0 == 0:
                break
            best = (0.0, None, None)
            for k in names:
                for i in range(len(cuts[k])):
                    for op in (">=", "<"):
                        cell = side(table, k, op, i)
                        p, n = cell[True, True], cell[True, False]
                        if p >= min_covered:
                            gain = p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))
                            if gain > best[0] + 1e-9:
                                best = (gain, (k, op, i), cell)
            if best[1] is None:
                break
            conds.append(best[1])
            reached.append(best[2])
        if not conds:
            break
        worth = [(c[False, True] - c[False, False]) / (c[False, True] + c[False, False] + 1) for c in reached]
        size = max(range(len(worth)), key=lambda i: (worth[i], -i)) + 1
        cell = reached[size - 1]
        bad, good = cell[False, True] + cell[True, True], cell[False, False] + cell[True, False]
        if bad < min_precision * (bad + good) or worth[size - 1] < 0:
            break
        conds = conds[:size]
        rules.append(Rule(tuple(Condition(k, op, cuts[k][i]) for k, op, i in conds), bad + good, good))
        left = left & ~holds(conds)
    return rules


def verdict(rules: list[Rule], stats: dict[str, Column]) -> Column:
    """Number of the first rule that holds (from 0), null if none does: the
    ordered conditional expression of the list."""
    out = None
    for i, rule in enumerate(rules):
        cond = F.lit(True)
        for c in rule.conditions:
            x = stats[c.stat]
            cond = cond & ((x >= F.lit(c.cut)) if c.op == ">=" else (x < F.lit(c.cut)))
        out = F.when(cond, F.lit(i)) if out is None else out.when(cond, F.lit(i))
    return F.lit(None).cast("int") if out is None else out


def base_failed(s: Column, min_words: int = 20, max_repeat_percent: int = 30) -> Column:
    return (s["n_words"] < min_words) | (100 * s["n_repeat_words"] > max_repeat_percent * s["n_words"])


def counted(docs: DataFrame, stats: str) -> DataFrame:
    """doc_id and the struct ``stats`` of counts: what learning and judging need.
    Only this leaves the tasks that read the texts; texts are never shuffled."""
    return with_text_stats(docs.select("doc_id", "text"), stats).select("doc_id", stats)


def learn_quality_rules(counts: DataFrame, stats: str, labels: DataFrame, **how) -> list[Rule]:
    """Decision list from the counted documents that have a ``quality`` label (0:
    reject).

    Null labels and labels without a document teach nothing. A document with
    several labels counts once for each.
    """
    y = labels.select(F.col("doc_id").alias("_key"), F.col("quality").alias("_quality")).where("_quality is not null")
    rows = counts.join(y, F.col("doc_id") == F.col("_key"))
    return learn(rows, ratios(F.col(stats)), F.col("_quality"), F.col("doc_id"), **how)


def judge(df: DataFrame, stats: str, rules: list[Rule], out: str) -> DataFrame:
    """``df`` with a struct ``out`` in place of ``stats``: the counts, base_failed, the
    number of the rule that rejects (null: none) and kept."""
    s = F.col(stats)
    failed, rule = base_failed(s), verdict(rules, ratios(s))
    keep = [F.col(f"`{c}`") for c in df.columns if c not in (out, stats)]
    return df.select(*keep, F.struct(
        s["n_words"].alias("n_words"), s["word_chars"].alias("word_chars"), s["n_symbols"].alias("n_symbols"),
        s["n_dup_lines"].alias("n_dup_lines"), s["n_repeat_words"].alias("n_repeat_words"),
        failed.alias("base_failed"), rule.alias("rule"), (~failed & rule.isNull()).alias("kept")).alias(out))


def apply_quality_rules(docs: DataFrame, rules: list[Rule], out: str) -> DataFrame:
    """``docs`` with the struct ``out`` of ``judge``. Null text has no words and fails
    the base check. Equal rows get equal results; other columns stay."""
    (stats,) = fresh(docs, "_stats")
    return judge(with_text_stats(docs, stats), stats, rules, out)


def op3(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts and verdicts of all documents; the texts are read once."""
    counts = cut_lineage(counted(docs, "_stats"))
    rules = learn_quality_rules(counts, "_stats", labels)
    return judge(counts, "_stats", rules, "_r").select("doc_id", "_r.*")
