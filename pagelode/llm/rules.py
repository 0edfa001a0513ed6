"""Operator 5: quality rules, a learned decision list over document statistics.

`statistics` counts words, symbols, repeated lines and repeated three-word windows inside each row:
no shuffle, and `n log n` steps in a text's length. `learn` fits an ordered list of rules that reject
documents by sequential covering: a rule grows by the threshold condition of highest information
gain on two thirds of the labelled rows, is pruned back to the prefix that does best on the other
third, and stays if it is precise there; the rows that it covers go, and the next rule grows from
the rest, with thresholds taken anew. If it is not, the conditions that are precise alone have their
turn, and if none stays, the cell is set aside and a rule grows elsewhere, until the best of all is no
better than chance. All labelled rows take part: every step is an aggregate over them, and only sums
per threshold, or at most `FEW_ROWS` values, reach the driver. `decision` is the list as one Spark conditional
expression, `as_sql` the same as text.

Null text: no words, base_failed. Null doc_id: has its row, takes no label. Several labels of a
document: each counts. No labels or one class: no rules, what passes the base stays. Empty table: no
rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelode.llm.common import query, stored, table

WHITE = " \t\n\x0b\x0c\r"
NOT_WORD = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["words", "word_length", "symbol_share", "dup_lines", "repeat_share", "upper_share", "mark_share", "distinct_share"]
# Quantiles at which thresholds are tried, of the rows of label 0 that no rule covers: close together where
# junk would lie. Of label 1, where its tails end. The best threshold is refined between its neighbours.
QUANTILES = [0.0, 0.005, 0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.5, 0.7, 0.8, 0.85, 0.9, 0.95, 0.98, 0.99, 0.995, 1.0]
TAILS = [0.0, 0.001, 0.01, 0.99, 0.999, 1.0]
EVENLY = [k / 32 for k in range(33)]
# So many rows' values are compared one by one.
FEW_ROWS = 2000


def let(value: Column, body) -> Column:
    """body(value) with value worked out once, also inside lambdas of the body."""
    return F.transform(F.array(value), body)[0]


def repeat_words(words: Column) -> Column:
    """Words that lie in three-word windows found twice or more in the array."""

    def covered(places: Column) -> Column:
        # Window starts in order: each covers three words, or those up to the next start.
        gaps = F.transform(places, lambda p, k: F.least(F.coalesce(F.get(places, k + 1) - p, F.lit(3)), F.lit(3)))
        return F.aggregate(gaps, F.lit(0), lambda a, g: a + g)

    def repeated(ordered: Column) -> Column:
        def same(x, k, d):
            return F.coalesce(F.get(ordered, k + d)["h"] == x["h"], F.lit(False))
        twice = F.filter(ordered, lambda x, k: same(x, k, -1) | same(x, k, 1))
        return let(F.sort_array(F.transform(twice, lambda x: x["i"])), covered)

    def windows(w: Column) -> Column:
        starts = F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0)))
        return F.transform(starts, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))

    def counted(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(let(ordered, repeated))

    return F.when(F.size(words) < 4, 0).otherwise(let(words, lambda w: let(windows(w), counted)))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, the counts of the base, and counts of capitals, marks and distinct words."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    trimmed = F.btrim(text, F.lit(WHITE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, NOT_WORD))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")

    def measured(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeat_words(w).cast("long").alias("n_repeat_words"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct"))

    def left(pattern: str) -> Column:
        return F.length(F.regexp_replace(text, pattern, "")).cast("long")

    return docs.select(
        F.col("doc_id").cast("long"),
        let(words, measured).alias("m"),
        (F.length(text) - left(SYMBOL)).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        left(r"[^\p{Lu}]+").alias("n_upper"),
        left(r"[\p{L}\p{N}\x20\x09-\x0D]+").alias("n_marks"),
    ).select("doc_id", "m.*", "n_symbols", "n_dup_lines", "n_upper", "n_marks")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def features() -> dict[str, Column]:
    """Shares that do not depend on a text's length, and the length itself."""
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    values = [F.col("n_words"), F.col("word_chars") / words, F.col("n_symbols") / chars, F.col("n_dup_lines"),
              F.col("n_repeat_words") / words, F.col("n_upper") / chars, F.col("n_marks") / chars, F.col("n_distinct") / words]
    return {name: value.cast("double") for name, value in zip(FEATURES, values)}


@dataclass(frozen=True)
class Condition:
    """feature > threshold if above, else feature <= threshold."""

    feature: str
    above: bool
    threshold: float

    def column(self, values: dict[str, Column]) -> Column:
        value = values[self.feature]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold!r}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]

    def column(self, values: dict[str, Column]) -> Column:
        out = F.lit(True)
        for c in self.conditions:
            out = out & c.column(values)
        return out

    def __str__(self) -> str:
        return " AND ".join(map(str, self.conditions))


def decision(rules: list[Rule], values: dict[str, Column] | None = None) -> Column:
    """Number of the first rule that rejects a document, from 1; 0 if none does."""
    values = values or features()
    out = None
    for number, rule in enumerate(rules, 1):
        out = F.when(rule.column(values), number) if out is None else out.when(rule.column(values), number)
    return F.lit(0) if out is None else out.otherwise(0)


def as_sql(rules: list[Rule]) -> str:
    return "CASE " + " ".join(f"WHEN {r} THEN {n}" for n, r in enumerate(rules, 1)) + " ELSE 0 END" if rules else "0"


def _gain(p0: float, n0: float, p: float, n: float) -> float:
    """Information gain for the p rows still covered (all counts of two classes)."""
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def _surprise(p0: float, n0: float, p: float, n: float) -> float:
    """Bits by which p and n of p0 and n0 rows differ from a draw without regard to the class."""
    base, share = p0 / (p0 + n0), p / (p + n)
    return p * math.log2(share / base) + (n * math.log2((1 - share) / (1 - base)) if n else 0.0)


class _Grid:
    """Thresholds per feature, and the rows of both classes in the cells between them."""

    def __init__(self, rows: DataFrame, cuts: dict[str, list[float]]):
        self.cuts = cuts
        steps = [F.struct(F.lit(f).alias("feature"), sum(((F.col(f) > t).cast("int") for t in ts), F.lit(0)).alias("step")) for f, ts in cuts.items()]
        self.cells = {f: [[0, 0] for _ in range(len(ts) + 1)] for f, ts in cuts.items()}
        found = rows.select("label", F.explode(F.array(*steps)).alias("at")).groupBy("label", "at.feature", "at.step").count()
        for label, feature, step, n in found.collect():
            self.cells[feature][step][label] += n
        self.totals = [sum(x) for x in zip(*next(iter(self.cells.values())))]

    def conditions(self, feature: str, totals: list[int], below: list[int]):
        """Each threshold's place and its two conditions with the rows (label 0, label 1) that meet them."""
        for step, t in enumerate(self.cuts[feature]):
            below = [b + x for b, x in zip(below, self.cells[feature][step])]
            yield step, Condition(feature, False, t), below
            yield step, Condition(feature, True, t), [x - b for x, b in zip(totals, below)]


def _thresholds(rows: DataFrame, names: list[str], quantiles: tuple[list[float], list[float]]) -> dict[str, list[float]]:
    """The quantiles of the rows of label 0 and of label 1."""
    got = rows.agg(*[F.percentile_approx(F.when(F.col("label") == y, F.col(f)), quantiles[y], 10_000).alias(f"{f}_{y}")
                     for f in names for y in (0, 1)]).first()
    return {f: sorted({t for y in (0, 1) for t in got[f"{f}_{y}"] or []}) for f in names}


def _refined(rows: DataFrame, grid: _Grid, best: Condition, gain_of) -> Condition:
    """The best threshold among all values between the neighbours of the one found on the grid."""
    f, totals = best.feature, grid.totals
    step, cuts, cells, before = grid.cuts[f].index(best.threshold), grid.cuts[f], grid.cells[f], [0, 0]
    best_gain = max((gain_of(*x) for _, c, x in grid.conditions(f, totals, before) if c == best), default=0.0)
    low = high = None
    while True:
        low, high = (cuts[step - 1] if step else low), (cuts[step + 1] if step + 1 < len(cuts) else high)
        before = [b + sum(c[y] for c in cells[:step]) for y, b in enumerate(before)]
        inside = rows.where((F.col(f) > low if low is not None else F.lit(True)) & (F.col(f) <= high if high is not None else F.lit(True)))
        if sum(map(sum, cells[step:step + 2])) <= FEW_ROWS:
            found: dict[float, list[int]] = {}
            for value, label, n in inside.groupBy(f, "label").count().collect():
                found.setdefault(value, [0, 0])[label] += n
            below, values = before, sorted(found)
            for x, y in zip(values, values[1:]):
                below = [b + n for b, n in zip(below, found[x])]
                met = [t - b for t, b in zip(totals, below)] if best.above else below
                if (gain := gain_of(*met)) >= best_gain:
                    best, best_gain = Condition(f, best.above, x + (y - x) / 2), gain
            return best
        cut = sorted({*_thresholds(inside, [f], (EVENLY, EVENLY))[f], best.threshold})
        finer = _Grid(inside, {f: cut})
        for _, c, x in finer.conditions(f, totals, before):
            if c.above == best.above and (gain := gain_of(*x)) > best_gain:
                best, best_gain = c, gain
        step, cuts, cells = finer.cuts[f].index(best.threshold), finer.cuts[f], finer.cells[f]
        # Equal values may keep the neighbours where they are.
        if (step == 0 or cuts[step - 1] == low) and (step + 1 == len(cuts) or cuts[step + 1] == high):
            return best


def _widened(rows: DataFrame, found: list[Condition]) -> list[Condition]:
    """Each threshold halfway to the next value of the rows."""
    after = rows.agg(*[F.min(F.when(F.col(c.feature) > c.threshold, F.col(c.feature))).alias(str(k)) for k, c in enumerate(found)]).first()
    return [c if y is None else Condition(c.feature, c.above, c.threshold + (y - c.threshold) / 2) for c, y in zip(found, after)]


def learn(labelled: DataFrame, max_conditions: int = 3, min_precision: float = 0.9, min_rows: int = 5) -> list[Rule]:
    """Rules from rows with the features and `label` (1: keep, 0: reject); null labels are left out."""
    known = stored(labelled.where(F.col("label").isin(0, 1)).select(
        F.col("label").cast("int"), (F.pmod(F.xxhash64("doc_id"), F.lit(3)) < 2).alias("grow"), F.lit(False).alias("aside"), *FEATURES), "labelled")
    values = {f: F.col(f) for f in FEATURES}

    def covers(conditions) -> Column:
        return Rule(tuple(conditions)).column(values)

    def totals(wanted: list[tuple[Condition, ...]], rows: DataFrame) -> list[tuple[int, int]]:
        """(label 0, label 1) of the rows that meet each list of conditions: one aggregate without keys."""
        got = rows.agg(*[F.count_if(covers(c) & (F.col("label") == y)) for c in wanted for y in (0, 1)]).first()
        return list(zip(got[::2], got[1::2]))

    rules: list[Rule] = []
    free, aside, tests = F.lit(True), F.col("aside"), 0
    while True:
        if tests == 16:  # else the expressions grow with the rules
            known = stored(known.where(free).withColumn("aside", aside), "labelled")
            free, aside, tests = F.lit(True), F.col("aside"), 0
        tests += 1
        growing = known.where(free & F.col("grow") & ~aside)
        conditions: list[Condition] = []
        tails: list[Condition] = []
        cost, first = 0.0, None
        for _ in range(max_conditions):
            rows = growing.where(covers(conditions))
            cuts = _thresholds(rows, FEATURES, (QUANTILES, TAILS))
            if not all(cuts.values()):
                break
            grid = _Grid(rows, cuts)
            p0, n0 = grid.totals
            if not (p0 and n0):
                break
            first = first or (p0, n0)

            def gain_of(p: int, n: int) -> float:
                return _gain(p0, n0, p, n) if p >= min_rows else 0.0

            found = [(c, x) for f in FEATURES for _, c, x in grid.conditions(f, grid.totals, [0, 0])]
            best, counts = max(found, key=lambda cx: gain_of(*cx[1]))
            if gain_of(*counts) <= 1e-9:
                break
            if not conditions:  # what is precise alone, however few rows it has: the widest of each feature and side
                for f in FEATURES:
                    for above in (False, True):
                        precise = [(x[0], c) for c, x in found if c.feature == f and c.above == above
                                   and x[0] >= min_rows and x[0] >= min_precision * sum(x)]
                        tails += [max(precise, key=lambda pc: pc[0])[1]] if precise else []
                tails = _widened(growing, tails) if tails else []
            conditions.append(_refined(rows, grid, best, gain_of))
            cost += math.log2(2 * len(FEATURES) * (p0 + n0))  # bits to name a condition
        if not conditions:
            break
        prefixes = [tuple(conditions[:k]) for k in range(1, len(conditions) + 1)]
        met = totals([*prefixes, *((c,) for c in tails)], known.where(free & ~F.col("grow")))

        def holds(p: int, n: int) -> bool:
            return p >= max(min_rows // 2, 1) and p >= min_precision * (p + n)

        k = max(range(len(prefixes)), key=lambda k: ((met[k][0] - met[k][1]) / sum(met[k]) if sum(met[k]) else -1.0, -k))
        alone = [i for i in range(len(prefixes), len(met)) if holds(*met[i])]
        if holds(*met[k]) or alone:
            rule = prefixes[k] if holds(*met[k]) else (tails[max(alone, key=lambda i: met[i][0]) - len(prefixes)],)
            rules.append(Rule(rule))
            free = free & ~covers(rule)
            continue
        # None holds on the other third. Grow elsewhere, unless the best of all is as good as chance.
        surprise = _surprise(*first, *totals([tuple(conditions)], growing)[0])
        if surprise < cost:
            break
        aside = aside | covers(conditions)
    return rules


def quality_rules(docs: DataFrame, labels: DataFrame, **options) -> tuple[DataFrame, list[Rule]]:
    """Statistics with base_failed, rule (number of the rejecting rule, 0 if none) and kept; and the rules."""
    counted = stored(statistics(docs), "statistics")
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("label"))
    rules = learn(counted.join(known, "doc_id").select("doc_id", "label", *[c.alias(n) for n, c in features().items()]), **options)
    judged = counted.withColumn("base_failed", base_failed()).withColumn("rule", decision(rules).cast("int"))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0)), rules


@query("op5_quality_rules")
def op5(spark, sf_dir):
    out, _ = quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", *COUNTS, "base_failed", "kept", "rule")
