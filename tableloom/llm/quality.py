"""Quality rules: a decision list learned from labelled text statistics.

Sequential covering: a rule, a conjunction of thresholds, is grown on two
thirds of the labelled rows by information gain, pruned on the other third,
kept if it is precise there, and what it covers is put aside before the next.
Spark counts labels per statistic and bin; only these histograms, of a size
fixed by the number of statistics and cut points, reach the driver. The list is
emitted as one ordered conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_BREAK, let, packed, store, table
from .registry import query

WINDOW = 5
CUTS = 24
"""Cut points a statistic gets from each label's quantiles."""
MAX_RULES = 8
MAX_CONDITIONS = 4
PRECISION = 0.95
"""Share of a rule's rows, among those it was pruned on, that must be rejects."""
MIN_ROWS = 5
"""Rejects a rule must cover among the rows it was grown on."""

COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_exclaims", "n_digits", "n_distinct_words",
]


def _covered(windows: Column) -> Column:
    """Words in windows whose content occurs twice or more; ``windows``: a long each.

    Sorting (content, position) brings equal windows together; then one pass
    over the repeated positions adds the words each covers first.
    """
    def positions(sorted_pairs: Column) -> Column:
        def repeated(k: Column) -> Column:
            here = F.get(sorted_pairs, k)["x"]
            return (here == F.get(sorted_pairs, k - 1)["x"]) | (
                here == F.get(sorted_pairs, k + 1)["x"]
            )

        numbers = F.sequence(F.lit(0), F.size(sorted_pairs) - 1)
        kept = F.filter(numbers, lambda k: F.coalesce(repeated(k), F.lit(False)))
        return F.sort_array(F.transform(kept, lambda k: F.get(sorted_pairs, k)["i"]))

    pairs = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    return F.aggregate(
        let(pairs, positions),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, i: F.struct(
            (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")
        ),
        lambda a: a["n"],
    )


def _repeat_words(hashes: Column) -> Column:
    starts = F.sequence(F.lit(0), F.size(hashes) - WINDOW)
    windows = F.transform(
        starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)])
    )
    count = let(
        windows,
        lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(
            _covered(w)
        ),
    )
    return F.when(F.size(hashes) < WINDOW, F.lit(0).cast("long")).otherwise(count)


def text_counts(text: Column) -> Column:
    """Struct of ``COUNTS`` (longs) of a whole text; a null text counts as empty.

    Words are runs without white space (space, tab to carriage return). Repeated
    five-word windows are found by 64-bit hashes of their words.
    """
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, WORD_BREAK), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def of_words(w: Column) -> Column:
        return let(
            F.transform(w, lambda x: F.xxhash64(x)),
            lambda h: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.aggregate(
                    w, F.lit(0).cast("long"), lambda a, x: a + F.char_length(x)
                ).alias("word_chars"),
                _repeat_words(h).alias("n_repeat_words"),
                F.size(F.array_distinct(h)).cast("long").alias("n_distinct_words"),
            ),
        )

    def of_lines(x: Column) -> Column:
        return F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        )

    parts = F.struct(let(words, of_words).alias("w"), let(lines, of_lines).alias("l"))
    counted = {
        "n_symbols": "[#*$%&|<>]", "n_upper": r"\p{Lu}", "n_exclaims": "!", "n_digits": "[0-9]",
    }
    return let(
        parts,
        lambda p: F.struct(
            *[
                (
                    F.regexp_count(text, F.lit(counted[c])).cast("long")
                    if c in counted
                    else p["l"][c] if c.endswith("lines") else p["w"][c]
                ).alias(c)
                for c in COUNTS
            ]
        ),
    )


def base_failed(counts: Column) -> Column:
    return (counts["n_words"] < 10) | (100 * counts["n_repeat_words"] > 20 * counts["n_words"])


def statistics(counts: Column) -> dict[str, Column]:
    """What rules may ask about: counts and shares, never null."""
    words = F.greatest(counts["n_words"], F.lit(1))
    chars = F.greatest(counts["word_chars"], F.lit(1))
    lines = F.greatest(counts["n_lines"], F.lit(1))
    return {
        "n_words": counts["n_words"].cast("double"),
        "word_length": counts["word_chars"] / words,
        "symbols_per_word": counts["n_symbols"] / words,
        "exclaims_per_word": counts["n_exclaims"] / words,
        "upper_share": counts["n_upper"] / chars,
        "digit_share": counts["n_digits"] / chars,
        "dup_line_share": counts["n_dup_lines"] / lines,
        "repeat_share": counts["n_repeat_words"] / words,
        "distinct_share": counts["n_distinct_words"] / words,
        "words_per_line": counts["n_words"] / lines,
    }


@dataclass(frozen=True)
class Condition:
    statistic: str
    at_least: bool
    cut: float

    def holds(self, values: dict[str, Column]) -> Column:
        value = values[self.statistic]
        return value >= self.cut if self.at_least else value < self.cut

    def __str__(self) -> str:
        return f"{self.statistic} {'>=' if self.at_least else '<'} {self.cut:.6g}"


Rule = list[Condition]


def _both(conditions: list[Column]) -> Column:
    result = F.lit(True)
    for c in conditions:
        result = result & c
    return result


def learn_rules(
    labelled: DataFrame,
    names: list[str],
    reject: str = "reject",
    fold: str = "fold",
    max_rules: int = MAX_RULES,
    max_conditions: int = MAX_CONDITIONS,
    precision: float = PRECISION,
    min_rows: int = MIN_ROWS,
    cuts: int = CUTS,
) -> list[Rule]:
    """Decision list for ``reject`` (boolean) over the double columns ``names``.

    Rows with ``fold`` 0 prune, all others grow. All rows count. Without rejects
    or without rows the list is empty.
    """
    probabilities = [i / (cuts - 1) for i in range(cuts)]
    row = labelled.agg(
        *[
            F.percentile_approx(F.when(F.col(reject) == side, F.col(n)), probabilities, 10000).alias(
                f"{n}_{side}"
            )
            for n in names
            for side in (True, False)
        ]
    ).first()
    points = {}
    for n in names:
        seen = sorted({v for side in (True, False) for v in (row[f"{n}_{side}"] or [])})
        points[n] = [(a + b) / 2 for a, b in zip(seen, seen[1:])]  # as far from both as can be

    def bin_of(name: str) -> Column:
        """How many cut points the value reaches."""
        if not points[name]:
            return F.lit(0)
        reached = F.filter(F.array(*map(F.lit, points[name])), lambda p: p <= F.col(name))
        return F.size(reached)

    rows = store(
        labelled.select(
            F.col(reject).cast("int").alias("bad"),
            (F.col(fold) != 0).alias("grow"),
            F.array(*map(bin_of, names)).alias("bins"),
        ),
        "quality-bins",
    )

    def test(condition: tuple[int, bool, int]) -> Column:
        i, at_least, k = condition
        value = F.get("bins", F.lit(i))
        return value >= k if at_least else value < k

    def histogram(left: list, chosen: list) -> dict:
        rest = rows.filter(_both([~_both([test(c) for c in rule]) for rule in left]))
        rest = rest.filter(_both([test(c) for c in chosen]))
        counted = (
            rest.select("bad", "grow", F.posexplode("bins").alias("i", "k"))
            .groupBy("i", "k")
            .agg(
                F.sum(F.expr("int(grow AND bad = 1)")).alias("gp"),
                F.sum(F.expr("int(grow AND bad = 0)")).alias("gn"),
                F.sum(F.expr("int(NOT grow AND bad = 1)")).alias("pp"),
                F.sum(F.expr("int(NOT grow AND bad = 0)")).alias("pn"),
            )
        )
        return {(r["i"], r["k"]): (r["gp"], r["gn"], r["pp"], r["pn"]) for r in counted.collect()}

    def candidates(seen: dict):
        """Every threshold with the counts of the rows that meet it, and the total."""
        for i, n in enumerate(names):
            columns = [seen.get((i, k), (0, 0, 0, 0)) for k in range(len(points[n]) + 1)]
            total = tuple(map(sum, zip(*columns)))
            below = (0, 0, 0, 0)
            for k in range(1, len(columns)):
                below = tuple(a + b for a, b in zip(below, columns[k - 1]))
                yield (i, False, k), below, total
                yield (i, True, k), tuple(t - b for t, b in zip(total, below)), total

    learned: list[list[tuple[int, bool, int]]] = []
    while len(learned) < max_rules:
        rule, worths = [], []
        while len(rule) < max_conditions:
            best = None
            for condition, met, total in candidates(histogram(learned, rule)):
                if met[0] < min_rows or met[0] + met[1] == total[0] + total[1]:
                    continue
                gain = met[0] * (
                    math.log2(met[0] / (met[0] + met[1])) - math.log2(total[0] / (total[0] + total[1]))
                )
                if gain > 1e-9 and (best is None or gain > best[0]):
                    best = (gain, condition, met)
            if best is None:
                break
            rule.append(best[1])
            worths.append(best[2])
            if best[2][1] == 0:
                break
        if not rule:
            break
        # Prune: the shortest beginning of the rule that does best on the other rows.
        def worth(met):
            return (met[2] - met[3]) / (met[2] + met[3]) if met[2] + met[3] else -1.0

        length = max(range(1, len(rule) + 1), key=lambda m: (worth(worths[m - 1]), -m))
        pruned, met = rule[:length], worths[length - 1]
        if met[2] + met[3] == 0 or met[2] / (met[2] + met[3]) < precision:
            break
        learned.append(pruned)
    return [[Condition(names[i], up, points[names[i]][k - 1]) for i, up, k in r] for r in learned]


def verdict(rules: list[Rule], values: dict[str, Column]) -> Column:
    """Number (from 1) of the first rule that rejects the row, 0 if none does."""
    expression = F.lit(0)
    for number, rule in reversed(list(enumerate(rules, 1))):
        expression = F.when(_both([c.holds(values) for c in rule]), F.lit(number)).otherwise(expression)
    return expression


def rules_from_labels(
    counted: DataFrame, labels: DataFrame, id_column: str, counts: str = "counts"
) -> list[Rule]:
    """Rules learned from all rows of ``counted`` whose id ``labels`` marks 0 or 1.

    Rows that fail the base rule are rejected anyway and teach nothing. An id marked both ways counts as 0. Ids and labels that are null teach nothing.
    """
    marks = (
        labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("__marked"))
        .agg((F.min("quality") == 0).alias("reject"))
    )
    values = statistics(F.col(counts))
    passing = counted.filter(~base_failed(F.col(counts)))
    rows = passing.select(F.col(f"`{id_column}`").cast("long").alias("__id"), counts).join(
        marks, F.col("__id") == F.col("__marked")
    )
    labelled = store(
        rows.select(
            "reject",
            F.pmod(F.xxhash64("__id"), F.lit(3)).alias("fold"),
            *[v.alias(n) for n, v in values.items()],
        ),
        "quality-labelled",
    )
    return learn_rules(labelled, list(values))


def quality(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``id``, ``counts``, ``base_failed``, ``rule`` (0: none) and ``kept`` of every row.

    Null texts count as empty and fail the base rule, as does any text of fewer
    than ten words. Repeated rows get equal results; other columns are not read.
    """
    counted = store(
        docs.select(
            F.col(f"`{id_column}`").cast("long").alias("id"),
            text_counts(F.col(f"`{text}`")).alias("counts"),
        ),
        "quality-counts",
    )
    rules = rules_from_labels(counted, labels, "id")
    counts = F.col("counts")
    return counted.select(
        "id",
        "counts",
        base_failed(counts).alias("base_failed"),
        verdict(rules, statistics(counts)).alias("rule"),
    ).withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def keep_good(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that neither the base rule nor a learned rule rejects."""
    rows = store(
        packed(docs).select(
            "row",
            F.col(f"row.`{id_column}`").alias("id"),
            text_counts(F.col(f"row.`{text}`")).alias("counts"),
        ),
        "quality-rows",
    )
    rules = rules_from_labels(rows, labels, "id")
    counts = F.col("counts")
    good = ~base_failed(counts) & (verdict(rules, statistics(counts)) == 0)
    return rows.filter(good).select("row.*")


@query("op3_quality_rules")
def op3_quality_rules(spark, sf_dir):
    judged = quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        F.col("id").alias("doc_id"),
        *[F.col(f"counts.{c}").alias(c) for c in COUNTS[:5]],
        "base_failed",
        "kept",
        "rule",
    )
