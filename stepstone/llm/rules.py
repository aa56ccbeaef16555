"""Quality rules under weak supervision: rules vote or abstain, and a posterior replaces "all must pass".

Only DataFrame expressions are used.  Texts are read once into a thin table of counts and votes.  Votes repeat, so
expectation-maximisation runs over the table of vote patterns, of which there are at most 3 ** (number of rules).
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stepstone.llm.registry import documents, query
from stepstone.session import cut

WHITE = " \t\n\x0b\x0c\r"
BETWEEN_WORDS, IN_WORD = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
LATIN_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝ"
#: Frequent function words of English, German, French and Spanish.
FUNCTION_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "for", "it", "was", "on", "with", "by", "this", "are",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "nicht", "ein", "eine",
    "de", "la", "le", "et", "les", "un", "une", "du", "en", "est", "que", "pour", "qui", "dans", "par", "sur",
    "el", "y", "los", "se", "del", "las", "por", "con", "no", "para", "al", "lo",
)
MIN_WORDS, MOST_REPEATED_PERCENT = 50, 50
ITERATIONS, KEEP_FROM = 20, 0.5
#: Where expectation-maximisation starts: good rows are seldom flagged, and a rule sees only some of what is bad.
FIRST_GOOD, FIRST_BAD, FIRST_PRIOR = 0.98, 0.3, 0.8
#: Weight of these first accuracies in every step, as a share of all rows, so that rare kinds of bad rows don't vanish.
GOOD_WEIGHT, BAD_WEIGHT, MOST = 0.5, 0.05, 0.9995


@dataclass(frozen=True)
class Rule:
    """Votes 1 (good) where ``good`` holds, else 0 (bad) where ``bad`` holds, else abstains with -1."""

    name: str
    good: Callable[[], Column]
    bad: Callable[[], Column]

    def vote(self) -> Column:
        return F.when(self.good(), 1).when(self.bad(), 0).otherwise(-1).cast("int")


def _per_word(count: str) -> Column:
    return F.col(count) / F.greatest(F.col("n_words"), F.lit(1))


RULES = (
    Rule("length", lambda: F.col("n_words") >= 100, lambda: F.col("n_words") < MIN_WORDS),
    Rule("word_size", lambda: _per_word("word_chars").between(3.5, 9), lambda: ~_per_word("word_chars").between(2.5, 12)),
    Rule("symbols", lambda: _per_word("n_symbols") < 0.02, lambda: _per_word("n_symbols") > 0.15),
    Rule("lines", lambda: F.col("n_dup_lines") * 20 <= F.col("n_lines"), lambda: F.col("n_dup_lines") * 4 > F.col("n_lines")),
    Rule("repetition", lambda: _per_word("n_repeat_words") < 0.1, lambda: _per_word("n_repeat_words") > 0.3),
    Rule("capitals", lambda: _per_word("n_capitals") < 0.6, lambda: _per_word("n_capitals") > 2),
    Rule("function_words", lambda: _per_word("n_function_words") > 0.1, lambda: _per_word("n_function_words") < 0.02),
    Rule("exclamation", lambda: _per_word("n_exclamations") < 0.02, lambda: _per_word("n_exclamations") > 0.2),
)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once a row, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _count_of(text: Column, letters: str) -> Column:
    return (F.char_length(text) - F.char_length(F.translate(text, letters, ""))).cast("bigint")


def _repeated_words(words: Column) -> Column:
    """Words inside a window of three words that the text holds twice or more."""

    def windows(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")),
        )

    def repeated(w: Column, s: Column) -> Column:
        """Positions of windows that equal a neighbour in the order of hashes; equal hashes are checked word by word."""

        def same(a: Column, b: Column) -> Column:
            return (a["h"] == b["h"]) & reduce(
                lambda x, y: x & y, [F.get(w, a["i"] + k) == F.get(w, b["i"] + k) for k in range(3)]
            )

        flags = F.transform(
            s,
            lambda x, k: F.when(
                F.coalesce(same(x, F.get(s, k - 1)), F.lit(False)) | F.coalesce(same(x, F.get(s, k + 1)), F.lit(False)), x["i"]
            ),
        )
        return F.sort_array(F.filter(flags, lambda x: x.isNotNull()))

    def covered(places: Column) -> Column:
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("n"))
        return F.aggregate(
            places,
            start,
            lambda acc, x: F.struct(x.alias("last"), (acc["n"] + F.least(F.lit(3), x - acc["last"])).alias("n")),
            lambda acc: acc["n"],
        )

    def of(w: Column) -> Column:
        return let(
            windows(w),
            lambda s: F.when(
                F.size(F.array_distinct(F.transform(s, lambda x: x["h"]))) < F.size(s),
                let(F.sort_array(s), lambda ordered: covered(repeated(w, ordered))),
            ).otherwise(F.lit(0).cast("bigint")),
        )

    return F.when(F.size(words) >= 3, of(words)).otherwise(F.lit(0).cast("bigint"))


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of every row; a null or empty text has none.  Only the id comes along, under its own name."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(IN_WORD))
    words = F.array_remove(F.split(text, BETWEEN_WORDS), "")
    # one struct for what the word list gives, so that texts are split once
    by_word = let(
        words,
        lambda w: F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            _repeated_words(w).alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: F.lower(x).isin(*FUNCTION_WORDS))).cast("bigint").alias("n_function_words"),
        ),
    )
    by_line = let(
        lines,
        lambda x: F.struct(
            F.size(x).cast("bigint").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines")
        ),
    )
    read = docs.select(
        F.col(id_col),
        by_word.alias("_w"),
        by_line.alias("_l"),
        F.char_length(F.translate(text, WHITE, "")).cast("bigint").alias("word_chars"),
        _count_of(text, SYMBOLS).alias("n_symbols"),
        _count_of(text, LATIN_CAPITALS).alias("n_capitals"),
        _count_of(text, "!").alias("n_exclamations"),
    )
    return read.select(
        id_col, "_w.n_words", "word_chars", "n_symbols", "_l.n_dup_lines", "_w.n_repeat_words",
        "_l.n_lines", "n_capitals", "n_exclamations", "_w.n_function_words",
    )


@dataclass(frozen=True)
class Accuracy:
    """Chance that a vote is right, for rows that are good and for rows that are bad."""

    good: float = FIRST_GOOD
    bad: float = FIRST_BAD

    def weights(self) -> list[float]:
        """Log likelihood ratios of an abstention, a bad vote and a good vote."""
        return [0.0, math.log((1 - self.good) / self.bad), math.log(self.good / (1 - self.bad))]


def posterior(accuracies: list[Accuracy], prior: float) -> Column:
    """Probability that a row with columns vote_0, vote_1, ... is good.

    Weights sit in array literals that a vote picks from, so each iteration runs the code compiled for the first.
    """
    start = math.log(prior / (1 - prior))
    odds = reduce(
        lambda x, y: x + y,
        [
            F.get(F.array(*[F.lit(w + (start if k == 0 else 0.0)) for w in a.weights()]), F.col(f"vote_{k}") + 1)
            for k, a in enumerate(accuracies)
        ],
    )
    return 1 / (1 + F.exp(-odds))


def fit_accuracies(votes: DataFrame, n_rules: int, iterations: int = ITERATIONS) -> tuple[list[Accuracy], float]:
    """Accuracies of each rule's votes and the share of good rows, by expectation-maximisation over vote patterns.

    All rows count.  A rule that never votes keeps its first accuracy; no rows at all leave everything as it began.
    """
    names = [f"vote_{k}" for k in range(n_rules)]
    patterns = cut(votes.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).coalesce(1), "patterns")
    accuracies, prior = [Accuracy()] * n_rules, FIRST_PRIOR

    def share(right: float | None, voted: float | None, first: float, weight: float) -> float:
        return min(((right or 0.0) + weight * first) / ((voted or 0.0) + weight), MOST)

    for _ in range(iterations):
        split = patterns.withColumn("good", F.col("n") * posterior(accuracies, prior)).withColumn("bad", F.col("n") - F.col("good"))
        sums = [F.sum("n").alias("rows"), F.sum("good").alias("good")]
        for k, name in enumerate(names):
            for kind, vote in (("good", 1), ("bad", 0)):
                sums.append(F.sum(F.when(F.col(name) == vote, F.col(kind))).alias(f"{kind}_right_{k}"))
                sums.append(F.sum(F.when(F.col(name) >= 0, F.col(kind))).alias(f"{kind}_voted_{k}"))
        row = split.agg(*sums).first()
        if not row["rows"]:
            break
        prior = min(max(row["good"] / row["rows"], 0.001), 0.999)
        accuracies = [
            Accuracy(
                share(row[f"good_right_{k}"], row[f"good_voted_{k}"], FIRST_GOOD, GOOD_WEIGHT * row["rows"]),
                share(row[f"bad_right_{k}"], row[f"bad_voted_{k}"], FIRST_BAD, BAD_WEIGHT * row["rows"]),
            )
            for k in range(n_rules)
        ]
    return accuracies, prior


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, counts, base_failed, quality, kept) of every row.

    ``base_failed``: fewer than 50 words, or over half of the words in repeated windows; such rows are not kept.  Of the
    others those are kept whose posterior probability to be good is at least one half.
    """
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    read = counts(docs, id_col, text_col)
    voted = cut(read.select("*", *[r.vote().alias(f"vote_{k}") for k, r in enumerate(rules)], base.alias("base_failed")), "votes")
    accuracies, prior = fit_accuracies(voted, len(rules))
    quality = posterior(accuracies, prior)
    return voted.select(
        id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        quality.alias("quality"), (~F.col("base_failed") & (quality >= KEEP_FROM)).alias("kept"),
    )


@query("op10_rule_votes")
def rule_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir))
