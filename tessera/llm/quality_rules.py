"""Quality rules as weak supervision.

Each rule votes for or against a text or abstains. Expectation-maximisation estimates how each
rule votes on good and on bad texts from the counts of vote patterns alone, and the posterior
probability of a good text replaces the demand that every rule passes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import text_or_empty, without_white_space, written
from tessera.llm.text_stats import lines_with_words, n_equal_earlier, n_repeat_words, n_symbols, words

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: What a rule has to be, to be one: rarely against a good text, and sometimes against a bad one.
MOST_FALSE_ALARMS = 0.001
LEAST_ALARMS = 0.05


@dataclass(frozen=True)
class Rule:
    """Votes -1 where ``value`` is beyond ``bad``, 1 where it is within ``good`` (None: nowhere), else abstains."""

    name: str
    value: str
    bad: float
    good: float | None = None
    low_is_bad: bool = False

    def vote(self) -> Column:
        v = F.expr(self.value)
        vote = F.when(v < self.bad if self.low_is_bad else v > self.bad, -1)
        if self.good is not None:
            vote = vote.when(v > self.good if self.low_is_bad else v < self.good, 1)
        return vote.otherwise(0)


#: Over the statistics of text_statistics(); shares are of words unless named otherwise. That one
#: fault is absent says little about a text, so most rules vote against or abstain.
RULES = (
    Rule("symbols", "n_symbols / greatest(n_words, 1)", 0.2),
    Rule("plain words", "(n_plain - n_stutter) / greatest(n_words, 1)", 0.6, 0.9, low_is_bad=True),
    Rule("shouting", "n_upper / greatest(word_chars, 1)", 0.5),
    Rule("exclamations", "n_exclamations / greatest(n_words, 1)", 0.3),
    Rule("word repetition", "n_stutter / greatest(n_words, 1)", 0.3),
    Rule("passage repetition", "n_repeat_words / greatest(n_words, 1)", 0.25),
    Rule("line repetition", "n_dup_lines / greatest(n_lines, 1)", 0.3),
    Rule("distinct words", "n_distinct / greatest(n_words, 1)", 0.08, low_is_bad=True),
    Rule("long words", "word_chars / greatest(n_words, 1)", 25.0),
    Rule("short words", "word_chars / greatest(n_words, 1)", 1.5, low_is_bad=True),
)


def text_statistics(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` with the counts that the rules read."""
    text = F.col("text")
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
        .select("doc_id", "text", words(text).alias("words"), lines_with_words(text).alias("lines"))
        .select(
            "doc_id", F.size("words").cast("long").alias("n_words"),
            F.char_length(without_white_space(text)).cast("long").alias("word_chars"), n_symbols(text).alias("n_symbols"),
            n_equal_earlier(F.col("lines")).alias("n_dup_lines"), n_repeat_words(F.col("words")).alias("n_repeat_words"),
            F.size("lines").cast("long").alias("n_lines"),
            F.size(F.filter("words", lambda w: w.rlike(r"^\p{L}+[.,;:!?]?$"))).cast("long").alias("n_plain"), F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
            F.regexp_count(text, F.lit("!")).cast("long").alias("n_exclamations"),
            F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
            F.size(F.filter("words", lambda w, i: (i > 0) & (w == F.get(F.col("words"), F.greatest(i - 1, F.lit(0)))))).cast("long").alias("n_stutter"))
    )


@dataclass(frozen=True)
class VoteModel:
    """Share of good texts, and for each rule the chances of the votes -1, 0, 1 on bad and on good texts."""

    good: float
    chances: tuple[tuple[tuple[float, float, float], tuple[float, float, float]], ...]

    def log_odds(self, votes: tuple[int, ...]) -> float:
        total = math.log(self.good / (1 - self.good))
        for v, (bad, good) in zip(votes, self.chances, strict=True):
            total += math.log(good[v + 1] / bad[v + 1])
        return total


def _bounded(votes: list[float], least: float, most: float) -> tuple[float, float, float]:
    """Shares of the votes, that of the votes against within its bounds."""
    against = min(most, max(least, votes[0] / sum(votes)))
    others = votes[1] + votes[2]
    return against, (1 - against) * votes[1] / others, (1 - against) * votes[2] / others


def estimate_votes(patterns: dict[tuple[int, ...], int], n_rules: int, rounds: int = 200, tolerance: float = 1e-9) -> VoteModel:
    """Expectation-maximisation over pattern counts, of which there are at most 3 ** n_rules.

    Starts from rules that are mostly right. Half a vote of each kind is added to every count, so
    no chance is 0 and an unseen vote stays possible. The bounds on alarms keep a few rules that
    agree with each other from making every other rule's alarms into noise on good texts.
    """
    start = ((0.3, 0.3, 0.4), (MOST_FALSE_ALARMS, 0.199, 0.8))
    model = VoteModel(0.8, (start,) * n_rules)
    total = sum(patterns.values())
    for _ in range(rounds if total else 0):
        weight = [0.0, 0.0]
        votes = [[[0.5] * 3, [0.5] * 3] for _ in range(n_rules)]
        for pattern, n in patterns.items():
            p = 1 / (1 + math.exp(-max(-700.0, min(700.0, model.log_odds(pattern)))))
            for side, share in ((0, n * (1 - p)), (1, n * p)):
                weight[side] += share
                for k, v in enumerate(pattern):
                    votes[k][side][v + 1] += share
        good = min(0.99, max(0.01, weight[1] / total))
        chances = tuple((_bounded(bad, LEAST_ALARMS, 1.0), _bounded(good_votes, 0.0, MOST_FALSE_ALARMS)) for bad, good_votes in votes)
        moved = max([abs(good - model.good)] + [
            abs(x - y) for new, old in zip(chances, model.chances, strict=True)
            for r, s in zip(new, old, strict=True) for x, y in zip(r, s, strict=True)])
        model = VoteModel(good, chances)
        if moved < tolerance:
            break
    return model


def posterior(model: VoteModel, rules: tuple[Rule, ...] = RULES) -> Column:
    """The probability that a text is good, as a column over its votes."""
    odds = F.lit(math.log(model.good / (1 - model.good)))
    for rule, (bad, good) in zip(rules, model.chances, strict=True):
        vote = rule.vote()
        odds = odds + F.when(vote == -1, math.log(good[0] / bad[0])).when(vote == 0, math.log(good[1] / bad[1])).otherwise(
            math.log(good[2] / bad[2]))
    return 1 / (1 + F.exp(-odds))


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, quality.

    Words are runs of characters other than ``[\\x20\\x09-\\x0D]``; null texts have none and fail the
    base rules (fewer than 20 words, or over 30 % of words in repeated 8-word windows). Other texts
    stay if their posterior probability ``quality`` is 0.5 or more. All statistics and vote patterns
    are over all rows; repeated rows count each. An empty table gives an empty result; extra
    columns are ignored.
    """
    stats = written(text_statistics(docs), "quality-stats")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    names = [f"v{k}" for k in range(len(rules))]
    counted = stats.select(*[r.vote().alias(v) for r, v in zip(rules, names, strict=True)]).groupBy(*names).count().collect()
    model = estimate_votes({tuple(row[v] for v in names): row["count"] for row in counted}, len(rules))
    return stats.withColumn("quality", posterior(model, rules)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (F.col("quality") >= 0.5)).alias("kept"), "quality")
