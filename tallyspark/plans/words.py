"""Word statistics of text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.words import not_blank, word_rule


def text_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    return lines.filter(not_blank(value))


def words(lines: DataFrame, value: str = "value", rule: str = "no_digits") -> DataFrame:
    """One row per word of every line; see ``WORD_RULES`` for the rules."""
    candidates, valid = word_rule(value, rule)
    return lines.select(F.explode(candidates).alias("word")).filter(valid(F.col("word")))


def word_counts(words: DataFrame) -> DataFrame:
    """Occurrences per word. Counts are combined before the shuffle, so a very
    frequent word costs one row per map task."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def word_totals(counts: DataFrame) -> DataFrame:
    """Words and distinct words, from the counts: no second pass, no distinct."""
    return counts.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("words"),
        F.count(F.lit(1)).alias("distinct_words"),
    )


def most_common(counts: DataFrame, length: int, prefix: str) -> DataFrame:
    """Most frequent word of a length and prefix; alphabetical among equals."""
    return (
        counts.filter((F.length("word") == length) & F.col("word").startswith(prefix))
        .orderBy(F.desc("count"), F.asc("word"))
        .limit(1)
    )
