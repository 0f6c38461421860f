"""Word statistics."""

from __future__ import annotations

from tallyspark import bindings as b
from tallyspark.plans import words as wd
from tallyspark.registry.core import query
from tallyspark.tables import table

WORDS_SQL = {
    "no_digits": """words AS (
  SELECT word FROM (SELECT unnest(regexp_split_to_array(text, '[\\x09-\\x0d\\x1c-\\x20\\x{85}\\p{Z}]+')) AS word FROM documents)
  WHERE word <> '' AND NOT regexp_matches(word, '[0-9]'))""",
    "letters": """words AS (
  SELECT word FROM (SELECT unnest(regexp_split_to_array(replace(text, '.', ''), '[\\x09-\\x0d\\x1c-\\x20\\x{85}\\p{Z}]+')) AS word FROM documents)
  WHERE regexp_matches(word, '^\\p{L}+$'))""",
    "ascii": """words AS (
  SELECT word FROM (SELECT unnest(regexp_split_to_array(lower(translate(text, '.,!?:''', '')), '[\\x09-\\x0d\\x1c-\\x20\\x{85}\\p{Z}]+')) AS word
                    FROM documents)
  WHERE regexp_matches(word, '^[a-zA-Z]+$'))""",
}


def _words(spark, sf, rule):
    return wd.words(b.documents(spark, sf), "text", rule)


def _register(rule: str, item: str) -> None:
    totals_sql = f"WITH {WORDS_SQL[rule]} SELECT count(*) AS words, count(DISTINCT word) AS distinct_words FROM words"

    @query(f"word_totals_{rule}", f"{item} TX4 AG20", sql=totals_sql)
    def totals(spark, sf):
        return wd.word_totals(wd.word_counts(_words(spark, sf, rule)))

    counts_sql = f"WITH {WORDS_SQL[rule]} SELECT word, count(*) AS count FROM words GROUP BY word"

    @query(f"word_counts_{rule}", f"{item} AG21 SC12", sql=counts_sql)
    def counts(spark, sf):
        return wd.word_counts(_words(spark, sf, rule))


for _rule, _item in (("no_digits", "TX1"), ("letters", "TX2"), ("ascii", "TX3")):
    _register(_rule, _item)


@query(
    "most_common_word", "AG22 FLT7",
    sql=f"""WITH {WORDS_SQL["ascii"]} SELECT word, count(*) AS count FROM words
            WHERE length(word) = 7 AND starts_with(word, 's') GROUP BY word ORDER BY count DESC, word LIMIT 1""",
)
def most_common_word(spark, sf):
    return wd.most_common(wd.word_counts(_words(spark, sf, "ascii")), 7, "s")


@query(
    "words_of_lines", "FLT6 SC21",
    sql=f"""WITH {b.LINES_SQL}, shown AS (SELECT substr(value, 1, 60) AS shown FROM lines
            WHERE regexp_matches(value, '\\S')) SELECT shown, count(*) AS n FROM shown GROUP BY shown""",
)
def words_of_lines(spark, sf):
    from pyspark.sql import functions as F

    lines = wd.text_lines(b.lines_of_text(spark, sf))
    return lines.groupBy(F.substring("value", 1, 60).alias("shown")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "tokens_of_conversations", "AG29 TX1",
    sql="""SELECT word, count(*) AS count
           FROM (SELECT unnest(regexp_split_to_array(text, '[\\x09-\\x0d\\x1c-\\x20\\x{85}\\p{Z}]+')) AS word FROM conversations)
           WHERE word <> '' AND NOT regexp_matches(word, '[0-9]') GROUP BY word""",
)
def tokens_of_conversations(spark, sf):
    return wd.word_counts(wd.words(table(spark, sf, "conversations"), "text"))
