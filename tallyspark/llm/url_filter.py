"""URL filter: host and path rules, else the ratio of two character models.

The rules give the examples: URLs that a rule allows train a model of accepted
URLs, those that a rule blocks a model of rejected ones. Both are Markov models
of variable order. The chance of a character after a context of up to
``ORDER`` - 1 characters is smoothed with the chance after the context without
its first character, down to an even chance: a model that saw the context ``t``
times and the character after it ``n`` times says (n + s * shorter) / (t + s),
and s * shorter / (t + s) if it never saw them together. So the chances after a
context add up to one.

What scoring needs of both models is one number per character sequence, the
difference of the log chances of its last character, and one per context, the
difference of both ln(s / (t + s)). All sequences and contexts of the examples
are kept, in written tables that grow with the input. Of a URL every character
is judged by its window, the last ``ORDER`` characters up to it: the value of a
window is that of its longest end that the examples hold, plus those of the
known contexts of all longer ends. Values are joined to the distinct windows of
the input, length by length. Windows that
make up at least one of ``FREQUENT`` parts of all characters, which are
``FREQUENT`` at most, are then broadcast; the others are counted per URL and
joined by shuffling. Sums are exact in steps of 2^-``STEP_BITS``, so they do not
depend on the order of rows.

The sum of the differences over a URL, divided by its length, is compared with
a limit. The limit is the one that separates the examples best which were held
back from training (every fifth by a hash).

All steps are DataFrame operations.

Defined results: NULL and texts without ``://`` have empty host and path, fit
no rule and are scored as they are; repeated URLs train once but are judged
each; without examples of both kinds the limit is 0 and everything without a
rule is allowed; columns named like a result are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import with_new_columns, written

ORDER = 4
SMOOTHING = 1.0
ALPHABET = 256
FREQUENT = 1 << 16
STEP_BITS = 40
HELD_BACK = 5
BINS_PER_UNIT, LAST_BIN = 200, 4000
END = "\x03"
RESULTS = ("host", "path", "rule", "verdict", "score")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A host with its subdomains and the start of a path."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def rule(verdict: str, text: str) -> Rule:
    """A rule from text like ``example.com/en/``."""
    host, slash, path = text.partition("/")
    return Rule(verdict, host, slash + path)


def with_parts(df: DataFrame, url: str, host: str, path: str) -> DataFrame:
    """Add host (ASCII lower case) and path of a URL."""
    whole = F.col(url)
    at = F.locate("://", whole)
    rest = F.when(F.coalesce(at, F.lit(0)) > 0, whole.substr(at + 3, F.length(whole))).otherwise(F.lit(""))
    written_host = F.regexp_extract("__rest", "^[^/?#]*", 0)
    after = F.col("__rest").substr(F.length(written_host) + 1, F.length("__rest"))
    return (
        df.withColumn("__rest", rest)
        .withColumns({host: F.translate(written_host, UPPER, LOWER), path: F.regexp_extract(after, "^[^?#]*", 0)})
        .drop("__rest")
    )


def matched(rules: list[Rule], host: Column, path: Column, value: str) -> Column:
    """Name or verdict of the longest rule that fits, NULL if none does."""
    found = []
    for r in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found.append(F.when(fits, F.lit(getattr(r, value))))
    return F.coalesce(*found, F.lit(None).cast("string"))


def _sequences(urls: DataFrame) -> DataFrame:
    """Every character of the URLs with its contexts: sequences of 1 to ORDER characters."""
    ends = urls.withColumn("__at", F.explode(F.sequence(F.lit(1), F.length("__text"))))
    sizes = F.explode(F.sequence(F.lit(1), F.least(F.col("__at"), F.lit(ORDER))))
    return ends.withColumn("__size", sizes).select(
        F.col("__text").substr(F.col("__at") - F.col("__size") + 1, F.col("__size")).alias("gram"),
        F.col("__size").alias("size"),
        "__accepted",
    )


def _steps(difference: Column) -> Column:
    return F.round(difference * F.lit(float(1 << STEP_BITS))).cast("bigint")


def _model(examples: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """Per length all sequences of the examples with their values, and all contexts
    of such sequences with what a character costs that was never seen after them."""
    counted = written(
        _sequences(examples)
        .groupBy("gram", "size")
        .agg(F.count_if("__accepted").alias("a"), F.count_if(~F.col("__accepted")).alias("r")),
        "url-sequences",
    )
    levels, below = [], None
    for size in range(1, ORDER + 1):
        level = counted.filter(F.col("size") == size).withColumn("context", F.col("gram").substr(1, size - 1))
        totals = written(level.groupBy("context").agg(F.sum("a").alias("ta"), F.sum("r").alias("tr")), "url-contexts")
        level = level.join(totals, "context")
        if below is None:
            level = level.withColumns({"pa0": F.lit(1 / ALPHABET), "pr0": F.lit(1 / ALPHABET)})
        else:
            shorter = below.select(F.col("gram").alias("__shorter"), F.col("pa").alias("pa0"), F.col("pr").alias("pr0"))
            level = level.join(shorter, F.col("gram").substr(2, size) == F.col("__shorter"))
        smooth = F.lit(SMOOTHING)
        below = written(
            level.select(
                "gram",
                ((F.col("a") + smooth * F.col("pa0")) / (F.col("ta") + smooth)).alias("pa"),
                ((F.col("r") + smooth * F.col("pr0")) / (F.col("tr") + smooth)).alias("pr"),
            ),
            "url-chances",
        )
        known = below.select("gram", _steps(F.ln("pa") - F.ln("pr")).alias("steps"))
        unseen = _steps(F.ln(F.col("tr") + smooth) - F.ln(F.col("ta") + smooth))
        levels.append((known, totals.select("context", unseen.alias("unseen"))))
    return levels


def _valued(windows: DataFrame, model: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """The distinct windows with ``n``, how often they occur, and the ``steps`` of their
    longest end in the model (0 if it holds none) and of the contexts before it.

    A shorter end has at most as many windows as there are characters before it.
    """
    counted = written(windows.groupBy("window").agg(F.count(F.lit(1)).alias("n")), "url-windows")
    size = F.length("window")
    ends = [counted.filter(size == len(model)).select("window")]
    for shorter in range(len(model) - 1, 0, -1):
        cut = ends[-1].select(F.col("window").substr(2, shorter).alias("window"))
        ends.append(written(cut.union(counted.filter(size == shorter).select("window")).distinct(), "url-ends"))
    values, below = [], None
    none = F.lit(0).cast("bigint")
    for length, (needed, (level, contexts)) in enumerate(zip(reversed(ends), model, strict=True), 1):
        found = needed.join(level.withColumnRenamed("gram", "window"), "window", "left").join(
            contexts, F.col("window").substr(1, length - 1) == F.col("context"), "left"
        )
        if below is None:
            found = found.withColumn("__steps", none)
        else:
            end = below.select(F.col("window").alias("__end"), F.col("steps").alias("__steps"))
            found = found.join(end, F.col("window").substr(2, length - 1) == F.col("__end"), "left")
        shorter = F.col("__steps") + F.coalesce("unseen", none)
        below = written(found.select("window", F.coalesce("steps", shorter).alias("steps")), "url-values")
        values.append(below)
    return counted.join(reduce(DataFrame.union, values), "window")


def _scored(df: DataFrame, model: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Add ``__score``, the difference of the log chances per character of ``__text``.

    Rows are told apart by a number that is written with them.
    """
    text = F.col("__text")
    rows = written(df.withColumn("__row", F.monotonically_increasing_id()), "url-rows")
    at, order = F.col("__at"), F.lit(len(model))
    window = text.substr(F.greatest(at - order + 1, F.lit(1)), F.least(at, order))
    windows = rows.select("__row", "__text", F.explode(F.sequence(F.lit(1), F.length(text))).alias("__at")).select(
        "__row", window.alias("window")
    )
    valued = written(_valued(windows, model), "url-valued")
    total = valued.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = F.col("n") >= F.lit(total / FREQUENT)
    frequent = F.broadcast(valued.filter(often).select("window", "steps"))  # at most FREQUENT rows
    by_frequent = windows.join(frequent, "window").groupBy("__row").agg(F.sum("steps").alias("steps"))
    by_others = (
        windows.join(frequent, "window", "left_anti")
        .groupBy("__row", "window")
        .agg(F.count(F.lit(1)).alias("times"))
        .join(valued.filter(~often).select("window", "steps"), "window")
        .select("__row", (F.col("times") * F.col("steps")).alias("steps"))
    )
    summed = by_frequent.union(by_others).groupBy("__row").agg(F.sum("steps").alias("__steps"))
    score = F.col("__steps") / F.lit(float(1 << STEP_BITS)) / F.length(text)
    return rows.join(summed, "__row").withColumn("__score", score).drop("__steps", "__row")


def _limit(held_back: DataFrame) -> float:
    """The limit with the best mean of both rates, from counts in fixed bins."""
    place = F.round(F.col("__score") * BINS_PER_UNIT)
    bins = held_back.select(
        F.greatest(F.lit(-LAST_BIN), F.least(F.lit(LAST_BIN), place)).cast("int").alias("bin"), "__accepted"
    )
    counts = (
        bins.groupBy("bin")
        .agg(F.count_if("__accepted").alias("a"), F.count_if(~F.col("__accepted")).alias("r"))
        .orderBy("bin")
        .collect()
    )  # at most 2 * LAST_BIN + 1 rows
    accepted, rejected = sum(c["a"] for c in counts), sum(c["r"] for c in counts)
    if not accepted or not rejected:
        return 0.0
    best, limits, lost, kept_out = -1.0, [], 0, 0
    for before, c in zip([None, *counts], [*counts, None], strict=True):
        quality = (accepted - lost) / accepted + kept_out / rejected
        # Between the bins on both sides; a tie takes the middle one of the best.
        at = (before or c)["bin"] if c is None or before is None else (before["bin"] + c["bin"]) / 2
        if quality > best + 1e-12:
            best, limits = quality, []
        if quality >= best - 1e-12:
            limits.append(at / BINS_PER_UNIT)
        if c is not None:
            lost, kept_out = lost + c["a"], kept_out + c["r"]
    return limits[len(limits) // 2]


def judge(pages: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``verdict`` and ``score``.

    All columns travel with the rows, so leave out large ones like page texts.
    """
    marked = with_parts(pages, url, "__host", "__path").withColumns(
        {
            "__rule": matched(rules, F.col("__host"), F.col("__path"), "name"),
            "__by_rule": matched(rules, F.col("__host"), F.col("__path"), "verdict"),
            "__text": F.concat(F.coalesce(F.col(url), F.lit("")), F.lit(END)),
        }
    )
    examples = written(
        marked.filter(F.col("__by_rule").isNotNull())
        .select("__text", (F.col("__by_rule") == "allow").alias("__accepted"))
        .distinct(),
        "url-examples",
    )
    back = F.pmod(F.xxhash64("__text"), F.lit(HELD_BACK)) == 0
    model = _model(examples.filter(~back))
    judged = written(_scored(marked, model), "url-scored")
    # Equal texts have equal scores, so the distinct examples keep one row each.
    ruled = judged.filter(F.col("__by_rule").isNotNull() & back)
    limit = _limit(ruled.select("__text", "__score", (F.col("__by_rule") == "allow").alias("__accepted")).distinct())
    by_model = F.when(F.col("__score") >= limit, F.lit("allow")).otherwise(F.lit("block"))
    judged = judged.withColumn("__verdict", F.coalesce("__by_rule", by_model)).drop("__by_rule", "__text")
    return with_new_columns(judged, *RESULTS).withColumnsRenamed({f"__{name}": name for name in RESULTS})
