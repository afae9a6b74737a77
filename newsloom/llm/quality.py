"""Quality rules with thresholds that follow the data (operator 8, DataFrame only).

Three measures of a text are judged against limits of its own (language, source)
group instead of fixed cutoffs: the share of symbol characters, the mean word length
and the share of repeated lines. The limits come from mergeable quantile sketches:
every measure is an integer, its bucket keeps the leading ``SKETCH_BITS`` bits, and a
sketch is the count of each bucket. Two sketches merge by adding counts, so a group's
sketch is built by a partial aggregate in each task, a language's sketch is the sum of
its sources' and the overall one the sum of the languages'. A bucket is off by one part
in ``2 ** (SKETCH_BITS - 1)`` at most, whatever the data and their order, so a retried
task gives the same limits. A group with fewer than ``MIN_GROUP`` documents takes its
language's limits, and a language below that the overall ones.

Null, empty or blank texts have no words and fail the base rule. A null language or
source is a group like any other. Repeated rows are judged alike and each is returned.
An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import landed, let, small, words_of

SKETCH_BITS = 6
MIN_GROUP = 200
WINDOW = 8
MIN_WORDS = 20
#: Percent of the words that may lie in repeated windows.
MAX_REPEAT = 30
#: What a measure may always exceed the upper fence by; shares are in 1/10000, the length in 1/100.
SLACK = {"symbols": 200, "length": 300, "lines": 3000}
MEASURES = tuple(SLACK)
SYMBOLS = r"[#*$%&|<>]"


def counts(text: Column) -> Column:
    """Struct of the cheap counts of a text."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(words_of(text), lambda words: let(lines, lambda lines: F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
        (F.char_length(whole) - F.char_length(F.regexp_replace(whole, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))))


def repeat_words(text: Column) -> Column:
    """Words of a text that lie in an 8-word window found twice or more in it."""
    def starts(windows: Column) -> Column:
        ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(ordered, lambda s: F.sort_array(F.transform(
            F.filter(F.transform(s, lambda x, k: F.struct(x["i"].alias("i"), (
                ((k > 0) & (F.get(s, k - 1)["h"] == x["h"]))
                | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))).alias("twice"))),
                lambda x: x["twice"]),
            lambda x: x["i"])))

    def covered(at: Column) -> Column:
        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(at, start, lambda acc, i: F.struct(
            i.alias("last"), (acc["n"] + F.least(i - acc["last"], F.lit(WINDOW))).alias("n")), lambda acc: acc["n"])

    def of_words(words: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
        found = let(windows, lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), covered(starts(w))).otherwise(F.lit(0).cast("long")))
        return F.when(F.size(words) > WINDOW, found).otherwise(F.lit(0).cast("long"))

    return let(words_of(text), of_words)


def measures(c: Column) -> Column:
    """Struct of the integer measures, from the counts of a text."""
    def ratio(n: Column, of: Column, scale: int) -> Column:
        return F.when(of > 0, F.floor(n * scale / of)).cast("long")

    return F.struct(ratio(c["n_symbols"], c["word_chars"], 10000).alias("symbols"),
                    ratio(c["word_chars"], c["n_words"], 100).alias("length"),
                    ratio(c["n_dup_lines"], c["n_lines"], 10000).alias("lines"))


def bucket(v: Column) -> Column:
    """The value with all but its leading bits cleared."""
    drop = F.greatest(F.length(F.bin(v)) - SKETCH_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, drop), drop)


def sketches(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, measure, bucket, n): one sketch for each group, merged from all tasks."""
    m = docs.select(F.col(lang).alias("lang"), F.col(source).alias("source"), counts(F.col(text)).alias("c"))
    m = m.where("c.n_words > 0").select("lang", "source", measures(F.col("c")).alias("m"))
    each = F.explode(F.array(*[F.struct(F.lit(x).alias("measure"), F.col(f"m.{x}").alias("v")) for x in MEASURES]))
    rows = m.select("lang", "source", each.alias("x")).select("lang", "source", "x.measure", bucket(F.col("x.v")).alias("bucket"))
    return rows.groupBy("lang", "source", "measure", "bucket").agg(F.count("*").alias("n"))


def limits(sketch: DataFrame) -> DataFrame:
    """(lang, source, symbols, length, lines): the limits of each group."""
    def upper(keys: list[str]) -> DataFrame:
        """Upper quartile and three quartile distances of the sketches merged by ``keys``."""
        merged = sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
        listed = merged.groupBy(*keys, "measure").agg(F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("b"))

        def quartile(k: int) -> Column:
            start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("at"))
            return F.aggregate("b", start, lambda acc, x: F.struct(
                (acc["seen"] + x["n"]).alias("seen"),
                F.coalesce(acc["at"], F.when(4 * (acc["seen"] + x["n"]) >= k * F.col("n"), x["bucket"])).alias("at")), lambda acc: acc["at"])

        q = listed.select(*keys, "measure", "n", quartile(1).alias("q1"), quartile(3).alias("q3"))
        fence = F.col("q3") + 3 * (F.col("q3") - F.col("q1"))
        return q.groupBy(*keys).agg(F.max("n").alias("n"), *[
            F.max(F.when(F.col("measure") == x, fence + SLACK[x])).alias(x) for x in MEASURES])

    own, lang, overall = upper(["lang", "source"]), upper(["lang"]), upper([])
    g, h, o = own.alias("g"), lang.alias("h"), overall.alias("o")
    both = g.join(h, F.col("g.lang").eqNullSafe(F.col("h.lang"))).join(F.broadcast(o))
    chosen = [F.when(F.col("g.n") >= MIN_GROUP, F.col(f"g.{x}")).when(F.col("h.n") >= MIN_GROUP, F.col(f"h.{x}"))
              .otherwise(F.col(f"o.{x}")).alias(x) for x in MEASURES]
    return both.select(F.col("g.lang").alias("lang"), F.col("g.source").alias("source"), *chosen)


def judged(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """``row`` (the document), ``c`` (its counts), n_repeat_words, base_failed and kept."""
    bounds = landed(limits(sketches(docs, lang, source, text)), "limits")
    bounds = small(bounds, F.length(F.coalesce("lang", F.lit(""))) + F.length(F.coalesce("source", F.lit(""))) + 64)
    rows = docs.select(F.struct("*").alias("row"))
    rows = rows.select("row", counts(F.col(f"row.{text}")).alias("c"), repeat_words(F.col(f"row.{text}")).alias("n_repeat_words"))
    failed = (F.col("c.n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("c.n_words"))
    rows = rows.withColumn("base_failed", failed).withColumn("m", measures(F.col("c")))
    b = bounds.alias("b")
    joined = rows.join(b, F.col(f"row.{lang}").eqNullSafe(F.col("b.lang")) & F.col(f"row.{source}").eqNullSafe(F.col("b.source")), "left")
    within = F.lit(True)
    for x in MEASURES:
        within = within & F.coalesce(F.col(f"m.{x}") <= F.col(f"b.{x}"), F.lit(True))
    return joined.select("row", "c", "n_repeat_words", "base_failed", (~F.col("base_failed") & within).alias("kept"))


def verdicts(docs: DataFrame, doc_id: str = "doc_id", **columns: str) -> DataFrame:
    """The counts and the verdict of each document, without its text."""
    return judged(docs, **columns).select(
        F.col(f"row.{doc_id}").alias("doc_id"), "c.n_words", "c.word_chars", "c.n_symbols", "c.n_dup_lines",
        "n_repeat_words", "base_failed", "kept")


def filtered(docs: DataFrame, **columns: str) -> DataFrame:
    """The documents that pass, with their own columns."""
    return judged(docs, **columns).where("kept").select("row.*")
