"""Category tags from a table of rules.

A rule has a category, a phrase and perhaps a source; it holds for an article that names
the phrase and, if the rule has a source, comes from it. Phrases and articles are read as
words of letters and digits without case, and meet by the hash of their runs of words, so
the work does not grow with the number of rules: each article is cut once into the runs
of the lengths that rules have. Hashes have 64 bits.

A rule without a phrase names every article of its source, and without either it is no
rule; one without a category is none either. Rules that repeat change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import let
from newsloom.operators.extract import words_of
from newsloom.operators.sizing import broadcast_small
from newsloom.session import checkpointed


def runs_of(words: Column, lengths: list[int]) -> Column:
    """The distinct hashes of all runs of the given numbers of words."""
    none = F.array().cast("array<bigint>")

    def of(length: int) -> Column:
        starts = F.sequence(F.lit(1), F.size(words) - (length - 1))
        return F.when(F.size(words) >= length, F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, length)))).otherwise(none)

    return F.array_distinct(F.concat(none, *[of(length) for length in lengths]))


def read_rules(rules: DataFrame) -> tuple[DataFrame, list[int]]:
    """(category, source, run) of the rules, with a null run for those without a phrase, and the lengths of their phrases."""
    words = rules.filter("category IS NOT NULL").select(
        "category", F.col("source").alias("rule_source"), words_of(F.coalesce("phrase", F.lit(""))).alias("words"))
    usable = words.filter(F.col("rule_source").isNotNull() | (F.size("words") > 0))
    read = checkpointed(usable.select("category", "rule_source", F.size("words").alias("length"),
                                      F.when(F.size("words") > 0, F.xxhash64("words")).alias("run")).distinct())
    lengths = sorted(r["length"] for r in read.select("length").distinct().collect() if r["length"])
    return read.drop("length"), lengths


def tagged(articles: DataFrame, rules: DataFrame) -> DataFrame:
    """(id, tags) of every article: its categories in order of name; ``rules`` has category, phrase and source."""
    read, lengths = read_rules(rules)
    text = F.concat_ws(" ", "title", "original_summary")
    runs = let(words_of(text), lambda words: runs_of(words, lengths))
    cut = articles.select("id", "source_name", F.explode(runs).alias("run")) if lengths else None
    anywhere = F.col("rule_source").isNull() | (F.col("rule_source") == F.col("source_name"))
    by_source = articles.select("id", "source_name").join(
        broadcast_small(read.filter("run IS NULL")), F.col("rule_source") == F.col("source_name")).select("id", "category")
    found = by_source
    if cut is not None:
        phrases = broadcast_small(read.filter("run IS NOT NULL"))
        found = found.unionByName(cut.join(phrases, "run").filter(anywhere).select("id", "category"))
    tags = found.groupBy("id").agg(F.sort_array(F.collect_set("category")).alias("tags"))
    named = articles.select("id").join(tags, "id", "left")
    return named.select("id", F.coalesce("tags", F.array().cast("array<string>")).alias("tags"))
