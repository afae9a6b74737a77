"""Offline summary model: the two sentences whose words the article uses most."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import let, strip
from newsloom.operators.sizing import spread

SENTENCE = r"[^.!?\n]+[.!?]*"
WORD = r"[\p{L}\p{N}]"
NOT_WORD = r"[^\p{L}\p{N}]+"


def sentences_of(text: Column) -> Column:
    found = F.transform(F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(0)), strip)
    return F.filter(found, lambda sentence: sentence != "")


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), NOT_WORD), lambda word: word != "")


def _run_starts(rows: Column, field: str) -> Column:
    """Places in a sorted array of structs at which ``field`` takes a new value."""
    return F.filter(
        F.sequence(F.lit(0), F.size(rows) - 1),
        lambda k: (k == 0) | (F.get(rows, k - 1)[field] != F.get(rows, k)[field]),
    )


def _runs(rows: Column, field: str, use: Callable[[Column], Column]) -> Column:
    """``use`` of the rows of each run of equal ``field`` in a sorted, non-empty array."""
    return let(
        _run_starts(rows, field),
        lambda starts: F.transform(starts, lambda start, k: let(
            F.slice(rows, start + 1, F.coalesce(F.get(starts, k + 1), F.size(rows)) - start), use
        )),
    )


def summary_of(text: Column, sentences: int = 2) -> Column:
    """Best sentences by mean word frequency, in their original order; NULL without a word.

    All of it happens inside the row: words are sorted once to count them and once more
    to bring them back to their sentences.
    """

    def of_sentences(found: Column) -> Column:
        words = F.flatten(F.transform(found, lambda sentence, place: F.transform(
            words_of(sentence), lambda word: F.struct(word.alias("word"), place.alias("place"))
        )))
        return let(F.sort_array(words), lambda words: F.when(F.size(words) > 0, of_words(found, words)))

    def of_words(found: Column, words: Column) -> Column:
        counted = F.flatten(_runs(words, "word", lambda run: F.transform(
            run, lambda word: F.struct(word["place"].alias("place"), F.size(run).cast("long").alias("uses"))
        )))
        return let(F.sort_array(counted), lambda counted: best_of(found, counted))

    def best_of(found: Column, counted: Column) -> Column:
        scores = _runs(counted, "place", lambda run: F.struct(
            (-F.aggregate(run, F.lit(0).cast("long"), lambda total, word: total + word["uses"]) / F.size(run)).alias("score"),
            F.get(run, F.lit(0))["place"].alias("place"),
        ))
        best = F.transform(F.slice(F.sort_array(scores), 1, sentences), lambda row: row["place"])
        return F.array_join(F.transform(F.sort_array(best), lambda place: F.get(found, place)), " ")

    return let(sentences_of(text), of_sentences)


def extractive_summaries(
    articles: DataFrame, key: str, text: str, sentences: int = 2
) -> DataFrame:
    """(key, summary) of every article that has a word.

    Which articles have one is asked of the text: a filter on the summary would be pushed
    below the projection and make every summary twice. Nothing is shuffled but the rows
    of a table with fewer files than there are cores.
    """
    worded = articles.select(key, text).filter(F.col(text).rlike(WORD))
    return spread(worded).select(key, summary_of(F.col(text), sentences).alias("summary"))


def extractive_model(requests: DataFrame) -> DataFrame:
    """The same as an inference model: an article without a word is a failed request."""
    answered = spread(requests).withColumn("content", summary_of(F.col("text")))
    return answered.withColumn("error", F.when(F.col("content").isNull(), F.lit("no sentence")))
