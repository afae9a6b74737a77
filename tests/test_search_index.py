"""The written index against plain counts."""

import re
from collections import Counter

from pyspark.sql import functions as F

from newsloom.operators import search

ROWS = [
    (1, "The license", "of the token, the TOKEN"), (2, None, None), (3, "", " .,"), (4, "naïve Zoë 日本", "x1 naïve"),
    (5, "twice", "one id"), (5, "twice", "with two rows twice"), (None, "no id", "but words"), (None, None, "more words"), (6, "the the", "the"),
    (7, "copies", None), (7, "copies", None), (8, None, "one " * 3000),
]


def test_words_are_counted_in_their_row(spark):
    rows = spark.createDataFrame([(["b", "a", "b", "b"],), ([],), (["z"],)], "words array<string>")
    found = [[tuple(u) for u in r[0]] for r in rows.select(search.uses_of(F.col("words"))).collect()]
    assert found == [[("a", 1), ("b", 3)], [], [("z", 1)]]


def test_index_against_plain_counts(spark, tmp_path):
    articles = spark.createDataFrame(ROWS, "id long, title string, original_summary string").repartition(3)
    path = search.build_index(articles, str(tmp_path / "index"), folders=4)
    used, length = Counter(), Counter()
    for id_, title, text in ROWS:
        words = re.findall(r"[^\W_]+", f"{title or ''} {text or ''}".lower())
        length[id_] += len(words)
        used.update((w, id_) for w in words)
    rows = spark.read.schema(search.POSTINGS).parquet(f"{path}/postings").withColumn("file", F.input_file_name()).collect()
    found = [(r["word"], r["id"], r["uses"], r["length"]) for r in rows]
    assert sorted(found) == sorted((w, i, n, length[i]) for (w, i), n in used.items() if i is not None)
    totals = spark.read.parquet(f"{path}/totals").first()
    assert (totals["articles"], totals["words"], totals["folders"]) == (len(length), sum(length.values()), 4)
    assert len({(r["word"], r["file"]) for r in rows}) == len({r["word"] for r in rows})


def test_words_are_not_shuffled(spark, tmp_path, monkeypatch):
    """Each row of the one shuffle of words is a posting: a word that an article repeats is counted before."""
    kind, dealt = type(spark.range(1)), []
    old = kind.repartition

    def watched(self, *columns):
        if "word" in self.columns:
            dealt.append(self.count())
        return old(self, *columns)

    monkeypatch.setattr(kind, "repartition", watched)
    articles = spark.createDataFrame([(8, None, "one " * 3000)], "id long, title string, original_summary string")
    search.build_index(articles, str(tmp_path / "index"), folders=4)
    assert dealt == [1]
