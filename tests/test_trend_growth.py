"""Trends at a few thousand articles, against plain counts."""

from collections import Counter

from pyspark.sql import functions as F

from newsloom.operators import stories


def test_trends_of_many_stories(spark):
    """Articles of 900 stories over two ranges, each text long enough that boxed hashes took minutes."""
    words = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(400)), lambda k: F.concat(F.lit("w"), F.abs(F.xxhash64(F.col("id") % 900, k) % 9000))))
    rows = spark.range(2700).select(
        "id", F.lit(None).cast("string").alias("published_at"), F.timestamp_seconds(F.lit(14 * 86400 * 1400) + F.col("id") % 7 * 86400).alias("fetched_at"),
        words.alias("original_summary"))
    told = stories.similar_stories(rows)
    found = {r["id"]: (r["story_id"], r["story_size"], r["day"]) for r in told.collect()}
    assert found == {i: (i % 900, 3, 14 * 1400 + i % 7) for i in range(2700)}
    counts = Counter((i % 900, 14 * 1400 + i % 7) for i in range(2700))
    ranked: dict[int, list] = {}
    for (story, day), n in counts.items():
        rise = 3 * n - sum(counts[story, day - k] for k in (1, 2, 3))
        if rise > 0:
            ranked.setdefault(day, []).append((-rise, -n, story))
    expected = {(day, k, story, -rise) for day, rows in ranked.items() for k, (rise, _, story) in enumerate(sorted(rows)[:10], 1)}
    assert {(r["day"], r["rank"], r["story_id"], r["rise"]) for r in stories.trending_stories(told).collect()} == expected
