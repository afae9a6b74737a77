"""Band keys of word sets, and stories and trends that come of them."""

import datetime

import numpy as np
import pytest

from newsloom.operators import stories


def _sets(rng, n, shared):
    """Two sets of ``n`` numbers with a similarity of ``shared`` of their union."""
    both = int(round(2 * n * shared / (1 + shared)))
    x = rng.integers(1 << 63, size=2 * n - both, dtype=np.uint64)
    return np.sort(x[:n]), np.sort(x[n - both:])


@pytest.mark.parametrize(("shared", "least", "most"), [(0.8, 1.0, 1.0), (0.2, 0.0, 0.12), (0.0, 0.0, 0.0)])
def test_bands_follow_similarity(shared, least, most):
    rng = np.random.default_rng(3)
    sets = [s for _ in range(400) for s in _sets(rng, 120, shared)]
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    keys = stories.band_keys(np.concatenate(sets), starts, stories.BANDS, stories.BAND)
    met = (keys[::2] == keys[1::2]).any(axis=1).mean()
    assert least <= met <= most


def test_signatures_do_not_depend_on_blocks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(k, None if k % 3 else 7, [int(x) for x in rng.integers(-(1 << 62), 1 << 62, size=size)])
            for k, size in enumerate([1, 2, 300, 5000, 1, 40, 900])]
    sets = spark.createDataFrame(rows, "c long, range long, items array<long>").coalesce(1)
    whole = {r["c"]: (r["range"], r["keys"]) for r in stories.signatures(sets, 8, 4).collect()}
    items = [np.array(r[2], np.int64).view(np.uint64) for r in rows]
    starts = np.zeros(1, np.int64)
    for (c, range_, _), x in zip(rows, items, strict=True):
        assert whole[c] == (range_, stories.band_keys(x, starts, 8, 4)[0].tolist())
    monkeypatch.setattr(stories, "BLOCK", 64)
    assert {r["c"]: (r["range"], r["keys"]) for r in stories.signatures(sets, 8, 4).collect()} == whole


def _articles(spark, n):
    rng = np.random.default_rng(5)
    at = datetime.datetime(2025, 6, 10, tzinfo=datetime.timezone.utc)
    rows = []
    for k in range(n):
        words = [f"w{x}" for x in rng.integers(4000, size=100)]
        rows.append((3 * k, None, at, " ".join(words)))
        # One word of a hundred changed: 5 of about 100 shingles.
        rows.append((3 * k + 1, None, at + datetime.timedelta(days=1), " ".join([*words[:50], "other", *words[51:]])))
        rows.append((3 * k + 2, None, None if k % 2 else at, " ".join(words) if k % 2 else None))
    return spark.createDataFrame(rows, "id long, published_at string, fetched_at timestamp, original_summary string")


def test_stories_of_near_copies(spark):
    found = {r["id"]: r for r in stories.similar_stories(_articles(spark, 200)).collect()}
    assert len(found) == 600
    for k in range(200):
        assert [found[3 * k + i]["story_id"] for i in range(3)] == [3 * k, 3 * k, 3 * k + 2]
        assert [found[3 * k + i]["story_size"] for i in range(3)] == [2, 2, 1]


def test_trends_of_near_copies(spark):
    found = stories.trending_stories(stories.similar_stories(_articles(spark, 20)), top=3).collect()
    first = datetime.date(2025, 6, 10).toordinal() - datetime.date(1970, 1, 1).toordinal()
    # A day's rise is 3 articles the first day, and less by the day before on the second.
    assert [(r["day"], r["rank"], r["story_id"], r["rise"]) for r in sorted(found, key=lambda r: (r["day"], r["rank"]))] == [
        (first, 1, 0, 3), (first, 2, 3, 3), (first, 3, 6, 3), (first + 1, 1, 0, 2), (first + 1, 2, 3, 2), (first + 1, 3, 6, 2)]
