"""Components of few links in one task, and the same by rounds."""

import random

import pytest

from newsloom.llm import components as module


@pytest.mark.parametrize("few", [0, module.FEW])
def test_few_links_need_no_rounds(spark, monkeypatch, few):
    rng = random.Random(2)
    links = [(k, k + 1) for k in range(100, 160)] + [(rng.randrange(200, 500), rng.randrange(200, 500)) for _ in range(150)] + [(7, 7), (9, 8)]
    root = {x: x for link in links for x in link}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    tables, landed = [], module.landed

    def watched(df, name, *more):
        tables.append(name)
        return landed(df, name, *more)

    monkeypatch.setattr(module, "landed", watched)
    monkeypatch.setattr(module, "FEW", few)
    found = {r["node"]: r["root"] for r in module.components(spark.createDataFrame(links, "a long, b long").repartition(5)).collect()}
    # A node that is linked with itself only may be left out.
    assert found == {x: r for x, r in root.items() if x != 7 or x in found}
    assert (tables.count("labels") == 1) == (few > 0)
