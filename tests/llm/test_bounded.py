"""No task gets all copies of a row at once."""

from newsloom.llm import packing, suffix


def test_repeated_rows_are_dealt_to_several_parts(spark, monkeypatch):
    docs, made = spark.range(0, 4000, 1, 8).selectExpr("7L AS doc_id", "'a few words' AS text"), {}
    land = packing.landed
    monkeypatch.setattr(packing, "landed", lambda df, name: made.setdefault(name, land(df, name)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = packing.packed(docs).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len({(r["batch"], r["slot"]) for r in found}) == 4000
    assert made["dealt"].select("part").distinct().count() > 1


def test_runs_of_repeated_rows_combine_before_the_shuffle(spark):
    docs = spark.createDataFrame([(None, "one text " * 60)] * 3, "doc_id long, text string")
    found = suffix.run_texts(docs, suffix.all_runs(docs, 400, "doc_id", "text"), 400, "doc_id", "text")
    assert "collect_list" not in found._jdf.queryExecution().toString()
    rows = [tuple(r) for r in found.select("shift", "starts").collect()]
    assert len(rows) == 3 * len(set(rows))


def test_runs_with_one_text_are_split(spark):
    docs = spark.range(0, 4000, 1, 8).selectExpr("id AS doc_id", f"'{' '.join(f'word{k}' for k in range(70))}' AS text")
    skew = "spark.sql.adaptive.skewJoin.skewedPartition"
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", f"{skew}ThresholdInBytes": "4k", f"{skew}Factor": "1.5"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        found = suffix.removals(docs)
        rows = found.collect()
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert {r["doc_id"] for r in rows} == set(range(4000))
    assert "SortMergeJoin(skew=true)" in found._jdf.queryExecution().executedPlan().toString()
