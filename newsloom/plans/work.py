"""The open-work table: what of a store is not finished, kept up as files are appended.

A generation holds the articles that still need a step, without their text, and the
decisions on them, together with the list of files it was made from. Pending work is that
generation and the files appended since, so a run reads what is open and what is new, and
not every fact there is. An article is finished once it is not relevant, or summarized and
sent. A later decision on a finished one brings it back: its rows are then read again
from the whole tables, and from those alone for such links.

The table follows from the store's files alone. If it is lost, or a crash comes before
its commit, the next run reads more and finds the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom import schemas
from newsloom.operators import facts
from newsloom.operators.sizing import broadcast_small
from newsloom.plans.compaction import Compacted
from newsloom.plans.generations import Generations
from newsloom.session import checkpointed

#: An article without its text.
OPEN_ARTICLES = T.StructType([field for field in schemas.ARTICLES_RAW if field.name != "original_summary"])
PARTS: dict[str, T.StructType] = {
    "articles_raw": OPEN_ARTICLES, "relevance_facts": schemas.RELEVANCE_FACTS,
    "summary_facts": schemas.SUMMARY_FACTS, "sent_facts": schemas.SENT_FACTS,
}


class OpenWork:
    def __init__(self, store):  # noqa: ANN001
        self.store, self.spark = store, store.spark
        self.generations = Generations(store.spark, f"{store.root}/open_work")

    def pending(self) -> dict[str, DataFrame]:
        """The tables, less what is finished."""
        generation = self.generations.latest()
        if generation is None:
            return {table: self._narrow(table, self.store.read(table)) for table in PARTS}
        held = self.generations.manifest(generation)
        found, new = {}, {}
        for table, schema in PARTS.items():
            new[table] = self._narrow(table, self._appended_since(table, held.get(table, set())))
            kept = self.spark.read.schema(schema).parquet(self.generations.data(generation, table))
            found[table] = kept.unionByName(new[table])
        decided = [new[t].select("link") for t in PARTS if t != "articles_raw"]
        decided = decided[0].unionByName(decided[1]).unionByName(decided[2]).filter("link IS NOT NULL").distinct()
        back = checkpointed(decided.join(found["articles_raw"].select("link"), "link", "left_anti"))
        if not back.isEmpty():
            links = broadcast_small(back)
            for table in PARTS:
                again = self._narrow(table, self.store.read(table)).join(links, "link", "left_semi")
                rest = found[table] if table == "articles_raw" else found[table].join(links, "link", "left_anti")
                found[table] = rest.unionByName(again)
        return found

    def refresh(self) -> int:
        """Commits the next generation and returns its number."""
        held = {table: set().union(*self._files(table).values()) for table in PARTS}
        found = self.pending()
        state = facts.with_relevance(found["articles_raw"], found["relevance_facts"])
        state = facts.with_sent(facts.with_summary(state, found["summary_facts"]), found["sent_facts"])
        served = F.col("is_ai_relevant") & F.col("llm_summary").isNotNull() & F.col("sent_in_newsletter_at").isNotNull()
        finished = F.coalesce(~F.col("is_ai_relevant") | served, F.lit(False))
        keys = checkpointed(state.filter(~finished).select("link"))
        links = broadcast_small(keys)
        generation = self.generations.latest()
        generation = 0 if generation is None else generation + 1
        for table in PARTS:
            kept = found[table].join(links, "link", "left_semi").select(*PARTS[table].names)
            kept.write.mode("overwrite").parquet(self.generations.data(generation, table))
        self.generations.commit(generation, held)
        for old in self.generations.whole()[:-2]:
            self.generations.drop(f"{self.generations.root}/manifest/generation={old}")
            for table in PARTS:
                self.generations.drop(self.generations.data(old, table))
        return generation

    def _files(self, table: str) -> dict[str, set[str]]:
        return Compacted(self.store, table).files()

    def _appended_since(self, table: str, held: set[str]) -> DataFrame:
        """The rows of the files whose sources are not all held."""
        return Compacted(self.store, table).read_some({file for file, sources in self._files(table).items() if not sources <= held})

    def _narrow(self, table: str, rows: DataFrame) -> DataFrame:
        return rows.select(*PARTS[table].names)
