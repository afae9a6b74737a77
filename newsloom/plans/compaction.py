"""Compaction: the small files of a store's table, merged to files of a target size.

``compact`` takes the files a table has now, writes their rows as one generation, ordered
by their key, and commits it with the list of the merged files. From then on readers take
the generation and whatever was appended since, so no row is read twice or missed, also
where a run key that was merged is written to again. ``vacuum`` removes what the newest
generations made superfluous; a reader made before keeps its files as long as they are
among the ``keep`` last generations. Each step can be the last one of a crashed job:
the next ``compact`` starts over from the last commit, and ``vacuum`` can be repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame

from newsloom.plans.generations import Generations, bytes_of, files_of, read_files

TARGET_BYTES = 128 * 1024 * 1024


class Compacted:
    """One table of a store, with its generations beside it."""

    def __init__(self, store, table: str):  # noqa: ANN001
        self.store, self.table = store, table
        self.spark, self.base = store.spark, store.path(table)
        self.schema, self.key = store.layout(table)
        self.generations = Generations(store.spark, f"{store.root}/generations/{table}")

    def appended(self) -> DataFrame:
        """The table as it was appended, merged or not."""
        return self.spark.read.schema(self.schema).parquet(self.base)

    def read(self) -> DataFrame:
        generation = self.generations.latest()
        if generation is None:
            return self.appended()
        merged = self.spark.read.schema(self.schema).parquet(self.generations.data(generation))
        rest = files_of(self.appended()) - self.merged(generation)
        return merged.unionByName(read_files(self.spark, self.schema, self.base, rest)) if rest else merged

    def merged(self, generation: int) -> set[str]:
        """The appended files whose rows a generation has."""
        return self.generations.manifest(generation).get(self.table, set())

    def files(self) -> dict[str, set[str]]:
        """Each file that ``read`` takes, with the appended files whose rows it has."""
        generation = self.generations.latest()
        held = self.merged(generation) if generation is not None else set()
        found = {file: {file} for file in files_of(self.appended()) - held}
        if generation is not None:
            data = self.spark.read.schema(self.schema).parquet(self.generations.data(generation))
            found |= {file: held for file in files_of(data)}
        return found

    def read_some(self, files: set[str]) -> DataFrame:
        """Some of the files that ``read`` takes."""
        generation = self.generations.latest()
        inside = files - files_of(self.appended())
        rows = read_files(self.spark, self.schema, self.base, files - inside)
        if not inside:
            return rows
        return rows.unionByName(read_files(self.spark, self.schema, self.generations.data(generation), inside))

    def steps(self, target_bytes: int = TARGET_BYTES) -> Iterator[str]:
        """The steps of a compaction, one at a time."""
        before = self.generations.latest()
        held = self.merged(before) if before is not None else set()
        taken = files_of(self.appended()) - held
        if not taken:
            return
        generation = 0 if before is None else before + 1
        rows = read_files(self.spark, self.schema, self.base, taken)
        size = bytes_of(self.spark, taken)
        if before is not None:
            earlier = self.spark.read.schema(self.schema).parquet(self.generations.data(before))
            size += bytes_of(self.spark, files_of(earlier))
            rows = rows.unionByName(earlier)
        yield "taken"
        order = [self.key, *(c for c in ("link", "id", "part") if c in rows.columns)][:2]
        dealt = rows.repartitionByRange(max(1, -(-size // target_bytes)), *order).sortWithinPartitions(*order)
        dealt.write.mode("overwrite").parquet(self.generations.data(generation))
        yield "written"
        # What was merged before and is still there has to stay on the list.
        self.generations.commit(generation, {self.table: taken | held})
        yield "committed"

    def vacuum(self, keep: int = 1) -> int:
        """Removes generations but the ``keep`` last, and appended files that all of these have; how many."""
        whole = self.generations.whole()
        if not whole:
            return 0
        kept = whole[-keep:]
        gone = set.intersection(*(self.merged(g) for g in kept)) & files_of(self.appended())
        for file in gone:
            self.generations.drop(file)
        for generation in whole[:-keep]:
            self.generations.drop(f"{self.generations.root}/manifest/generation={generation}")
            self.generations.drop(self.generations.data(generation))
        return len(gone)
