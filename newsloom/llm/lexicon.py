"""BPE encoding through a minimal acyclic transducer lexicon, and decoding (operator 5).

The most frequent words of the corpus, ``LEXICON`` of them at most, are compiled into an
acyclic automaton: words are added in sorted order and the part behind the last common
prefix is folded into the shared suffixes, so the automaton is always minimal. Every
transition carries the number of words that sort before it, and the sum along a word's
path is its number, which leads to its ids. The automaton is one file of arrays in the
shared folder; Spark hands it to every executor and workers map it into memory. Words
that are not in it are merged exactly by the rules of the tokenizer file, many at once.
The word counts come from all documents; the lexicon decides only how fast a word is
encoded, never its ids.

Decoding joins the strings of the ids by one space, as the tokenizers library does for a
vocabulary without a decoder.

Null counts as an empty text, which has no ids and decodes to an empty text. Special
strings inside texts get their one id. Repeated rows get equal results; an empty table
gives no rows, and its lexicon is empty.
"""

from __future__ import annotations

import hashlib
import io
import re
import uuid
from collections.abc import Callable
from functools import lru_cache

import numpy as np
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, normalizers

from newsloom.llm.common import each_text, file_system, landed, scratch, words_of
from newsloom.llm.pieces import Merges, assemble, blocks, cut, distinct, merges, parts_of, spread

#: Words in the automaton at most, and the counted words they are taken from.
LEXICON, COUNTED = 60_000, 100_000
#: Longer words are left to the merges.
LONGEST = 40


#: Characters whose composed and lower-case forms differ between versions of Unicode lie outside this range.
_BEYOND = re.compile("[^\0-\u024f]")


@lru_cache(maxsize=2)
def _normalizer(path: str) -> normalizers.Normalizer:
    return Tokenizer.from_file(path).normalizer


def normal(text: str, path: str) -> str:
    """The text composed and in lower case, as the tokenizer file at ``path`` wants it."""
    if _BEYOND.search(text):
        return _normalizer(path).normalize_str(text)
    # Below the bound every character is composed; white space only separates, so runs of it may stay.
    return text.lower()


class Automaton:
    """The minimal automaton of sorted words, built word by word."""

    def __init__(self) -> None:
        self.edges: list[dict[int, int]] = [{}]
        self.final = [False]
        self.known: dict[tuple, int] = {}
        self.path: list[int] = [0]
        self.last = b""

    def add(self, word: bytes) -> None:
        common = next((k for k, (a, b) in enumerate(zip(word, self.last, strict=False)) if a != b), min(len(word), len(self.last)))
        self.fold(common)
        for byte in word[common:]:
            self.edges.append({})
            self.final.append(False)
            self.edges[self.path[-1]][byte] = len(self.edges) - 1
            self.path.append(len(self.edges) - 1)
        self.final[self.path[-1]] = True
        self.last = word

    def fold(self, keep: int) -> None:
        """Replaces the states behind the first ``keep`` bytes of the last word by equal ones that exist."""
        while len(self.path) > keep + 1:
            state = self.path.pop()
            shape = (self.final[state], *self.edges[state].items())
            self.edges[self.path[-1]][self.last[len(self.path) - 1]] = self.known.setdefault(shape, state)

    def arrays(self) -> dict[str, np.ndarray]:
        """Transitions by open addressing over state << 8 | byte, with goal and number of words before."""
        self.fold(0)
        words: dict[int, int] = {}

        def behind(state: int) -> int:
            if state not in words:
                words[state] = self.final[state] + sum(behind(s) for s in self.edges[state].values())
            return words[state]

        number = {0: 0}
        todo, found = [0], []
        while todo:
            state = todo.pop()
            skip = int(self.final[state])
            for byte, goal in sorted(self.edges[state].items()):
                if goal not in number:
                    number[goal] = len(number)
                    todo.append(goal)
                found.append((number[state] << 8 | byte, number[goal], skip))
                skip += behind(goal)
        bits = max(8, (2 * len(found)).bit_length())
        key, goal, before = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32), np.zeros(1 << bits, np.int32)
        for k, g, s in found:
            at = ((k * 0x9E3779B97F4A7C15) & (1 << 64) - 1) >> 64 - bits
            while key[at] >= 0:
                at = (at + 1) & (1 << bits) - 1
            key[at], goal[at], before[at] = k, g, s
        final = np.zeros(len(number), bool)
        final[[n for s, n in number.items() if self.final[s]]] = True
        return {"key": key, "goal": goal, "before": before, "final": final}


FIELDS = (("key", np.int64), ("goal", np.int32), ("before", np.int32), ("final", np.bool_), ("place", np.int64), ("ids", np.int32))


def compiled(words: list[bytes], table: Merges) -> bytes:
    """The file of the lexicon: the lengths of its arrays, then the arrays."""
    automaton = Automaton()
    words = sorted(set(words))
    for word in words:
        automaton.add(word)
    arrays = automaton.arrays()
    lists = [table.one(w) for w in words]
    arrays["place"] = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    arrays["ids"] = np.array([i for x in lists for i in x], np.int32)
    out = io.BytesIO()
    out.write(np.array([len(arrays[name]) for name, _ in FIELDS], np.int64).tobytes())
    for name, kind in FIELDS:
        raw = arrays[name].astype(kind).tobytes()
        out.write(raw + bytes(-len(raw) % 8))
    return out.getvalue()


class Lexicon:
    """A compiled lexicon, mapped from its file."""

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        sizes = raw[:8 * len(FIELDS)].view(np.int64)
        at = 8 * len(FIELDS)
        for (name, kind), size in zip(FIELDS, sizes.tolist(), strict=True):
            n = size * np.dtype(kind).itemsize
            setattr(self, name, raw[at:at + n].view(kind))
            at += n + -n % 8
        self.shift = np.uint64(64 - (len(self.key).bit_length() - 1))
        self.sizes = np.diff(self.place)

    def numbers(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The number of each word in the lexicon, -1 for others."""
        out = np.full(len(start), -1, np.int64)
        live = np.flatnonzero((end - start <= LONGEST) & (end > start))
        state, number = np.zeros(len(live), np.int64), np.zeros(len(live), np.int64)
        for k in range(LONGEST + 1):
            over = end[live] - start[live] == k
            if over.any():
                done = over & self.final[state]
                out[live[done]] = number[done]
                live, state, number = live[~over], state[~over], number[~over]
            if not len(live):
                break
            keys = state << 8 | data[start[live] + k]
            at = ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)
            todo = np.flatnonzero((self.key[at] != keys) & (self.key[at] >= 0))
            while len(todo):
                at[todo] = (at[todo] + 1) & (len(self.key) - 1)
                todo = todo[(self.key[at[todo]] != keys[todo]) & (self.key[at[todo]] >= 0)]
            hit = self.key[at] == keys
            at, live = at[hit], live[hit]
            state, number = self.goal[at].astype(np.int64), number[hit] + self.before[at]
        return out


@lru_cache(maxsize=2)
def lexicon(name: str) -> Lexicon:
    return Lexicon(SparkFiles.get(name))


def encode(texts: list[str], path: str, words: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one text after the other, and their number in each."""
    table = merges(path)
    all_ids, all_counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for first, last in blocks(texts):
        parts, special, owner = parts_of(texts[first:last], table.special)
        data, start, end, part_of = cut([normal(p, path) for p in parts], words_only=True)
        one, group = distinct(data, start, end)
        number = words.numbers(data, start[one], end[one])
        unseen = np.flatnonzero(number < 0)
        merged, unseen_size = table.merged(data, start[one[unseen]], end[one[unseen]])
        known = number >= 0
        size, place = np.zeros(len(one), np.int64), np.zeros(len(one), np.int64)
        size[known], place[known] = words.sizes[number[known]], words.place[number[known]]
        size[unseen], place[unseen] = unseen_size, len(words.ids) + np.cumsum(unseen_size) - unseen_size
        pool = np.concatenate([words.ids, merged])
        flat = pool[spread(place[group], size[group])]
        per_part = np.bincount(part_of, weights=size[group], minlength=len(parts)).astype(np.int64)
        ids, counts = assemble(last - first, special, owner, per_part, flat)
        all_ids.append(ids)
        all_counts.append(counts)
    return np.concatenate(all_ids), np.concatenate(all_counts)


@lru_cache(maxsize=2)
def strings(path: str) -> tuple[list[str], list[str]]:
    """The vocabulary string and the decimal form of each id."""
    table = merges(path)
    every = {**table.vocab, **table.special}
    found = [""] * (max(every.values()) + 1)
    for text, i in every.items():
        found[i] = text
    return found, [str(i) for i in range(len(found))]


def decode(ids: list[int], path: str) -> str:
    return " ".join(map(strings(path)[0].__getitem__, ids))


def word_counts(text: Column, docs: DataFrame) -> DataFrame:
    """(word, n) over all documents; each task adds up its own words before the shuffle."""
    return docs.select(F.explode(words_of(F.lower(text))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def frequent(counts: DataFrame, most: int) -> list[tuple[str, int]]:
    """At most ``most`` words with the largest counts, as (word, n).

    Counts are grouped by their leading bits into some hundred bins, and only the words
    above the bin that would exceed ``most`` leave the tasks.
    """
    drop = F.greatest(F.length(F.bin("n")) - 6, F.lit(0))
    floor = F.call_function("shiftleft", F.call_function("shiftright", F.col("n"), drop), drop)
    bins = counts.groupBy(floor.alias("floor")).agg(F.count("*").alias("words")).collect()
    held, lowest = 0, None
    for row in sorted(bins, reverse=True):
        held += row["words"]
        if held > most:
            break
        lowest = row["floor"]
    if lowest is None:
        return []
    return sorted((r["word"], r["n"]) for r in counts.where(F.col("n") >= lowest).collect())


def compile_lexicon(docs: DataFrame, path: str, text: str = "text", size: int = LEXICON) -> str:
    """Writes the lexicon of the documents to the shared folder, hands it to the executors and returns its name."""
    spark = docs.sparkSession
    counts = word_counts(F.col(text), docs).where((F.length("word") <= LONGEST) & (F.col("n") > 1))
    top = frequent(landed(counts, "words"), COUNTED)
    weight: dict[bytes, int] = {}
    texts = [normal(word, path) for word, _ in top]
    data, start, end, owner = cut(texts, words_only=True)
    for s, e, i in zip(start.tolist(), end.tolist(), owner.tolist(), strict=True):
        piece = data[s:e].tobytes()
        weight[piece] = weight.get(piece, 0) + top[i][1]
    chosen = sorted(weight, key=lambda w: (-weight[w], w))[:size]
    name = f"lexicon-{uuid.uuid4().hex}"
    uri = f"{scratch(spark, 'lexicon')}/{name}"
    files, place = file_system(uri)
    files.create_dir(place.rsplit("/", 1)[0])
    with files.open_output_stream(place) as out:
        out.write(compiled([w for w in chosen if len(w) <= LONGEST], merges(path)))
    spark.sparkContext.addFile(uri)
    return name


def coded(docs: DataFrame, path: str, work: Callable[[list[list[int]]], dict], schema: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes every text and returns what ``work`` makes of the ids of a batch."""
    name = compile_lexicon(docs, path, text)

    def of_texts(texts: list[str]) -> dict:
        parts: list[dict] = []
        for first, last in blocks(texts):
            ids, counts = encode(texts[first:last], path, lexicon(name))
            ends = np.cumsum(counts).tolist()
            flat = ids.tolist()
            parts.append(work([flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]))
        return {key: [x for part in parts for x in part[key]] for key in (parts[0] if parts else work([]))}

    return each_text(docs, doc_id, text, of_texts, schema)


def encoded(docs: DataFrame, path: str, **columns: str) -> DataFrame:
    """doc_id and ids of every document."""
    return coded(docs, path, lambda ids: {"ids": ids}, "ids array<long>", **columns)


def digests(docs: DataFrame, path: str, **columns: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    def of_ids(ids: list[list[int]]) -> dict:
        decimal = strings(path)[1]
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        return {"n_tokens": [len(x) for x in ids], "ids_sha256": [sha(" ".join(map(decimal.__getitem__, x))) for x in ids],
                "decoded_sha256": [sha(decode(x, path)) for x in ids]}

    return coded(docs, path, of_ids, "n_tokens long, ids_sha256 string, decoded_sha256 string", **columns)
