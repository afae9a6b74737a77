"""Token counts by a finite-state transducer (operator 4).

A byte-level BPE vocabulary is compiled into a deterministic transducer over bytes. Its
transitions carry the change of the token count: after a prefix of a piece is read, the
sum of the changes is the number of tokens of that prefix. It rests on one property of
byte-pair merges: a split into tokens is the right one exactly if every two neighbours
are, so each prefix has one last token, the one that may follow the last token of the
prefix before it. A state therefore needs no more than the tail of the prefix that could
still become part of a longer token, with the last token and the relative count at each
position in it. Prefixes with the same tail are one state. States and transitions are
compiled when the text first needs them and kept in arrays; when ``MAX_STATES`` is
reached the table starts anew, which changes nothing but the work.

Pieces are found by the machine of ``pieces``: it runs over chunks from all states, and
the chunks' state maps compose through a parallel prefix scan. A piece start resets the
transducer, so pieces are read side by side, one byte of each in a step.

Null counts as an empty text: no bytes, no tokens. Special strings are one token each,
as the tokenizers library counts them by default. Rows are counted one by one, so
repeated rows get equal counts, and an empty table gives no rows.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from newsloom.llm.common import each_text
from newsloom.llm.pieces import Merges, blocks, cut, distinct, merges, parts_of

#: A worker's table holds this many states before it starts anew.
MAX_STATES = 300_000
BLOCK = 1 << 19
LIMIT = 1024


class Transducer:
    def __init__(self, table: Merges):
        self.rank = table.rank
        ids = {table.letters[b]: b for b in range(256)}
        self.token: dict[bytes, int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for (a, b), (k, new) in table.rank.items():
            self.parts.setdefault(new, (k, a, b))
        made = {*self.parts, *table.plain.tolist()}
        for text, token in table.vocab.items():
            if token in made:
                self.token[bytes(ids[c] for c in text)] = token
        self.opens = {t[:k] for t in self.token for k in range(1, len(t))}
        self.pair: dict[tuple[int, int], bool] = {}
        self.spines: dict[tuple[int, bool], list[tuple[int, float]]] = {}
        self.reset()

    def reset(self) -> None:
        # Open addressing over state << 8 | byte.
        self.bits = 16
        self.key = np.full(1 << self.bits, -1, np.int64)
        self.goal = np.zeros(1 << self.bits, np.int32)
        self.change = np.zeros(1 << self.bits, np.int32)
        self.used = 0
        self.states: list[tuple[bytes, tuple[int, ...], tuple[int, ...]]] = [(b"", (-1,), (0,))]
        self.number = {self.states[0]: 0}

    def spine(self, token: int, right: bool) -> list[tuple[int, float]]:
        """The symbols at one edge of a token while it is merged, each with the rank that ends it."""
        found = self.spines.get((token, right))
        if found is None:
            part = self.parts.get(token)
            found = [(token, float("inf"))]
            if part is not None:
                inner = self.spine(part[2] if right else part[1], right)
                found = [*inner[:-1], (inner[-1][0], part[0]), *found]
            self.spines[token, right] = found
        return found

    def follows(self, a: int, b: int) -> bool:
        """Whether the merges of the bytes of ``a`` and ``b`` end in these two tokens."""
        known = self.pair.get((a, b))
        if known is None:
            left, right = self.spine(a, True), self.spine(b, False)
            i = j = 0
            known = True
            while known:
                (x, x_ends), (y, y_ends) = left[i], right[j]
                joined = self.rank.get((x, y))
                # Of equal ranks the leftmost pair merges first.
                known = not (joined and joined[0] < x_ends and joined[0] <= y_ends)
                if x_ends == y_ends == float("inf"):
                    break
                if x_ends <= y_ends:
                    i += 1
                else:
                    j += 1
            self.pair[a, b] = known
        return known

    def after(self, state: int, byte: int) -> tuple[int, int]:
        """The state after one more byte, and the change of the token count."""
        tail, lasts, counts = self.states[state]
        text = tail + bytes([byte])
        for k in range(len(text)):
            token = self.token.get(text[k:])
            if token is not None and (lasts[k] < 0 or self.follows(lasts[k], token)):
                break
        else:
            raise ValueError("no split of this text into tokens")
        change = counts[k] + 1
        lasts, counts = (*lasts, token), (*(c - change for c in counts), 0)
        keep = next((k for k in range(len(text)) if text[k:] in self.opens), len(text))
        made = (text[keep:], lasts[keep:], counts[keep:])
        number = self.number.get(made)
        if number is None:
            number = self.number[made] = len(self.states)
            self.states.append(made)
        return number, change

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot that holds each key, or the free one where it belongs."""
        mask = (1 << self.bits) - 1
        at = ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)
        left = np.flatnonzero((self.key[at] != keys) & (self.key[at] >= 0))
        while len(left):
            at[left] = (at[left] + 1) & mask
            left = left[(self.key[at[left]] != keys[left]) & (self.key[at[left]] >= 0)]
        return at

    def add(self, keys: list[int], goals: list[int], changes: list[int]) -> None:
        if 2 * (self.used + len(keys)) > len(self.key):
            old = self.key >= 0
            keys = [*self.key[old].tolist(), *keys]
            goals = [*self.goal[old].tolist(), *goals]
            changes = [*self.change[old].tolist(), *changes]
            while 4 * len(keys) > 1 << self.bits:
                self.bits += 1
            self.key = np.full(1 << self.bits, -1, np.int64)
            self.goal = np.zeros(1 << self.bits, np.int32)
            self.change = np.zeros(1 << self.bits, np.int32)
            self.used = 0
        mask = (1 << self.bits) - 1
        for key, goal, change in zip(keys, goals, changes, strict=True):
            at = ((key * 0x9E3779B97F4A7C15) & (1 << 64) - 1) >> 64 - self.bits
            while self.key[at] >= 0:
                at = (at + 1) & mask
            self.key[at], self.goal[at], self.change[at] = key, goal, change
        self.used += len(keys)

    def counts(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The number of tokens of each piece."""
        if len(self.states) > MAX_STATES:
            self.reset()
        size = end - start
        order = np.argsort(-size, kind="stable")
        begin, state, total = start[order], np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        # Pieces still being read are the first ones in this order.
        going = len(order) - np.searchsorted(np.sort(size), np.arange(int(size.max(initial=0))), side="right")
        for k, n in enumerate(going.tolist()):
            keys = state[:n] << 8 | data[begin[:n] + k]
            at = self.slots(keys)
            missing = np.unique(keys[self.key[at] < 0])
            if len(missing):
                found = [self.after(key >> 8, key & 0xFF) for key in missing.tolist()]
                self.add(missing.tolist(), [f[0] for f in found], [f[1] for f in found])
                at = self.slots(keys)
            state[:n] = self.goal[at]
            total[:n] += self.change[at]
        out = np.empty(len(order), np.int64)
        out[order] = total
        return out


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    return Transducer(merges(path))


def count_tokens(texts: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and tokens of each text."""
    machine, special = transducer(path), merges(path).special
    n_bytes, n_tokens = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for first, last in blocks(texts, BLOCK):
        n_bytes[first:last] = [len(text.encode()) for text in texts[first:last]]
        parts, ids, owner = parts_of(texts[first:last], special)
        np.add.at(n_tokens, first + owner[ids >= 0], 1)
        data, start, end, part_of = cut(parts)
        if len(start):
            one, group = distinct(data, start, end)
            counts = machine.counts(data, start[one], end[one])[group]
            per_part = np.bincount(part_of, weights=counts, minlength=len(parts)).astype(np.int64)
            np.add.at(n_tokens, first + owner[ids < 0], per_part)
    return n_bytes, n_tokens


def token_counts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row; the vocabulary is at ``path`` on every worker."""
    def counted(texts: list[str]) -> dict:
        n_bytes, n_tokens = count_tokens(texts, path)
        return {"n_bytes": n_bytes, "n_tokens": n_tokens, "over_limit": n_tokens > limit}

    return each_text(docs, doc_id, text, counted, "n_bytes long, n_tokens long, over_limit boolean")
