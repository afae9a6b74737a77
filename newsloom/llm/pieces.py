"""Pre-tokenization by a finite-state machine, and merging of pieces, in numpy.

A text is cut into pieces (the units byte-pair merges stay inside) by a small
deterministic machine over character classes. A block of text is cut into chunks; for
each chunk the machine runs from all its states at once, which gives the chunk's state
map, and the maps compose through a parallel prefix scan. After the scan every chunk
knows its true first state and marks its piece starts. Whatever a rule needs to look
ahead (the next class, a contraction) is folded into the symbol of a position, so the
machine never backs up.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import regex
from tokenizers.pre_tokenizers import ByteLevel

#: Characters of text worked on at once; a longer text makes a block of its own.
BLOCK = 1 << 21
CHUNK = 256

LETTER, NUMBER, OTHER, SHORT, LONG, LAST_SPACE, LAST_BLANK, BLANK = range(8)
#: Symbols from here on are the same at the first position of a text, the last one leaves a state as it is.
FIRST, KEEP = 8, 16
NEUTRAL, IN_LETTERS, IN_NUMBERS, IN_OTHER, IN_BLANKS, PREFIX, ONE_MORE, TWO_MORE = range(8)

#: The characters that count as white space.
WHITE = [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache
def classes() -> np.ndarray:
    """The class of every code point: LETTER, NUMBER, OTHER or BLANK."""
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    text = "".join(map(chr, points))
    table = np.full(0x110000, OTHER, np.uint8)
    for pattern, first, kind in ((r"\p{L}", "L", LETTER), (r"\p{N}", "N", NUMBER)):
        table[[ord(c) for c in text if unicodedata.category(c)[0] == first]] = kind
        # Tables of characters differ by Unicode version: where two do, the tokenizer's own is asked.
        for c in regex.findall(pattern, text):
            if table[ord(c)] != kind:
                parts = [at for _, at in ByteLevel(add_prefix_space=False).pre_tokenize_str(f"a{c}1")]
                table[ord(c)] = LETTER if parts[0] == (0, 2) else NUMBER if (1, 3) in parts else OTHER
    table[WHITE] = BLANK
    return table


def machine(words_only: bool) -> tuple[np.ndarray, np.ndarray]:
    """Next state and "a piece starts here" for each (symbol, state), flattened.

    With ``words_only`` white space belongs to no piece, numbers are single and no
    piece has a leading space.
    """
    step = np.zeros((17, 8), np.uint8)
    starts = np.ones((17, 8), bool)
    new_state = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHER, SHORT: ONE_MORE, LONG: TWO_MORE,
                 LAST_SPACE: PREFIX, LAST_BLANK: NEUTRAL, BLANK: IN_BLANKS}
    if words_only:
        new_state |= {NUMBER: NEUTRAL, LAST_SPACE: NEUTRAL, BLANK: NEUTRAL}
    for symbol, state in new_state.items():
        step[symbol], step[symbol + FIRST] = state, state
    goes_on = [(LETTER, IN_LETTERS, IN_LETTERS), (LETTER, ONE_MORE, NEUTRAL), (LETTER, TWO_MORE, ONE_MORE)]
    goes_on += [(s, IN_OTHER, IN_OTHER) for s in (OTHER, SHORT, LONG)]
    if not words_only:
        goes_on += [(LETTER, PREFIX, IN_LETTERS), (NUMBER, PREFIX, IN_NUMBERS), (NUMBER, IN_NUMBERS, IN_NUMBERS), (BLANK, IN_BLANKS, IN_BLANKS)]
        goes_on += [(s, PREFIX, IN_OTHER) for s in (OTHER, SHORT, LONG)]
    for symbol, state, after in goes_on:
        step[symbol, state], starts[symbol, state] = after, False
    step[KEEP], starts[KEEP] = np.arange(8), False
    return step.ravel(), starts.ravel()


def symbols(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """The machine's symbol at each code point; ``firsts`` marks where texts begin."""
    kind = classes()[points]
    out = kind.copy()
    follows = np.empty(len(kind), bool)  # the next character is of the same text and not white space
    follows[:-1] = (kind[1:] != BLANK) & ~firsts[1:]
    follows[-1:] = False
    blank = kind == BLANK
    out[blank & follows] = LAST_BLANK
    out[blank & follows & (points == 0x20)] = LAST_SPACE
    at = np.flatnonzero((points == 0x27) & follows)
    if len(at):
        padded = np.concatenate([points, np.zeros(2, points.dtype)])
        one, two = padded[at + 1], padded[at + 2]
        same = at + 2 < len(points)
        same[same] = ~firsts[at[same] + 2]
        out[at[np.isin(one, [ord(c) for c in "stmd"])]] = SHORT
        pairs = [(ord(a), ord(b)) for a, b in ("re", "ve", "ll")]
        out[at[same & np.any([(one == a) & (two == b) for a, b in pairs], axis=0)]] = LONG
    out[firsts] += FIRST
    return out


def piece_starts(points: np.ndarray, firsts: np.ndarray, words_only: bool = False) -> np.ndarray:
    """Whether a piece (or a run of white space outside all pieces) starts at each code point."""
    n = len(points)
    if not n:
        return np.zeros(0, bool)
    step, begins = machine(words_only)
    lanes = -(-n // CHUNK)
    padded = np.full(lanes * CHUNK, KEEP, np.uint8)
    padded[:n] = symbols(points, firsts)
    by_step = np.ascontiguousarray(padded.reshape(lanes, CHUNK).T)
    maps = np.tile(np.arange(8, dtype=np.uint8), (lanes, 1))
    for row in by_step:
        maps = np.take(step, (row << 3)[:, None] + maps)
    # Prefix scan: maps[i] becomes the map of chunks 0 to i.
    distance = 1
    while distance < lanes:
        maps[distance:] = np.take_along_axis(maps[distance:], maps[:-distance], axis=1)
        distance *= 2
    state = np.zeros(lanes, np.uint8)
    state[1:] = maps[:-1, NEUTRAL]
    marks = np.empty((CHUNK, lanes), bool)
    for k, row in enumerate(by_step):
        at = (row << 3) + state
        marks[k], state = np.take(begins, at), np.take(step, at)
    return marks.T.ravel()[:n]


def blocks(texts: list[str], most: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` characters together."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def cut(texts: list[str], words_only: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, and the pieces: first byte, end, index of the text."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lengths)
    firsts = np.zeros(len(points), bool)
    firsts[(ends - lengths)[lengths > 0]] = True
    at = np.flatnonzero(piece_starts(points, firsts, words_only))
    width = (1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)).astype(np.int64)
    byte_at = np.cumsum(width) - width
    start = byte_at[at]
    end = np.append(start[1:], len(data))
    owner = np.searchsorted(ends, at, side="right")
    if words_only:
        used = classes()[points[at]] != BLANK
        start, end, owner = start[used], end[used], owner[used]
    return data, start, end, owner


_FACTOR = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_FACTOR), -1, 1 << 64))
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(n, _FACTOR)), np.cumprod(np.full(n, inverse))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span."""
    size = 1 << max(10, int(len(data)).bit_length())
    powers, inverses = _powers(size)
    with np.errstate(over="ignore"):
        mixed = (data.astype(np.uint64) + np.uint64(0x51)) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(29)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(mixed * powers[:len(data)], out=sums[1:])
        out = (sums[end] - sums[start]) * inverses[start]
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= (end - start).astype(np.uint64) * _FACTOR
        return out ^ (out >> np.uint64(32))


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of each span, one span after the other."""
    total = int(size.sum())
    ends = np.cumsum(size)
    return np.arange(total) + np.repeat(start - (ends - size), size)


def distinct(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first of each group of equal spans, and the group of each span.

    Spans are grouped by hash and then compared byte by byte; a span that differs
    from the first of its group makes a group of its own.
    """
    _, first, group = np.unique(span_hashes(data, start, end), return_index=True, return_inverse=True)
    size, other = end - start, first[group]
    odd = np.flatnonzero(size != size[other])
    even = np.flatnonzero(size == size[other])
    differs = data[spread(start[even], size[even])] != data[spread(start[other[even]], size[even])]
    if differs.any():
        odd = np.union1d(odd, even[np.unique(np.searchsorted(np.cumsum(size[even]), np.flatnonzero(differs), side="right"))])
    if len(odd):
        group[odd] = len(first) + np.arange(len(odd))
        first = np.append(first, odd)
    return first, group


class Merges:
    """Byte-pair merges of a tokenizer file, for many pieces at once."""

    #: Pieces with more symbols are merged one by one.
    LONG_PIECE = 200

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.letters = byte_letters()
        self.plain = np.array([self.vocab[c] for c in self.letters], np.int64)
        self.closing = np.array([self.vocab[c + self.suffix] for c in self.letters], np.int64)
        pairs = [tuple(m) if isinstance(m, (list, tuple)) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for k, (a, b) in enumerate(pairs):
            self.rank.setdefault((self.vocab[a], self.vocab[b]), (k, self.vocab[a + b]))
        self._table()

    def _table(self) -> None:
        bits = 19
        self.shift = np.uint64(64 - bits)
        self.key = np.full((1 << bits) + 64, -1, np.int64)
        self.value = np.zeros((1 << bits) + 64, np.int64)
        self.probes = 1
        for (a, b), (k, new) in self.rank.items():
            key = a << 20 | b
            at = ((key * int(_FACTOR)) & (1 << 64) - 1) >> 64 - bits
            far = 1
            while self.key[at] >= 0:
                at, far = at + 1, far + 1
            self.key[at], self.value[at] = key, k << 20 | new
            self.probes = max(self.probes, far)

    NONE = np.int64(1) << 60

    def look(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``rank << 20 | new symbol`` of each pair, NONE without a merge."""
        key = a << 20 | b
        at = ((key.astype(np.uint64) * _FACTOR) >> self.shift).astype(np.int64)
        out = np.full(key.shape, self.NONE)
        found = self.key[at]
        hit = found == key
        out[hit] = self.value[at[hit]]
        left = np.flatnonzero((~hit & (found >= 0)).ravel())
        flat_at, flat_key, flat_out = at.ravel(), key.ravel(), out.ravel()
        for far in range(1, self.probes):
            if not len(left):
                break
            found = self.key[flat_at[left] + far]
            hit = found == flat_key[left]
            flat_out[left[hit]] = self.value[flat_at[left[hit]] + far]
            left = left[~hit & (found >= 0)]
        return flat_out.reshape(key.shape)

    def one(self, data: bytes) -> list[int]:
        """The merged ids of one piece."""
        ids = self.plain[list(data)].tolist()
        if ids:
            ids[-1] = int(self.closing[data[-1]])
        after = list(range(1, len(ids) + 1))
        before = list(range(-1, len(ids) - 1))
        heap = [(self.rank[p][0], i, *p) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in self.rank]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= len(ids) or ids[j] != b:
                continue
            ids[i], ids[j] = self.rank[a, b][1], -1
            after[i] = after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < len(ids) and (ids[x], ids[y]) in self.rank:
                    heapq.heappush(heap, (self.rank[ids[x], ids[y]][0], x, ids[x], ids[y]))
        return [t for t in ids if t >= 0]

    def merged(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces, one piece after the other, and each piece's number of ids.

        Pieces of one length are merged together: each step joins the leftmost pair of
        lowest rank in every piece that has one, so all of them stay equally long.
        """
        size = end - start
        counts = np.zeros(len(size), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        order = np.argsort(size, kind="stable")
        for some in np.split(order, np.flatnonzero(np.diff(size[order])) + 1):
            length = int(size[some[0]]) if len(some) else 0
            if length > self.LONG_PIECE:
                for i in some:
                    ids = np.array(self.one(data[start[i]:end[i]].tobytes()), np.int64)
                    counts[i] = len(ids)
                    parts.append((np.array([i]), ids[None, :]))
                continue
            step = max(1, (1 << 20) // max(length, 1))
            for k in range(0, len(some) if length else 0, step):
                self._level(data, start, some[k:k + step], length, counts, parts)
        place = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), np.int64)
        for which, ids in parts:
            out[(place[which][:, None] + np.arange(ids.shape[1])).ravel()] = ids.ravel()
        return out, counts

    def _level(self, data: np.ndarray, start: np.ndarray, which: np.ndarray, length: int, counts: np.ndarray, parts: list) -> None:
        raw = data[start[which][:, None] + np.arange(length)]
        ids = self.plain[raw]
        ids[:, -1] = self.closing[raw[:, -1]]
        pairs = self.look(ids[:, :-1], ids[:, 1:])
        while True:
            if ids.shape[1] == 1:
                counts[which] = 1
                parts.append((which, ids))
                return
            best = np.argmin(pairs, axis=1)
            rows = np.arange(len(which))
            found = pairs[rows, best]
            done = found == self.NONE
            if done.any():
                counts[which[done]] = ids.shape[1]
                parts.append((which[done], ids[done]))
                going = ~done
                which, ids, pairs, best, found = which[going], ids[going], pairs[going], best[going], found[going]
                rows = np.arange(len(which))
                if not len(which):
                    return
            ids[rows, best] = found & 0xFFFFF
            stay = np.ones(ids.shape, bool)
            stay[rows, best + 1] = False
            ids = ids[stay].reshape(len(rows), -1)
            stay = np.ones(pairs.shape, bool)
            stay[rows, best] = False
            pairs = pairs[stay].reshape(len(rows), -1)
            left = np.flatnonzero(best > 0)
            pairs[left, best[left] - 1] = self.look(ids[left, best[left] - 1], ids[left, best[left]])
            right = np.flatnonzero(best < pairs.shape[1])
            pairs[right, best[right]] = self.look(ids[right, best[right]], ids[right, best[right] + 1])


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(hidden)) for b in range(0x100)]


@lru_cache(maxsize=4)
def merges(path: str) -> Merges:
    return Merges(path)


def split_special(text: str, special: dict[str, int]) -> list[str | int]:
    """Ordinary text and ids of special strings in turn; the leftmost special string wins."""
    out: list[str | int] = []
    while True:
        found = min(((text.find(s), -len(s), s) for s in special if s in text), default=None)
        if found is None:
            return [*out, text]
        at, _, s = found
        out += [text[:at], special[s]]
        text = text[at + len(s):]


def parts_of(texts: list[str], special: dict[str, int]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The ordinary parts of all texts, and for each item (part or special string) its id or -1 and its text."""
    parts, ids, owner = [], [], []
    for i, text in enumerate(texts):
        for item in split_special(text, special) if any(s in text for s in special) else (text,):
            if isinstance(item, str):
                parts.append(item)
            ids.append(item if isinstance(item, int) else -1)
            owner.append(i)
    return parts, np.array(ids, np.int64), np.array(owner, np.int64)


def assemble(n_texts: int, ids: np.ndarray, owner: np.ndarray, per_part: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts and their number in each, from the ids of their parts and the special ids between."""
    counts = np.ones(len(ids), np.int64)
    counts[ids < 0] = per_part
    ordinary = np.repeat(ids < 0, counts)
    out = np.empty(len(ordinary), np.int64)
    out[ordinary] = flat
    out[~ordinary] = ids[ids >= 0]
    return out, np.bincount(owner, weights=counts, minlength=n_texts).astype(np.int64)


def encode(texts: list[str], table: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one text after the other, and their number in each."""
    all_ids, all_counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for first, last in blocks(texts):
        parts, special, owner = parts_of(texts[first:last], table.special)
        data, start, end, part_of = cut(parts)
        one, group = distinct(data, start, end)
        merged, size = table.merged(data, start[one], end[one])
        flat = merged[spread((np.cumsum(size) - size)[group], size[group])]
        per_part = np.bincount(part_of, weights=size[group], minlength=len(parts)).astype(np.int64)
        ids, counts = assemble(last - first, special, owner, per_part, flat)
        all_ids.append(ids)
        all_counts.append(counts)
    return np.concatenate(all_ids), np.concatenate(all_counts)
