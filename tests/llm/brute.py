"""Plain versions of the operators, for small tables."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def passages(rows, length):
    """doc_id, bytes, removed, runs, digest of what is left."""
    seen = Counter()
    for _, text in rows:
        data = (text or "").encode()
        seen.update(data[i:i + length] for i in range(len(data) - length + 1))
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if seen[data[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for k, g in enumerate(gone) if g and (not k or not gone[k - 1]))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out.append((doc_id, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text, width):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[k:k + width]) for k in range(len(words) - width + 1)}


def near_groups(rows, width, roots=False, percent=80):
    """doc_id, shingles, smallest doc_id reachable, for each row in turn; null ids come last."""
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(list)
    for i, items in enumerate(sets):
        for x in items:
            holders[x].append(i)
    both = Counter((a, b) for items in holders.values() for k, a in enumerate(items) for b in items[k + 1:])
    for (a, b), n in both.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            root[find(b)] = find(a)
    if roots:
        return [find(i) if s else None for i, s in enumerate(sets)]
    names = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            names[find(i)].append(doc_id)
    return [(d, len(s), min(names[find(i)]) if names[find(i)] else None) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]
