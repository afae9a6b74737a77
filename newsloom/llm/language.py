"""Language identification in two steps (operator 3).

The family of a language is predicted first; inside a family of several languages, linear
support vector machines for each pair of languages vote. Features are hashed n-grams of
one to ``ORDER`` letters of the lower-cased text, with word bounds, as relative
frequencies over the whole text. A machine's margin is then a mean of weights over the
text's n-grams, so a text of any length is scored in one pass without keeping counts.

Training uses a bounded sample, about ``SAMPLE`` texts of a language (fewer if all would
exceed ``SAMPLE_TOTAL``), chosen by the hash
of the text among all rows whose ``learn`` flag is set and whose language is known. Texts
are sampled whole. The machines (squared hinge loss, L2 penalty) are fitted on the driver:
``SAMPLE`` x languages x ``FEATURES`` numbers. Families are those of FAMILIES; a language
that is not listed is a family of its own.

A text that is null or has no letter is ``und`` with score 0. Without any learnable row
every text is ``und``; with one language every other text has that language. The score is
the product of the logistic margins of the decisions taken, halved where votes are tied.
Repeated rows get equal results; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import each_text
from newsloom.llm.pieces import LETTER, blocks, classes

#: Sampled texts of a language, and of all languages together.
SAMPLE, SAMPLE_TOTAL = 300, 6_000
FEATURES = 1 << 12
ORDER = 4
ROUNDS = 300
PENALTY = 1e-5

#: Families of languages by ISO 639-1 code.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "turkic": "az kk ky tk tr tt uz",
    "indic": "bn gu hi mr ne pa si ur",
    "semitic": "am ar he mt",
}


def family(lang: str) -> str:
    code = lang.split("-")[0].split("_")[0].lower()
    return next((name for name, codes in FAMILIES.items() if code in codes.split()), f"other {lang}")


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text and order, the feature of every n-gram: features, text of each, and whether a text has a letter."""
    points = np.frombuffer("".join(t.lower() + "\0" for t in texts).encode("utf-32-le"), np.uint32)
    ends = np.flatnonzero(points == 0) if not any("\0" in t for t in texts) else np.cumsum([len(t.lower()) + 1 for t in texts]) - 1
    letter = classes()[points] == LETTER
    letter[ends] = False
    # Everything between words becomes one blank.
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    signs = np.where(letter, points, 32).astype(np.uint64)[keep]
    owner = np.searchsorted(ends, np.flatnonzero(keep), side="left")
    features, owners = [], []
    with np.errstate(over="ignore"):
        for n in range(1, ORDER + 1):
            h = np.full(max(0, len(signs) - n + 1), n, np.uint64)
            for k in range(n):
                h = (h ^ signs[k:k + len(h)]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            same = owner[:len(h)] == owner[n - 1:]
            features.append((h >> np.uint64(20)).astype(np.int64)[same] & (FEATURES - 1))
            owners.append(owner[:len(h)][same])
    has = np.zeros(len(texts), bool)
    has[owner] = True
    return np.concatenate(features), np.concatenate(owners), has


def means(texts: list[str], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The mean over each text's n-grams of each row of ``weights``, and whether a text has a letter."""
    out, letters = np.zeros((len(texts), len(weights))), np.zeros(len(texts), bool)
    for first, last in blocks(texts):
        features, owner, has = grams(texts[first:last])
        count = np.maximum(np.bincount(owner, minlength=last - first), 1)
        for k, w in enumerate(weights):
            out[first:last, k] = np.bincount(owner, weights=w[features], minlength=last - first) / count
        letters[first:last] = has
    return out, letters


def frequencies(texts: list[str]) -> np.ndarray:
    """The feature vector of each text."""
    out = np.zeros((len(texts), FEATURES), np.float32)
    for i, text in enumerate(texts):
        features, _, _ = grams([text])
        if len(features):
            out[i] = np.bincount(features, minlength=FEATURES) / len(features)
    return out


def machine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a linear support vector machine with bias for labels of -1 and 1, by accelerated gradient steps."""
    scale = 1 / max(float(np.sqrt((x ** 2).sum(axis=1)).mean()), 1e-9)
    x = np.hstack([x * scale, np.ones((len(x), 1))]).astype(np.float32)
    y = y.astype(np.float32)
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    v = np.ones(x.shape[1], np.float32)
    for _ in range(20):
        v = x.T @ (share * (x @ v))
        v /= np.linalg.norm(v)
    step = np.float32(1 / (2.2 * float(np.linalg.norm(x.T @ (share * (x @ v)))) + PENALTY))
    w = z = np.zeros(x.shape[1], np.float32)
    for k in range(ROUNDS):
        slack = np.maximum(0, 1 - y * (x @ z))
        new = z - step * (np.float32(PENALTY) * z - 2 * (x.T @ (share * y * slack)))
        z = new + np.float32(k / (k + 3)) * (new - w)
        w = new
    return w[:-1].astype(np.float64) * scale + float(w[-1])  # features sum to one, so the bias can join every weight


@dataclass
class Model:
    """Weights of all machines; each machine tells its first label (positive) from its second."""

    weights: np.ndarray
    families: list[str]
    languages: dict[str, list[str]]
    names: list[tuple[str, str, str]]

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        if not self.families:
            return ["und"] * len(texts), [0.0] * len(texts)
        margins, letters = means(texts, self.weights)
        langs, scores = [], []
        for row, has in zip(margins, letters, strict=True):
            if not has:
                langs.append("und")
                scores.append(0.0)
                continue
            by = {name: float(m) for name, m in zip(self.names, row, strict=True)}
            group, sure = self.vote("family", self.families, by)
            lang, more = self.vote(group, self.languages[group], by)
            langs.append(lang)
            scores.append(sure * more)
        return langs, scores

    def vote(self, level: str, labels: list[str], by: dict[tuple[str, str, str], float]) -> tuple[str, float]:
        """The label with most pairwise wins, of equal ones that with the larger margins."""
        if len(labels) == 1:
            return labels[0], 1.0
        wins, total = dict.fromkeys(labels, 0), dict.fromkeys(labels, 0.0)
        for a, b in combinations(labels, 2):
            m = by[level, a, b]
            wins[a if m >= 0 else b] += 1
            total[a] += m
            total[b] -= m
        best = max(labels, key=lambda x: (wins[x], total[x]))
        sure = min(1 / (1 + np.exp(-4 * np.clip(by[level, a, b] * (1 if a == best else -1), -20, 20))) for a, b in combinations(labels, 2) if best in (a, b))
        tied = sum(w == wins[best] for w in wins.values()) > 1
        return best, float(sure) / (2 if tied else 1)


def sample(docs: DataFrame, learn: Column, text: str, lang: str, size: int) -> DataFrame:
    """(lang, text): about ``size`` different texts of each language, those with the smallest hashes."""
    rows = docs.where(learn).select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    rows = rows.withColumn("h", F.xxhash64("text", F.lit(7)))
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"))
    found = counts.collect()  # a row for each language
    if not found:
        return rows.select("lang", "text")
    size = min(size, max(1, SAMPLE_TOTAL // len(found)))
    share = {r["lang"]: min(1.0, 1.2 * size / max(r["n"], 1)) for r in found}
    limit = F.coalesce(F.create_map(*[x for k, v in share.items() for x in (F.lit(k), F.lit(int(v * (1 << 30))))])[F.col("lang")], F.lit(0))
    return rows.where(F.pmod("h", F.lit(1 << 30)) < limit).dropDuplicates(["lang", "h"]).select("lang", "text")


def fit(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang", size: int = SAMPLE) -> Model:
    chosen = sample(docs, learn, text, lang, size)

    def of_texts(texts: list[str]) -> dict:
        return {"x": [v.tobytes() for v in frequencies(texts)], "has": [bool(f) for f in means(texts, np.zeros((0, FEATURES)))[1]]}

    rows = each_text(chosen, "lang", "text", of_texts, "x binary, has boolean").where("has").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["x"]))  # each_text passes the language on as the key
    langs = np.array([r["doc_id"] for r in rows])
    x = np.array([np.frombuffer(r["x"], np.float32) for r in rows])
    languages: dict[str, list[str]] = {}
    for name in sorted(set(langs.tolist())):
        languages.setdefault(family(name), []).append(name)
    of = np.array([family(name) for name in langs])
    found, names = [], []
    for a, b in combinations(sorted(languages), 2):
        some = (of == a) | (of == b)
        found.append(machine(x[some], np.where(of[some] == a, 1.0, -1.0)))
        names.append(("family", a, b))
    for group, members in languages.items():
        for a, b in combinations(members, 2):
            some = (langs == a) | (langs == b)
            found.append(machine(x[some], np.where(langs[some] == a, 1.0, -1.0)))
            names.append((group, a, b))
    return Model(np.array(found).reshape(len(found), FEATURES), sorted(languages), languages, names)


def predicted(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # machines x FEATURES numbers

    def of_texts(texts: list[str]) -> dict:
        langs, scores = shared.value.predict(texts)
        return {"lang_pred": langs, "score": scores}

    return each_text(docs, doc_id, text, of_texts, "lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    """Whether a document is left out of training; a null doc_id is not held out and not learned from."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def cross_checked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score, learned from the rows that are not held out."""
    model = fit(docs, ~held_out(F.col(doc_id)) & F.col(doc_id).isNotNull(), text, lang)
    return predicted(docs, model, doc_id, text).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
