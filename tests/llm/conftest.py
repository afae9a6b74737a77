import random

import pytest

LETTERS = ["alpha", "beta", "gamma", "delta", "eps", "zé", "日本", "x1", "It's", "<|endoftext|>"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with nulls, empty, blank and long texts, copies, repeated rows and clashing columns."""
    rng = random.Random(5)
    words = lambda n: " ".join(rng.choice(LETTERS) + str(rng.randrange(60)) for _ in range(n))
    passages = [words(70) for _ in range(3)]
    texts = []
    for _ in range(40):
        text = words(rng.randrange(1, 60))
        if rng.random() < 0.5:
            text = f"{text} {rng.choice(passages)[rng.randrange(20):]} {words(8)}"
        texts.append(text)
    base = words(120)
    near = [base.replace(base.split()[k], f"other{k}", 1) for k in (3, 50, 90)]
    texts += [base, *near, texts[3], texts[3].replace(" ", "\n\t"), f" {texts[4]} ", "", " \n", "q" * 3000, "ab" * 900,
              "one line of this text\n" * 90, words(6000), "123 456", "ß", "日" * 500, "a|b#c$ %& <> " * 30]
    rows = [(i, t, ["en", "de", "fr", None][i % 4], f"s{i % 3}" if i % 5 else None, i) for i, t in enumerate(texts)]
    rows += [(900, None, "en", "s1", None), (901, None, None, None, None), (None, texts[5], "en", "s0", 1), (None, "no id " * 30, "de", "s1", 2),
             (None, None, None, None, None), rows[7], rows[7], (7, "another text under the same id " * 20, "en", "s0", 3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame = spark.createDataFrame(rows, schema)
    # Columns named like those the operators make.
    for name in ("row", "h", "norm", "kept", "n_words", "grp", "digest", "spans", "bucket", "rest", "root", "d", "points"):
        frame = frame.selectExpr("*", f"'own' AS {name}")
    frame = frame.cache()
    yield frame
    frame.unpersist()


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


@pytest.fixture(scope="session")
def texts_of():
    def collect(df):
        return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]

    return collect
