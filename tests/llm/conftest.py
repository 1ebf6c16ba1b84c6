import random

import pytest


@pytest.fixture(scope="session")
def corpus(spark):
    """Documents with the awkward cases: nulls, empty and very long texts, repeated rows, clashing column names."""
    rng = random.Random(11)
    words = [a + b for a in ("the", "on", "er", "Ti", "é", "nd") for b in ("re", "st", "ou", "ha", "ing", "ß")]
    make = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = make(60)
    texts = [None, "", " \n ", "one", "two words", base, base, base.replace("thre", "other", 1), base.upper(), make(20_000), make(300), make(80), "a\u00a0b  c\tİΣ\u2028x <|endoftext|> ▁"]
    for _ in range(12):  # near copies
        w = base.split()
        w[rng.randrange(len(w))] = "edit"
        texts.append(" ".join(w))
    texts += [make(rng.randrange(1, 200)) for _ in range(30)]
    rows = [(i, t, "en", "s", None if i % 5 == 0 else len(t or ""), i, "x") for i, t in enumerate(texts)]
    rows += [rows[5], (None, base, None, None, None, None, None), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_words int, rep string")


@pytest.fixture(scope="session")
def texts(corpus):
    return [(r.doc_id, r.text) for r in corpus.select("doc_id", "text").collect()]
