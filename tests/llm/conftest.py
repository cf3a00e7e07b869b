import random

import pytest


def prose(rng, n):
    parts = ["an", "be", "co", "di", "el", "fo", "gu", "ha", "in", "ju"]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text, lang, source) with copies, near copies, shared passages, nulls, empty, long and repeated texts."""
    rng = random.Random(11)
    passage = prose(rng, 45)
    rows = []
    for i in range(60):
        rows.append((i, prose(rng, rng.randrange(1, 160)), "en" if i % 2 else "fr", f"s{i % 7}"))
    for i in range(60, 75):
        rows.append((i, rows[i % 5][1], "en", "s0"))
    for i in range(75, 90):
        words = prose(random.Random(3), 150).split()
        words[i % 150] = "changed"
        rows.append((i, " ".join(words), "en", "s1"))
    for i in range(90, 100):
        rows.append((i, prose(rng, 30) + "\n" + passage + " \t" + prose(rng, 10), "en", "s2"))
    rows += [(100, None, None, None), (101, "", "en", "s0"), (102, " \n\t ", None, "s3"), (103, "one", "en", None), (104, "Ünï cødé 日本 " * 3, "xx", "s4"), (105, prose(rng, 9000), "en", "s5"), (106, "same same same " * 60, "en", "s6")]
    return rows


@pytest.fixture(scope="session")
def documents(spark, corpus):
    """The corpus with columns whose names clash with those the operators use."""
    rows = [(*r, len(r[1] or ""), 1.5, "x", 7) for r in corpus]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, key string, size int").repartition(5).persist()


@pytest.fixture(scope="session")
def no_documents(documents):
    return documents.filter("false")
