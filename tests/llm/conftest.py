import random

import pytest
from pyspark.sql import functions as F

#: Columns that clash with names the operators use inside.
CLASHING = ["block", "rank", "copy", "starts", "position", "size", "kept", "__doc", "task", "cell", "n_words"]


def words(rng, n, pool=400):
    return " ".join(f"w{rng.randrange(pool)}{'.' if rng.random() < 0.1 else ''}" for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """(doc_id, text, lang, source): copies, near copies, shared passages, lines, blanks and odd characters."""
    rng = random.Random(7)
    passage = words(rng, 90)
    line = words(rng, 30)
    out = []
    for k in range(60):
        body = words(rng, rng.choice([5, 60, 200, 400]), 5000)
        if k % 5 == 0:
            body = f"{body}\n{passage}\n{line}\nend {k}"
        if k % 7 == 0:
            body += f"\n{line}\n{passage}"
        out.append((k, body, "en" if k % 3 else "de", "hot" if k % 3 else f"s{k % 4}"))
    base = words(rng, 300, 9000).split()
    for k in range(60, 75):  # near copies
        own = list(base)
        for _ in range(k % 4):
            own[rng.randrange(300)] = f"x{k}"
        out.append((k, " ".join(own), "en", "hot"))
    for k in range(75, 80):  # exact copies
        out.append((k, out[3][1], "en", "hot"))
    out += [(80, None, "en", "hot"), (81, "", None, None), (82, " \n\t ", "en", "hot"), (83, "aé" * 900, "en", "s1"), (84, "a" * 1500, "en", "s1"), (85, "one two", "en", None)]
    out += [(86, "one two", "en", "s1"), (87, "Ünï çôdé " * 70, "fr", "hot"), (88, words(rng, 6000, 90000), "en", "hot"), (None, out[3][1], "en", "hot"), (5, out[5][1], "en", "hot")]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    df = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string")
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHING]).repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("false")
