import random

import pytest

SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"
#: Names that the operators use themselves.
CLASHES = ("row", "key", "kept", "score", "pieces", "n_words", "id", "set", "shard", "text_")


def sentence(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Distinct, copied, nearly copied, overlapping, short, empty, long and missing texts."""
    rng = random.Random(5)
    passage = sentence(rng, 60)
    base = [sentence(rng, rng.randrange(40, 160)) for _ in range(20)]
    near = [base[k].replace("w1", "x1", 1) for k in range(8)]
    holding = [f"{sentence(rng, 30)} {passage}\n{sentence(rng, 20)}" for _ in range(6)]
    odd = ["", " ", "\n\t ", "one", "one two", "one two", "a  b c　d ▁x", "é你好 😀" * 30, None, None]
    long = [" ".join([sentence(rng, 3000, 50)] * 2), "same " * 3000]
    return [*base, *base[:5], base[0], *near, *holding, *odd, *long]


@pytest.fixture(scope="session")
def docs(spark, texts):
    """All texts, with a missing id, a repeated id, a row repeated in full and clashing names."""
    rows = [(k, t, "en", f"s{k % 3}", len(t or "")) for k, t in enumerate(texts)]
    rows += [(None, "no id but words " * 20, None, None, None), (3, "id of another", "en", None, 3), rows[7]]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in CLASHES:
        df = df.selectExpr("*", f"'extra' AS `{name}`")
    return df


@pytest.fixture(scope="session")
def rows_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
