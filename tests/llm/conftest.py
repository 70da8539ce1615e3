import random

import pytest
from pyspark.sql import functions as F

#: Names that operators use for columns of their own.
CLASHING = ["id", "key", "rep", "n", "text_", "spans", "simhash", "c0", "source_", "copy", "rate", "order", "component", "words"]


def words(rng: random.Random, n: int, of: int = 400) -> list[str]:
    return [f"w{rng.randrange(of)}" for _ in range(n)]


def sample_texts() -> list[str | None]:
    """Copies, near copies, shared passages, white space of all kinds, empty
    and null texts, one very long text."""
    rng = random.Random(4)
    base = [words(rng, rng.randrange(1, 260)) for _ in range(40)]
    passage = words(rng, 90)
    out: list[str | None] = [" ".join(b) for b in base]
    out += [out[3], out[3], out[5], out[7]]
    for k in (3, 8, 12, 20):
        near = list(base[k])
        near[len(near) // 2] = "changed"
        out.append(" ".join(near))
    for k in (1, 9, 15):
        out.append(" ".join(base[k][:30] + passage + base[k][30:]))
    out.append("\t".join(passage[:70]) + "\n" + " ".join(words(rng, 40)))
    out += [None, "", "   ", " \t\n", "one", "one two", "ONE Two", "x" * 300, "be " * 200, "Ünïcödé ☃ 日本語 \U0001f600 text  with   runs \r\n of\x0bspace"]
    out.append(" ".join(words(rng, 30_000, 3000)))
    return out


@pytest.fixture(scope="session")
def texts() -> list[str | None]:
    return sample_texts()


@pytest.fixture(scope="session")
def docs(spark, texts):
    """documents with columns whose names clash; ids not in file order."""
    n = len(texts)
    rows = [((i * 37) % n * 3, t, f"s{min(i % 7, 3)}" if i % 11 else None, len(t) if t is not None else None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").repartition(5)
    for i, c in enumerate(CLASHING):
        df = df.withColumn(c, F.lit(i))
    return df


@pytest.fixture(scope="session")
def odd_docs(spark, docs):
    """The same with repeated rows, repeated ids and null ids."""
    again = docs.filter("doc_id % 2 = 0")
    nameless = docs.limit(5).withColumn("doc_id", F.lit(None).cast("long"))
    return docs.unionByName(again).unionByName(nameless)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.filter("false")
