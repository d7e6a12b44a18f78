import random

import pytest
from texts import prose, word

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Frames of (doc_id, text) with the columns of documents and more, whose names clash with what operators use inside."""

    def run(rows, extra=True):
        full = [(i, t, None if t is None else "en", "s", None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(full, SCHEMA)
        if extra:
            from pyspark.sql import functions as F

            for name in ("batch", "rest", "fp", "size", "shard", "h", "n", "score", "part", "rank", "length", "piece", "t1", "key", "sketch", "root", "least", "n_words"):
                df = df.withColumn(name, F.lit(name))
        return df

    return run


@pytest.fixture(scope="session")
def corpus():
    """Texts with copies, near copies, shared passages, nulls, empty, blank and long texts and repeated rows."""
    rng = random.Random(5)
    base = [prose(rng, rng.randint(3, 120)) for _ in range(60)]
    passage = prose(rng, 30)
    rows = list(enumerate(base))
    rows += [(100 + k, base[k % 5]) for k in range(40)]
    for k in range(20):
        w = base[10 + k].split()
        w[rng.randrange(len(w))] = word(rng)
        rows.append((200 + k, " ".join(w)))
    rows += [(300 + k, f"{prose(rng, 20)} {passage} {prose(rng, 5)}") for k in range(12)]
    rows += [(400, None), (401, ""), (402, " \t\n"), (403, "one"), (404, "Two WORDS"), (405, prose(rng, 4000)), (406, passage), (407, None), (408, "Ünïcödé ẞ été x " * 5)]
    rows += [(300, rows[120][1]), (None, base[3]), (None, "nobody's text"), (403, "one")]
    return rows
