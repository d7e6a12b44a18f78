import random

import pytest
from texts import prose, word

from tidemark.llm import decontam, substring
from tidemark.llm.common import materialize


@pytest.fixture(scope="module")
def tables(spark, make, tmp_path_factory):
    """Documents of all kinds, labels and a benchmark."""
    rng = random.Random(21)
    items = [(k, prose(rng, rng.randint(15, 40)) + ".") for k in range(20)]
    passage = prose(rng, 60)
    rows, labels = [], []
    for k in range(400):
        good = rng.random() < 0.75
        text = prose(rng, rng.randint(30, 150))
        if not good:
            text = " ".join(w + rng.choice(["%%%", "!!", " |"]) for w in text.split())
        rows.append((k, text))
        labels.append((k, int(good), int(rng.random() < 0.1)))
    good = [i for i, y, _ in labels if y]
    by = dict(rows)
    for k in range(30):
        rows.append((1000 + k, by[good[k % 3]]))
    for k in range(40):
        w = by[good[10 + k]].split()
        w[rng.randrange(len(w))] = word(rng)
        rows.append((1100 + k, " ".join(w)))
    for k in range(10):
        rows.append((1200 + k, f"{prose(rng, 50)} {passage} {prose(rng, 20)}"))
        rows.append((1300 + k, f"{prose(rng, 50)} {items[k][1]} {prose(rng, 20)}"))
    rows += [(1400, None), (1401, ""), (None, prose(rng, 50)), (1402, prose(rng, 6000)), (1000, rows[400][1])]
    rng.shuffle(rows)
    folder = f"file://{tmp_path_factory.mktemp('tables')}"
    make(rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, labels, items, passage


def test_each_stage_on_what_the_one_before_kept(spark, tables):
    import corpus_pipeline as c

    folder, rows, labels, items, passage = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = docs.columns
    seen = [docs]
    for name, f in c.STAGES:
        seen.append(materialize(f(spark, seen[-1], folder), name))
    for d in seen[1:-1]:
        assert d.columns == names
    kept = [{r["doc_id"] for r in d.select("doc_id").collect()} for d in seen]
    truth = {i: y for i, y, _ in labels}
    good = {i for i, y in truth.items() if y}
    # quality: junk goes, and hardly anything else
    assert len(good - kept[1]) <= 0.03 * len(good) and len(kept[1] & (set(truth) - good)) <= 0.08 * (len(truth) - len(good))
    # near duplicates: copies and near copies of kept documents go, the rest stays
    assert not kept[2] & {*range(1000, 1030)} or not {i for i in good} & kept[1]
    assert len(kept[2] & {*range(1100, 1140)} & kept[1]) <= 4
    assert {i for i in kept[1] if i is not None and (i < 400 or 1200 <= i < 1400 or i == 1402)} <= kept[2]
    # substring: the passage stays with its first document
    texts = {r["doc_id"]: r["text"] for r in seen[3].collect()}
    first = min(i for i in kept[2] if i is not None and 1200 <= i < 1210)
    assert [i for i, t in texts.items() if passage in " ".join((t or "").split())] == [first]
    assert kept[3] == kept[2]
    # decontamination
    leaked = {i for i in kept[3] if i is not None and 1300 <= i < 1310}
    assert kept[4] == kept[3] - leaked and leaked
    # packing takes every document that is left, whole
    pieces = seen[5].groupBy("doc_id").count().collect()
    assert {r["doc_id"] for r in pieces} == kept[4]


def test_run_writes_every_stage(spark, tables):
    import corpus_pipeline as c

    out = c.run(spark, tables[0])
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.groupBy("sequence_id").sum("length").agg({"sum(length)": "max"}).first()[0] <= 1024


def test_empty_documents(spark, make, tables, tmp_path):
    import corpus_pipeline as c

    docs = make([])
    for _, f in c.STAGES:
        docs = f(spark, docs, tables[0])
    assert docs.count() == 0
    assert decontam and substring


def test_entry_lists_them():
    import __spark_entry__ as entry

    names = list(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
