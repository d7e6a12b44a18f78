import pytest
from pyspark.sql import functions as F

from tidemark.sources import feeds
from tidemark.sources.tables import AuditError, Files, Table, buckets, days, export, overwrite_partitions, reconcile, workdir, write_csv


def test_a_failed_audit_leaves_the_table(spark):
    t = Table(spark, workdir(spark))
    with pytest.raises(FileNotFoundError):
        t.read()
    t.publish(spark.range(3))

    def refuse(df):
        raise AuditError("no")

    with pytest.raises(AuditError):
        t.publish(spark.range(9), refuse)
    assert t.read().count() == 3
    assert len([x for x in t.files.list(t.path) if x.startswith("tidemark_version=")]) == 2  # the refused version stays for a look


def test_readers_keep_their_version(spark):
    t = Table(spark, workdir(spark))
    t.publish(spark.range(3))
    old = t.read()
    t.publish(spark.range(5))
    assert (old.count(), t.read().count()) == (3, 5)


def test_upsert_is_idempotent(spark):
    t = Table(spark, workdir(spark))
    rows = lambda *x: spark.createDataFrame(list(x), "k string, v int")
    t.upsert(rows(("a", 1), ("b", 1), (None, 1)), ["k"], 0)
    for _ in range(2):
        t.upsert(rows(("b", 2), ("c", 2), (None, 2)), ["k"], 1)
    assert sorted((r["k"] or "", r["v"]) for r in t.read().collect()) == [("", 2), ("a", 1), ("b", 2), ("c", 2)]


def test_upsert_touches_only_its_partitions(spark):
    t = Table(spark, workdir(spark), ["d"], keyed_partitions=True)
    rows = lambda *x: spark.createDataFrame(list(x), "k int, v int, d string")
    t.upsert(rows((1, 1, "01"), (2, 1, "02"), (3, 1, None)), ["k", "d"])
    before = t._manifest()["partitions"]
    t.upsert(rows((2, 2, "02"), (4, 2, "03")), ["k", "d"])
    after = t._manifest()["partitions"]
    assert sorted((r["k"], r["v"], r["d"]) for r in t.read().collect()) == [(1, 1, "01"), (2, 2, "02"), (3, 1, None), (4, 2, "03")]
    assert {p for p in before if before[p] == after[p]} == {"d=01", "d=__HIVE_DEFAULT_PARTITION__"} and before["d=02"] != after["d=02"]


def test_partition_overwrite_leaves_others(spark):
    path = workdir(spark)
    overwrite_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), path, ["p"])
    overwrite_partitions(spark.createDataFrame([(3, "b"), (4, "c")], "v int, p string"), path, ["p"])
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [1, 3, 4]


def test_export_and_reconcile(spark):
    path = workdir(spark)
    df = spark.range(10).withColumn("t", F.timestamp_seconds("id"))
    m = export(spark, {"a": (df, "t", False), "gone": (None, None, True)}, path)
    assert m[0]["row_count"] == 10 and m[0]["watermark"].startswith("1970-01-01 00:00:09")
    assert reconcile(spark, path) == {"a": (10, 10)}
    spark.range(1).write.mode("append").parquet(f"{path}/a")
    with pytest.raises(AuditError):
        reconcile(spark, path)
    with pytest.raises(FileNotFoundError):
        export(spark, {"gone": (None, None, False)}, path)


def test_csv_extract_and_scan(spark, tmp_path):
    write_csv(spark.createDataFrame([("x", "online")], feeds.CATEGORY_REF), f"{tmp_path}/c")
    assert feeds.read_csv(spark, f"{tmp_path}/c", feeds.CATEGORY_REF).collect()[0]["channel"] == "online"
    (tmp_path / "d.csv").write_text("Unnamed: 0,a,when\n0,1.5,2020-01-01 00:00:00\n")
    assert feeds.read_csv(spark, f"{tmp_path}/d.csv", None).columns == ["a", "when"]


def test_pointer_is_replaced(spark, tmp_path):
    f = Files(spark, f"file://{tmp_path}")
    for text in ("one", "two"):
        f.write(f"file://{tmp_path}/p", text)
    assert f.read(f"file://{tmp_path}/p") == "two" and f.list(f"file://{tmp_path}") == ["p"]


def test_malformed_messages_are_dropped(spark):
    df = spark.createDataFrame([('{"trans_num":"a","event_ts":"2024-01-01T00:00:00","amt":1}',), ("{broken",), ('{"trans_num":"b","event_ts":"soon"}',), (None,)], "value string")
    assert [r["trans_num"] for r in feeds.decode_events(df).collect()] == ["a"]


def test_replaced_partitions(spark, tmp_path):
    """Named partitions are new or gone, the others keep their files."""
    table = Table(spark, f"file://{tmp_path}/r", ["k"])
    frame = lambda rows: spark.createDataFrame(rows, "v int, k int")
    table.replace(frame([(1, 0), (2, 1), (3, 2)]), ["k=0", "k=1", "k=2"])
    before = {f for f in table.read().inputFiles() if "/k=2/" in f}
    out = table.replace(frame([(4, 1), (5, 1), (6, 3)]), ["k=0", "k=1", "k=3"])
    assert sorted(map(tuple, out.collect())) == [(3, 2), (4, 1), (5, 1), (6, 3)]
    assert table.partitions() == ["k=1", "k=2", "k=3"]
    assert {f for f in table.read().inputFiles() if "/k=2/" in f} == before
    with pytest.raises(AuditError):
        table.replace(frame([(7, 9)]), ["k=1"])
    assert sorted(map(tuple, table.read().collect())) == [(3, 2), (4, 1), (5, 1), (6, 3)]


def test_transforms_are_partitions_that_readers_do_not_see(spark):
    t = Table(spark, workdir(spark), keyed_partitions=True, transforms={"d": days("at"), "b": buckets("k", 2)})
    rows = lambda *r: spark.createDataFrame(list(r), "k int, at string, v int").withColumn("at", F.col("at").cast("timestamp"))
    t.upsert(rows((1, "2024-01-01 10:00:00", 1), (2, "2024-01-02 10:00:00", 2), (3, None, 3)), ["k", "at"])
    before = t._manifest()["partitions"]
    t.upsert(rows((1, "2024-01-01 10:00:00", 9), (3, None, 4)), ["k", "at"])
    after = t._manifest()["partitions"]
    assert t.read().columns == ["k", "at", "v"]
    assert sorted((r["k"], r["v"]) for r in t.read().collect()) == [(1, 9), (2, 2), (3, 4)]
    assert sum(before[p] == after[p] for p in before) == 1  # the day that has no new rows keeps its files
    with pytest.raises(ValueError, match="named as transforms"):
        t.publish(rows((1, None, 1)).withColumn("d", F.lit(1)))


def test_a_table_without_transforms_is_taken_over(spark):
    path = workdir(spark)
    Table(spark, path).publish(spark.createDataFrame([(1, 1), (2, 2)], "k int, v int"))
    t = Table(spark, path, keyed_partitions=True, transforms={"b": buckets("k", 4)})
    t.upsert(spark.createDataFrame([(2, 5), (3, 6)], "k int, v int"), ["k"])
    assert sorted(map(tuple, t.read().collect())) == [(1, 1), (2, 5), (3, 6)]


def test_other_file_formats(spark):
    t = Table(spark, workdir(spark), ["p"], keyed_partitions=True, kind="orc")
    rows = lambda *x: spark.createDataFrame(list(x), "k int, p string")
    t.upsert(rows((1, "a"), (2, "b")), ["k"])
    t.upsert(rows((2, "b"), (3, "c")), ["k"])
    assert sorted(map(tuple, t.read().collect())) == [(1, "a"), (2, "b"), (3, "c")]
    assert any(name.endswith(".orc") for v in t._manifest()["partitions"].values() for name in t.files.list(f"{t.path}/{v}/p=a"))


def test_tables_of_the_catalog_are_overwritten_whole(spark):
    from tidemark.sources.tables import save_managed

    path = workdir(spark)
    try:
        for n in (5, 3):
            assert save_managed(spark.range(n), "tidemark_managed", "orc", path).count() == n
    finally:
        spark.sql("drop table if exists tidemark_managed")


def test_dashboard(spark):
    from tidemark.operators import conform
    from tidemark.plans import dashboard

    tx = conform.conform(feeds.transactions(spark, "/root/testdata/sf0.001", True), "salt")
    rejected = conform.classify(conform.conform(feeds.dirty_transactions(spark, "/root/testdata/sf0.001", True), "salt"), feeds.FEED_CATEGORIES).where("reject_reason is not null")
    rows = dashboard.collect(dashboard.figures(tx, rejected, "2024-02-01 00:00:00"))
    assert len(rows["tiles"]) == 1 and rows["tiles"][0]["txns"] == tx.count() and rows["tiles"][0]["quarantined"] == rejected.count()
    assert sum(r["txns"] for r in rows["daily"]) == tx.count() and len(rows["states"]) <= 12 and rows["quarantine"]
    page = dashboard.as_page(rows | {"windows": [{"category": "<b>"}], "none": []})
    assert "&lt;b&gt;" in page and "<p>no rows</p>" in page and dashboard.as_json(rows).startswith("{")
