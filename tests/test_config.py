from pathlib import Path

import pytest

from tidemark.config import expand, load


def test_placeholders(tmp_path):
    env = {"A": "x"}
    assert expand({"k": ["${A}", "${B:y}/${A}", 3, "${C:}"]}, env) == {"k": ["x", "y/x", 3, ""]}
    with pytest.raises(KeyError):
        expand("${NONE_SUCH}", env)
    (tmp_path / "c.yml").write_text("a: ${NONE_SUCH:1}\n")
    assert load(tmp_path / "c.yml") == {"a": "1"}


def test_command_line_batch_and_stream(spark, tmp_path, monkeypatch):
    """The whole batch chain and the stream on a small CSV feed."""
    from tidemark import cli
    from tidemark.sources.tables import Table

    head = "trans_date_trans_time,cc_num,merchant,category,amt,first,last,gender,street,city,state,zip,lat,long,city_pop,job,dob,trans_num,unix_time,merch_lat,merch_long,is_fraud,merch_zipcode"
    row = "2024-01-01 0{h}:00:00,4000000000001234,fraud_m,{c},{a},F,L,M,S,C,NY,10001,40.0,-73.0,1,J,1980-01-01,{n:032x},1,41.0,-73.0,{f},"
    for split, base in (("train", 0), ("test", 100)):
        (tmp_path / f"{split}.csv").write_text("\n".join([head, *(row.format(h=k % 10, c="food" if k % 2 else "net", a=5 + k, n=base + k, f=int(k % 20 == 0)) for k in range(60))]) + "\n")
    (tmp_path / "category_ref.csv").write_text("category,channel\nfood,in_person\nnet,online\n")
    monkeypatch.setattr(cli.session, "create", lambda *a, **k: spark)
    monkeypatch.delenv("TIDEMARK_SALT", raising=False)
    contracts = str(Path(__file__).resolve().parents[1] / "conf" / "contracts")
    args = ["--root", f"file://{tmp_path}/lake", "--input", f"file://{tmp_path}", "--once", "--contracts", contracts, "--reports", f"{tmp_path}/reports"]
    cli.main(["bronze", *args])
    with pytest.raises(SystemExit):
        cli.main(["silver", *args])
    monkeypatch.setenv("TIDEMARK_SALT", "s")
    for command in ("batch", "train", "produce", "consume", "score-stream", "summary", "contracts"):
        cli.main([command, *args])
    lake = f"file://{tmp_path}/lake"
    silver = Table(spark, f"{lake}/silver/transactions").read()
    assert silver.count() == 120 and not {"first", "last", "street", "lat", "long", "dob", "cc_num"} & set(silver.columns)
    assert Table(spark, f"{lake}/stream/txn_decisions").read().count() == 120
    assert silver.columns == list(__import__("tidemark.operators.conform", fromlist=["SILVER"]).SILVER)
    reports = sorted(p.name for p in (tmp_path / "reports").glob("*__latest.json"))
    assert len(reports) == 11 and all('"status": "PASSED' in (tmp_path / "reports" / r).read_text() for r in reports)


def test_downloads_are_whole_or_absent(tmp_path):
    from tidemark.sources import download

    source = tmp_path / "source.bin"
    source.write_bytes(b"x" * 1000)
    url = source.as_uri()
    m = download.fetch_all({"a.bin": url}, tmp_path / "in", least_bytes=1000)
    assert m[0]["bytes"] == 1000 and len(m[0]["sha256"]) == 64
    source.write_bytes(b"y")
    assert download.fetch(url, tmp_path / "in" / "a.bin")["bytes"] == 1000  # it is there
    with pytest.raises(download.TooSmall):
        download.fetch(url, tmp_path / "in" / "a.bin", 10, force=True)
    assert (tmp_path / "in" / "a.bin").stat().st_size == 1000 and not list((tmp_path / "in").glob("*.part"))
