import datetime as dt
import json

import pytest
from pyspark.sql import DataFrame

from tidemark import contracts as c
from tidemark.contracts.spec import contract_from


@pytest.fixture
def frame(spark):
    t = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([("a", t, 10.0, "x"), ("b", t + dt.timedelta(minutes=5), 20.0, "y"), ("c", t + dt.timedelta(minutes=10), None, "z")], "trans_num string, trans_time timestamp, amt double, category string")


def run(frame, *checks, mode="warn", schema=None, **kinds):
    return c.validate(frame, contract_from({"name": "t", "mode": mode, "schema": schema or {}, "checks": list(checks)}), **kinds)


@pytest.mark.parametrize(
    ("check", "passed", "failing"),
    [
        ({"type": "row_count", "min": 3, "max": 3}, True, 0),
        ({"type": "row_count", "min": 4}, False, 0),
        ({"type": "not_null", "columns": ["amt", "category"]}, False, 1),
        ({"type": "unique", "columns": ["trans_num"]}, True, 0),
        ({"type": "accepted_range", "column": "amt", "min": 10, "max": 20}, True, 0),
        ({"type": "accepted_range", "column": "amt", "max": 15}, False, 1),
        ({"type": "accepted_values", "column": "category", "values": ["x", "y"]}, False, 1),
        ({"type": "null_rate", "column": "amt", "max": 0.34}, True, 0),
        ({"type": "null_rate", "column": "amt", "max": 0.3}, False, 1),
        ({"type": "expression", "expr": "amt > 5"}, False, 1),
        ({"type": "positive_values", "column": "amt"}, True, 0),
        ({"type": "fraction_range", "column": "amt"}, False, 2),
        ({"type": "percentage_range", "column": "amt"}, True, 0),
        ({"type": "freshness", "column": "trans_time", "max_age": "1 hour", "as_of": "2024-01-01T01:00:00"}, True, 0),
        ({"type": "freshness", "column": "trans_time", "max_age": 60, "as_of": "2024-01-01T01:00:00"}, False, 0),
        ({"type": "not_null", "columns": ["absent"]}, False, 0),
    ],
)
def test_each_check(frame, check, passed, failing):
    r = run(frame, check).results[0]
    assert (r.passed, r.failing_rows) == (passed, failing), r.message


def test_null_keys_are_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 1)], "k string, v int")
    assert run(df, {"type": "unique", "columns": ["k"]}).results[0].failing_rows == 1


def test_empty_table(frame):
    r = run(frame.limit(0), {"type": "null_rate", "column": "amt", "max": 0}, {"type": "freshness", "column": "trans_time", "max_age": 1}, {"type": "unique", "columns": ["trans_num"]})
    assert [x.passed for x in r.results] == [True, False, True]


def test_all_checks_in_one_aggregation(frame, monkeypatch):
    calls, agg = [], DataFrame.agg
    kind = type(frame)
    agg = kind.agg
    monkeypatch.setattr(kind, "agg", lambda self, *a: calls.append(1) or agg(self, *a))
    run(frame, {"type": "row_count", "min": 1}, {"type": "unique", "columns": ["trans_num"]}, {"type": "accepted_range", "column": "amt", "min": 0}, {"type": "not_null", "columns": ["category"]})
    assert len(calls) == 1


def test_severity_mode_and_examples(frame):
    warn = run(frame, {"type": "row_count", "min": 9, "severity": "warn"}, mode="fail")
    assert warn.status == "PASSED_WITH_WARNINGS"
    with pytest.raises(c.ContractViolation) as e:
        run(frame, {"type": "expression", "name": "big", "expr": "amt > 15"}, mode="fail")
    assert [x["trans_num"] for x in e.value.report.results[0].examples] == ["a", "c"]
    with pytest.raises(c.ContractError):
        run(frame, {"type": "row_count", "min": 1, "severity": "fatal"})


def test_schema(frame):
    cols = [{"name": "trans_num", "type": "string", "nullable": False}, {"name": "amt", "type": "double", "nullable": False}]
    loose = run(frame, schema={"columns": cols})
    assert [r.passed for r in loose.results] == [True, False] and loose.results[1].failing_rows == 1
    assert not run(frame, schema={"columns": cols, "strict": True}).results[0].passed
    assert not run(frame, schema={"columns": [{"name": "amt", "type": "int"}]}).results[0].passed


def test_bad_contracts(frame):
    for check in ({"type": "no_such"}, {"type": "accepted_range", "column": "amt"}, {"type": "row_count"}, {"type": "unique"}, {"name": "untyped"}):
        with pytest.raises(c.ContractError):
            run(frame, check)


def test_durations():
    assert [c.parse_duration(x) for x in ("3 days", "90 minutes", "1 hour", 5, "7", "2 weeks")] == [259200, 5400, 3600, 5, 7, 1209600]
    with pytest.raises(c.ContractError):
        c.parse_duration("soon")


def test_yaml_files_and_reports(frame, tmp_path, monkeypatch):
    monkeypatch.setenv("LOW", "3")
    (tmp_path / "t.yml").write_text("name: t\nmode: warn\nchecks:\n  - {type: row_count, min: 1}\n  - {type: expression, expr: 'amt > ${LOW} and amt < ${HIGH:99}'}\n")
    report = c.enforce(frame, "t", tmp_path)
    a, b = c.write_report(report, tmp_path / "out"), c.write_report(report, tmp_path / "out")
    assert a != b and json.loads((tmp_path / "out" / "t__latest.json").read_text())["status"] == "FAILED"
    with pytest.raises(KeyError):
        c.enforce(frame, "other", tmp_path)


def test_own_check_types(frame):
    from pyspark.sql import functions as F

    from tidemark.contracts.checks import Compiled, Outcome

    @c.register("sum_below", "column")
    def _sum(params, context):
        return Compiled(lambda v, n: Outcome(v["s"] < params["limit"]), {"s": F.sum(params["column"])})

    assert "sum_below" in c.check_types()
    assert [r.passed for r in run(frame, {"type": "sum_below", "column": "amt", "limit": 31}, {"type": "sum_below", "column": "amt", "limit": 30}).results] == [True, False]


def test_summary(spark, frame):
    ok = run(frame, {"type": "row_count", "min": 1})
    s = c.summarize(c.results_frame(spark, [ok])).first()
    assert (s["contract"], s["checks"], s["status"]) == ("t", 1, "PASSED")
