"""Check types. Each compiles to aggregates, and to a judgement of their values; new types are added with ``register``.

A check's aggregates all go into the one aggregation of its contract. A check on a missing column fails and asks for nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, time, timezone
from typing import Any

from pyspark.sql import Column, functions as F
from pyspark.sql.types import StructType

from .spec import CheckSpec, ContractError, parse_duration


@dataclass(frozen=True)
class Outcome:
    passed: bool
    failing_rows: int = 0
    message: str = ""
    observed: dict[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class Context:
    schema: StructType
    as_of: datetime


@dataclass(frozen=True)
class Compiled:
    """``aggregates`` by name; ``judge`` takes their values and the row count; ``bad`` selects rows to show."""

    judge: Callable[[dict[str, Any], int], Outcome]
    aggregates: dict[str, Column] = field(default_factory=dict)
    bad: Column | None = None


Compiler = Callable[[dict[str, Any], Context], Compiled]
_types: dict[str, tuple[Compiler, tuple[str, ...]]] = {}


def register(name: str, *needs: str) -> Callable[[Compiler], Compiler]:
    """Make the function the compiler of checks of this type; ``needs`` are parameters that name columns, one or several."""

    def put(f: Compiler) -> Compiler:
        _types[name] = (f, needs)
        return f

    return put


def check_types() -> list[str]:
    return sorted(_types)


def _col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def compile_check(spec: CheckSpec, context: Context) -> Compiled:
    if spec.type not in _types:
        raise ContractError(f"{spec.name}: unknown check type {spec.type!r}; there are {', '.join(check_types())}")
    make, needs = _types[spec.type]
    named: list[str] = []
    for n in needs:
        if n not in spec.params:
            raise ContractError(f"{spec.name}: {spec.type} needs {n}")
        named += [spec.params[n]] if isinstance(spec.params[n], str) else list(spec.params[n])
    if gone := [c for c in named if c not in context.schema.names]:
        return Compiled(lambda _v, _n: Outcome(False, 0, f"no column {', '.join(gone)}"))
    return make(spec.params, context)


def _none_bad(bad: Column, what: str) -> Compiled:
    return Compiled(lambda v, _n: Outcome(not v["bad"], v["bad"], f"{v['bad']} {what}" if v["bad"] else ""), {"bad": F.count_if(bad)}, bad)


@register("schema")
def _schema(params: dict[str, Any], context: Context) -> Compiled:
    have = {f.name: f.dataType.simpleString() for f in context.schema.fields}
    want = {n: t for n, t in params["columns"]}
    wrong = [f"missing {n}" for n in want if n not in have] + [f"{n} is {have[n]}, not {t}" for n, t in want.items() if n in have and have[n] != t]
    if params.get("strict"):
        wrong += [f"undeclared {n}" for n in have if n not in want]
    return Compiled(lambda _v, _n: Outcome(not wrong, 0, "; ".join(wrong)))


@register("not_null", "columns")
def _not_null(params: dict[str, Any], context: Context) -> Compiled:
    names: Sequence[str] = params["columns"]
    tests = [_col(c).isNull() for c in names]
    some = tests[0]
    for t in tests[1:]:
        some = some | t

    def judge(v: dict[str, Any], _n: int) -> Outcome:
        by = {c: v[f"c{k}"] for k, c in enumerate(names) if v[f"c{k}"]}
        return Outcome(not by, sum(by.values()), ", ".join(f"{c}: {n} nulls" for c, n in by.items()), by)

    return Compiled(judge, {f"c{k}": F.count_if(t) for k, t in enumerate(tests)}, some)


@register("unique", "columns")
def _unique(params: dict[str, Any], context: Context) -> Compiled:
    """Null keys are equal to each other."""
    distinct = F.count_distinct(F.struct(*(_col(c) for c in params["columns"])))
    return Compiled(lambda v, n: Outcome(v["distinct"] == n, n - v["distinct"], f"{n - v['distinct']} duplicate rows" if v["distinct"] != n else ""), {"distinct": distinct})


register("unique_combination", "columns")(_unique)


@register("row_count")
def _row_count(params: dict[str, Any], context: Context) -> Compiled:
    low, high = params.get("min"), params.get("max")
    if low is None and high is None:
        raise ContractError("row_count needs min or max")
    return Compiled(lambda _v, n: Outcome((low is None or n >= low) and (high is None or n <= high), 0, f"{n} rows, not {low if low is not None else ''}..{high if high is not None else ''}", {"rows": n}))


def _range(column: str, low: Any, high: Any) -> Compiled:
    c = _col(column)
    outside = F.lit(False)
    if low is not None:
        outside = outside | (c < F.lit(low))
    if high is not None:
        outside = outside | (c > F.lit(high))
    bad = F.coalesce(outside, F.lit(False))

    def judge(v: dict[str, Any], _n: int) -> Outcome:
        return Outcome(not v["bad"], v["bad"], f"{v['bad']} rows outside, from {v['low']} to {v['high']}" if v["bad"] else "", {"min": v["low"], "max": v["high"]})

    return Compiled(judge, {"bad": F.count_if(bad), "low": F.min(c), "high": F.max(c)}, bad)


@register("accepted_range", "column")
def _accepted_range(params: dict[str, Any], context: Context) -> Compiled:
    if params.get("min") is None and params.get("max") is None:
        raise ContractError("accepted_range needs min or max")
    return _range(params["column"], params.get("min"), params.get("max"))


@register("percentage_range", "column")
def _percentage(params: dict[str, Any], context: Context) -> Compiled:
    return _range(params["column"], 0, 100)


@register("fraction_range", "column")
def _fraction(params: dict[str, Any], context: Context) -> Compiled:
    return _range(params["column"], 0, 1)


@register("positive_values", "column")
def _positive(params: dict[str, Any], context: Context) -> Compiled:
    return _none_bad(F.coalesce(_col(params["column"]) <= 0, F.lit(False)), "rows not above zero")


@register("accepted_values", "column")
def _accepted_values(params: dict[str, Any], context: Context) -> Compiled:
    return _none_bad(F.coalesce(~_col(params["column"]).isin(*params["values"]), F.lit(False)), "rows with other values")


@register("null_rate", "column")
def _null_rate(params: dict[str, Any], context: Context) -> Compiled:
    c, most = _col(params["column"]), float(params["max"])

    def judge(v: dict[str, Any], n: int) -> Outcome:
        rate = v["nulls"] / max(1, n)
        return Outcome(rate <= most, v["nulls"] if rate > most else 0, f"null rate {rate:.6f}, at most {most}" if rate > most else "", {"null_rate": rate})

    return Compiled(judge, {"nulls": F.count_if(c.isNull())}, c.isNull())


@register("expression")
def _expression(params: dict[str, Any], context: Context) -> Compiled:
    """A row for which the expression is null breaks it."""
    return _none_bad(~F.coalesce(F.expr(params.get("expr") or params["expression"]).cast("boolean"), F.lit(False)), "rows break the expression")


def _utc(value: Any) -> datetime:
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    if isinstance(value, date) and not isinstance(value, datetime):
        value = datetime.combine(value, time())
    return value.replace(tzinfo=timezone.utc) if value.tzinfo is None else value.astimezone(timezone.utc)


@register("freshness", "column")
def _freshness(params: dict[str, Any], context: Context) -> Compiled:
    most, as_of = parse_duration(params["max_age"]), _utc(params.get("as_of") or context.as_of)

    def judge(v: dict[str, Any], _n: int) -> Outcome:
        if v["latest"] is None:
            return Outcome(False, 0, "no rows to be fresh")
        age = (as_of - _utc(v["latest"])).total_seconds()
        return Outcome(age <= most, 0, f"latest is {age:.0f} s old, at most {most:.0f}" if age > most else "", {"age_seconds": age})

    return Compiled(judge, {"latest": F.max(_col(params["column"]).cast("string"))})
