"""Evaluate contracts: one aggregation for all checks, then a look at examples of those that fail."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from .checks import Compiled, Context, compile_check
from .spec import Contract, load_contracts

EXAMPLES = 5


@dataclass(frozen=True)
class CheckResult:
    name: str
    type: str
    severity: str
    passed: bool
    failing_rows: int
    message: str
    observed: dict[str, Any] = field(default_factory=dict)
    examples: list[dict[str, Any]] = field(default_factory=list)


@dataclass(frozen=True)
class ContractReport:
    contract: str
    dataset: str
    rows: int
    at: str
    results: list[CheckResult]

    @property
    def status(self) -> str:
        failed = {r.severity for r in self.results if not r.passed}
        return "FAILED" if "error" in failed else "PASSED_WITH_WARNINGS" if failed else "PASSED"


class ContractViolation(Exception):
    def __init__(self, report: ContractReport):
        self.report = report
        super().__init__(f"{report.contract}: " + "; ".join(f"{r.name}: {r.message}" for r in report.results if not r.passed and r.severity == "error"))


def validate(df: DataFrame, contract: Contract, as_of: datetime | None = None, examples: int = EXAMPLES) -> ContractReport:
    """The contract's report. In mode ``fail`` a failed check of severity ``error`` raises ContractViolation."""
    now = datetime.now(timezone.utc)
    context = Context(df.schema, as_of or now)
    checks = [(s, compile_check(s, context)) for s in contract.all_checks]
    wanted = {f"k{k}__{name}": a for k, (_, c) in enumerate(checks) for name, a in c.aggregates.items()}
    values = df.agg(F.count(F.lit(1)).alias("rows"), *(a.alias(n) for n, a in wanted.items())).first().asDict()
    results = []
    for k, (spec, compiled) in enumerate(checks):
        own = {name: values[f"k{k}__{name}"] for name in compiled.aggregates}
        got = compiled.judge(own, values["rows"])
        results.append(CheckResult(spec.name, spec.type, spec.severity, got.passed, int(got.failing_rows), "" if got.passed else got.message, got.observed, [] if got.passed else _examples(df, compiled, examples)))
    report = ContractReport(contract.name, contract.dataset, values["rows"], now.isoformat(), results)
    if contract.mode == "fail" and report.status == "FAILED":
        raise ContractViolation(report)
    return report


def _examples(df: DataFrame, compiled: Compiled, n: int) -> list[dict[str, Any]]:
    return [r.asDict(recursive=True) for r in df.where(compiled.bad).limit(n).collect()] if compiled.bad is not None and n else []


def enforce(df: DataFrame, name: str, folder: str | Path, **kinds: Any) -> ContractReport:
    """Validate against the contract of that name in ``folder``."""
    contracts = load_contracts(folder)
    if name not in contracts:
        raise KeyError(f"no contract {name!r} in {folder}")
    return validate(df, contracts[name], **kinds)


def write_report(report: ContractReport, folder: str | Path) -> Path:
    """A file of its own for each report, and a copy as the contract's latest."""
    folder = Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    text = json.dumps(asdict(report) | {"status": report.status}, default=str, indent=1)
    path = folder / f"{report.contract}__{report.at.replace(':', '')}__{uuid.uuid4().hex[:8]}.json"
    path.write_text(text)
    (folder / f"{report.contract}__latest.json").write_text(text)
    return path


RESULTS = "contract string, check string, type string, severity string, passed boolean, failing_rows long, rows long"


def results_frame(spark: SparkSession, reports: Iterable[ContractReport]) -> DataFrame:
    """A row for each check of each report."""
    return spark.createDataFrame([(r.contract, c.name, c.type, c.severity, c.passed, c.failing_rows, r.rows) for r in reports for c in r.results], RESULTS)


def summarize(results: DataFrame) -> DataFrame:
    """A row for each contract: its checks, failures, warnings and status."""
    bad = ~F.col("passed")
    out = results.groupBy("contract").agg(F.count("*").alias("checks"), F.count_if(bad & (F.col("severity") == "error")).alias("errors"), F.count_if(bad & (F.col("severity") == "warn")).alias("warnings"))
    return out.withColumn("status", F.when(F.col("errors") > 0, "FAILED").when(F.col("warnings") > 0, "PASSED_WITH_WARNINGS").otherwise("PASSED"))
