"""What a contract says: columns with types, checks with parameters, read from YAML."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from ..config import expand

SECONDS = {"s": 1, "second": 1, "m": 60, "minute": 60, "h": 3600, "hour": 3600, "d": 86400, "day": 86400, "w": 604800, "week": 604800}


class ContractError(ValueError):
    """A contract that can't be understood."""


def parse_duration(value: str | int | float) -> float:
    """Seconds: "3 days", "90 minutes", or a bare number of seconds."""
    if isinstance(value, (int, float)):
        return float(value)
    m = re.fullmatch(r"\s*(\d+(?:\.\d+)?)\s*([A-Za-z]*?)s?\s*", str(value))
    unit = (m[2].lower() or "s") if m else ""
    if unit not in SECONDS:
        raise ContractError(f"not a duration: {value!r}")
    return float(m[1]) * SECONDS[unit]


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str
    nullable: bool = True


@dataclass(frozen=True)
class CheckSpec:
    type: str
    name: str
    params: dict[str, Any] = field(default_factory=dict)
    severity: str = "error"

    def __post_init__(self) -> None:
        if self.severity not in ("error", "warn"):
            raise ContractError(f"{self.name}: severity is error or warn, not {self.severity!r}")


@dataclass(frozen=True)
class Contract:
    name: str
    dataset: str = ""
    mode: str = "fail"
    columns: tuple[ColumnSpec, ...] = ()
    strict: bool = False
    checks: tuple[CheckSpec, ...] = ()

    def __post_init__(self) -> None:
        if self.mode not in ("fail", "warn"):
            raise ContractError(f"{self.name}: mode is fail or warn, not {self.mode!r}")

    @property
    def all_checks(self) -> tuple[CheckSpec, ...]:
        """The declared checks after those that the columns imply: their types, and that what isn't nullable has no nulls."""
        implied = []
        if self.columns:
            implied.append(CheckSpec("schema", "schema", {"columns": [(c.name, c.type) for c in self.columns], "strict": self.strict}))
            if needed := [c.name for c in self.columns if not c.nullable]:
                implied.append(CheckSpec("not_null", "required_columns", {"columns": needed}))
        return (*implied, *self.checks)


def contract_from(data: dict[str, Any]) -> Contract:
    if not isinstance(data, dict) or not data.get("name"):
        raise ContractError("a contract needs a name")
    schema = data.get("schema") or {}
    columns = tuple(ColumnSpec(c["name"], c["type"], c.get("nullable", True)) for c in schema.get("columns") or ())
    checks = []
    for k, c in enumerate(data.get("checks") or ()):
        c = dict(c)
        kind = c.pop("type", None)
        if not kind:
            raise ContractError(f"{data['name']}: check {k} has no type")
        name, severity = c.pop("name", f"{kind}_{k}"), c.pop("severity", "error")
        c.pop("description", None)
        params = c.pop("params", None)
        checks.append(CheckSpec(kind, name, {**(params or {}), **c}, severity))
    return Contract(data["name"], data.get("dataset") or data.get("table") or "", data.get("mode", "fail"), columns, bool(schema.get("strict", False)), tuple(checks))


def load_contract(path: str | Path) -> Contract:
    import yaml

    return contract_from(yaml.safe_load(expand(Path(path).read_text())))  # expanded first, so that numbers are numbers


def load_contracts(folder: str | Path) -> dict[str, Contract]:
    found = [load_contract(p) for p in sorted(Path(folder).glob("*.y*ml"))]
    if len({c.name for c in found}) < len(found):
        raise ContractError(f"two contracts of one name in {folder}")
    return {c.name: c for c in found}
