"""Settings: YAML with ${VAR:default} placeholders."""

from __future__ import annotations

import os
import re
from pathlib import Path
from typing import Any

PLACEHOLDER = re.compile(r"\$\{(\w+)(?::([^}]*))?\}")


def expand(value: Any, env: dict[str, str] | None = None) -> Any:
    """Placeholders in all strings of ``value`` replaced; one without a default needs its variable."""
    env = os.environ if env is None else env
    if isinstance(value, dict):
        return {k: expand(v, env) for k, v in value.items()}
    if isinstance(value, list):
        return [expand(v, env) for v in value]
    if not isinstance(value, str):
        return value

    def put(m: re.Match) -> str:
        if m[1] in env:
            return env[m[1]]
        if m[2] is None:
            raise KeyError(f"environment variable {m[1]} is not set and has no default")
        return m[2]

    return PLACEHOLDER.sub(put, value)


def load(path: str | Path) -> dict[str, Any]:
    import yaml

    return expand(yaml.safe_load(Path(path).read_text())) or {}
