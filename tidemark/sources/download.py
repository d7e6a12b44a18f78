"""Downloads with a check of size and a manifest of digests; a file is either whole or not there."""

from __future__ import annotations

import hashlib
import json
import urllib.request
from pathlib import Path

CHUNK = 1 << 20


class TooSmall(Exception):
    """What came is smaller than it can be."""


def fetch(url: str, to: str | Path, least_bytes: int = 1, force: bool = False) -> dict:
    """Download ``url`` unless it is there; returns name, size and SHA-256."""
    to = Path(to)
    if force or not to.exists():
        to.parent.mkdir(parents=True, exist_ok=True)
        part = to.with_name(to.name + ".part")
        with urllib.request.urlopen(url) as source, part.open("wb") as out:
            while block := source.read(CHUNK):
                out.write(block)
        if part.stat().st_size < least_bytes:
            size = part.stat().st_size
            part.unlink()
            raise TooSmall(f"{url}: {size} bytes, at least {least_bytes} expected")
        part.replace(to)
    digest = hashlib.sha256()
    with to.open("rb") as f:
        while block := f.read(CHUNK):
            digest.update(block)
    return {"file": to.name, "bytes": to.stat().st_size, "sha256": digest.hexdigest()}


def fetch_all(urls: dict[str, str], folder: str | Path, force: bool = False, least_bytes: int = 1) -> list[dict]:
    """File name to address; writes ``_manifest.json`` beside the files."""
    found = [fetch(url, Path(folder) / name, least_bytes, force) for name, url in urls.items()]
    Path(folder).mkdir(parents=True, exist_ok=True)
    (Path(folder) / "_manifest.json").write_text(json.dumps(found, indent=1))
    return found
