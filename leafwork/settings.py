"""Settings from the environment, with a file of ``key=value`` lines behind it."""

from __future__ import annotations

import os
from pathlib import Path


def parse(text: str) -> dict[str, str]:
    """Pairs of a settings file: comments and lines without = are skipped, one pair of quotes is taken off."""
    out = {}
    for line in text.splitlines():
        line = line.strip()
        if not line or line.startswith("#") or "=" not in line:
            continue
        key, value = line.split("=", 1)
        value = value.strip()
        if len(value) > 1 and value[0] == value[-1] and value[0] in "\"'":
            value = value[1:-1]
        out[key.strip()] = value
    return out


def nearest(name: str = ".env", start: str | None = None) -> Path | None:
    here = Path(start or os.getcwd()).resolve()
    return next((d / name for d in (here, *here.parents) if (d / name).is_file()), None)


def get(key: str, start: str | None = None) -> str:
    """The environment's value, else the nearest file's; an error if there is none."""
    if os.environ.get(key):
        return os.environ[key]
    file = nearest(start=start)
    value = parse(file.read_text(encoding="utf-8")).get(key) if file else None
    if not value:
        raise LookupError(f"setting {key} is missing")
    return value
