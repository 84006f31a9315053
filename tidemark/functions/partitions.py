"""Partition keys and values in paths, and date prefixes from strftime templates."""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def template_columns(template: str) -> list[str]:
    """Keys of a template such as date=%Y-%m-%d/hour=%H, in order."""
    return [segment.partition("=")[0] for segment in template.split("/") if "=" in segment]


def path_value(path: Column, key: str) -> Column:
    """The value of the path's segment key=value; null without one. The whole key must match."""
    pattern = f"(?:^|/){re.escape(key)}=([^/]*)"
    return F.when(path.rlike(pattern), F.regexp_extract(path, pattern, 1))


def path_values(path: str, keys: Iterable[str] | None = None) -> dict[str, str]:
    """Values by key. Without keys: of all segments key=value whose value has no dot, so a file's name isn't taken for one."""
    found: dict[str, str] = {}
    for segment in path.split("/"):
        key, eq, value = segment.partition("=")
        if eq and (keys is not None or "." not in value):
            found.setdefault(key, value) if keys is not None else found.update({key: value})
    return found if keys is None else {k: found[k] for k in keys if k in found}


def date_prefixes(template: str, lookback: int, now: datetime | None = None) -> list[str]:
    """The template for now and lookback units before it, oldest first, in UTC; a unit is an hour if it has %H, else a day."""
    now = datetime.now(UTC) if now is None else now
    unit = timedelta(hours=1) if "%H" in template else timedelta(days=1)
    return [(now - k * unit).strftime(template) for k in range(lookback, -1, -1)]


def split_watermark(watermark: str) -> tuple[str, str]:
    """(folder, file name) of a path; the folder of one at the root is empty."""
    folder, _, name = watermark.rpartition("/")
    return folder, name
