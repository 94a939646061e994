"""Helpers that test files import (fixtures live in conftest.py)."""

from __future__ import annotations

import datetime as dt

SF_SMALL = "/root/testdata/sf0.001"


def ms(text: str) -> int:
    """'2024-01-01 10:00' (or with seconds) -> epoch ms, UTC."""
    fmt = "%Y-%m-%d %H:%M:%S" if text.count(":") == 2 else "%Y-%m-%d %H:%M"
    return int(dt.datetime.strptime(text, fmt).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)


def day(h: str, d: int = 1) -> int:
    return ms(f"2024-01-{d:02d} {h}")
