"""Versioned transition tables of time zones, for vectorised conversion of local times.

The tables are read on the driver from the host's zone files and shipped with the tasks, so every executor converts by
the same release. About 600 zones of at most a few hundred transitions: some 3 MB, whatever the data.
"""

from __future__ import annotations

import functools
import re
import struct
import zoneinfo
from datetime import date, timedelta
from pathlib import Path

import numpy as np

LAST_YEAR = 2200  # rules without an end are unrolled to this year
FIRST = -(2**62)


def _files() -> list[Path]:
    roots = [Path(p) for p in zoneinfo.TZPATH if Path(p).is_dir()]
    try:
        import tzdata

        roots.append(Path(tzdata.__file__).parent / "zoneinfo")
    except ImportError:
        pass
    return roots


@functools.cache
def version() -> str:
    """The release of the zone files, as 2026a."""
    for root in _files():
        for name, pattern in (("tzdata.zi", r"# version (\S+)"), ("+VERSION", r"(\S+)")):
            if (p := root / name).exists() and (m := re.match(pattern, p.read_text(errors="replace"))):
                return m[1]
    try:
        import tzdata

        return tzdata.IANA_VERSION
    except ImportError:
        return "unknown"


_OFFSET = r"([+-]?\d+)(?::(\d+))?(?::(\d+))?"
_NAME = r"(?:<[^>]+>|[A-Za-z]+)"


def _seconds(parts: tuple[str | None, ...]) -> int:
    h, m, s = (abs(int(x or 0)) for x in parts)
    return (-1 if (parts[0] or "").startswith("-") else 1) * (h * 3600 + m * 60 + s)


def _day(rule: str, year: int) -> date:
    if rule[0] == "M":
        month, week, weekday = map(int, rule[1:].split("."))
        first = date(year, month, 1)
        d = first + timedelta((weekday - first.isoweekday()) % 7 + 7 * (week - 1))
        while d.month != month:
            d -= timedelta(7)
        return d
    n = int(rule.lstrip("J"))
    if rule[0] == "J":
        leap = year % 4 == 0 and (year % 100 != 0 or year % 400 == 0)
        return date(year, 1, 1) + timedelta(n - 1 + (leap and n > 59))
    return date(year, 1, 1) + timedelta(n)


def _unroll(rule: str, since: int) -> list[tuple[int, int]]:
    """(UTC second, offset from then on) of a zone file's last rule, after ``since``."""
    m = re.fullmatch(rf"{_NAME}{_OFFSET}(?:{_NAME}(?:{_OFFSET})?,([^,/]+)(?:/{_OFFSET})?,([^,/]+)(?:/{_OFFSET})?)?", rule)
    if not m or not m[7]:
        return []
    standard = -_seconds(m.groups()[0:3])
    summer = -_seconds(m.groups()[3:6]) if m[4] else standard + 3600
    out = []
    for year in range(date(1970, 1, 1).year, LAST_YEAR):
        for day, time, before, after in ((m[7], m.groups()[7:10], standard, summer), (m[11], m.groups()[11:14], summer, standard)):
            local = (_day(day, year) - date(1970, 1, 1)).days * 86400 + (_seconds(time) if time[0] else 7200)
            if local - before > since:
                out.append((local - before, after))
    return sorted(out)


def _read(path: Path) -> tuple[np.ndarray, np.ndarray] | None:
    """(UTC seconds of transitions, the first minus infinity; offsets from then on)."""
    raw = path.read_bytes()
    if raw[:4] != b"TZif":
        return None
    isut, isstd, leap, times, types, chars = struct.unpack(">6l", raw[20:44])
    at, width = 44, 4
    if raw[4:5] >= b"2":
        at += times * 5 + types * 6 + chars + leap * 8 + isstd + isut
        isut, isstd, leap, times, types, chars = struct.unpack(">6l", raw[at + 20 : at + 44])
        at, width = at + 44, 8
    instants = struct.unpack(f">{times}{'q' if width == 8 else 'l'}", raw[at : at + times * width])
    index = raw[at + times * width : at + times * (width + 1)]
    at += times * (width + 1)
    kinds = [struct.unpack(">lBB", raw[at + 6 * i : at + 6 * i + 6]) for i in range(types)]
    at += types * 6 + chars + leap * (width + 4) + isstd + isut
    rule = raw[at:].decode("ascii").strip() if width == 8 else ""
    first = next((k[0] for k in kinds if not k[1]), kinds[0][0])
    table = [(FIRST, first), *((t, kinds[i][0]) for t, i in zip(instants, index, strict=True))]
    table += _unroll(rule, table[-1][0]) if rule else []
    return np.array([t for t, _ in table], np.int64), np.array([o for _, o in table], np.int64)


@functools.cache
def tables() -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """By zone name: (local microseconds from which an offset holds, offsets in microseconds).

    From a transition at UTC second t and offset a to b, the offset b holds from local time t + max(a, b): the earlier
    instant of a repeated local time, and the offset before the jump for a skipped one.
    """
    out = {}
    for root in reversed(_files()):
        for name in zoneinfo.available_timezones():
            p = root / name
            if p.is_file() and (z := _read(p)):
                when, offset = z
                before = np.append(offset[:1], offset[:-1])
                local = np.where(when == FIRST, FIRST, when + np.maximum(before, offset))
                out[name] = (np.maximum.accumulate(np.where(local == FIRST, FIRST, local * 1_000_000)), offset * 1_000_000)
    return out


def to_utc(local_us: np.ndarray, zone: str, known: dict) -> np.ndarray | None:
    """UTC microseconds of local ones; None for an unknown zone."""
    if zone not in known:
        return None
    start, offset = known[zone]
    return local_us - offset[np.searchsorted(start, local_us, side="right") - 1]
