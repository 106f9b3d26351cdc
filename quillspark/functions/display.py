"""What pages show: programme windows and their labels, opacities and sizes, flags, stable keys."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

#: How a window is written.
WINDOW = r"(?i)^\s*(\w+),\s*(\w+)\s+(\d+)\s*\|\s*(\d{1,2}):(\d{2})\s*-\s*(\d{1,2}):(\d{2})"


def window_bounds(label: Column, year: int, offset_hours: int = 2) -> tuple[Column, Column]:
    """Start and end, as UTC timestamps, of a window such as ``Monday, June 15 | 13:45-14:45`` in local time; null if it can't be read."""
    part = lambda i: F.regexp_extract(label, WINDOW, i)
    month = F.lower(part(2))
    names = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
    number = F.coalesce(*(F.when(month == m, i + 1) for i, m in enumerate(names)))
    at = lambda h, m: F.try_make_timestamp(F.lit(year), number, part(3).try_cast("int"), part(h).try_cast("int"), part(m).try_cast("int"), F.lit(0), F.lit("UTC")) - F.make_dt_interval(F.lit(0), F.lit(offset_hours))
    read = F.trim(F.coalesce(label, F.lit(""))).rlike(WINDOW)
    return F.when(read, at(4, 5)), F.when(read, at(6, 7))


def window_label(start: Column, end: Column, first_day: str, offset_hours: int = 2) -> Column:
    """``Day N (Wkd Mon DD) · HH:MM–HH:MM`` of UTC timestamps in local time; days count from first_day, 1 at least."""
    shift = F.make_dt_interval(F.lit(0), F.lit(offset_hours))
    here, there = start + shift, end + shift
    day = F.greatest(F.lit(1), F.datediff(F.to_date(here), F.lit(first_day).cast("date")) + 1)
    return F.concat(F.lit("Day "), day, F.lit(" ("), F.date_format(here, "EEE MMM dd"), F.lit(") · "), F.date_format(here, "HH:mm"), F.lit("–"), F.date_format(there, "HH:mm"))


def _within(x: Column, low: float, high: float) -> Column:
    return F.when(F.isnan(x), low).otherwise(F.least(F.lit(high), F.greatest(F.lit(low), x)))


def density_opacity(count: Column) -> Column:
    """40 / n^0.42 for n points, from 0.12 to 0.9."""
    return _within(40 / F.pow(F.greatest(F.lit(1.0), F.floor(count).cast("double")), 0.42), 0.12, 0.9)


def _zoom(zoom: Column) -> Column:
    z = zoom.cast("double")
    return F.greatest(F.lit(1.0), F.when(F.isnan(z) | (F.abs(z) == float("inf")) | z.isNull(), 1.0).otherwise(z))


def backdrop_opacity(count: Column, zoom: Column) -> Column:
    """The density's opacity times the root of the zoom, in the same bounds."""
    return _within(density_opacity(count) * F.sqrt(_zoom(zoom)), 0.12, 0.9)


def marker_size(zoom: Column) -> Column:
    """5 times zoom^0.4, 14 at most."""
    return F.least(F.lit(14.0), F.greatest(F.lit(5.0), 5 * F.pow(_zoom(zoom), 0.4)))


def clampable(text: Column, least: int = 280) -> Column:
    return F.length(F.trim(F.coalesce(text, F.lit("")))) >= least


def session_of(block: Column, number: Column, sessions: dict[int, tuple[int, int]]) -> Column:
    """The session of a poster in a block: the block's first one for odd numbers, its second for even ones. Other blocks and
    numbers that aren't positive are errors."""
    pairs = F.create_map(*(x for b, (odd, even) in sessions.items() for x in (F.lit(b), F.array(F.lit(odd), F.lit(even)))))
    known = block.isin(list(sessions)) & (number > 0)
    return F.when(known, F.get(F.try_element_at(pairs, block), F.when(number % 2 == 1, 0).otherwise(1))).otherwise(F.raise_error(F.lit("unknown block or poster number")).cast("int"))


def canonical(value: Any) -> Any:
    """Sets and mappings in order, paths as text, so that equal values are written alike."""
    if isinstance(value, Mapping):
        return {str(k): canonical(v) for k, v in value.items()}
    if isinstance(value, (set, frozenset)):
        return sorted((canonical(v) for v in value), key=lambda v: json.dumps(v, sort_keys=True))
    if isinstance(value, (list, tuple)):
        return [canonical(v) for v in value]
    return value if isinstance(value, (str, int, float, bool, type(None))) else str(value)


def state_key(value: Any, length: int = 12) -> str:
    """The first digits of the SHA-256 of a value's canonical JSON."""
    return hashlib.sha256(json.dumps(canonical(value), sort_keys=True, separators=(",", ":")).encode()).hexdigest()[:length]


def row_key(*columns: Column | str, length: int = 12) -> Column:
    """The same of a row's columns, written as JSON with nulls."""
    return F.substring(F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256), 1, length)


def path_safe(name: Column) -> Column:
    """Whether a name can stand in a path: not blank, no parent, no separator, no control sign."""
    return F.coalesce((F.trim(name) != "") & ~name.isin(".", "..") & ~name.rlike(r"[/\\\x00-\x1f]"), F.lit(False))


def status_class(status: Column) -> Column:
    """2xx, 3xx, 4xx, 5xx, or none for no answer."""
    return F.coalesce(F.when(status.between(200, 599), F.concat(F.floor(status / 100), F.lit("xx"))), F.lit("none"))
