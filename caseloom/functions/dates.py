"""Dates in text: absolute ones (vectorised Python, since spans matter), relative ones (native), and their status."""

from __future__ import annotations

import calendar
import re
from datetime import date

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Month names by number, weekday names by number (Monday 0), units of relative dates.
MONTH = {
    "jan": 1, "january": 1, "feb": 2, "february": 2, "mar": 3, "march": 3, "apr": 4, "april": 4, "may": 5, "jun": 6, "june": 6, "jul": 7, "july": 7, "aug": 8, "august": 8, "sep": 9, "sept": 9, "september": 9,
    "oct": 10, "october": 10, "nov": 11, "november": 11, "dec": 12, "december": 12,
}
WEEKDAY_OF = {
    "mon": 0, "monday": 0, "tue": 1, "tues": 1, "tuesday": 1, "wed": 2, "wednesday": 2, "thu": 3, "thur": 3, "thurs": 3, "thursday": 3, "fri": 4, "friday": 4, "sat": 5, "saturday": 5, "sun": 6, "sunday": 6,
}
UNITS = "day|days|week|weeks|month|months|year|years"
#: Characters of a text that an anchor date is looked for in.
ANCHORED = 12_000

_M = "(" + "|".join(sorted(MONTH, key=len, reverse=True)) + ")"
_ISO = r"(\d{4})-(\d{2})-(\d{2})"
_RANGES = (("iso", re.compile(rf"\b{_ISO}\s+(?:to|through|-)\s+{_ISO}\b", re.I)), ("month", re.compile(rf"\b{_M}\s+(\d{{1,2}})\s*[-–—]\s*(\d{{1,2}}),\s*(\d{{4}})\b", re.I)))
#: Pattern, order of its year, month and day groups (0: absent).
_FORMS = [
    (re.compile(rf"\b{_ISO}\b"), (1, 2, 3)),
    (re.compile(r"\b(\d{1,2})/(\d{1,2})/(\d{4})\b"), (3, 1, 2)),
    (re.compile(rf"\b{_M}\s+(\d{{1,2}}),\s*(\d{{4}})\b", re.I), (3, 1, 2)),
    (re.compile(rf"\b(\d{{1,2}})\s+{_M}\s+(\d{{4}})\b", re.I), (3, 2, 1)),
    (re.compile(rf"\b{_M}\s+(\d{{4}})\b", re.I), (2, 1, 0)),
    (re.compile(r"\b(\d{4})-(\d{2})\b"), (1, 2, 0)),
    (re.compile(r"\b(\d{4})\b"), (1, 0, 0)),
]

Found = tuple[str, str, str]


def _period(year: str, month: str | None, day: str | None) -> Found | None:
    """First day, last day and precision; None if there is no such date."""
    y = int(year)
    m = None if month is None else MONTH.get(month.lower()) or (int(month) if month.isdigit() else 0)
    try:
        if m is None:
            return date(y, 1, 1).isoformat(), date(y, 12, 31).isoformat(), "year"
        if day is None:
            return date(y, m, 1).isoformat(), date(y, m, calendar.monthrange(y, m)[1]).isoformat(), "month"
        at = date(y, m, int(day)).isoformat()
        return at, at, "day"
    except ValueError:
        return None


def parse_absolute(text: str | None) -> tuple[Found | None, str | None]:
    """The period that a text names, or a status: empty, invalid_format, unresolved_ambiguous, None (no date at all)."""
    if not text or not text.strip():
        return None, "empty"
    text = text.strip()
    for kind, pattern in _RANGES:
        if m := pattern.search(text):
            g = m.groups()
            ends = [_period(*g[:3]), _period(*g[3:])] if kind == "iso" else [_period(g[3], g[0], g[1]), _period(g[3], g[0], g[2])]
            if None in ends or kind == "month" and int(g[2]) < int(g[1]):
                return None, "invalid_format"
            first, last = sorted(e[0] for e in ends)
            return (first, last, "range"), None
    spans = []
    for pattern, order in _FORMS:
        for m in pattern.finditer(text):
            if p := _period(*(m[i] if i else None for i in order)):
                spans.append((m.start(), -m.end(), p))
    if not spans:
        return None, None
    kept: list[tuple[int, int, Found]] = []
    reach = -1
    for start, end, p in sorted(spans, key=lambda s: s[:2]):
        # Sorted by start, longest first: a span that ends within what was reached is contained.
        if -end > reach:
            kept.append((start, end, p))
            reach = -end
    found = {p for _, _, p in kept}
    return (kept[0][2], None) if len(found) == 1 else (None, "unresolved_ambiguous")


def first_anchor(text: str | None, most: int | None = ANCHORED) -> str | None:
    """First day of the first absolute date in a text's first `most` characters (None: all)."""
    if not text:
        return None
    text = text[:most]
    spans = [m.span() for _, p in _RANGES for m in p.finditer(text)] + [m.span() for p, _ in _FORMS for m in p.finditer(text)]
    # Ties keep the order of the forms.
    for start, end in sorted(spans, key=lambda s: s[0]):
        period, status = parse_absolute(text[start:end])
        if period and status is None:
            return period[0]
    return None


def absolute(c: Column) -> Column:
    """Struct date_start, date_end, precision, status of the absolute date in a text."""

    @F.arrow_udf("date_start string, date_end string, precision string, status string")
    def parse(texts: pa.Array) -> pa.Array:
        rows = [parse_absolute(x.as_py()) for x in texts]
        cols = [[r[0][k] if r[0] else None for r in rows] for k in range(3)] + [[r[1] for r in rows]]
        return pa.StructArray.from_arrays([pa.array(v, pa.string()) for v in cols], names=["date_start", "date_end", "precision", "status"])

    return parse(c)


def anchor(c: Column, most: int | None = ANCHORED) -> Column:
    @F.arrow_udf("string")
    def find(texts: pa.Array) -> pa.Array:
        return pa.array([first_anchor(x.as_py(), most) for x in texts], pa.string())

    return find(c)


def relative(c: Column, anchor_date: Column) -> Column:
    """The day that a relative expression means, seen from an anchor (a date); null if it is none or can't be resolved.

    The text's parts are bound once, by a lambda over an array of one: inlined where they are used they would make code
    that is too large to compile.
    """
    t = F.lower(F.trim(c))
    group = lambda p, i: F.nullif(F.regexp_extract(t, p, i), F.lit(""))
    later, ago = rf"^in\s+(\d+)\s+({UNITS})$", rf"^(\d+)\s+({UNITS})\s+ago$"
    days = r"^(last|next|this)\s+(" + "|".join(sorted(WEEKDAY_OF, key=len, reverse=True)) + ")$"
    # Every name of a weekday begins with the same three letters.
    target = F.array_position(F.array(*map(F.lit, ("mon", "tue", "wed", "thu", "fri", "sat", "sun"))), F.substring(group(days, 2), 1, 3)) - 1
    parts = F.struct(
        group(r"^(today|yesterday|tomorrow)$", 1).alias("word"), F.coalesce(group(later, 1).try_cast("int"), -group(ago, 1).try_cast("int")).alias("n"),
        F.regexp_replace(F.coalesce(group(later, 2), group(ago, 2)), "s$", "").alias("unit"), group(days, 1).alias("way"), target.alias("target"), F.weekday(anchor_date).alias("now"), anchor_date.alias("base"),
    )
    ways = lambda p: F.struct(p.alias("parts"), F.pmod(p["now"] - p["target"], F.lit(7)).alias("back"), F.pmod(p["target"] - p["now"], F.lit(7)).alias("forth"))

    def day(x: Column) -> Column:
        p, back, forth = x["parts"], x["back"], x["forth"]
        by_day = (
            F.when(p["way"] == "last", -F.when(back == 0, 7).otherwise(back)).when(p["way"] == "next", F.when(forth == 0, 7).otherwise(forth)).when(p["way"] == "this", forth)
            .when(p["word"] == "today", 0).when(p["word"] == "yesterday", -1).when(p["word"] == "tomorrow", 1)
            # Distances beyond any calendar are not resolved.
            .when((p["unit"] == "day") & (F.abs(p["n"]) < 3_000_000), p["n"]).when((p["unit"] == "week") & (F.abs(p["n"]) < 400_000), p["n"] * 7)
        )
        by_month = F.when((p["unit"] == "month") & (F.abs(p["n"]) < 100_000), p["n"]).when((p["unit"] == "year") & (F.abs(p["n"]) < 8_000), p["n"] * 12)
        return F.coalesce(F.date_add(p["base"], by_day.cast("int")), F.add_months(p["base"], by_month))

    return F.transform(F.transform(F.array(parts), ways), day)[0]


def in_calendar(c: Column) -> Column:
    """A day if its year has four digits, else null."""
    return F.when(c.between(F.lit("0001-01-01").cast("date"), F.lit("9999-12-31").cast("date")), c)


def is_relative(c: Column) -> Column:
    return F.lower(F.trim(c)).rlike(rf"^(today|yesterday|tomorrow|in\s+\d+\s+({UNITS})|\d+\s+({UNITS})\s+ago|(last|next|this)\s+({'|'.join(WEEKDAY_OF)}))$")


def iso_day(c: Column) -> Column:
    """The wall-clock day of an ISO timestamp, as text."""
    return F.when(F.trim(c).rlike(r"^\d{4}-\d{2}-\d{2}([T ].*)?$"), F.try_to_date(F.substring(F.trim(c), 1, 10), "yyyy-MM-dd").cast("string") if hasattr(F, "try_to_date") else F.try_to_timestamp(F.substring(F.trim(c), 1, 10), F.lit("yyyy-MM-dd")).cast("date").cast("string"))
