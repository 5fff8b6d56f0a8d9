"""The frame around the read models: page routes and their guard, filters in URLs, navigation, widgets' health. Driver-side only."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from typing import NamedTuple
from urllib.parse import parse_qs, quote, urlencode, urlsplit

from caseloom.operators.readmodels import Filters

ROLES = ("investigator", "analyst", "admin")
#: The pages, by name; :parts are parameters, the last of them the page's resource.
ROUTES = {
    "cases_index": "/cases",
    "case_viewer": "/cases/:case_id",
    "people_index": "/cases/:case_id/people",
    "person_profile": "/cases/:case_id/people/:person_id",
    "timeline": "/cases/:case_id/timeline",
    "evidence_index": "/cases/:case_id/evidence",
    "evidence_detail": "/cases/:case_id/evidence/:evidence_id",
}
#: Filters that pages share, in the order that URLs have them.
SHARED = ("case_id", "person_id", "date_start", "date_end", "confidence_min")
_IN_URL = {"case_id": "case_id_norm"}


class Decision(NamedTuple):
    status: int
    code: str
    route: str | None = None
    params: dict[str, str] = {}


def resolve(path: str) -> Decision:
    """The page that a path names, with its parameters; 404 not_found if none."""
    parts = path.split("?", 1)[0].strip().strip("/").split("/")
    for name, template in ROUTES.items():
        want = template.strip("/").split("/")
        if len(want) == len(parts) and all(p and (w[0] == ":" or w == p) for w, p in zip(want, parts)):
            return Decision(200, "ok", name, {w[1:]: p for w, p in zip(want, parts) if w[0] == ":"})
    return Decision(404, "not_found")


def guard(path: str, role: str, case_exists: bool = True, resource_exists: bool = True) -> Decision:
    """Unknown page 404, unknown role 403, missing case or resource 404, in this order."""
    found = resolve(path)
    if found.status != 200:
        return found
    if role not in ROLES:
        return found._replace(status=403, code="forbidden")
    if found.params and not case_exists:
        return found._replace(status=404, code="case_not_found")
    return found if resource_exists or not found.params else found._replace(status=404, code="resource_not_found")


def _number(text: str, kind: type, low: float, high: float) -> float | None:
    try:
        n = kind(text)
    except ValueError:
        return None
    return n if low <= n <= high else None


def parse_filters(url: str | None) -> Filters:
    """Shared filters of a URL or a query string; what is empty or out of range is left out."""
    url = (url or "").strip()
    given = parse_qs(urlsplit(url).query if "?" in url or "/" in url else url)
    found = {k: given.get(_IN_URL.get(k, k), [""])[0].strip() for k in SHARED}
    return Filters(
        case_id=found["case_id"] or None, person_id=_number(found["person_id"], int, 1, float("inf")), date_start=found["date_start"] or None,
        date_end=found["date_end"] or None, confidence_min=_number(found["confidence_min"], float, 0.0, 1.0),
    )


def serialize_filters(filters: Filters) -> str:
    """The query string of the shared filters that are set; confidence with four digits at most."""
    shown = []
    for k in SHARED:
        value = getattr(filters, k)
        if k == "confidence_min" and value is not None:
            shown.append((k, f"{value:.4f}".rstrip("0").rstrip(".")))
        elif value:
            shown.append((_IN_URL.get(k, k), str(value)))
    return urlencode(shown)


def case_filter(selected: str | None, shared: Filters | None = None) -> str | None:
    """The case that counts: the shared one before the selected one."""
    return next((c.strip() for c in (shared.case_id if shared else None, selected) if c and c.strip()), None)


def navigation(selected: str | None, shared: Filters | None = None) -> list[tuple[str, str, bool]]:
    """Label, path and whether it can be used, of the main pages; case pages need a case. Shared filters travel in the paths."""
    case = case_filter(selected, shared)
    query = serialize_filters(Filters(**{k: getattr(shared, k) for k in SHARED} | {"case_id": case})) if shared else ""
    suffix = f"?{query}" if query else ""
    pages = [(name, f"/cases/{quote(case, safe=':')}/{name.lower()}" if case else "/cases") for name in ("People", "Timeline", "Evidence")]
    return [("Cases", f"/cases{suffix}", True), *((name, path + suffix, bool(case)) for name, path in pages)]


@dataclass(frozen=True)
class Widget:
    widget_id: str
    status: str
    correlation_id: str | None = None
    error_code: str | None = None


def widget_error(widget_id: str, correlation_id: str) -> Widget:
    """A widget whose data can't be had: its page still shows the others."""
    return Widget(widget_id, "error", correlation_id, "widget_data_unavailable")


def health(widgets: Iterable[Widget]) -> dict[str, int | bool]:
    """Counts by status; a failure is partial if some widgets, but not all, have errors."""
    states = [w.status for w in widgets]
    errors = states.count("error")
    return {"total": len(states), "loading": states.count("loading"), "empty": states.count("empty"), "errors": errors, "partial_failure": 0 < errors < len(states)}
