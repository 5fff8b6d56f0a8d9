"""Column functions over text: normalising, signals for triage, coercions. All of them stay in the JVM."""

from __future__ import annotations

import hashlib
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters analysed of a chunk, and tokens that shapes are taken of, unless said otherwise (None: all); characters of a token that make its shape.
ANALYSED, SHAPED, SHAPE = 50_000, 2_000, 40

#: What the signals look for.
MONTHS = "Jan|January|Feb|February|Mar|March|Apr|April|May|Jun|June|Jul|July|Aug|August|Sep|Sept|September|Oct|October|Nov|November|Dec|December"
DATE = rf"\b\d{{4}}-\d{{2}}-\d{{2}}\b|\b\d{{1,2}}[/-]\d{{1,2}}[/-]\d{{2,4}}\b|\b(?:{MONTHS})\s+\d{{1,2}},\s+\d{{4}}\b"
PATTERNS = {
    "dialogue_marker_count": r"(?i)\b(?:[qa]|[a-z]{2,21}):\s|—|\"[^\"]{1,200}\"",
    "time_like_count": r"(?i)\b\d{1,2}:\d{2}(?::\d{2})?\s*(?:am|pm|a\.m\.|p\.m\.)?\b",
    "time_of_day_word_count": r"(?i)\b(?:morning|afternoon|evening|night)\b",
    "honorific_count": r"(?i)\b(?:Mr|Mrs|Ms|Dr|Prof|Officer|Det|Detective|Sgt|Sergeant|Lt|Lieutenant)\.?\b",
    "capitalized_name_count": r"\b[A-Z][a-z]{1,20}\s+(?:[A-Z]\.\s+)?[A-Z][a-z]{1,20}\b",
    "initials_count": r"\b[A-Z]\.\s*[A-Z]\.\b",
    "org_suffix_count": r"(?i)\b(?:Inc|LLC|Ltd|Corp|Co|Company|University|Dept|Department|Agency|Bureau|Commission)\.?\b",
    "badge_id_count": r"(?i)\b(?:ID|Case|Report|Badge|Employee|Officer)\s*#?:?\s*[A-Z0-9][A-Z0-9-]{2,}\b",
    "date_like_count": rf"(?i){DATE}",
    "incident_verb_count": r"(?i)\b(?:arrest|interview|report|observe|respond|arriv|depart|transport|contact|call|meet|search|seiz|testif|confess|assault|threaten|shoot|stab|rob|burglar|kidnap|detain|pursu|follow|witness)\w*\b",
}
NEAR_DATE = rf"(?is)\b(?:on|at|by)\b.{{0,20}}?(?:{DATE})"
BULLET = r"^\s*(?:[-*•]|\d{1,3}[.)])\s+\S"
#: What each match of a pattern begins with: a look at one character spares word boundaries and alternatives elsewhere.
STARTS = {
    "time_like_count": "[0-9]", "time_of_day_word_count": "[maen]", "honorific_count": "[mdposl]", "capitalized_name_count": "[A-Z]", "initials_count": "[A-Z]", "org_suffix_count": "[ilcudab]",
    "badge_id_count": "[icrbeo]", "date_like_count": "[0-9jfmasond]", "incident_verb_count": "[aiordtcmsbkpfw]",
}
PACKS = {
    "people_identity": ["date of birth", "dob", "ssn", "social security", "address", "alias", "aka", "maiden name", "driver license", "dl", "passport", "phone", "email"],
    "events_timeline": ["on", "at", "by", "reported", "responded", "arrived", "departed", "observed", "interview", "statement", "timeline"],
    "communications": ["text message", "sms", "call", "phone call", "voicemail", "email", "chat", "message"],
    "legal": ["charge", "charges", "statute", "warrant", "affidavit", "probable cause", "complaint", "indictment", "plea", "sentencing", "subpoena"],
}


def normal_name(c: Column) -> Column:
    """Lower case, runs of other than a-z and 0-9 as one space; null if nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " ")), F.lit(""))


def analysed(c: Column, most: int | None = ANALYSED) -> Column:
    whole = F.replace(F.coalesce(c, F.lit("")), F.lit("\x00"), F.lit(""))
    return whole if most is None else F.substring(whole, 1, most)


def count_of(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern))


def led(pattern: str, starts: str | None) -> str:
    """The pattern with a look ahead at what its matches begin with, behind its flags."""
    flags = pattern[: pattern.index(")") + 1] if pattern.startswith("(?i") else ""
    return pattern if starts is None else f"{flags}(?={starts})(?:{pattern[len(flags):]})"


def ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def bare(c: Column) -> Column:
    """The text without white space."""
    return F.regexp_replace(c, r"\s+", "")


def shape_tokens(c: Column, most: int | None = SHAPED) -> Column:
    """Shapes of the first tokens (None: all): A, a, 0 and _ stand for their kinds, - for the rest."""
    shaped = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"[^\p{Lu}\p{Ll}\p{Nd}_\s]", "-"), r"\p{Lu}", "A"), r"\p{Ll}", "a"), r"\p{Nd}", "0")
    tokens = F.filter(F.split(shaped, r"\s+"), lambda t: t != "")
    return tokens if most is None else F.slice(tokens, 1, most)


def lines_of(c: Column) -> Column:
    ends = F.regexp_replace(c, r"\R\z", "")
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(ends, r"\R"))


def text_quality(c: Column, bare: Column, tokens: Column, n_shapes: Column) -> dict[str, Column]:
    """Length, ratios and shapes of an analysed text; bare, tokens and n_shapes as above, computed once."""
    # Only runs of three or more are listed: others are many, and one search tells whether there are any.
    runs = F.transform(F.regexp_extract_all(bare, F.lit(r"(?s)((.)\2{2,})"), 1), F.length)
    return {
        "char_len": F.length(c),
        "non_ws_ratio": F.round(ratio(F.length(bare), F.length(c)), 6),
        "punctuation_ratio": F.round(ratio(count_of(c, r"\p{P}"), F.length(bare)), 6),
        "replacement_char_count": _with(c, ["�"], count_of(c, "�")),
        "max_repeated_char_run": F.coalesce(F.array_max(runs), F.when(bare == "", 0).when(bare.rlike(r"(?s)(.)\1"), 2).otherwise(1)),
        "tokens_sampled_for_shapes": F.size(tokens),
        "unique_word_shapes": n_shapes,
        "word_shape_diversity": F.round(ratio(n_shapes, F.size(tokens)), 6),
    }


def distinct_shapes(tokens: Column) -> Column:
    return F.size(F.array_distinct(F.transform(tokens, lambda t: F.substring(t, 1, SHAPE))))


def structure(lines: Column, full: Column, bullets: Column, table: Column) -> dict[str, Column]:
    """Counts of lines, full (not blank) ones, bullets and table-like lines."""
    return {
        "line_count": F.size(lines),
        "nonempty_line_count": F.size(full),
        "bullet_line_count": bullets,
        "bullet_density": F.round(ratio(bullets, F.size(full)), 6),
        "tableish_line_count": table,
        "table_like": table >= 2,
    }


def full_lines(lines: Column) -> Column:
    return F.filter(lines, lambda x: x.rlike(r"\S"))


def bullet_lines(full: Column) -> Column:
    return F.size(F.filter(full, lambda x: x.rlike(BULLET)))


def table_lines(full: Column) -> Column:
    """Lines with a tab, two bars, or two spaces between words."""
    return F.size(F.filter(full, lambda x: x.contains("\t") | (F.length(x) - F.length(F.replace(x, F.lit("|"), F.lit(""))) >= 2) | x.rlike(r"\S\s{2,}\S")))


def _with(c: Column, marks: list[str], found: Column) -> Column:
    """found where the text has one of the marks that any match has, else 0: a plain search spares the pattern."""
    some = c.contains(marks[0])
    for m in marks[1:]:
        some = some | c.contains(m)
    return F.when(some, found).otherwise(0)


#: Characters that every match of a pattern has one of.
MARKS = {"dialogue_marker_count": [":", "—", '"'], "time_like_count": [":"], "initials_count": ["."]}


def pattern_counts(c: Column) -> dict[str, Column]:
    counts = {name: count_of(c, led(p, STARTS.get(name))) for name, p in PATTERNS.items()}
    counts = {name: _with(c, MARKS[name], n) if name in MARKS else n for name, n in counts.items()}
    counts["date_like_count"] = F.when(c.rlike("[0-9]"), counts["date_like_count"]).otherwise(0)
    # The costly search near dates is made only where there is a date.
    return counts | {"on_at_by_date_count": F.when(counts["date_like_count"] > 0, count_of(c, NEAR_DATE)).otherwise(0)}


def keyword_patterns(keywords: list[str]) -> list[str]:
    """Patterns whose matches, added up, are the hits of each keyword by itself, though keywords may overlap.

    A match is empty, where a keyword starts; boundaries only at an edge that is a word character. Of one pattern no
    keyword begins with another, so at most one starts at a place: a pack is a pattern or two instead of one a keyword.
    """
    word = lambda ch: ch.isascii() and (ch.isalnum() or ch == "_")
    groups: list[list[str]] = []
    for k in dict.fromkeys(w.lower() for w in keywords if w):
        free = next((g for g in groups if word(g[0][0]) == word(k[0]) and not any(o.startswith(k) or k.startswith(o) for o in g)), None)
        groups.append([k]) if free is None else free.append(k)
    one = lambda k: "".join(ch if ch.isalnum() or ch == " " else "\\" + ch for ch in k) + r"(?![a-z0-9_])" * word(k[-1])
    starts = lambda g: "".join(ch if ch.isalnum() else "\\" + ch for ch in sorted({k[0] for k in g}))
    return [f"(?=[{starts(g)}])" + r"(?<![a-z0-9_])" * word(g[0][0]) + f"(?={'|'.join(map(one, g))})" for g in groups]


def keyword_hits(c: Column, packs: dict[str, list[str]] | None = None) -> dict[str, Column]:
    """Hits by pack in a lower-case text. A keyword that is listed twice counts once. Packs that are given come beside the default ones, or in their place by name."""
    counts = {pack: [count_of(c, p) for p in keyword_patterns(words)] for pack, words in (PACKS | (packs or {})).items()}
    return {pack: sum(ns[1:], ns[0]) if ns else F.lit(0) for pack, ns in counts.items()}


def token_estimate(c: Column) -> Column:
    n = F.length(F.coalesce(c, F.lit("")))
    return F.when(n == 0, 0).otherwise(F.greatest(F.lit(1), F.floor(n / 4))).cast("int")


def redacted_preview(c: Column, length: int = 120) -> Column:
    """Mail addresses and telephone numbers replaced, digits as 0, white space collapsed, cut."""
    c = F.regexp_replace(c, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "[email]")
    c = F.regexp_replace(c, r"\+?\d[\d() .-]{7,}\d", "[phone]")
    return F.substring(F.trim(F.regexp_replace(F.regexp_replace(c, r"\d", "0"), r"\s+", " ")), 1, length)


def case_key(c: Column) -> Column:
    """A case id as the loader has it: no white space, upper case."""
    return F.nullif(F.upper(F.regexp_replace(c, r"\s+", "")), F.lit(""))


def case_slug(c: Column) -> Column:
    """A case id as contracts have it: other than A-Z, 0-9, dot, underscore and hyphen as one underscore, trimmed."""
    s = F.regexp_replace(F.regexp_replace(F.upper(F.trim(c)), "[^A-Z0-9._-]+", "_"), "_+", "_")
    return F.coalesce(F.nullif(F.regexp_replace(s, "^[._-]+|[._-]+$", ""), F.lit("")), F.lit("unknown"))


def address_key(c: Column) -> Column:
    return F.nullif(F.lower(F.trim(F.regexp_replace(c, r"\s+", " "))), F.lit(""))


def birth_key(c: Column) -> Column:
    """ISO dates as they are, M/D/YYYY as ISO if month and day are in range, else the text itself."""
    t = F.trim(c)
    part = lambda i: F.regexp_extract(t, r"^(\d{1,2})/(\d{1,2})/(\d{4})$", i)
    m, d = F.expr("try_cast(0 AS int)") + part(1).try_cast("int"), part(2).try_cast("int")
    iso = F.concat(part(3), F.lit("-"), F.lpad(part(1), 2, "0"), F.lit("-"), F.lpad(part(2), 2, "0"))
    return F.when(t.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$") & m.between(1, 12) & d.between(1, 31), iso).otherwise(t)


def clean(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def clean_quote(c: Column) -> Column:
    return F.nullif(F.trim(F.regexp_replace(c, r"\s+", " ")), F.lit(""))


def clean_int(c: Column) -> Column:
    """"4", 4.0 and "4.0" are 4; booleans, fractions and other text are null."""
    v = F.trim(c).try_cast("double")
    return F.when((v == F.floor(v)) & ~F.lower(F.trim(c)).isin("nan", "infinity", "-infinity", "inf", "-inf"), v.try_cast("int"))


def clean_float(c: Column) -> Column:
    v = F.trim(c).try_cast("double")
    return F.when(~F.isnan(v), v)


def canonical(text: str | None) -> str:
    """Without NUL, in NFC, lines stripped and white space inside them collapsed."""
    text = unicodedata.normalize("NFC", (text or "").replace("\x00", ""))
    return "\n".join(" ".join(line.split()) for line in text.split("\n")).strip()


def canonical_hash(c: Column) -> Column:
    """sha256 of the canonical text. Vectorised Python: Spark has no NFC."""

    @F.arrow_udf("string")
    def hashed(texts: pa.Array) -> pa.Array:
        return pa.array([hashlib.sha256(canonical(x.as_py()).encode("utf-8", "replace")).hexdigest() for x in texts], pa.string())

    return hashed(c)
