"""Personal data by candidate gradient boosting.

Generators with high recall propose overlapping spans: what the base patterns match, the same kinds in other forms
(spelled-out addresses, numbers without a country code, all choices of groups in a run of digits), identity and bank numbers, and
secrets (opaque runs, values given to a name like "token", private keys). Boosted trees score each candidate by its format and its context; scores are calibrated on rows the trees haven't seen, and a kind's threshold is the lowest
with PRECISION there. What passes is added to the base spans, which always stay; of overlapping additions the better one
is taken, and none may overlap a base span. The model is fitted here on generated examples (EXAMPLES of them, a fixed
seed), so it needs no labelled rows.

Spans are code points, end exclusive, over the whole text; null and empty texts have none. Time is linear in a text's
length. Repeated rows get equal results, ties between equally good overlapping candidates go to the first and then shorter one, and empty
tables give no rows. A column named `pii` that is there already is replaced; all others stay.
"""

from __future__ import annotations

import ipaddress
import math
import random
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.boosting import Boosted, boost
from caseloom.llm.common import table
from caseloom.llm.linear import logistic

#: Base kinds in the order that results list them, then the added ones.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "national_id", "secret")
#: Generated values to fit on; precision on unseen ones that sets a kind's threshold; candidates scored at a time.
EXAMPLES, PRECISION, BLOCK = 11_000, 0.98, 4096

Span = tuple[str, int, int]

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = re.compile("[0-9]+")
_CARD = re.compile("[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches of local part, @, domain: only what stands around an @ is looked at."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            done = m.end()
            yield "email", start, done
        else:
            done = at + 1
        at = text.find("@", at + 1 if not m else done)


def _runs(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _DIGITS.finditer(text)]


def _ips(text: str, runs: list[tuple[int, int]]) -> Iterator[Span]:
    """Four runs of digits with single dots between them; whole runs, so a match that fails isn't tried again inside."""
    i = 0
    while i + 3 < len(runs):
        four = runs[i : i + 4]
        if all(b[0] - a[1] == 1 and text[a[1]] == "." for a, b in zip(four, four[1:])):
            if all(e - s <= 3 or not text[s : e - 3].strip("0") for s, e in four) and all(int(text[max(s, e - 4) : e]) <= 255 for s, e in four):
                yield "ip", four[0][0], four[3][1]
            i += 4
        else:
            i += 1


def base_spans(text: str | None) -> list[Span]:
    """Base spans by kind, then start."""
    if not text:
        return []
    out = list(_emails(text)) if "@" in text else []
    runs = _runs(text)
    if len(runs) >= 4:
        out += _ips(text, runs)
    if runs:
        for m in _CARD.finditer(text):
            d = re.sub("[ -]", "", m.group())
            if 13 <= len(d) <= 19 and luhn(d):
                out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m.group())) <= 15]
    return out


#: Parts of the generators. Every one is anchored at something rare (a mark, a run of digits, a naming word), takes whole runs without
#: backtracking and goes on behind them, so time is linear; none has a window or a limit that its kind's own format doesn't have.
_AT = re.compile(r" ?[\[({<] ?(?:at|AT|@) ?[\])}>] ?")
_SPACED = (" at ", " AT ", " @ ", " @", "@ ")
_SPELLED_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:(?: ?[\[({<] ?(?:dot|DOT|\.) ?[\])}>] ?| (?:dot|DOT) |\.)[A-Za-z0-9-]{2,}+)++")
_GROUPS = re.compile(r"(?<![0-9])\(?[0-9]++\)?(?:[ ./-]{1,2}\(?[0-9]++\)?)++")
_SSN = re.compile("[0-9]{3}[- ][0-9]{2}[- ][0-9]{4}")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{1,4}+)++")
_SIX = re.compile(r"(?:[0-9A-Fa-f]{0,4}+:){2,}+[0-9A-Fa-f.]*+")
_OPAQUE = re.compile(r"[A-Za-z0-9_+/=-]{16,}+")
_NAMES = ("key", "token", "secret", "passw", "passphrase", "pwd", "auth", "credential", "bearer")
_NAME = re.compile("|".join(_NAMES), re.I)
_REST, _GIVEN = re.compile(r"[\w-]*+"), re.compile(r"[\"']?(?:\s*+[:=]>?\s*+|\s++)[\"']?")
_VALUE = re.compile(r"[^\s\"',;<>]++")
_PEM = re.compile(r"-----BEGIN (?:[A-Z]+ )*?PRIVATE KEY-----")
_PEM_END = re.compile(r"-----END (?:[A-Z]+ )*?PRIVATE KEY-----")

#: Words near personal data, in four languages, near other numbers and near digests that aren't secret; how public formats of keys begin.
_NEAR = re.compile(r"\b(?:phone|tel|telephone|call|mobile|cell|fax|contact|reach|e-?mail|mail|write|ssn|social|security|iban|account|konto|bank|teléfono|llamar|correo|téléphone|appel|courriel|telefon|anruf|rufen)\b", re.I)
_FAR = re.compile(r"\b(?:version|isbn|issn|invoice|order|page|pages|vol|volume|chapter|section|model|serial|release|build|price|score|ratio|date|year|sku|item|no|nr|id|line|code|part|ticket)\b", re.I)
_DIGEST = re.compile(r"(?:sha-?[0-9]*|md5|commit|checksum|hash|digest|etag|uuid|guid|revision|fingerprint|crc)\W*$", re.I)
_SECRET = re.compile(r"(?:key|token|secret|passwd|password|passphrase|pwd|auth|credentials?|bearer)[\w-]*[\"']?\s*(?:[:=]>?|\s)\s*[\"']?$", re.I)
_SHAPES = re.compile(r"AKIA[0-9A-Z]{12}|gh[pousr]_|sk[-_]|xox[abprs]-|AIza|eyJ|glpat-|-----BEGIN")
_UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
#: Digits in a telephone number (7 with a local one, 15 by E.164), characters in an IBAN (ISO 13616).
PHONE_DIGITS, IBAN_CHARS = (7, 15), (15, 34)


def iban_ok(s: str) -> bool:
    s = s.replace(" ", "")
    if not IBAN_CHARS[0] <= len(s) <= IBAN_CHARS[1]:
        return False
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def six_ok(s: str) -> bool:
    try:
        return ipaddress.ip_address(s).version == 6
    except ValueError:
        return False


def _apart_from_words(text: str, start: int, end: int) -> bool:
    return not text[start - 1 : start].isalnum() and not text[end : end + 1].isalnum()


def _marks(text: str) -> list[tuple[int, int]]:
    out = []
    for mark in _SPACED:
        at = text.find(mark)
        while at >= 0:
            out.append((at, at + len(mark)))
            at = text.find(mark, at + 1)
    if "@" in text or any(x + y in text for x in ("at", "AT", "at ", "AT ") for y in "])}>"):
        out += [m.span() for m in _AT.finditer(text)]
    return sorted(out)


def _spelled(text: str) -> Iterator[Span]:
    """Addresses with their at or dots spelled out, bracketed or set apart by spaces."""
    done = 0
    for at, end in _marks(text):
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _SPELLED_DOMAIN.match(text, end) if start < at else None
        if m:
            yield "email", start, m.end()
            done = m.end()


def _numbers(text: str) -> Iterator[Span]:
    """Consecutive groups of digits with as many digits as a telephone or identity number has: all choices of groups in a run."""
    for run in _GROUPS.finditer(text):
        groups = [m.span() for m in _DIGITS.finditer(text, *run.span())]
        for i, (s, _) in enumerate(groups):
            n = 0
            for j, e in groups[i : i + PHONE_DIGITS[1]]:
                n += e - j
                # A group has two digits or more, but for a leading 1.
                if n > PHONE_DIGITS[1] or e - j == 1 and (j > s or text[j] != "1"):
                    break
                both = text[s - 1 : s] == "(" and text[e : e + 1] == ")"
                a, b = s - (text[s - 1 : s] == "(" and (both or ")" in text[s:e])), e + both
                if n >= PHONE_DIGITS[0] and j > s and _apart_from_words(text, a, b):
                    yield "phone", a, b
                    if n == 9 and _SSN.fullmatch(text, a, b):
                        yield "national_id", a, b


def _ibans(text: str) -> Iterator[Span]:
    """The ends of groups after a country and check digits, where an IBAN can end."""
    for m in _IBAN.finditer(text):
        if text[m.start() - 1 : m.start()].isalnum():
            continue
        n = 0
        for part in re.finditer("[A-Z0-9]+", text[m.start() : min(m.end(), m.start() + 2 * IBAN_CHARS[1])]):
            n += part.end() - part.start()
            if IBAN_CHARS[0] <= n <= IBAN_CHARS[1] and _apart_from_words(text, m.start(), m.start() + part.end()):
                yield "iban", m.start(), m.start() + part.end()


def _secrets(text: str) -> Iterator[Span]:
    """Opaque runs with a digit, values that are given to a name of a secret, private keys."""
    if _DIGITS.search(text):
        for m in _OPAQUE.finditer(text):
            if _DIGITS.search(text, *m.span()) and not m.group().isdigit():
                yield "secret", *m.span()
    done, low = 0, text.lower()
    for m in _NAME.finditer(text) if any(w in low for w in _NAMES) else ():
        if m.start() < done:
            continue  # in the same word as a name before
        done = _REST.match(text, m.end()).end()
        given = _GIVEN.match(text, done)
        v = _VALUE.match(text, given.end()) if given else None
        if v and v.end() - v.start() >= 6:
            yield "secret", *v.span()
    at = 0
    while m := _PEM.search(text, at):
        end = _PEM_END.search(text, m.end())
        yield "secret", m.start(), end.end() if end else m.end()
        if not end:
            break
        at = end.end()


def candidates(text: str) -> Iterator[Span]:
    """Further spans to score; they may overlap each other and the base spans."""
    yield from _spelled(text)
    if _DIGITS.search(text):
        yield from _numbers(text)
        yield from _ibans(text)
    if ":" in text:
        yield from (("ip", *m.span()) for m in _SIX.finditer(text) if len(m.group()) > 4 and _apart_from_words(text, *m.span()))
    yield from _secrets(text)


#: Characters of context on either side; longer spans' format is told from their first FORMAT characters, as much as any check needs.
CONTEXT, FORMAT = 40, 4096


def features(kind: str, text: str, start: int, end: int) -> list[float]:
    """Format of the span and its context."""
    s = text[start : min(end, start + FORMAT)]
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    groups = [len(g) for g in _DIGITS.findall(s)]
    n, size = sum(groups), len(s)
    counts = Counter(s)
    upper, lower = sum(map(str.isupper, s)), sum(map(str.islower, s))
    changes = sum(a.isdigit() != b.isdigit() for a, b in zip(s, s[1:]))
    return [
        *(float(kind == k) for k in KINDS),
        float(size),
        float(n),
        float(len(groups)),
        float(groups[0] if groups else 0),
        float(groups[-1] if groups else 0),
        float(max(groups, default=0)),
        float(len({c for c in s if not c.isalnum()})),
        float("(" in s),
        float("/" in s),
        float("." in s),
        float(bool(re.search(r"[\[({<] ?(?:at|AT|@)", s))),
        float(bool(re.search(r"\b(?:dot|DOT)\b", s))),
        float("@" in s),
        float(kind == "iban" and iban_ok(s)),
        float(kind == "ip" and six_ok(s)),
        float(kind == "national_id" and s[:3] not in ("000", "666") and s[0] != "9" and s[4:6] != "00" and s[-4:] != "0000"),
        float(len(_NEAR.findall(before)) + len(_NEAR.findall(after[:15]))),
        float(len(_FAR.findall(before))),
        float(len({c for c in s if c.isdigit()})),
        # Whether the run of groups goes on before or after.
        float(bool(re.search(r"[0-9]\)?[ ./-]{1,2}$", before))),
        float(bool(re.match(r"[ ./-]{1,2}\(?[0-9]", after))),
        float(s[:2] in ("00", "1-", "1 ") or s[0] in "(0"),
        # What tells an opaque value from words.
        -sum(c / size * math.log2(c / size) for c in counts.values()),
        upper / size,
        lower / size,
        n / size,
        changes / size,
        float(all(c in "0123456789abcdefABCDEF" for c in s)),
        float(bool(_UUID.fullmatch(s))),
        float(bool(_SHAPES.match(s))),
        float(bool(_SECRET.search(before))),
        float(bool(_DIGEST.search(before))),
        float(before[-1:] in ("'", '"') and after[:1] == before[-1:]),
        float(bool(re.search(r"[:=]>?\s*[\"']?$", before))),
        float("/" in s and "." not in s and lower / size > 0.6),
    ]


@dataclass
class Model:
    trees: Boosted
    threshold: dict[str, float]


def _iban(rnd: random.Random, valid: bool) -> str:
    country, body = rnd.choice(["DE", "FR", "ES", "GB", "NL"]), "".join(rnd.choices("0123456789", k=rnd.choice([14, 16, 18])))
    check = 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97
    s = f"{country}{(check if valid else (check + rnd.randint(1, 90)) % 97):02d}{body}"
    return " ".join(s[i : i + 4] for i in range(0, len(s), 4)) if rnd.random() < 0.5 else s


def examples(n: int, seed: int) -> list[tuple[str, str, int, int, int]]:
    """Candidates in generated texts: (kind, text, start, end, whether personal).

    Personal and other values come in the same formats, from the same digits and letters, wherever the format alone doesn't decide; then the
    words around them do. A candidate is personal if it is the value's span as a whole: its parts, and what reaches beyond, are not.
    """
    rnd = random.Random(seed)
    word = lambda low=2, high=9: "".join(rnd.choices("abcdefghilmnoprstu", k=rnd.randint(low, high)))
    d = lambda k: "".join(rnd.choices("0123456789", k=k))
    of = lambda chars, k: "".join(rnd.choices(chars, k=k))
    hexa, letters = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"

    def email() -> tuple[str, bool, list[str]]:
        if rnd.random() < 0.5:
            at, dot = rnd.choice([(" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "(dot)"), ("[at]", "."), (" (at) ", "."), (" AT ", " DOT "), ("[at]", "[dot]"), ("{at}", "{dot}"), (" at ", "."), (" @ ", ".")])
            cue = ["contact", "email", "write to", "mail", "reach"] if (at, dot) in ((" at ", "."), (" @ ", ".")) else ["contact", "email", word(), word()]
            return f"{word()}{rnd.choice(['', '.', '_'])}{word()}{at}{rnd.choice(['example', 'mail', 'post', word()])}{dot}{rnd.choice(['com', 'org', 'net', 'de', 'fr', 'es'])}", True, cue
        return rnd.choice([f"{word()} at {word()}.{word().capitalize()}", f"{word()} @ {word()}.{word()}", f"{word()} at {word()}.{rnd.choice(['com', 'org', 'net', word()])}", f"{word()} at {word()} dot {word()}s"]), False, [word()]

    def phone() -> tuple[str, bool, list[str]]:
        sure = [f"({d(3)}) {d(3)}-{d(4)}", f"1-{rnd.randint(201, 989)}-{d(3)}-{d(4)}", f"0{rnd.randint(1, 9)} {d(2)} {d(2)} {d(2)} {d(2)}", f"0{d(3)}/{d(7)}", f"0049 {d(3)} {d(4)} {d(3)}"]
        either = [f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)}.{d(3)}.{d(4)}", f"{d(3)} {d(3)} {d(4)}", f"{d(4)} {d(4)} {d(3)}", f"{d(3)} {d(2)} {d(2)} {d(2)}", f"{d(3)} {d(4)}", f"{d(5)}-{d(4)}", f"{d(2)} {d(3)} {d(4)} {d(2)}"]
        never = [f"{rnd.randint(1, 28):02d}{x}{rnd.randint(1, 12):02d}{x}{rnd.randint(1900, 2030)}" for x in "-/."] + [f"{rnd.randint(1900, 2030)}-{rnd.randint(1, 12):02d}-{rnd.randint(1, 28):02d}", f"978-{d(1)}{d(2)}-{d(4)}-{d(3)}", f"{d(1)}.{d(2)}.{d(4)}", " ".join(d(rnd.randint(1, 6)) for _ in range(rnd.randint(2, 7)))]
        cues = ["phone", "call", "tel", "contact", "mobile", "fax", "Telefon", "llamar", "téléphone"]
        pick = rnd.random()
        if pick < 0.3:
            return rnd.choice(sure), True, [*cues, word(), word(), word()]
        if pick < 0.5:
            return rnd.choice(either), True, cues
        return (rnd.choice(either), False, [*others, word()]) if pick < 0.75 else (rnd.choice(never), False, [*others, word(), "call"])

    def national_id() -> tuple[str, bool, list[str]]:
        if rnd.random() < 0.6:
            return f"{rnd.randint(1, 899):03d}-{rnd.randint(1, 99):02d}-{rnd.randint(1, 9999):04d}", True, ["SSN", "social security", word()]
        return rnd.choice([f"000-{d(2)}-{d(4)}", f"9{d(2)}-00-{d(4)}", f"{d(3)} {d(2)} {d(4)}", f"{d(3)}-{d(2)}-0000"]), False, [*others, word()]

    def iban() -> tuple[str, bool, list[str]]:
        good = rnd.random() < 0.5
        return _iban(rnd, good), good, ["IBAN", "account", "bank", word()]

    def ip() -> tuple[str, bool, list[str]]:
        if rnd.random() < 0.5:
            full = [of(hexa, rnd.randint(1, 4)) for _ in range(8)]
            return rnd.choice([":".join(full), ":".join(full[:3]) + "::" + ":".join(full[6:]), "fe80::" + ":".join(full[:4])]), True, ["address", "host", "from", word()]
        return rnd.choice([f"{d(2)}:{d(2)}:{d(2)}", f"{of(hexa, 2)}:{of(hexa, 2)}:{of(hexa, 2)}:{of(hexa, 2)}:{of(hexa, 2)}:{of(hexa, 2)}", f"{d(1)}:{d(2)}:{d(2)}"]), False, ["time", "at", word()]

    def secret() -> tuple[str, bool, list[str]]:
        opaque = rnd.choice([of(hexa, rnd.choice([32, 40, 64])), of(letters, rnd.randint(16, 72)), of("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", rnd.choice([16, 20, 40])), of(letters, 30) + "=="])
        shaped = rnd.choice(["AKIA" + of("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 16), "ghp_" + of(letters, 36), "sk-" + of(letters, 32), "xoxb-" + d(11) + "-" + of(letters, 24), "AIza" + of(letters, 35), "eyJ" + of(letters, 60)])
        name = rnd.choice(["token", "api_key", "API_KEY", "apikey", "secret", "client_secret", "password", "auth_token", "SECRET_KEY", "access-token", "pwd"])
        quote, sign = rnd.choice(["", '"', "'"]), rnd.choice([" = ", "=", ": ", ":"])
        pick = rnd.random()
        if pick < 0.3:
            return opaque, True, [f"{name}{sign}{quote}"]
        if pick < 0.34:
            kind = rnd.choice(["", "RSA ", "EC "])
            return f"-----BEGIN {kind}PRIVATE KEY-----\n" + "".join(of(letters + "+/", 64) + "\n" for _ in range(rnd.randint(1, 20))) + f"-----END {kind}PRIVATE KEY-----", True, [word(), "key"]
        if pick < 0.46:
            return shaped, True, [word(), f"{name}{sign}{quote}"]
        if pick < 0.55:
            return rnd.choice([of(letters + "!$%_", rnd.randint(8, 14)) + d(1), word(4, 8) + d(rnd.randint(2, 4)) + rnd.choice("!$%_#")]), True, [f"{rnd.choice(['password', 'passwd', 'pwd', 'secret'])}{sign}{quote}"]
        if pick < 0.75:
            return opaque, False, [f"{rnd.choice(['sha1', 'sha256', 'md5', 'commit', 'checksum', 'hash', 'digest', 'etag', 'revision'])}{sign}{quote}", rnd.choice(["commit ", "hash ", "revision "])]
        if pick < 0.82:
            return "-".join(of(hexa, k) for k in (8, 4, 4, 4, 12)), False, ["id ", "uuid: ", word() + " "]
        if pick < 0.9:
            return rnd.choice([f"{word(6, 12)}{rnd.choice('-_/')}{word(6, 12)}{rnd.choice('-_/')}{d(rnd.randint(1, 4))}", f"/{word()}/{word()}/{word()}/{d(2)}/{word()}"]), False, [word() + " ", "see "]
        return rnd.choice([word(6, 12), word(6, 9) + d(1)]), False, [rnd.choice([f"{name}: ", f"the {name} ", f"key {rnd.choice(['is', 'to'])} ", "token "])]

    others = ["version", "ISBN", "invoice", "order no", "page", "serial", "price", "date", "score", "model", "ticket"]
    makers = (email, phone, phone, phone, phone, national_id, iban, ip, secret, secret, secret)
    out = []
    for k in range(n):
        value, good, cues = makers[k % len(makers)]()
        own = makers[k % len(makers)].__name__
        cue = rnd.choice(cues)
        head = " ".join([*(word() for _ in range(rnd.randint(0, 4))), cue])
        head += "" if cue[-1] in "=\"' :" else rnd.choice([" ", ": "])
        closing = head[-1] if head[-1] in "\"'" else ""
        tail = closing + rnd.choice([" ", ", ", ". ", "; "]) + rnd.choice(["", f"{rnd.randint(1, 99)} "]) * (rnd.random() < 0.3) + " ".join(word() for _ in range(rnd.randint(0, 5)))
        text = head + value + tail
        at = (own, len(head), len(head) + len(value))
        near = [c for c in dict.fromkeys(candidates(text)) if c[1] < at[2] and c[2] > at[1]]
        # Of the wrong choices of groups some are enough.
        wrong = [c for c in near if c != at and not (good and c[0] != own)]
        out += [(*c[:1], text, *c[1:], int(good)) for c in near if c == at] + [(*c[:1], text, *c[1:], 0) for c in rnd.sample(wrong, min(3, len(wrong)))]
    return out


@lru_cache(maxsize=1)
def fitted() -> Model:
    """Trees on three fifths of the examples, calibration and thresholds on the rest."""
    rows = examples(EXAMPLES, 11)
    x, y = np.array([features(*r[:4]) for r in rows]), np.array([r[4] for r in rows], np.float64)
    cut = len(rows) * 3 // 5
    trees = boost(x[:cut], y[:cut])
    trees.slope, trees.bias = map(float, logistic(trees.margin(x[cut:])[:, None], y[cut:], l2=1e-3))
    p, threshold = trees.predict(x[cut:]), {}
    for kind in KINDS:
        own = np.array([r[0] == kind for r in rows[cut:]])
        order = np.argsort(-p[own], kind="stable")
        hits = np.cumsum(y[cut:][own][order]) / np.arange(1, own.sum() + 1)
        good = np.flatnonzero(hits >= PRECISION)
        threshold[kind] = max(0.5, float(p[own][order][good[-1]])) if len(good) else 2.0
    return Model(trees, threshold)


def spans(text: str | None, model: Model) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans, each by kind, then start."""
    base = base_spans(text)
    if not text:
        return base, base
    found = list(dict.fromkeys(candidates(text)))
    taken = [(s, e) for _, s, e in base]
    found = [c for c in found if not any(c[1] < e and s < c[2] for s, e in taken)] if len(taken) * len(found) < 20_000 else _apart(found, taken)
    if not found:
        return base, base
    passed = []
    for at in range(0, len(found), BLOCK):
        part = found[at : at + BLOCK]
        score = model.trees.predict(np.array([features(k, text, s, e) for k, s, e in part]))
        passed += [(-p, s, e, k) for p, (k, s, e) in zip(score.tolist(), part) if p >= model.threshold[k]]
    passed.sort()
    added: list[Span] = []
    starts: list[int] = []
    ends: list[int] = []
    for _, s, e, k in passed:
        # What was added is apart, so of all that starts before e only the last can reach s.
        i = bisect_left(starts, e)
        if i and ends[i - 1] > s:
            continue
        starts.insert(i, s)
        ends.insert(i, e)
        added.append((k, s, e))
    return base, sorted(base + added, key=lambda c: (KINDS.index(c[0]), c[1]))


def _apart(found: list[Span], taken: list[tuple[int, int]]) -> list[Span]:
    """Those of found that overlap none of taken, which may be many; the longest taken span bounds the search."""
    starts = np.array(sorted(s for s, _ in taken), np.int64)
    ends = np.array([e for _, e in sorted(taken)], np.int64)
    reach = np.maximum.accumulate(ends) if len(ends) else ends
    out = []
    for k, s, e in found:
        i = int(np.searchsorted(starts, e)) - 1  # the last taken span that starts before e
        if i < 0 or reach[i] <= s:
            out.append((k, s, e))
    return out


def redacted(text: str | None, all_spans: list[Span]) -> str | None:
    """The text with each span as its kind in brackets; of overlapping spans the union is replaced once."""
    if not text or not all_spans:
        return text
    out, at = [], 0
    for k, s, e in sorted(all_spans, key=lambda c: (c[1], -c[2])):
        if s >= at:
            out += [text[at:s], f"[{k.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def joined(found: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in found)


def with_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with `pii`, a struct: base and spans (joined kind:start:end), counts of the base kinds, of secrets and of all, redacted text."""
    model = fitted()

    @F.arrow_udf("base string, spans string, n_email long, n_ip long, n_card long, n_phone long, n_secret long, n_spans long, redacted string")
    def find(texts: pa.Array) -> pa.Array:
        rows = []
        for x in texts:
            value = x.as_py()
            base, every = spans(value, model)
            kinds = [k for k, _, _ in base]
            rows.append((joined(base), joined(every), *(kinds.count(k) for k in BASE), sum(k == "secret" for k, _, _ in every), len(every), redacted(value, every)))
        cols = list(zip(*rows)) if rows else [()] * 9
        kinds = [pa.string()] * 2 + [pa.int64()] * 6 + [pa.string()]
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["base", "spans", "n_email", "n_ip", "n_card", "n_phone", "n_secret", "n_spans", "redacted"])

    return docs.withColumn("pii", find(F.col(text)))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "pii.n_email", "pii.n_ip", "pii.n_card", "pii.n_phone", F.sha2("pii.base", 256).alias("base_sha256"), "pii.spans", "pii.n_secret", "pii.n_spans", F.sha2("pii.redacted", 256).alias("redacted_sha256"))
