from datetime import date

from pyspark.sql import functions as F

from caseloom.functions import dates, ids
from caseloom.functions import text as T


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr(F.col("v")).alias("x")).first().x


def test_names_and_keys(spark):
    assert one(spark, "  O'Neil,  Bob-J. ", T.normal_name) == "o neil bob j" and one(spark, " -- ", T.normal_name) is None
    assert one(spark, " case  12 b", T.case_key) == "CASE12B" and one(spark, " a/b  c. ", T.case_slug) == "A_B_C" and one(spark, "--", T.case_slug) == "unknown"
    assert [one(spark, v, T.birth_key) for v in ("1/2/1980", "13/2/1980", "1980-01-02", "2/31/1980")] == ["1980-01-02", "13/2/1980", "1980-01-02", "1980-02-31"]
    assert one(spark, "1  Main \n St", T.address_key) == "1 main st"


def test_coercions(spark):
    assert [one(spark, v, T.clean_int) for v in ("4", "3.0", " 7 ", "true", "3.5", "x", "NaN", None)] == [4, 3, 7, None, None, None, None, None]
    assert [one(spark, v, T.clean_float) for v in ("0.5", "nan", "true", "1e-2")] == [0.5, None, None, 0.01]
    assert one(spark, " a \n b  ", T.clean_quote) == "a b" and one(spark, "  ", T.clean_quote) is None
    assert [one(spark, v, T.token_estimate) for v in ("", "abc", "x" * 9, None)] == [0, 1, 2, 0]


def test_preview_and_hash(spark):
    assert one(spark, "mail a.b@c.org or +1 (212) 555-0143\n on 12.5.", T.redacted_preview) == "mail [email] or [phone] on 00.0."
    assert one(spark, "é x \n y", T.canonical_hash) == one(spark, "é  x\ny\x00", T.canonical_hash)


def test_keywords(spark):
    hits = lambda t: spark.createDataFrame([(t,)], "v string").select(*[c.alias(k) for k, c in T.keyword_hits(F.lower("v")).items()]).first().asDict()
    assert hits("Phone call about the dob, AKA x; takama") == {"people_identity": 3, "events_timeline": 0, "communications": 2, "legal": 0}
    assert hits("on on at, by_ the")["events_timeline"] == 3


def test_absolute_dates():
    want = {
        "2024-01-05": ("2024-01-05", "2024-01-05", "day"), "on 1/5/2024 maybe": ("2024-01-05", "2024-01-05", "day"), "5 Jan 2024": ("2024-01-05", "2024-01-05", "day"), "Sept 2024": ("2024-09-01", "2024-09-30", "month"),
        "2024-02": ("2024-02-01", "2024-02-29", "month"), "in 2024": ("2024-01-01", "2024-12-31", "year"), "2024-01-09 to 2024-01-05": ("2024-01-05", "2024-01-09", "range"), "Jan 3-5, 2024": ("2024-01-03", "2024-01-05", "range"),
        "2024-01-05, that is January 5, 2024": ("2024-01-05", "2024-01-05", "day"),
    }
    assert {t: dates.parse_absolute(t)[0] for t in want} == want
    status = {"": "empty", "2024-01-05 and 2024-02-06": "unresolved_ambiguous", "Jan 5-3, 2024": "invalid_format", "2024-02-30 to 2024-03-01": "invalid_format", "yesterday": None}
    assert {t: dates.parse_absolute(t)[1] for t in status} == status
    assert dates.first_anchor("seen 99/99/2024, then 2023-05-06") == "2024-01-01" and dates.first_anchor("none") is None
    assert dates.first_anchor("x" * 12_000 + " 2024-01-01") is None


def test_relative_dates(spark):
    rows = [("last Tuesday", "2026-02-20"), ("next friday", "2026-02-20"), ("this fri", "2026-02-20"), ("in 1 month", "2026-01-31"), ("1 year ago", "2024-02-29"), ("tomorrow", "2024-02-28"), ("3 weeks ago", "2024-03-22"), ("in 99999999 days", "2024-01-01"), ("soon", "2024-01-01")]
    got = spark.createDataFrame(rows, "t string, a string").select(dates.relative(F.col("t"), F.col("a").cast("date")).alias("d"), dates.is_relative(F.col("t")).alias("r")).collect()
    assert [r.d for r in got] == [date(2026, 2, 17), date(2026, 2, 27), date(2026, 2, 20), date(2026, 2, 28), date(2023, 2, 28), date(2024, 2, 29), date(2024, 3, 1), None, None]
    assert [r.r for r in got] == [True] * 8 + [False]
    assert [one(spark, v, dates.iso_day) for v in ("2024-01-05T23:59:00Z", "2024-01-05 01:00:00+05:00", "2024-13-01", "x")] == ["2024-01-05", "2024-01-05", None, None]


def test_ids_and_references(spark):
    assert one(spark, "f", lambda c: ids.chunk_id(c, F.lit(1), F.lit(2))) == "f:1-2" and one(spark, "f", lambda c: ids.chunk_id(c, F.lit(3), F.lit(2))) is None
    base = {"file_id": "f", "chunk_id": "c", "page_start": 1, "page_end": 2, "char_start": None, "char_end": None, "quote": "q", "source_phase": "p", "prompt_hash": None, "confidence": 0.5}
    cases = [({}, None), ({"file_id": " "}, "missing_file_id"), ({"page_end": 0}, "invalid_page_range"), ({"char_start": 1}, "invalid_char_range"), ({"quote": "x" * 281}, "quote_too_long"), ({"prompt_hash": "zz"}, "invalid_prompt_hash"), ({"confidence": 1.5}, "invalid_confidence"), ({"source_phase": None}, "missing_source_phase")]
    schema = "file_id string, chunk_id string, page_start int, page_end int, char_start int, char_end int, quote string, source_phase string, prompt_hash string, confidence double"
    got = ids.evidence_errors(spark.createDataFrame([tuple((base | c).values()) for c, _ in cases], schema)).collect()
    assert [r.error_code for r in got] == [e for _, e in cases] and [r.valid for r in got] == [e is None for _, e in cases]


def test_looks_ahead_and_long_runs_change_no_count(spark):
    """patterns led by their first characters match what they did, and lists of runs hold long ones only."""
    texts = ["Officer Dana Reed, Dr. J. B.Poe and Lt at Acme INC. on Jan 5, 2024, 10:30 pm; 2024-01-05", "MORNING night arrested CASE #A12 Badge: B99 unarrested badgE x1/2/24y 1/2/24", "aab", "aaabbbb  bb", "abc", "", "éé\U0001f600\U0001f600\U0001f600"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    for name, starts in T.STARTS.items():
        both = df.select(T.count_of(F.col("v"), T.PATTERNS[name]), T.count_of(F.col("v"), T.led(T.PATTERNS[name], starts))).collect()
        assert all(a == b for a, b in both) and any(a for a, _ in both) and T.led(T.PATTERNS[name], starts) != T.PATTERNS[name]
    bare = T.bare(F.col("v"))
    runs = df.select(T.text_quality(F.col("v"), bare, F.array(), F.lit(0))["max_repeated_char_run"]).collect()
    assert [r[0] for r in runs] == [2, 2, 2, 6, 1, 0, 3]
    assert all("(?=[" in p for words in T.PACKS.values() for p in T.keyword_patterns(words))
