"""SQL twins of the queries, written from the definitions for another engine (its dialect has no look-around in patterns)."""

from __future__ import annotations

from caseloom.functions import text as T
from caseloom.operators.resolve import NICKNAMES
from caseloom.operators.threads import STOPWORDS
from caseloom.plans.adapters import DAYS, FIRST, LAST


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(items: list[str]) -> str:
    return "[" + ", ".join(map(_q, items)) + "]"


def _count(expr: str, pattern: str) -> str:
    return f"len(regexp_extract_all({expr}, {_q(pattern)}))"


#: Word boundaries are ASCII there: other letters become a word character first.
_E = "regexp_replace(t, '[À-ɏ]', '_', 'g')"
_DIALOGUE = T.PATTERNS["dialogue_marker_count"]

PAGES = """
pages AS (
  SELECT doc_id, sha256('fs||' || doc_id) AS file_id, generate_subscripts(l, 1) - 1 AS page_index, unnest(l) AS text
  FROM (SELECT doc_id, string_split(coalesce(text, '') || chr(10) || 'On 2024-' || lpad((doc_id % 12 + 1)::VARCHAR, 2, '0') || '-' || lpad((doc_id % 28 + 1)::VARCHAR, 2, '0')
        || ' Officer Dana Reed reported to Acme Inc. about Case #A' || (doc_id % 50 + 100) || '.' || CASE WHEN doc_id % 3 = 0 THEN chr(10) || 'Name: yes' ELSE '' END, chr(10)) AS l FROM documents))
"""
CHUNKS = f"""{PAGES},
said AS (SELECT *, regexp_matches(regexp_replace(text, '[À-ɏ]', '_', 'g'), {_q(_DIALOGUE)}) AS dialogue FROM pages),
ahead AS (SELECT *, lead(text) OVER w AS ntext, lead(dialogue) OVER w AS ndialogue FROM said WINDOW w AS (PARTITION BY file_id ORDER BY page_index)),
chunks AS (
  SELECT file_id || ':' || page_index || '-' || (page_index + n - 1) AS chunk_id, doc_id, file_id, page_index AS page_start, page_index + n - 1 AS page_end,
         CASE WHEN n = 1 THEN text WHEN text <> '' AND ntext <> '' THEN text || chr(10) || chr(10) || ntext ELSE text || ntext END AS t, dialogue
  FROM (SELECT *, CASE WHEN ntext IS NULL OR dialogue OR ndialogue THEN 1 ELSE 2 END AS n FROM ahead))
"""
_FULL = "list_filter(string_split(regexp_replace(t, '\\n$', ''), chr(10)), lambda x: regexp_matches(x, '\\S'))"
_SHAPE = "regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '[^\\p{Lu}\\p{Ll}\\p{Nd}_\\s]', '-', 'g'), '\\p{Lu}', 'A', 'g'), '\\p{Ll}', 'a', 'g'), '\\p{Nd}', '0', 'g')"
_BARE = "regexp_replace(t, '\\s', '', 'g')"
_BULLETS = f"len(list_filter(nonempty, lambda x: regexp_matches(x, {_q(T.BULLET)})))"
_TABLES = "len(list_filter(nonempty, lambda x: contains(x, chr(9)) OR length(x) - length(replace(x, '|', '')) >= 2 OR regexp_matches(x, '\\S\\s{2,}\\S')))"


def _keyword(w: str) -> str:
    body = "".join(c if c.isalnum() or c == " " else "\\" + c for c in w).replace(" ", "  ")
    return _count("doubled", f"(?i)(?:^|[^A-Za-z0-9_]){body}(?:$|[^A-Za-z0-9_])")


_PACKS = {p: " + ".join(map(_keyword, ws)) for p, ws in T.PACKS.items()}
FEATURES = f"""{CHUNKS},
chars AS (SELECT chunk_id, unnest(string_split({_BARE}, '')) AS c, generate_subscripts(string_split({_BARE}, ''), 1) AS i FROM chunks),
marks AS (SELECT chunk_id, i, c, CASE WHEN c = lag(c) OVER (PARTITION BY chunk_id ORDER BY i) THEN 0 ELSE 1 END AS s FROM chars WHERE c <> ''),
islands AS (SELECT chunk_id, sum(s) OVER (PARTITION BY chunk_id ORDER BY i) AS g FROM marks),
longest AS (SELECT chunk_id, max(n) AS run FROM (SELECT chunk_id, g, count(*) AS n FROM islands GROUP BY ALL) GROUP BY chunk_id),
parts AS (SELECT *, {_BARE} AS bare, list_filter(regexp_split_to_array({_SHAPE}, '\\s+'), lambda x: x <> '') AS toks,
  {_FULL} AS nonempty, CASE WHEN t = '' THEN 0 ELSE len(string_split(regexp_replace(t, '\\n$', ''), chr(10))) END AS line_count,
  regexp_replace(t, '([^A-Za-z0-9_])', '\\1\\1', 'g') AS doubled, {_E} AS e FROM chunks),
features AS (SELECT p.*, length(t) AS char_len, CASE WHEN length(t) > 0 THEN round(length(bare) / length(t), 6) ELSE 0.0 END AS non_ws_ratio,
  CASE WHEN length(bare) > 0 THEN round({_count('t', chr(92) + 'p{P}')} / length(bare), 6) ELSE 0.0 END AS punctuation_ratio,
  {_count('t', chr(0xFFFD))} AS replacement_char_count, coalesce(run, 0) AS max_repeated_char_run, len(toks) AS tokens_sampled_for_shapes,
  len(list_distinct(list_transform(toks, lambda x: substr(x, 1, 40)))) AS unique_word_shapes,
  len(nonempty) AS nonempty_line_count, {_BULLETS} AS bullet_line_count, {_TABLES} AS tableish_line_count,
  {', '.join(f"{_count('e', p)} AS {n}" for n, p in T.PATTERNS.items())}, {', '.join(f'{v} AS kw_{p}' for p, v in _PACKS.items())}
  FROM parts p LEFT JOIN longest USING (chunk_id)),
flags AS (SELECT *, CASE WHEN tokens_sampled_for_shapes > 0 THEN round(unique_word_shapes / tokens_sampled_for_shapes, 6) ELSE 0.0 END AS word_shape_diversity,
  CASE WHEN nonempty_line_count > 0 THEN round(bullet_line_count / nonempty_line_count, 6) ELSE 0.0 END AS bullet_density, tableish_line_count >= 2 AS table_like,
  CASE WHEN date_like_count > 0 THEN {_count('e', T.NEAR_DATE)} ELSE 0 END AS on_at_by_date_count, {' + '.join(f'kw_{p}' for p in T.PACKS)} AS keyword_hit_total FROM features)
"""
_WEIGHTS = [("badge_id_count > 0", 0.10), ("capitalized_name_count > 0", 0.08), ("honorific_count > 0", 0.05), ("org_suffix_count > 0", 0.05), ("date_like_count > 0", 0.15), ("time_like_count > 0", 0.05), ("on_at_by_date_count > 0", 0.10), ("incident_verb_count > 0", 0.10), ("dialogue_marker_count > 0", 0.08), ("table_like", 0.03), ("bullet_density >= 0.2", 0.03), ("char_len < 40", -0.20), ("non_ws_ratio < 0.05", -0.20), ("punctuation_ratio > 0.40", -0.10), ("max_repeated_char_run >= 10", -0.10)]
_SCORE = "least(0.4::DOUBLE, 0.05::DOUBLE * keyword_hit_total)" + "".join(f" + CASE WHEN {c} THEN ({w})::DOUBLE ELSE 0.0::DOUBLE END" for c, w in _WEIGHTS)
TRIAGE = f"""{FEATURES},
scored AS (SELECT *, greatest(0.0::DOUBLE, least(1.0::DOUBLE, {_SCORE})) AS score, CASE WHEN char_len = 0 THEN 0 ELSE greatest(1, char_len // 4) END AS token_est,
  (char_len > 0 AND char_len < 40) OR non_ws_ratio < 0.05 OR punctuation_ratio > 0.40 OR max_repeated_char_run >= 10 AS low_quality,
  char_len >= 800 AND nonempty_line_count >= 8 AND NOT table_like AND bullet_density < 0.25 AND dialogue_marker_count + capitalized_name_count + date_like_count + incident_verb_count + time_like_count >= 4 AS complex_narrative FROM flags),
triage AS (SELECT *, CASE WHEN score < 0.10 THEN 'skip' WHEN score >= 0.75 OR complex_narrative THEN 'llm_large' ELSE 'llm_small' END AS route FROM scored)
"""


def _title(e: str) -> str:
    return f"(upper(substr({e}, 1, 1)) || substr({e}, 2))"


def _person(i: str, short: str) -> str:
    return f"({_title(f'({_list(FIRST)})[({i}) % 6 * 2 + {short} + 1]')} || ' ' || {_title(f'({_list(LAST)})[({i}) % 10 + 1]')} || (({i}) // 60))"


_DAY = "strftime(ts, '%Y-%m-%d')"
EVENTS = f"""
ev AS (SELECT event_id, event_type AS event, user_id, ts::DATE AS day,
  CASE event_id % 10 WHEN 0 THEN {_DAY} WHEN 1 THEN strftime(ts, '%-m/%-d/%Y') WHEN 2 THEN strftime(ts, '%B %-d, %Y') WHEN 3 THEN strftime(ts, '%b %Y') WHEN 4 THEN strftime(ts, '%Y') WHEN 5 THEN 'yesterday'
    WHEN 6 THEN 'last ' || ({_list(DAYS)})[user_id % 7 + 1] WHEN 7 THEN {_DAY} || ' and 2023-02-06' WHEN 8 THEN {_DAY} || ' to ' || strftime(ts::DATE + 4, '%Y-%m-%d') ELSE CASE WHEN event_id % 20 = 19 THEN 'unknown' ELSE 'in 2 months' END END AS date,
  CASE WHEN event_id % 17 <> 0 THEN (event_id % 101) / 100 END AS confidence, 'u' || user_id AS file_id, 'u' || user_id || ':' || {_DAY} AS chunk_id,
  day(ts) AS page_start, day(ts) + event_id % 2 AS page_end, 'event ' || event_id || ' ' || event_type AS quote FROM events),
evc AS (SELECT DISTINCT file_id, chunk_id, user_id, day FROM ev),
ent AS (SELECT {_person('user_id // 2', 'day(day) % 2')} AS entity, 'person' AS type, 0.5 + (day(day) % 5) / 10 AS confidence, file_id, chunk_id, day(day) AS page_start, day(day) AS page_end, 'saw ' || chunk_id AS quote, user_id // 2 AS pid, user_id FROM evc
  UNION ALL SELECT 'Town ' || (user_id // 2 % 5), 'place', 0.5 + (day(day) % 5) / 10, file_id, chunk_id, day(day), day(day), 'in ' || chunk_id, user_id // 2, user_id FROM evc),
sig AS (SELECT entity AS person_text, confidence, file_id, chunk_id, page_start, page_end, quote, s.a AS attribute, s.v AS value, s.n AS value_norm FROM (SELECT *, unnest([
    {{'a': 'dob', 'k': user_id % 4 <> 3, 'v': (pid % 60 + 1940) || '-' || lpad((pid // 60 % 12 + 1)::VARCHAR, 2, '0') || '-' || lpad((pid // 720 % 28 + 1)::VARCHAR, 2, '0'), 'n': (pid % 60 + 1940) || '-' || lpad((pid // 60 % 12 + 1)::VARCHAR, 2, '0') || '-' || lpad((pid // 720 % 28 + 1)::VARCHAR, 2, '0')}},
    {{'a': 'address', 'k': user_id % 3 = 1, 'v': pid || ' Main  Street', 'n': pid || ' main street'}},
    {{'a': 'case_id', 'k': user_id % 3 = 0, 'v': ' case ' || (user_id // 6), 'n': 'CASE' || (user_id // 6)}}]) AS s FROM ent WHERE type = 'person') WHERE s.k)
"""
TIMES = f"""{EVENTS},
anch AS (SELECT e.*, CASE WHEN day(day) % 2 = 0 THEN day WHEN user_id % 5 <> 0 THEN ('2024-02-' || lpad((user_id % 28 + 1)::VARCHAR, 2, '0'))::DATE END AS anchor FROM ev e),
rel AS (SELECT *, CASE event_id % 10 WHEN 5 THEN anchor - 1 WHEN 6 THEN anchor - (CASE WHEN (isodow(anchor) - 1 - user_id % 7 + 7) % 7 = 0 THEN 7 ELSE (isodow(anchor) - 1 - user_id % 7 + 7) % 7 END)::INT WHEN 9 THEN CASE WHEN date <> 'unknown' THEN (anchor + INTERVAL 2 MONTH)::DATE END END AS rday FROM anch),
et AS (SELECT event_id, date AS date_raw,
  strftime(CASE event_id % 10 WHEN 0 THEN day WHEN 1 THEN day WHEN 2 THEN day WHEN 3 THEN date_trunc('month', day) WHEN 4 THEN date_trunc('year', day) WHEN 8 THEN day ELSE rday END, '%Y-%m-%d') AS date_start,
  strftime(CASE event_id % 10 WHEN 0 THEN day WHEN 1 THEN day WHEN 2 THEN day WHEN 3 THEN last_day(day) WHEN 4 THEN make_date(year(day), 12, 31) WHEN 8 THEN day + 4 ELSE rday END, '%Y-%m-%d') AS date_end,
  CASE WHEN event_id % 10 IN (0, 1, 2) THEN 'day' WHEN event_id % 10 = 3 THEN 'month' WHEN event_id % 10 = 4 THEN 'year' WHEN event_id % 10 = 8 THEN 'range' WHEN rday IS NOT NULL THEN 'day' ELSE 'unknown' END AS precision,
  CASE WHEN event_id % 10 IN (0, 1, 2, 3, 4, 8) THEN 'ok' WHEN event_id % 10 = 7 THEN 'unresolved_ambiguous' WHEN date = 'unknown' THEN 'invalid_format' WHEN anchor IS NULL THEN 'missing_anchor' ELSE 'ok' END AS status,
  CASE WHEN event_id % 10 IN (0, 1, 2, 3, 4, 8) THEN 'absolute_v1' WHEN rday IS NOT NULL THEN 'relative_v1' END AS parser FROM rel)
"""
CASES = f"""{TIMES},
ec AS (SELECT e.event_id, coalesce(s.value_norm, 'file:' || e.file_id) AS case_id_norm, CASE WHEN s.value_norm IS NULL THEN 'fallback' ELSE 'identity_signals' END AS source
  FROM ev e LEFT JOIN (SELECT DISTINCT file_id, chunk_id, value_norm FROM sig WHERE attribute = 'case_id') s USING (file_id, chunk_id))
"""
_NORM = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))"
_FULLNAME = "CASE {0} " + " ".join(f"WHEN {_q(s)} THEN {_q(f)}" for s, f in NICKNAMES.items()) + " ELSE {0} END"
PEOPLE = f"""{CASES},
obs AS (SELECT chunk_id AS obs_id, entity AS name, {_NORM.format('entity')} AS name_norm, file_id, chunk_id, page_start, page_end,
  split_part({_NORM.format('entity')}, ' ', 1) AS f, split_part({_NORM.format('entity')}, ' ', 2) AS l FROM ent WHERE type = 'person'),
osig AS (SELECT o.*, {_FULLNAME.format('f')} AS ff, (SELECT max(value_norm) FROM sig s WHERE s.chunk_id = o.chunk_id AND attribute = 'dob') AS dob, (SELECT max(value_norm) FROM sig s WHERE s.chunk_id = o.chunk_id AND attribute = 'address') AS address,
  (SELECT max(value_norm) FROM sig s WHERE s.chunk_id = o.chunk_id AND attribute = 'case_id') AS case_id FROM obs o),
keys AS (SELECT obs_id, 'last_first_initial' AS key_type, l || ':' || f[1] AS key FROM osig UNION ALL SELECT obs_id, 'canonical_first_last', ff || ':' || l FROM osig UNION ALL SELECT obs_id, 'exact', name_norm FROM osig
  UNION ALL SELECT obs_id, 'dob', dob FROM osig WHERE dob IS NOT NULL UNION ALL SELECT obs_id, 'address', address FROM osig WHERE address IS NOT NULL UNION ALL SELECT obs_id, 'case_id', case_id FROM osig WHERE case_id IS NOT NULL),
fit AS (SELECT key_type, key FROM keys GROUP BY ALL HAVING count(*) BETWEEN 2 AND 200),
pairs AS (SELECT a.obs_id AS "left", b.obs_id AS "right", key_type, key FROM keys a JOIN keys b USING (key_type, key) JOIN fit USING (key_type, key) WHERE a.obs_id < b.obs_id),
px AS (SELECT p."left", p."right", coalesce(a.dob = b.dob, false) AS d, coalesce(a.address = b.address, false) AS ad, coalesce(a.case_id = b.case_id, false) AS c, a.name_norm = b.name_norm AS x, coalesce(a.dob <> b.dob, false) AS conflict,
  a.name_norm <> b.name_norm AND a.l = b.l AS sl, a.f[1] = b.f[1] AS i, a.ff = b.ff AS nk FROM (SELECT DISTINCT "left", "right" FROM pairs) p JOIN osig a ON a.obs_id = p."left" JOIN osig b ON b.obs_id = p."right"),
pt AS (SELECT *, (CASE WHEN d THEN 10.0 ELSE 0 END + CASE WHEN ad THEN 6.0 ELSE 0 END + CASE WHEN c THEN 2.0 ELSE 0 END + CASE WHEN x THEN 4.0 ELSE 0 END + CASE WHEN sl THEN 1.0 ELSE 0 END + CASE WHEN sl AND i THEN 1.0 ELSE 0 END + CASE WHEN sl AND nk THEN 2.0 ELSE 0 END)::DOUBLE AS total FROM px),
sp AS (SELECT "left", "right", CASE WHEN conflict THEN -100.0 ELSE total END::DOUBLE AS score, CASE WHEN conflict THEN 'no_merge' WHEN d OR (ad AND (x OR sl AND nk) AND total >= 9) THEN 'auto_merge' WHEN (c AND NOT d AND NOT ad) OR total >= 5 THEN 'needs_review' ELSE 'no_merge' END AS decision,
  CASE WHEN conflict THEN 'dob_conflict' ELSE array_to_string(list_filter([CASE WHEN d THEN 'dob_match' END, CASE WHEN ad THEN 'address_match' END, CASE WHEN c THEN 'case_id_match' END, CASE WHEN x THEN 'name_exact' END, CASE WHEN sl THEN 'last_name_match' END, CASE WHEN sl AND i THEN 'first_initial_match' END, CASE WHEN sl AND nk THEN 'nickname_match' END, CASE WHEN NOT (d OR (ad AND (x OR sl AND nk) AND total >= 9)) AND NOT d AND NOT ad AND (c OR total >= 5) THEN CASE WHEN c THEN 'case_id_only' ELSE 'weak_match' END END], lambda r: r IS NOT NULL), '|') END AS reasons FROM pt),
links AS (SELECT "left" AS a, "right" AS b FROM sp WHERE decision = 'auto_merge' UNION SELECT "right", "left" FROM sp WHERE decision = 'auto_merge'),
reach(obs_id, root) AS (SELECT obs_id, obs_id FROM obs UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.obs_id WHERE r.root < l.b),
mem AS (SELECT obs_id, min(root) AS person_id FROM reach GROUP BY obs_id)
"""
GRAPH = f"""{PEOPLE},
ev_case AS (SELECT 'Event' AS src_type, event_id::VARCHAR AS src_id, 'IN_CASE' AS edge_type, 'Case' AS dst_type, case_id_norm AS dst_id, file_id, chunk_id, least(page_start, page_end)::INT AS page_start, greatest(page_start, page_end)::INT AS page_end, confidence, 'phase9_event_cases:' || source AS source_phase FROM ec JOIN ev USING (event_id)),
p_ev AS (SELECT DISTINCT 'Person' AS src_type, m.person_id AS src_id, 'MENTIONED_IN_EVENT' AS edge_type, 'Event' AS dst_type, e.event_id::VARCHAR AS dst_id, e.file_id, e.chunk_id, least(o.page_start, e.page_start)::INT AS page_start, greatest(o.page_end, e.page_end)::INT AS page_end, e.confidence, 'phase11_cooccurrence:file_chunk' AS source_phase FROM mem m JOIN obs o USING (obs_id) JOIN ev e ON e.file_id = o.file_id AND e.chunk_id = o.chunk_id),
p_case AS (SELECT DISTINCT 'Person' AS src_type, m.person_id AS src_id, 'IN_CASE' AS edge_type, 'Case' AS dst_type, s.value_norm AS dst_id, s.file_id, s.chunk_id, s.page_start::INT AS page_start, s.page_end::INT AS page_end, s.confidence, 'phase6_identity_signals:case_id' AS source_phase FROM sig s JOIN obs o ON o.chunk_id = s.chunk_id AND o.file_id = s.file_id AND o.name_norm = {_NORM.format('s.person_text')} JOIN mem m USING (obs_id) WHERE s.attribute = 'case_id'),
evid AS (SELECT * FROM ev_case UNION ALL SELECT * FROM p_ev UNION ALL SELECT * FROM p_case),
edges AS (SELECT DISTINCT src_type, src_id, edge_type, dst_type, dst_id FROM evid)
"""
TALK = f"""
ut AS (SELECT 'c' || conv_id AS file_id, 'c' || conv_id || ':' || (turn // 4) AS chunk_id, CASE WHEN role = 'user' THEN {_person('conv_id % 12', '0')} ELSE role || ' ' || (conv_id % 5) END AS speaker, text AS quote, turn AS page_start, turn AS page_end, conv_id FROM conversations),
tok AS (SELECT file_id, chunk_id, unnest(list_slice(list_filter(string_split({_NORM.format("coalesce(quote, '')")}, ' '), lambda x: NOT list_contains({_list(STOPWORDS)}, x) AND NOT regexp_matches(x, '^[0-9]+$') AND length(x) >= 3), 1, 200)) AS token FROM ut),
rk AS (SELECT *, row_number() OVER (PARTITION BY file_id, chunk_id ORDER BY n DESC, token) AS r FROM (SELECT file_id, chunk_id, token, count(*) AS n FROM tok GROUP BY file_id, chunk_id, token)),
tops AS (SELECT file_id, chunk_id, list(token ORDER BY r) AS top_tokens FROM rk WHERE r <= 20 GROUP BY file_id, chunk_id),
seg AS (SELECT u.chunk_id AS segment_id, u.file_id, u.chunk_id, count(*) AS utterance_count, min(page_start)::INT AS page_start, max(page_end)::INT AS page_end, 'K' || (any_value(conv_id) % 10) AS case_id_norm, list_sort(list_distinct(list('s:' || {_NORM.format('speaker')}))) AS pk, coalesce(any_value(top_tokens), []::VARCHAR[]) AS tt, ('2024-01-' || lpad((any_value(conv_id) % 28 + 1)::VARCHAR, 2, '0'))::DATE AS d
  FROM ut u LEFT JOIN tops t USING (file_id, chunk_id) GROUP BY u.file_id, u.chunk_id),
ix AS (SELECT segment_id, case_id_norm, unnest(list_distinct(list_concat(list_transform(pk, lambda x: 'k:' || x), list_transform(tt, lambda x: 't:' || x)))) AS key FROM seg),
fx AS (SELECT case_id_norm, key FROM ix GROUP BY ALL HAVING count(*) BETWEEN 2 AND 200),
sh AS (SELECT a.segment_id AS me, b.segment_id AS other, count(*) AS n FROM ix a JOIN fx USING (case_id_norm, key) JOIN ix b USING (case_id_norm, key) WHERE a.segment_id <> b.segment_id GROUP BY ALL),
tr AS (SELECT DISTINCT least(me, other) AS l, greatest(me, other) AS r FROM (SELECT *, row_number() OVER (PARTITION BY me ORDER BY n DESC, least(me, other), greatest(me, other)) AS k FROM sh) WHERE k <= 500),
jac AS (SELECT l AS "left", r AS "right", CASE WHEN len(a.pk) > 0 AND len(b.pk) > 0 THEN len(list_intersect(a.pk, b.pk)) / len(list_distinct(list_concat(a.pk, b.pk))) ELSE 0.0 END AS participant_j, CASE WHEN len(a.tt) > 0 AND len(b.tt) > 0 THEN len(list_intersect(a.tt, b.tt)) / len(list_distinct(list_concat(a.tt, b.tt))) ELSE 0.0 END AS topic_j,
  CASE WHEN abs(a.d - b.d) <= 7 THEN 0.1 WHEN abs(a.d - b.d) <= 30 THEN 0.05 ELSE 0.0 END::DOUBLE AS bonus FROM tr JOIN seg a ON a.segment_id = l JOIN seg b ON b.segment_id = r),
tp AS (SELECT * FROM (SELECT "left", "right", participant_j, topic_j, round(0.7::DOUBLE * participant_j + 0.3::DOUBLE * topic_j + bonus, 6) AS score, CASE WHEN participant_j > 0 AND 0.7::DOUBLE * participant_j + 0.3::DOUBLE * topic_j + bonus >= 0.45 THEN 'link' WHEN participant_j = 0 AND topic_j >= 0.6 AND 0.3::DOUBLE * topic_j + bonus >= 0.3 THEN 'needs_review' END AS decision, array_to_string(list_sort(list_filter([CASE WHEN participant_j > 0 THEN 'participant_overlap' END, CASE WHEN bonus > 0.07 THEN 'time_within_7d' WHEN bonus > 0 THEN 'time_within_30d' END, CASE WHEN topic_j > 0 THEN 'topic_overlap' END], lambda r: r IS NOT NULL)), '|') AS reasons FROM jac) WHERE decision IS NOT NULL),
tl AS (SELECT "left" AS a, "right" AS b FROM tp WHERE decision = 'link' UNION SELECT "right", "left" FROM tp WHERE decision = 'link'),
trch(segment_id, root) AS (SELECT segment_id, segment_id FROM seg UNION SELECT l.b, r.root FROM trch r JOIN tl l ON l.a = r.segment_id WHERE r.root < l.b),
tm AS (SELECT segment_id, min(root) AS root FROM trch GROUP BY segment_id)
"""


def sql(ctes: str, select: str) -> str:
    return f"WITH RECURSIVE {ctes.strip()}\n{select.strip()}"
