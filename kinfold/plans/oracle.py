"""The reference operators once more in SQL, put together from common table expressions."""

from __future__ import annotations

import re

from kinfold.functions import fixed
from kinfold.plans.adapter import ENTITIES_SQL, TRUTH_SQL


def nested(x: str, replacements: list[tuple[str, str]]) -> str:
    for pattern, to in replacements:
        x = f"regexp_replace({x}, '{pattern}', '{to}', 'gi')"
    return x


def squeezed(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def listed(words: list[str]) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def words(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda t: t <> '')"


def distinctive(x: str, stop: list[str], least: int = 4) -> str:
    return f"list_filter({words(x)}, lambda t: length(t) >= {least} AND NOT list_contains({listed(stop)}, t))"


ABBREVIATIONS = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in fixed.ABBREVIATIONS.items()) + "}"
PLAIN_PARTS = "list_filter(list_transform(string_split(raw, ','), lambda p: trim(p)), lambda p: p <> '')"
_clean = r"lower(trim(regexp_replace(p, '[^\p{L}\p{N}_\s-]', '', 'g')))"


def _usable(p: str, least: int) -> str:
    return rf"CASE WHEN NOT regexp_matches({p}, '{fixed.CITY_STREET}') AND NOT regexp_matches({p}, '^\d+') AND length({p}) >= {least} THEN {p} END"


_regions = listed(fixed.REGIONS)
CITY = f"""CASE WHEN len(cp) > 1 THEN coalesce(
  CASE WHEN list_contains({_regions}, cp[1]) THEN {_usable('cp[2]', 0)} END,
  CASE WHEN list_contains({_regions}, cp[-1]) THEN coalesce({_usable('cp[-2]', 2)}, {_usable('cp[-3]', 2)}) END,
  {_usable('cp[-2]', 3)}, {_usable('cp[1]', 3)}, '') ELSE '' END"""
_anywhere = rf"CASE WHEN NOT (regexp_matches(p, '(?i){fixed.PINCODE_STREET}') AND regexp_matches(p, '^\d+\s+')) THEN nullif(regexp_extract(p, '\b(\d{{5,6}})\b', 1), '') END"
PINCODE = rf"""coalesce(
  CASE upper(country) WHEN 'INDIA' THEN nullif(regexp_extract(raw, '\b([1-9]\d{{5}})\b', 1), '')
    WHEN 'FRANCE' THEN nullif(regexp_extract(raw, '\b(\d{{5}})\b', 1), '')
    WHEN 'US' THEN coalesce(nullif(regexp_extract(raw, '\b[A-Z]{{2}}\s+(\d{{5}}(?:-\d{{4}})?)\b', 1), ''),
      list_filter(list_reverse({words("coalesce(parts[-1], '')")}), lambda t: regexp_full_match(t, '\d{{5}}(?:-\d{{4}})?'))[1]) END,
  list_filter(list_transform(list_reverse(parts), lambda p: {_anywhere}), lambda x: x IS NOT NULL)[1], '')"""
LANDMARK = rf"""array_to_string(list_transform(list_filter(list_transform(regexp_extract_all(raw, '(?i){fixed.LANDMARK}'), lambda x: trim(x, ' ,;()')), lambda x: length(x) >= 4),
  lambda x: {squeezed("lower(regexp_replace(regexp_replace(x, '(?i)\\bopp\\s*\\.?\\b', 'opposite', 'g'), '(?i)\\bnr\\s*\\.?\\b', 'near', 'g'))")}), ' | ')"""

_name = nested("lower(replace(core, '&', ' and '))", fixed.LEGAL_FORMS)
NAME_NORM = squeezed(f"regexp_replace({_name}, '{fixed.NON_WORD}', ' ', 'g')")
_address = nested("lower(replace(replace(replace(raw, '&', ' and '), '#', ' number '), '/', ' '))", fixed.ADDRESS_PHRASES)
ADDRESS_NORM = f"array_to_string(list_transform({words(squeezed(f"regexp_replace({_address}, '{fixed.NON_WORD}', ' ', 'g')"))}, lambda t: coalesce(({ABBREVIATIONS})[t], t)), ' ')"

#: rec: the normalized records.
RECORDS_SQL = rf"""{ENTITIES_SQL},
r0 AS (SELECT *, trim(business_name) AS n0, trim(regexp_extract(trim(business_name), '(?i){fixed.ALIAS}', 1)) AS alias, strip_accents(trim(business_address)) AS raw FROM ent),
r1 AS (SELECT *, strip_accents(regexp_replace(regexp_replace(CASE WHEN length(alias) >= 3 THEN alias ELSE n0 END, '{fixed.METADATA_ID}', ' ', 'gi'), '{fixed.HONORIFIC}', '', 'i')) AS core, {PLAIN_PARTS} AS parts FROM r0),
r2 AS (SELECT *, {NAME_NORM} AS name_norm, {ADDRESS_NORM} AS address_norm, list_transform(parts, lambda p: {_clean}) AS cp FROM r1),
rec AS (
  SELECT entity_id, source, pos, country, name_norm, address_norm, {CITY} AS city_norm, {PINCODE} AS pincode, {LANDMARK} AS landmark,
         {squeezed(f"regexp_replace(address_norm, '(?i){fixed.LANDMARK}', ' ', 'g')")} AS address_core FROM r2)"""

_name_words = distinctive("name_norm", fixed.NAME_STOPWORDS)
_address_words = distinctive("address_core", fixed.ADDRESS_STOPWORDS)


def _one(name: str, key: str, weight: int, event: int) -> str:
    return f"'{name}' AS pass, {key} AS key, {weight} AS weight, {event} AS event"


def _postings(first: str, rest: str, kept: str) -> str:
    return f"""
ev AS ({first}),
po0 AS ({rest}),
po1 AS (SELECT *, row_number() OVER (PARTITION BY country, pass, key ORDER BY source, pos, event) AS rank, count(*) OVER (PARTITION BY country, pass, key) AS size FROM po0 WHERE key <> ''),
po AS (SELECT * FROM po1 WHERE {kept}),
pairs AS (
  SELECT ev.entity_id AS s1_id, po.entity_id AS cand_id, po.source, sum(ev.weight)::BIGINT AS score, count(*)::BIGINT AS hits, min(ev.event * 1000000000 + po.rank) AS first,
         array_to_string(list_sort(list(DISTINCT ev.pass)), '+') AS block_reason
  FROM ev JOIN po USING (country, pass, key) GROUP BY ALL),
"""


def _top(cap: int, name: str) -> str:
    return f"{name} AS (SELECT s1_id, cand_id, source, score, hits, block_reason FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY score DESC, first, cand_id) AS place FROM pairs) WHERE place <= {cap})"


def _side(side: str, selects: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(f"SELECT entity_id, source, pos, country, {cols} FROM {table} WHERE country <> '' AND source {side} 'S1'" + (f" AND {cond}" if cond else "") for cols, table, cond in selects)


def _listed_table(list_: str) -> str:
    return f"(SELECT *, unnest(range(len({list_}))) AS i, unnest({list_}) AS k FROM rec)"


_name_prefix = _one("prefix", "substr(name_norm, 1, 5)", 1, 0)
_name_token = "'token' AS pass, k AS key, 1 AS weight, 1 + 2 * i AS event"
NAME_BLOCKS_SQL = RECORDS_SQL + "," + _postings(
    _side("=", [(_name_prefix, "rec", "name_norm <> ''"), (_name_token, _listed_table(_name_words), "")]),
    _side("<>", [(_name_prefix, "rec", "length(name_norm) >= 3"), (_name_token, _listed_table(_name_words), "")]),
    f"rank <= {fixed.NAME_BUCKET}",
) + _top(fixed.NAME_CAP, "names")

_w = fixed.ADDRESS_WEIGHTS
_address_sides = [
    (_one("exact", "address_norm", _w["exact"], 0), "rec", "address_norm <> ''"), (_one("pincode", "pincode", _w["pincode"], 1), "rec", "pincode <> ''"), (_one("city", "city_norm", _w["city"], 2), "rec", "length(city_norm) >= 3"),
    (f"'token' AS pass, k AS key, {_w['token']} AS weight, 3 + i AS event", _listed_table(_address_words), ""), (_one("prefix", "substr(address_norm, 1, 6)", _w["prefix"], 1_000_000), "rec", "length(address_norm) >= 6"),
]


def address_blocks_sql(cap: int = fixed.ADDRESS_CAP, bucket: int = fixed.ADDRESS_BUCKET) -> str:
    return RECORDS_SQL + "," + _postings(_side("=", _address_sides), _side("<>", _address_sides), f"size <= {bucket} OR pass = 'exact'") + _top(cap, "addresses")


ADDRESS_BLOCKS_SQL = address_blocks_sql()

#: Both tracks in one: the name track's tables under other names.
_names = NAME_BLOCKS_SQL[len(RECORDS_SQL) + 1 :]
for _old in ("ev", "po0", "po1", "po", "pairs"):
    _names = re.sub(rf"\b{_old}\b(?!\.pos)", f"n_{_old}", _names)
TRACKS_SQL = ADDRESS_BLOCKS_SQL + "," + _names + f", {TRUTH_SQL}"


def lev(a: str, b: str) -> str:
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0.0 ELSE round(1 - levenshtein({a}, {b}) / greatest(length({a}), length({b})), 4) END"


def jac(a: str, b: str) -> str:
    both = f"len(list_distinct(list_concat({a}, {b})))"
    return f"CASE WHEN {both} > 0 THEN round(len(list_intersect({a}, {b})) / {both}, 4) ELSE 0.0 END"


def grams(x: str) -> str:
    return f"CASE WHEN {x} = '' THEN []::VARCHAR[] WHEN length({x}) < 3 THEN [{x}] ELSE list_transform(range(1, length({x}) - 1), lambda i: substr({x}, i, 3)) END"


def cosine(a: str, b: str) -> str:
    """From two lists of grams: a sum over the distinct ones."""
    count = lambda l, g: f"len(list_filter({l}, lambda y: y = {g}))"
    dot = f"list_sum(list_transform(list_distinct({a}), lambda g: {count(a, 'g')} * {count(b, 'g')}))"
    norm = lambda l: f"sqrt(list_sum(list_transform(list_distinct({l}), lambda g: {count(l, 'g')} * {count(l, 'g')})))"
    return f"CASE WHEN len({a}) > 0 AND len({b}) > 0 THEN round({dot} / ({norm(a)} * {norm(b)}), 4) ELSE 0.0 END"


NAME_FEATURES_SQL = f"""WITH {NAME_BLOCKS_SQL},
two AS (
  SELECT s1_id, cand_id, a.name_norm AS a, b.name_norm AS b, {grams('a.name_norm')} AS ga, {grams('b.name_norm')} AS gb, {words('a.name_norm')} AS wa, {words('b.name_norm')} AS wb
  FROM names JOIN rec a ON s1_id = a.entity_id JOIN rec b ON cand_id = b.entity_id)
SELECT s1_id, cand_id, {lev('a', 'b')}::DOUBLE AS levenshtein_sim, ({jac('wa', 'wb')})::DOUBLE AS token_jaccard, ({cosine('ga', 'gb')})::DOUBLE AS char_ngram_cos, CASE WHEN a = b AND a <> '' THEN 1 ELSE 0 END AS exact_match FROM two"""

_num = lambda x: rf"list_distinct(regexp_extract_all({x}, '\b\d+\b'))"
_house = lambda x: rf"regexp_extract({x}, '{fixed.HOUSE_NUMBER}', 1)"
_eq = lambda x, y: f"CASE WHEN {x} <> '' AND {x} = {y} THEN 1 ELSE 0 END"
ADDRESS_FEATURES_SQL = f"""WITH {ADDRESS_BLOCKS_SQL},
two AS (
  SELECT s1_id, cand_id, a.address_norm AS a, b.address_norm AS b, {words('a.address_norm')} AS wa, {words('b.address_norm')} AS wb, {grams('a.address_norm')} AS ga, {grams('b.address_norm')} AS gb,
         a.pincode AS pa, b.pincode AS pb, a.city_norm AS ca, b.city_norm AS cb, upper(a.country) AS ka, upper(b.country) AS kb, a.landmark AS la, b.landmark AS lb
  FROM addresses JOIN rec a ON s1_id = a.entity_id JOIN rec b ON cand_id = b.entity_id),
f AS (SELECT *, CASE WHEN a = '' OR b = '' THEN 0.0 WHEN a = b THEN 1.0 ELSE {cosine('ga', 'gb')} END AS cos FROM two)
SELECT s1_id, cand_id, ({lev('a', 'b')})::DOUBLE AS levenshtein_sim, (CASE WHEN a = '' OR b = '' THEN 0.0 ELSE {jac('wa', 'wb')} END)::DOUBLE AS token_jaccard, cos::DOUBLE AS tfidf_cosine, {_eq('pa', 'pb')} AS exact_pincode_match, {_eq('ca', 'cb')} AS exact_city_match, {_eq('ka', 'kb')} AS exact_country_match,
  {_eq('a', 'b')} AS exact_address_match, cos::DOUBLE AS char_ngram_cos, (CASE WHEN a = '' OR b = '' THEN 0 WHEN a = b THEN len(wa) ELSE len(list_intersect(wa, wb)) END)::INTEGER AS token_overlap_count,
  (CASE WHEN a = '' OR b = '' THEN 0.0 ELSE round(least(length(a), length(b)) / greatest(length(a), length(b)), 4) END)::DOUBLE AS address_len_ratio,
  (CASE WHEN a = '' OR b = '' THEN 0.0 WHEN a = b THEN CASE WHEN len({_num('a')}) > 0 THEN 1.0 ELSE 0.0 END WHEN len({_num('a')}) = 0 OR len({_num('b')}) = 0 THEN 0.0 ELSE {jac(_num('a'), _num('b'))} END)::DOUBLE AS digit_overlap_ratio,
  {_eq(_house('a'), _house('b'))} AS house_number_match, (CASE WHEN la = '' OR lb = '' THEN 0.0 ELSE {jac(words('la'), words('lb'))} END)::DOUBLE AS landmark_sim FROM f"""

_content = lambda x: f"list_distinct({distinctive(x, fixed.NAME_STOPWORDS, 3)})"
#: hits: the rule matcher's pairs before the cap.
HITS_SQL = f"""{RECORDS_SQL},
one AS (SELECT entity_id AS s1_id, country, name_norm AS n, address_norm AS a, {grams('name_norm')} AS g, {_content('name_norm')} AS w, {_content('address_norm')} AS wa FROM rec WHERE source = 'S1'),
oth AS (SELECT entity_id AS cand_id, source, pos, country, name_norm AS n, address_norm AS a, {grams('name_norm')} AS g, {_content('name_norm')} AS w, {_content('address_norm')} AS wa FROM rec WHERE source <> 'S1'),
h1 AS (
  SELECT s1_id, cand_id, o.source, o.pos, x.n <> '' AND o.n <> '' AND (x.n = o.n OR contains(x.n, o.n) OR contains(o.n, x.n) OR len(list_intersect(x.w, o.w)) > 0
         OR (length(x.n) >= 4 AND length(o.n) >= 4 AND x.n[1:4] = o.n[1:4]) OR ({cosine('x.g', 'o.g').replace('round(', '(').replace(', 4) ELSE', ') ELSE')}) >= {fixed.COSINE_LEAST}) AS match
  FROM oth o JOIN one x ON o.country = x.country AND o.a = x.a AND o.a <> ''),
h2 AS (
  SELECT s1_id, cand_id, o.source, o.pos, len(list_intersect(x.wa, o.wa)) >= 2 AS match
  FROM oth o JOIN one x ON o.country = x.country AND o.n = x.n AND length(x.n) >= 3
  WHERE NOT EXISTS (SELECT 1 FROM one y WHERE y.country = o.country AND y.a = o.a AND y.a <> '') AND len(list_intersect(x.wa, o.wa)) > 0),
hits AS (SELECT s1_id, cand_id, min(source || lpad(pos::VARCHAR, 19, '0')) AS arrived, bool_or(match) AS match FROM (SELECT * FROM h1 UNION ALL SELECT * FROM h2) GROUP BY ALL),
ruled AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY arrived, cand_id) AS place FROM hits) WHERE place <= {fixed.RULE_CAP} OR match)"""
RULE_LISTS_SQL = f"""{HITS_SQL},
lists AS (
  SELECT x.s1_id AS source1_entity_id, coalesce(array_to_string(list_sort(list(cand_id) FILTER (WHERE match)), ','), '') AS matched_entity_ids, coalesce(array_to_string(list_sort(list(cand_id) FILTER (WHERE cand_id IS NOT NULL)), ','), '') AS candidate_entity_ids
  FROM one x LEFT JOIN ruled USING (s1_id) GROUP BY x.s1_id)"""


def report_sql(base: str, table: str, per_all: bool, by_country: bool) -> str:
    country, group = ("country, ", " GROUP BY country") if by_country else ("", "")
    return f"""WITH {base}, {TRUTH_SQL},
p AS (SELECT DISTINCT s1_id, cand_id FROM {table}),
fd AS (SELECT t.s1_id, count(*) AS tr, count(p.cand_id) AS ca FROM truth t LEFT JOIN p ON t.s1_id = p.s1_id AND t.cand_id = p.cand_id GROUP BY 1),
e AS (SELECT rec.entity_id, country, coalesce((SELECT count(*) FROM p WHERE p.s1_id = entity_id), 0) AS cands, coalesce(tr, 0) AS tr, coalesce(ca, 0) AS ca FROM rec LEFT JOIN fd ON fd.s1_id = entity_id WHERE source = 'S1'),
g AS (
  SELECT {country}count(*)::BIGINT AS total_s1, sum(cands)::BIGINT AS candidate_pairs, sum(tr)::BIGINT AS true_pairs, sum(ca)::BIGINT AS captured_pairs, CASE WHEN sum(tr) > 0 THEN sum(ca) / sum(tr) ELSE 0.0 END AS recall_ceiling,
    {'sum(cands) / count(*)' if per_all else 'CASE WHEN count(*) FILTER (WHERE cands > 0) > 0 THEN sum(cands) / count(*) FILTER (WHERE cands > 0) ELSE 0.0 END'} AS avg_candidates,
    count(*) FILTER (WHERE tr > 0) AS entities_with_truth, count(*) FILTER (WHERE tr > 0 AND ca = tr) AS full_recall, count(*) FILTER (WHERE tr > 0 AND ca > 0 AND ca < tr) AS partial_recall, count(*) FILTER (WHERE tr > 0 AND ca = 0) AS zero_recall FROM e{group})
SELECT * EXCLUDE (recall_ceiling, avg_candidates), round(recall_ceiling, 6) AS recall_ceiling, round(avg_candidates, 6) AS avg_candidates,
  round(1 - candidate_pairs / (total_s1 * (SELECT count(*) FROM rec WHERE source <> 'S1')), 6) AS reduction_ratio FROM g"""


#: scored: pairs of the name track, their word overlap as the probability.
SCORED_SQL = f"""{NAME_BLOCKS_SQL}, {TRUTH_SQL},
scored AS (
  SELECT n.s1_id, n.cand_id, {jac(words('a.name_norm'), words('b.name_norm'))} AS probability, CASE WHEN t.s1_id IS NULL THEN 0 ELSE 1 END AS label
  FROM names n JOIN rec a ON n.s1_id = a.entity_id JOIN rec b ON n.cand_id = b.entity_id LEFT JOIN truth t ON t.s1_id = n.s1_id AND t.cand_id = n.cand_id),
act AS (SELECT s1_id, count(*) AS actual FROM truth GROUP BY 1)"""


def sweep_sql(thresholds: list[float]) -> str:
    return f"""WITH {SCORED_SQL},
th AS (SELECT unnest({thresholds}::DOUBLE[]) AS threshold),
c AS (SELECT threshold, s1_id, count(*) FILTER (WHERE probability >= threshold) AS pr, count(*) FILTER (WHERE probability >= threshold AND label = 1) AS co FROM scored, th GROUP BY ALL),
d AS (SELECT c.*, coalesce(actual, 0) AS ac FROM c LEFT JOIN act USING (s1_id)),
v AS (SELECT *, CASE WHEN pr > 0 THEN co / pr WHEN ac = 0 THEN 1.0 ELSE 0.0 END AS p, CASE WHEN ac > 0 THEN co / ac ELSE 1.0 END AS r FROM d),
f AS (SELECT *, CASE WHEN ac = 0 THEN CASE WHEN pr = 0 THEN 1.0 ELSE 0.0 END WHEN 0.25 * p + r = 0 THEN 0.0 ELSE 1.25 * p * r / (0.25 * p + r) END AS f FROM v)
SELECT threshold, round(avg(f), 6) AS f05, round(avg(p), 6) AS precision, round(avg(r), 6) AS recall, sum(pr)::BIGINT AS n_predicted, sum(ac)::BIGINT AS n_actual, sum(co)::BIGINT AS n_correct FROM f GROUP BY 1"""


#: planted: s and m, the matches' lists with faults in them.
PLANTED_SQL = f"""{RULE_LISTS_SQL},
marked AS (SELECT source1_entity_id AS s, matched_entity_ids AS ids, pos % 50 AS k FROM lists JOIN ent ON entity_id = source1_entity_id WHERE pos % 50 <> 2),
faulty AS (SELECT s, k, CASE WHEN ids = '' THEN ids WHEN k = 4 THEN ids || ',' || ids WHEN k = 3 THEN ids || ',S1-1' WHEN k = 5 THEN ids || ',Q7' WHEN k = 0 THEN ids || ',S2-none' ELSE ids END AS m FROM marked),
planted AS (SELECT s, m FROM faulty UNION ALL SELECT s, m FROM faulty WHERE k = 1)"""


def masks(a: str) -> str:
    """The places of each letter of a text, as bits (names are shorter than 120 letters)."""
    letters = f"list_distinct(string_split({a}, ''))"
    return f"CASE WHEN {a} = '' THEN MAP {{}} ELSE map_from_entries(list_transform({letters}, lambda ch: {{'k': ch, 'v': list_sum(list_transform(range(length({a})), lambda i: CASE WHEN substr({a}, i + 1, 1) = ch THEN (1::UHUGEINT << i::UHUGEINT) ELSE 0::UHUGEINT END))::UHUGEINT}})) END"


def indel(a: str, b: str, at: str) -> str:
    """2 * LCS / (both lengths), the subsequence bit-parallel over a with the masks `at`."""
    full = f"((1::UHUGEINT << length({a})::UHUGEINT) - 1)"
    steps = f"list_reduce(list_prepend({full}, list_transform(string_split({b}, ''), lambda ch: coalesce(({at})[ch], 0::UHUGEINT))), lambda s, m: ((s + (s & m)) | (s - (s & m))) & {full})"
    zeros = f"list_sum(list_transform(range(length({a})), lambda i: 1 - (({{s}} >> i::UHUGEINT) & 1::UHUGEINT)::INTEGER))"
    return f"list_transform([{steps}], lambda z: 2 * {zeros.format(s='z')} / (length({a}) + length({b})))[1]"


_joined = lambda x: f"array_to_string(list_sort({x}), ' ')"
#: ratios: token_sort_ratio and token_set_ratio of the name track's pairs.
RATIOS_SQL = f"""{NAME_BLOCKS_SQL},
sorted AS (SELECT entity_id, name_norm, {_joined(words('name_norm'))} AS srt, list_distinct({words('name_norm')}) AS ws FROM rec),
q0 AS (
  SELECT s1_id, cand_id, a.name_norm = '' OR b.name_norm = '' AS empty, a.srt AS sa, b.srt AS sb, {_joined('list_filter(a.ws, lambda x: list_contains(b.ws, x))')} AS c,
         {_joined('list_filter(a.ws, lambda x: NOT list_contains(b.ws, x))')} AS da, {_joined('list_filter(b.ws, lambda x: NOT list_contains(a.ws, x))')} AS db
  FROM names JOIN sorted a ON s1_id = a.entity_id JOIN sorted b ON cand_id = b.entity_id),
q1 AS (SELECT *, trim(c || ' ' || da) AS fa, trim(c || ' ' || db) AS fb FROM q0),
-- what a common part shares with its own extension is all of it
q2 AS (SELECT *, {masks('sa')} AS ms, {masks('fa')} AS mf, 2 * length(c) / (length(c) + length(fa)) AS ca, 2 * length(c) / (length(c) + length(fb)) AS cb FROM q1),
ratios AS (
  SELECT s1_id, cand_id, CASE WHEN empty THEN 0.0 ELSE round({indel('sa', 'sb', 'ms')}, 4) END::DOUBLE AS token_sort_ratio,
         CASE WHEN empty THEN 0.0 WHEN c <> '' AND (da = '' OR db = '') THEN 1.0 WHEN c <> '' THEN round(greatest({indel('fa', 'fb', 'mf')}, ca, cb), 4) ELSE round({indel('fa', 'fb', 'mf')}, 4) END::DOUBLE AS token_set_ratio
  FROM q2)"""

_name = NAME_FEATURES_SQL.removeprefix(f"WITH {NAME_BLOCKS_SQL},")
_address = ADDRESS_FEATURES_SQL.removeprefix(f"WITH {ADDRESS_BLOCKS_SQL},")
#: The matrix: name and address features by pair, zeros where a track hasn't seen the pair.
MATRIX_SQL = f"""WITH {RATIOS_SQL}, {TRUTH_SQL},
nf AS (WITH {_name.strip()}),
af AS ({ADDRESS_FEATURES_SQL})
SELECT coalesce(nf.s1_id, af.s1_id) AS s1_id, coalesce(nf.cand_id, af.cand_id) AS cand_id,
  {', '.join(f"coalesce({'r' if c.startswith('token_s') else 'nf'}.{c}, 0)::DOUBLE AS {c}" for c in fixed.NAME_FEATURES)},
  {', '.join(f"coalesce(af.{c}, 0)::DOUBLE AS addr_{c}" for c in fixed.ADDRESS_FEATURES)},
  CASE WHEN nf.s1_id IS NULL THEN 0 ELSE 1 END AS from_name, CASE WHEN af.s1_id IS NULL THEN 0 ELSE 1 END AS from_address,
  CASE WHEN t.s1_id IS NULL THEN 0 ELSE 1 END AS label
FROM nf FULL JOIN af ON nf.s1_id = af.s1_id AND nf.cand_id = af.cand_id
LEFT JOIN ratios r ON r.s1_id = nf.s1_id AND r.cand_id = nf.cand_id
LEFT JOIN truth t ON t.s1_id = coalesce(nf.s1_id, af.s1_id) AND t.cand_id = coalesce(nf.cand_id, af.cand_id)"""
