"""DuckDB comparison SQL for the queries that SQL can express."""

from __future__ import annotations

import string

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_LOWERED = f"translate({{}}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

# Words stand between two blanks each, so that neighbouring places share none.
_TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "bsd-text": (
        "redistribution and use in source and binary forms with or without modification are permitted provided "
        "that the following conditions are met"
    ),
    "cc-by-nc-4.0": "licensed under( a( creative commons)? license)? cc by nc 4 0",
    "copyright-notice": "copyright( c)?( [^ ]+){0,8} all rights reserved",
    "gpl-3.0": "licensed under the( terms of the)? gnu general public license version 3",
    "mit": "released under the( terms of the)? mit license",
    "mit-text": (
        "permission is hereby granted free of charge to any person obtaining a copy of( [^ ]+){0,12} to deal in the "
        "software without restriction"
    ),
}
_PHRASES = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}


def _spaced(pattern: str) -> str:
    return " " + pattern.replace(" ", "  ").replace("[^  ]", "[^ ]") + " "


_COUNT = "len(regexp_extract_all({}, '[^ ]+'))"
_PARTS = {f"p{i}": _spaced(phrase) for i, phrase in enumerate(_PHRASES.values())}
_SIZE = {f"p{i}": len(phrase.split()) for i, phrase in enumerate(_PHRASES.values())}
_FIRST = ", ".join(f"CASE WHEN len({p}) > 1 THEN {_COUNT.format(p + '[1]')} END" for p in _PARTS)
_LAST = ", ".join(f"CASE WHEN len({p}) > 1 THEN n - {_SIZE[p]} - {_COUNT.format(p + '[-1]')} END" for p in _PARTS)
_TEST = {label: f"len(p{i}) > 1" for i, label in enumerate(_PHRASES)}
_TEST |= {label: f"regexp_matches(line, '{_spaced(pattern)}')" for label, pattern in _TEMPLATES.items()}


def _labels(names: list[str]) -> str:
    cases = ", ".join(f"CASE WHEN {_TEST[name]} THEN '{name}' END" for name in sorted(names))
    return f"concat_ws(',', {cases})"


OP4 = f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all({_LOWERED.format("coalesce(text, '')")},
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
lines AS (SELECT doc_id, len(w) AS n, ' ' || array_to_string(w, '  ') || ' ' AS line FROM words),
found AS (SELECT *, {", ".join(f"string_split(line, '{phrase}') AS {p}" for p, phrase in _PARTS.items())} FROM lines)
SELECT doc_id, n::BIGINT AS n_words, ({" + ".join(f"len({p}) - 1" for p in _PARTS)})::BIGINT AS n_base,
  least({_FIRST})::BIGINT AS first_word, greatest({_LAST})::BIGINT AS last_word,
  {_labels([*_PHRASES])} AS base_labels, {_labels([*_PHRASES, *_TEMPLATES])} AS labels,
  CASE WHEN {" OR ".join(_TEST[t] for t in _TEMPLATES)} THEN 1.0
    WHEN {" OR ".join(_TEST[t] for t in _PHRASES)} THEN 0.5 ELSE 0.0 END::DOUBLE AS score
FROM found
"""

_BASE32 = " || ".join(
    f"substr('{ALPHABET}', (((('0x' || substr(h, {5 * (k // 4) + 1}, 5))::INTEGER >> {15 - 5 * (k % 4)}) & 31) + 1), 1)"
    for k in range(32)
)

OP7 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS h, min(page_id) OVER (PARTITION BY body) AS lowest FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = lowest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> lowest THEN lowest END AS refers_to, NULL::VARCHAR AS problem
FROM d
"""


def _strength(table: str) -> str:
    """Prior strength of a level, within 1 and 1000."""
    noise = "prior * (1 - prior)"
    return f"""
  SELECT CASE WHEN coalesce(room, 0) = 0 OR excess <= 0 THEN 1000.0
    ELSE least(greatest(room / excess - 1, 1.0), 1000.0) END AS k
  FROM (SELECT sum(n * (good / n - prior) * (good / n - prior) - {noise}) AS excess, sum({noise} * (n - 1)) AS room
    FROM {table} WHERE n > 0)"""


OP8 = f"""
WITH p AS (
  SELECT page_id, {_LOWERED.format("regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1)")} AS host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
o AS (
  SELECT doc_id AS page_id, min(CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END) AS ok FROM labels
  WHERE doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL GROUP BY doc_id),
hosts AS (
  SELECT host, regexp_extract(host, '[^.]*\\.?[^.]*$', 0) AS domain, regexp_extract(host, '[^.]*$', 0) AS suffix,
    coalesce(sum(ok), 0)::DOUBLE AS good, count(ok)::DOUBLE AS n
  FROM p LEFT JOIN o USING (page_id) GROUP BY host),
domains AS (SELECT suffix, domain, sum(good) AS good, sum(n) AS n FROM hosts GROUP BY suffix, domain),
suffixes AS (SELECT suffix, sum(good) AS good, sum(n) AS n FROM domains GROUP BY suffix),
s AS (SELECT *, (SELECT CASE WHEN sum(n) > 0 THEN sum(good) / sum(n) ELSE 1.0 END FROM suffixes) AS prior FROM suffixes),
sk AS ({_strength("s")}),
d AS (
  SELECT domains.*, (s.good + (SELECT k FROM sk) * s.prior) / (s.n + (SELECT k FROM sk)) AS prior
  FROM domains JOIN s USING (suffix)),
dk AS ({_strength("d")}),
h AS (
  SELECT hosts.host, hosts.good, hosts.n,
    (d.good + (SELECT k FROM dk) * d.prior) / (d.n + (SELECT k FROM dk)) AS prior
  FROM hosts JOIN d USING (domain)),
hk AS ({_strength("h")}),
m AS (SELECT host, (good + k * prior) / (n + k) AS mean, n + k AS total FROM h, hk),
judged AS (
  SELECT page_id, p.host, path, mean + 1.645 * sqrt(mean * (1 - mean) / (total + 1)) AS upper_bound, CASE
    WHEN (p.host = 'example.net' OR p.host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (p.host = 'example.com' OR p.host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (p.host = 'org' OR p.host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (p.host = 'net' OR p.host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM p LEFT JOIN m USING (host))
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN upper_bound < 0.5 THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""

OP9 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, replace(replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<', '%3C'), '[', '%5B') AS code,
    CASE WHEN regexp_matches(text, '<(/s|\\+/?s)>|\[(/INST|\\+/?INST)\]')
      THEN regexp_replace(regexp_replace(text, '<(\\*)(/?s>)', '<\\\1\2', 'g'), '\[(\\*)(/?INST\])', '[\\\1\2', 'g')
      ELSE text END AS body FROM t),
r AS (
  SELECT *, CASE WHEN role = 'assistant' THEN '<s>' || code || chr(10) || body || '</s>'
    ELSE '[INST]' || code || chr(10) || body || '[/INST]' END AS rendered FROM e),
c AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS lines,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
    sum(length(rendered)) AS size
  FROM r GROUP BY conv_id)
SELECT conv_id, n_turns::BIGINT AS n_turns, sha256(lines) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
  sha256(loss) AS loss_sha256, size::BIGINT AS formatted_chars, true AS identical
FROM c
"""

OP11 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
t AS (SELECT doc_id, w, array_to_string(w, ' ') AS line FROM d),
c AS (SELECT line, any_value(w) AS w, min(doc_id) AS node FROM t WHERE len(w) > 0 GROUP BY line),
g AS (
  SELECT DISTINCT node, array_to_string(w[i:i + 4], ' ') AS shingle
  FROM (SELECT node, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM c)),
z AS (SELECT node, count(*) AS n FROM g GROUP BY node),
p AS (
  SELECT x.node AS a, y.node AS b, count(*) AS shared
  FROM g AS x JOIN g AS y ON x.shingle = y.shingle AND x.node < y.node GROUP BY x.node, y.node),
l AS (
  SELECT a, b FROM p JOIN z AS x ON p.a = x.node JOIN z AS y ON p.b = y.node
  WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(node, reached) AS (
  SELECT node, node FROM c
  UNION SELECT r.node, e.b FROM r JOIN e ON r.reached = e.a),
m AS (SELECT node, min(reached) AS component FROM r GROUP BY node)
SELECT t.doc_id, coalesce(z.n, 0)::BIGINT AS n_shingles, coalesce(m.component, t.doc_id) AS component_id,
  t.doc_id = coalesce(m.component, t.doc_id) AS kept
FROM t LEFT JOIN c ON t.line = c.line LEFT JOIN z ON c.node = z.node LEFT JOIN m ON c.node = m.node
"""

OP12 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id) AS x,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u
  FROM documents),
h AS (
  SELECT *, len(u) AS n, ('0x' || x[1:8])::UBIGINT % (len(u) + 1) AS h1, ('0x' || x[9:16])::UBIGINT % (len(u) + 1) AS h2,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
      OR ('0x' || x[17:24])::UBIGINT % 100 >= 90 THEN 'plain'
      WHEN ('0x' || x[25:32])::UBIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
p AS (
  SELECT *, coalesce(array_to_string(u[1:least(h1, h2)], ''), '') AS head,
    coalesce(array_to_string(u[least(h1, h2) + 1:greatest(h1, h2)], ''), '') AS mid,
    coalesce(array_to_string(u[greatest(h1, h2) + 1:n], ''), '') AS tail
  FROM h)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(head)::BIGINT END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(mid)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || head || '<S>' || tail || '<M>' || mid
    ELSE '<S>' || tail || '<P>' || head || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""

ORACLE = {
    "op4_licenses": OP4,
    "op7_warc": OP7,
    "op8_url_filters": OP8,
    "op9_chat": OP9,
    "op11_minhash": OP11,
    "op12_infilling": OP12,
}
