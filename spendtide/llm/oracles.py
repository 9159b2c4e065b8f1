"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TEXT = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"

OP7 = f"""
WITH d AS (SELECT doc_id, sha256({_TEXT}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""

# The labels' templates, each counted against every four lines.
_TEMPLATES = [
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this"
     " software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("you may not use this file except in compliance with the license", "apache-2"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("this program is free software you can redistribute it and or modify it under the"
     " terms of the gnu general public license", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are"
     " permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0",
     "mpl-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under a creative commons attribution sharealike 4 0 international license",
     "cc-by-sa"),
]
_VALUES = ", ".join(
    f"({k}, '{label}', list_distinct(string_split('{text}', ' ')))"
    for k, (text, label) in enumerate(_TEMPLATES)
)
_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _at(*words: str) -> str:
    same = " AND ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(words))
    return f"list_filter(range(len(w)), lambda i: {same})"


OP9 = f"""
WITH t(k, label, words) AS (VALUES {_VALUES}),
d AS (SELECT row_number() OVER () AS r, doc_id, {_TEXT} AS text FROM documents),
w AS (SELECT r, doc_id,
             list_filter(string_split_regex(text, '{_NO_WORD}'), lambda x: x <> '') AS w FROM d),
p AS (SELECT r, doc_id, len(w) AS n_words, {_at('under', 'the', 'mit', 'license')} AS a,
             {_at('apache', 'license', 'version', '2')} AS b, {_at('cc', 'by', 'nc')} AS c FROM w),
lists AS (SELECT r, list_filter(string_split(text, chr(10)),
                               lambda x: regexp_replace(x, '{_NO_WORD}', '', 'g') <> '') AS l FROM d),
lines AS (SELECT r, unnest(list_transform(range(1, len(l) + 1),
                               lambda i: array_to_string(l[i:i + 3], ' '))) AS line FROM lists),
sets AS (SELECT r, list_distinct(string_split_regex(line, '{_NO_WORD}')) AS words FROM lines),
met AS (SELECT r, label, len(list_intersect(s.words, t.words)) / len(t.words) AS share
        FROM sets s, t WHERE len(list_intersect(s.words, t.words)) >= 0.8 * len(t.words)),
m AS (SELECT r, list(DISTINCT label) AS more, max(share) AS share FROM met GROUP BY r),
l AS (SELECT *, list_concat(a, b, c) AS places,
             list_concat(CASE WHEN len(a) > 0 THEN ['mit'] ELSE [] END,
                         CASE WHEN len(b) > 0 THEN ['apache-2'] ELSE [] END,
                         CASE WHEN len(c) > 0 THEN ['cc-by-nc'] ELSE [] END) AS own
      FROM p LEFT JOIN m USING (r))
SELECT doc_id, n_words, len(places) AS n_base, list_min(places) AS first_word,
       list_max(places) AS last_word,
       coalesce(array_to_string(list_sort(own), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(own, coalesce(more, [])))), ','), '')
         AS labels,
       CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM l
"""


def _second(text: str) -> str:
    number = f"('0x' || substr(md5({text}), 1, 8))::BIGINT"
    return f"make_timestamp((1704067200 + {number} % 31536000) * 1000000)"


_HOST = r"regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)"
_RULES = (
    "list_transform(range(1, len(string_split(host, '.')) + 1),"
    " lambda k: array_to_string(list_slice(string_split(host, '.'), k, 1000000), '.'))"
)

OP10 = f"""
WITH p AS (SELECT page_id, url, nullif(trim(lower({_HOST}), '.'), '') AS host,
                  {_second('url')} AS fetched_at FROM pages),
k AS (SELECT *, unnest({_RULES}) AS rule FROM p),
e AS (SELECT rule, rule || '#' || n AS seed
      FROM (SELECT DISTINCT rule FROM k), (VALUES (0), (1), (2)) v(n)),
d AS (SELECT rule, {_second('seed')} AS since,
             ('0x' || substr(md5(seed), 9, 1))::INT AS digit FROM e),
a AS (SELECT rule, since, max(CASE WHEN digit < 5 THEN 'block' WHEN digit < 9 THEN 'allow' END)
             AS action FROM d GROUP BY ALL),
i AS (SELECT *, lead(since) OVER (PARTITION BY rule ORDER BY since) AS until FROM a),
f AS (SELECT page_id, arg_max(i, length(i.rule)) AS best
      FROM k JOIN i ON k.rule = i.rule AND since <= fetched_at
           AND (until IS NULL OR fetched_at < until) AND action IS NOT NULL
      GROUP BY page_id)
SELECT page_id, url, host, strftime(fetched_at, '%Y-%m-%d %H:%M:%S') AS fetched_at,
       best.rule AS rule, best.action AS action,
       strftime(best.since, '%Y-%m-%d %H:%M:%S') AS since
FROM p LEFT JOIN f USING (page_id)
"""


_ORDERS = """
l(c) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT a.c || b.c || d.c || e.c || f.c AS filter_order FROM l a, l b, l d, l e, l f
      WHERE len(list_distinct([a.c, b.c, d.c, e.c, f.c])) = 5)
"""

OP11 = f"""
WITH {_ORDERS},
d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, part, t, min(doc_id) OVER (PARTITION BY t) AS least,
             list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM d),
m AS (SELECT doc_id, part, list_filter([
        CASE WHEN len(w) < 200 THEN 'A' END,
        CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' END,
        CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' END,
        CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
        CASE WHEN doc_id > least THEN 'E' END], lambda x: x IS NOT NULL) AS fails FROM w),
g AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
k AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
      FROM m LEFT JOIN g USING (doc_id) GROUP BY part, fails),
s AS (SELECT k.*, filter_order, step, substr(filter_order, step, 1) AS own,
             list_has_any(string_split(substr(filter_order, 1, step - 1), ''), fails) AS before
      FROM k, o, (VALUES (1), (2), (3), (4), (5)) v(step)),
r AS (SELECT part, filter_order, step, any_value(own) AS own,
             sum(CASE WHEN NOT before AND NOT list_contains(fails, own) THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN NOT before AND list_contains(fails, own) THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN before AND list_contains(fails, own) THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN fails = [own] THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN NOT before AND list_contains(fails, own) THEN good ELSE 0 END) AS good_lost,
             sum(CASE WHEN NOT before AND list_contains(fails, own) THEN toxic ELSE 0 END) AS toxic_lost
      FROM s GROUP BY part, filter_order, step)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM r
"""

_FIVE = "('0x' || substr(s, 5 * k + 1, 5))::BIGINT"
_SIGN = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> {}) & 31) + 1, 1)"

OP12 = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
h AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS s FROM p),
b AS (SELECT page_id, payload_bytes, min(page_id) OVER (PARTITION BY s) AS first,
             array_to_string(list_transform(list_transform(range(8), lambda k: {_FIVE}),
               lambda v: {' || '.join(_SIGN.format(k) for k in (15, 10, 5, 0))}), '') AS payload_digest
      FROM h)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM b
"""

_BYTE = "('0x' || substr(h, 2 * k + 1, 2))::BIGINT"
_GRAMS = """
SELECT {id}, unnest(list_concat(w, list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]))) AS f
"""

#: CRC-32 of each different feature, byte by byte by the table that the polynomial makes.
OP13 = f"""
WITH table_of AS (SELECT list(list_reduce(list_prepend(b, range(8)),
                    lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
                    ORDER BY b) AS crcs FROM range(256) r(b)),
d AS (SELECT doc_id, list_filter(string_split_regex({_TEXT}, '{_NO_WORD}'), lambda x: x <> '') AS w
      FROM documents),
e AS (SELECT list_filter(string_split_regex({_TEXT}, '{_NO_WORD}'), lambda x: x <> '') AS w FROM benchmark),
df AS ({_GRAMS.format(id='doc_id')} FROM d),
ef AS ({_GRAMS.format(id='0 AS none')} FROM e),
x AS (SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM df UNION SELECT f FROM ef)),
c AS (SELECT f, xor(list_reduce(
          list_prepend(4294967295, list_transform(range(length(h) // 2), lambda k: {_BYTE})),
          lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
      FROM x, table_of),
s AS (SELECT bucket, count(*) AS s FROM df JOIN c USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM ef JOIN c USING (f) GROUP BY bucket),
a AS (SELECT (SELECT count(*) FROM df)::DOUBLE AS all_s, (SELECT count(*) FROM ef)::DOUBLE AS all_t),
g AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (all_s + 10000)
                           / ((s + 1)::DOUBLE * (all_t + 10000))))::BIGINT AS gain
      FROM s LEFT JOIN t USING (bucket), a),
m AS (SELECT doc_id, count(*) AS n, sum(gain)::BIGINT AS total FROM df JOIN c USING (f) JOIN g USING (bucket)
      GROUP BY doc_id),
n AS (SELECT doc_id, len(w) AS words, coalesce(n, 0)::BIGINT AS n_features,
             coalesce((total - ((total % n) + n) % n) // n, 0)::BIGINT AS weight,
             ('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT AS h
      FROM d LEFT JOIN m USING (doc_id)),
z AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM n),
q AS (SELECT *, row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id) AS place,
             count(*) FILTER (words >= 20) OVER () AS many FROM z)
SELECT doc_id, n_features, weight, score,
       CASE WHEN words >= 20 AND place <= 25 * many // 100 THEN place END AS rank
FROM q
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op7_exact_dedup": OP7, "op9_license_scan": OP9, "op10_url_filter": OP10,
        "op11_filter_audit": OP11, "op12_warc": OP12, "op13_importance": OP13,
    }
