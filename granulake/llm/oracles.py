"""DuckDB SQL for the queries it can express.

Without SQL, and tested by brute force instead: learned scores (1, 3, 7, 9), merges
(4, 12, 13), and strings that start at any byte (6).
"""

from __future__ import annotations

import string

from granulake.llm.licenses import RULES, SENTENCES

DECONTAMINATION = r"""
WITH words AS (
  SELECT doc_id AS id, 0 AS item, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents
  UNION ALL SELECT item_id, 1, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') FROM benchmark),
places AS (SELECT id, item, w, unnest(range(1, len(w) - 3)) AS i FROM words WHERE len(w) >= 5),
shingles AS (SELECT DISTINCT id, item, array_to_string(w[i:i + 4], ' ') AS s FROM places),
sizes AS (SELECT id, count(*) AS n FROM shingles WHERE item = 1 GROUP BY id),
common AS (
  SELECT d.id AS doc_id, b.id AS item_id, count(*) AS n_common
  FROM shingles d JOIN shingles b ON d.s = b.s AND d.item = 0 AND b.item = 1 GROUP BY ALL)
SELECT doc_id, item_id, n AS n_item, n_common, n_common / n AS containment
FROM common JOIN sizes ON sizes.id = item_id WHERE 10 * n_common >= 8 * n
"""

SUBSTRINGS = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)),
least AS (SELECT k, min(doc_id) AS d FROM win GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, j FROM (
    SELECT win.doc_id, unnest(range(i, i + 50)) AS j FROM win JOIN least USING (k) WHERE d < win.doc_id)),
word AS (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS j FROM w),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY j) AS t FROM word ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)
"""

JACCARD = (
    r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '%s', '%s'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
link AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT reach.a, link.v FROM reach JOIN link ON link.u = reach.b)
SELECT doc_id, len(g) AS n_shingles, least(doc_id, c) AS component_id
FROM s JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) ON a = doc_id
"""
    % (string.ascii_uppercase, string.ascii_lowercase)
)


def license_scan() -> str:
    """One step per rule: its identifiers leave the rest of the sequence, its name is noted."""
    known = ", ".join(f"('{sentence}', '{name}')" for name, sentence in SENTENCES.items())
    steps = []
    for i, (name, ids) in enumerate(RULES):
        sought = "".join(f"|{x}|" for x in ids)
        steps.append(
            f"r{i + 1} AS (SELECT doc_id, ids, CASE WHEN contains(rest, '{sought}') THEN replace(rest, '{sought}', '|') ELSE rest END AS rest, "
            f"CASE WHEN contains(rest, '{sought}') AND NOT list_contains(names, '{name}') THEN list_append(names, '{name}') ELSE names END AS names FROM r{i})"
        )
    return rf"""
WITH known(sentence, name) AS (VALUES {known}),
plain AS (
  SELECT doc_id, string_split(regexp_replace(regexp_replace(lower(coalesce(text, '')), '[.!?:]+([ \t\n\x0b\f\r]+|$)', chr(10), 'g'),
    '[^a-z0-9.\n]+', ' ', 'g'), chr(10)) AS parts FROM documents),
each AS (SELECT doc_id, trim(unnest(parts)) AS sentence, unnest(range(len(parts))) AS i FROM plain),
named AS (
  SELECT doc_id, i, coalesce(name, CASE WHEN regexp_matches(sentence, '[a-z]{{3}}') AND NOT regexp_matches(sentence, '^(portions )?(copyright|c) ') THEN '~' END) AS name
  FROM each LEFT JOIN known USING (sentence)),
found AS (SELECT doc_id, list(name ORDER BY i) AS ids FROM named WHERE name IS NOT NULL GROUP BY doc_id),
r0 AS (
  SELECT doc_id, list_filter(coalesce(ids, []::VARCHAR[]), lambda x: x <> '~') AS ids,
    array_to_string(list_transform(coalesce(ids, []::VARCHAR[]), lambda x: '|' || x || '|'), '') AS rest, []::VARCHAR[] AS names
  FROM documents LEFT JOIN found USING (doc_id)),
{", ".join(steps)}
SELECT doc_id, array_to_string(ids, ' ') AS sentence_ids, array_to_string(names, ' ') AS licenses,
  CASE WHEN len(ids) = 0 THEN 'NONE' WHEN translate(rest, '|~', '') <> '' OR len(names) = 0 THEN 'UNKNOWN' ELSE array_to_string(names, ' AND ') END AS verdict
FROM r{len(RULES)}
"""


_TERMS = r"regexp_extract_all(translate(text, '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')".format(
    upper=string.ascii_uppercase, lower=string.ascii_lowercase
)
SEARCH = f"""
WITH sized AS (SELECT doc_id, {_TERMS} AS found FROM documents WHERE len({_TERMS}) > 0),
totals AS (SELECT count(*) AS docs, CAST(sum(len(found)) AS BIGINT) AS length FROM sized),
held AS (SELECT doc_id, CAST(len(found) AS BIGINT) AS n, unnest(found) AS term FROM sized),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM held GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, totals GROUP BY term, docs),
asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
scores AS (
  SELECT item_id, doc_id,
    CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // length)))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN weights USING (term), totals GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 20
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_decontamination": DECONTAMINATION,
        "op5_substring_dedup": SUBSTRINGS,
        "op8_license_scan": license_scan(),
        "op10_jaccard_join": JACCARD,
        "op11_lexical_search": SEARCH,
    }
