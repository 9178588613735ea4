"""SQL that computes the results of some registered queries by other means, for tables of a size that plain joins can bear."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWERED = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
_WORDS = r"'[^\x20\x09-\x0D]+'"
_TERMS = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"


def linked(size: int, similar: int, last: str) -> str:
    """Components of texts whose sets of ``size``-word shingles are similar: every pair that shares a shingle is counted."""
    return rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWERED}, {_WORDS}) AS words FROM documents),
s AS (SELECT doc_id, CASE WHEN len(words) >= {size} THEN list_distinct(list_transform(range(1, len(words) - {size - 2}), lambda i: array_to_string(words[i:i + {size - 1}], ' ')))
  WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE []::VARCHAR[] END AS own FROM w),
e AS (SELECT doc_id, len(own) AS n, unnest(own) AS shingle FROM s),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {similar} * (a.n + b.n - count(*))),
reach AS (SELECT doc_id, doc_id AS other FROM s UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other),
c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(len(own) AS BIGINT) AS n_shingles, component_id{last} FROM s JOIN c USING (doc_id)"""


REPEATED_WORDS = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS words FROM documents),
k AS (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS k FROM w WHERE len(words) >= 13),
v AS (SELECT doc_id, k, array_to_string(words[k:k + 12], ' ') AS own FROM k),
low AS (SELECT own, min(doc_id) AS low FROM v GROUP BY own),
gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + 13)) AS p FROM v JOIN low USING (own) WHERE low < doc_id),
each AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""

REPEATED_BYTES = r"""
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
k AS (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 199)) AS k FROM t WHERE len(h) >= 400),
v AS (SELECT doc_id, k, hash(substr(h, 2 * k + 1, 400)) AS own FROM k),
many AS (SELECT own FROM v GROUP BY own HAVING count(*) > 1),
hit AS (SELECT doc_id, k, lag(k) OVER (PARTITION BY doc_id ORDER BY k) AS before FROM v SEMI JOIN many USING (own)),
part AS (SELECT doc_id, k, sum(CASE WHEN before IS NULL OR k - before > 200 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY k) AS span FROM hit),
span AS (SELECT doc_id, span, min(k) AS a, max(k) + 200 AS b FROM part GROUP BY doc_id, span),
left_over AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS since FROM span),
kept AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last, string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS head
  FROM left_over JOIN t USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256 FROM t LEFT JOIN kept USING (doc_id)"""

#: Words that one deletion makes alike differ by one replacement at that place, or one is the other without a letter.
VARIANTS = rf"""
WITH RECURSIVE crc AS (SELECT list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS entry
  FROM range(256) t(i)),
r AS (SELECT doc_id, unnest(regexp_extract_all({_LOWERED}, '[a-zÀ-ÿ]{{7,}}')) AS run FROM documents),
d AS (SELECT run, coalesce(doc_id::VARCHAR, 'null') || ':' || run AS name, count(*) AS n FROM r GROUP BY 1, 2),
b AS (SELECT run, n, list_transform(range(1, strlen(name) + 1), lambda i: ('0x' || substr(hex(encode(name)), 2 * i - 1, 2))::BIGINT) AS bytes FROM d),
h AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, x: xor(entry[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) AS h FROM b, crc),
c AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM c WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
shorter AS (SELECT DISTINCT cut.word AS long, cut.n AS long_n, words.word AS short, words.n AS short_n FROM cut JOIN words ON cut.rest = words.word),
near AS (SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION ALL SELECT long, short, short_n FROM shorter UNION ALL SELECT short, long, long_n FROM shorter),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM near GROUP BY word),
f AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * n THEN other END AS form, CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
way AS (SELECT word, word AS root, 0 AS step FROM f UNION ALL SELECT way.word, f.form, step + 1 FROM way JOIN f ON f.word = way.root WHERE f.form IS NOT NULL),
last AS (SELECT word, arg_max(root, step) AS root FROM way GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM f JOIN last USING (word)"""

RANKING = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWERED}, {_TERMS}) AS terms FROM documents),
g AS (SELECT count(*) FILTER (len(terms) > 0) AS total, CAST(sum(len(terms)) AS BIGINT) AS length FROM d),
tf AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * total + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w FROM df, g),
q AS (SELECT i, item_id, term, count(*) AS times FROM (SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all({_LOWERED}, {_TERMS})) AS term FROM benchmark) GROUP BY ALL),
added AS (SELECT i, item_id, r, doc_id, times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * total) // length))) AS score
  FROM q JOIN tf USING (term) JOIN weight USING (term), g),
score AS (SELECT i, item_id, r, doc_id, CAST(sum(score) AS BIGINT) AS score FROM added GROUP BY ALL HAVING sum(score) > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM score) WHERE rank <= 20"""

SQL = {
    "op4_repeated_strings": REPEATED_BYTES,
    "op8_repeated_passages": REPEATED_WORDS,
    "op10_near_duplicates": linked(5, 75, ", doc_id = component_id AS kept"),
    "op11_spelling_variants": VARIANTS,
    "op12_grouped_join": linked(4, 85, ""),
    "op13_ranked_search": RANKING,
}
