"""DuckDB SQL of the queries that SQL can express (the others are compared with
brute force in tests/llm)."""

from __future__ import annotations

from tidemark.llm import search, secrets
from tidemark.llm.common import WORD_RE
from tidemark.llm.substring_dedup import WINDOW


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


SUBSTRING_DEDUP = f"""WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_q(WORD_RE)}) AS ws FROM documents),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM texts),
windows AS (
  SELECT doc_id, i, array_to_string(list_slice(ws, i, i + {WINDOW - 1}), ' ') AS run
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM texts)),
least AS (SELECT run, min(doc_id) AS first_doc FROM windows GROUP BY run),
gone AS (
  SELECT DISTINCT doc_id, i + unnest(range({WINDOW})) AS i
  FROM windows JOIN least USING (run) WHERE doc_id > first_doc),
kept AS (
  SELECT w.doc_id, count(*) AS n, count(g.i) AS lost,
    string_agg(w.word, ' ' ORDER BY w.i) FILTER (WHERE g.i IS NULL) AS text
  FROM words w LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.i = w.i GROUP BY w.doc_id)
SELECT t.doc_id, coalesce(k.n, 0) AS n_words, coalesce(k.lost, 0) AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k USING (doc_id)"""


def _found(name: str, rank: int, kind: str, pattern: str, group: int = 0, where: str = "") -> str:
    """All matches with their places: running sums over gaps and matches."""
    full = _q(rf"(?s)(.*?)(?:({pattern})|\z)")

    def part(g):
        return f"regexp_extract_all(t, {full}, {g})"

    return f"""{name} AS (
  SELECT doc_id, {rank} AS rank, {_q(kind)} AS kind, hits[i] AS hit,
    list_sum(list_transform(gaps[1:i], lambda x: length(x)))
      + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS s
  FROM (SELECT doc_id, gaps, hits, vals, unnest(range(1, len(hits) + 1)) AS i
        FROM (SELECT doc_id, {part(1)} AS gaps, {part(2)} AS hits, {part(2 + group)} AS vals
              FROM d WHERE regexp_matches(t, {_q(pattern)})))
  WHERE hits[i] <> ''{where})"""


def secret_scan(window: int = secrets.WINDOW) -> str:
    """Entropy here is counted anew for each window. A candidate's class is told by the
    kinds of characters it has, not by the operator's patterns."""
    kinds = {"digit": "0-9", "low": "a-z", "up": "A-Z", "sign": "+/_-", "above_f": "g-zG-Z"}
    has = ", ".join(f"regexp_matches(rtrim(hit, '='), '[{c}]') AS {k}" for k, c in kinds.items())
    allowed = " OR ".join(f"regexp_matches(hit, {_q(p)})" for p in secrets.ALLOW)
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
{_found('assigned', 0, 'assign', secrets.ASSIGN, 2, ' AND length(vals[i]) >= 8')},
{_found('access', 1, 'access', secrets.ACCESS)},
{_found('hexes', 2, 'hex', secrets.HEX)},
{_found('runs', 3, 'entropy', f'[A-Za-z0-9+/_-]{{{window},}}={{0,2}}')},
base AS (SELECT * FROM assigned UNION ALL SELECT * FROM access UNION ALL SELECT * FROM hexes),
classed AS (
  SELECT *, CASE WHEN digit AND NOT (low OR up) THEN NULL WHEN NOT digit AND NOT (low AND up) THEN NULL
    WHEN NOT digit AND sign THEN 4.2 WHEN NOT digit THEN 4.0
    WHEN sign OR contains(hit, '=') THEN 3.8 WHEN above_f THEN 3.7 ELSE 3.0 END AS bits
  FROM (SELECT *, {has} FROM runs WHERE NOT ({allowed}))),
odd AS (
  SELECT doc_id, rank, kind, hit, s FROM classed r
  WHERE bits IS NOT NULL AND list_max(list_transform(range(1, length(hit) - {window - 2}),
      lambda k: list_entropy(string_split(substr(hit, k, {window}), '')))) >= bits - 1e-9
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = r.doc_id
      AND b.s <= r.s AND r.s + length(r.hit) <= b.s + length(b.hit))),
spans AS (
  SELECT *, kind || ':' || s || ':' || (s + length(hit)) AS span
  FROM (SELECT * FROM base UNION ALL SELECT * FROM odd))
SELECT d.doc_id, count(*) FILTER (WHERE rank = 0) AS n_assign,
  count(*) FILTER (WHERE rank = 1) AS n_access, count(*) FILTER (WHERE rank = 2) AS n_hex,
  sha256(coalesce(string_agg(span, ',' ORDER BY s, rank) FILTER (WHERE rank < 3), ''))
    AS base_sha256,
  coalesce(string_agg(span, ',' ORDER BY s, rank), '') AS spans
FROM d LEFT JOIN spans USING (doc_id) GROUP BY d.doc_id"""


_LOWER = f"translate(text, {_q(search._UPPER)}, {_q(search._LOWER)})"

SEARCH = f"""WITH words AS (
  SELECT doc_id, row, unnest(regexp_extract_all({_LOWER}, {_q(search.TERM_RE)})) AS term
  FROM (SELECT *, row_number() OVER () AS row FROM documents)),
tf AS (SELECT row, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM words GROUP BY row, term),
long AS (SELECT row, count(*) AS n FROM words GROUP BY row),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM long),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
item AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, {_q(search.TERM_RE)})) AS term
  FROM benchmark),
weight AS (
  SELECT item_id, term, floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2 * df + 1)))::BIGINT AS w
  FROM item JOIN df USING (term), total),
scores AS (
  SELECT item_id, row, any_value(doc_id) AS doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score
  FROM weight JOIN tf USING (term) JOIN long USING (row), total GROUP BY item_id, row)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (
    PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
  FROM scores WHERE score > 0) WHERE rank <= 10"""


#: Near words here are words that share a word with one letter left out: at the same
#: place (one letter replaced) or with the word itself (one inserted or deleted). The
#: table of the checksum follows from its polynomial.
SPELLING = f"""WITH RECURSIVE table256 AS (
  SELECT list(list_reduce(range(8), lambda a, i: CASE WHEN a & 1 = 1
    THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, k) ORDER BY k) AS tab FROM range(256) r(k)),
runs AS (
  SELECT id, run, count(*) AS n FROM (
    SELECT coalesce(doc_id::VARCHAR, '') AS id,
      unnest(regexp_extract_all({_LOWER}, '[a-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 5 GROUP BY id, run),
sums AS (
  SELECT run, n, xor(list_reduce(list_transform(range(length(bytes) // 2),
      lambda i: ('0x' || substr(bytes, 2 * i + 1, 2))::BIGINT),
    lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) AS h
  FROM (SELECT run, n, hex(encode(id || ':' || run)) AS bytes FROM runs), table256),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INTEGER)
      || substr(run, (h % length(run))::INTEGER + 2) ELSE run END AS word FROM sums)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS part
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word AS a, b.word AS b, b.n AS b_n FROM cut a JOIN cut b
    ON a.i = b.i AND a.part = b.part AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.part = w.word
  UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.part = w.word),
best AS (
  SELECT a, b, b_n, count(*) OVER (PARTITION BY a) AS n_near,
    row_number() OVER (PARTITION BY a ORDER BY b_n DESC, b) AS place FROM near),
forms AS (
  SELECT word, CASE WHEN b_n >= 2 * n THEN b END AS form, n, coalesce(n_near, 0) AS n_near,
    CASE WHEN b_n >= 2 * n THEN b_n END AS form_n
  FROM words LEFT JOIN (SELECT * FROM best WHERE place = 1) ON a = word),
ways AS (
  SELECT word, form AS last FROM forms WHERE form IS NOT NULL
  UNION ALL SELECT w.word, f.form FROM ways w JOIN forms f ON f.word = w.last
    WHERE f.form IS NOT NULL),
ends AS (SELECT w.word, w.last FROM ways w JOIN forms f ON f.word = w.last WHERE f.form IS NULL)
SELECT word, form, coalesce(last, word) AS root, n, n_near, form_n
FROM forms LEFT JOIN ends USING (word)"""


SQL = {
    "op5_substring_dedup": SUBSTRING_DEDUP,
    "op10_secret_scan": secret_scan(),
    "op12_lexical_search": SEARCH,
    "op13_spelling_variants": SPELLING,
}
