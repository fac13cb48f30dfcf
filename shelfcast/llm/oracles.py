"""SQL twins of the document queries, where SQL can express them."""

from __future__ import annotations

# Word and line patterns, thresholds and phrases as the operators state them.
_WORD = r"[^\x20\x09-\x0D]+"
_LINE_FAILS = r"""
      len(regexp_extract_all(x, '[|»«›‹•·→]+')) * 100 > len(string_split(x, ' ')) * 20
      OR len(regexp_extract_all(x, '[#*$%&|<>{}\[\]~^=]{2,}')) * 100 > len(string_split(x, ' ')) * 30
      OR (len(string_split(x, ' ')) < 5
          AND NOT regexp_matches(x, '[.!?…。！？:;]["''”’»)\]]*[\x20\x09-\x0D]*$'))
      OR (len(string_split(x, ' ')) >= 60 AND NOT regexp_matches(x, '[.!?…。！？:;,]'))
      OR (len(string_split(x, ' ')) <= 20 AND regexp_matches(lower(x),
          'javascript|cookie policy|accept cookies|privacy policy|terms of use|terms of service|all rights reserved|lorem ipsum|click here|read more|licensed under|page not found|alle rechte vorbehalten|datenschutzerklärung|nutzungsbedingungen|cookies akzeptieren|hier klicken|seite nicht gefunden|tous droits réservés|politique de confidentialité|mentions légales|accepter les cookies|cliquez ici|lire la suite|todos los derechos reservados|política de privacidad|aviso legal|aceptar cookies|haga clic aquí|página no encontrada'))
"""

QUALITY = rf"""
WITH w AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws, string_split(coalesce(text, ''), chr(10)) AS ls
  FROM documents
), win AS (
  SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)
), twice AS (
  SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, g) > 1
), rep AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY rid
), lines AS (
  SELECT rid, list_filter(ls, lambda x: regexp_matches(x, '{_WORD}')) AS full_lines,
    list_filter(ls, lambda x: NOT ({_LINE_FAILS}) OR NOT regexp_matches(x, '{_WORD}')) AS good
  FROM w
), counted AS (
  SELECT w.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w.ws, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(w.t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(l.full_lines) - len(list_distinct(l.full_lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(regexp_extract_all(array_to_string(l.good, chr(10)), '{_WORD}')) AS BIGINT) AS kept_words
  FROM w JOIN lines l USING (rid) LEFT JOIN rep r USING (rid)
)
SELECT *, n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed,
  NOT (n_words < 50 OR n_repeat_words * 100 > n_words * 50) AND (n_words - kept_words) * 100 <= n_words * 50 AS kept
FROM counted
"""

_SEEDS = """
  SELECT id, i, 0 AS mask, w[i] || ' ' || w[i+1] || ' ' || w[i+3] || ' ' || w[i+5] || ' ' || w[i+6] AS g
  FROM {0} WHERE i + 6 <= len(w)
  UNION ALL
  SELECT id, i, 1, w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+5] || ' ' || w[i+6] FROM {0} WHERE i + 6 <= len(w)
  UNION ALL
  SELECT id, i, 2, w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+4] || ' ' || w[i+5] FROM {0} WHERE i + 5 <= len(w)
"""

DECONTAMINATE = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+') AS w FROM documents
), items AS (
  SELECT min(item_id) AS id, w
  FROM (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+') AS w FROM benchmark)
  WHERE len(w) >= 8 GROUP BY w
), doc_at AS (SELECT id, w, unnest(range(1, len(w) + 1)) AS i FROM docs),
item_at AS (SELECT id, w, unnest(range(1, len(w) + 1)) AS i FROM items),
doc_seeds AS ({_SEEDS.format("doc_at")}),
item_seeds AS ({_SEEDS.format("item_at")}),
hits AS (
  SELECT DISTINCT d.id AS did, b.id AS iid, d.i - b.i AS diagonal
  FROM doc_seeds d JOIN item_seeds b ON d.mask = b.mask AND d.g = b.g
), agree AS (
  SELECT h.did, h.iid, h.diagonal, d.doc_id, least(len(b.w), 25) AS width, len(b.w) AS size, k,
    CASE WHEN k + diagonal >= 1 AND d.w[k + diagonal] = b.w[k] THEN 1 ELSE 0 END AS same
  FROM (SELECT h.*, unnest(range(1, len(b.w) + 1)) AS k FROM hits h JOIN items b ON b.id = h.iid) h
  JOIN docs d ON d.id = h.did JOIN items b ON b.id = h.iid
), sums AS (
  SELECT did, iid, doc_id, diagonal, width, size, k,
    sum(same) OVER (PARTITION BY did, iid, diagonal ORDER BY k ROWS BETWEEN CURRENT ROW AND 24 FOLLOWING) AS s
  FROM agree
)
SELECT doc_id, iid AS item_id, CAST(max(width) AS BIGINT) AS compared, CAST(max(s) AS BIGINT) AS agreeing
FROM sums WHERE k <= size - width + 1 AND s * 100 >= width * 80
GROUP BY doc_id, iid
"""

_URL_RULES = """(VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
    ('block', 'net', '/es/'), ('block', 'net', '/fr/')) AS r(verdict, host, path)"""

URL_FILTER = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*(/[^?#]*)?', 1) AS path
  FROM cut
), best AS (
  SELECT p.page_id, max_by(r.host || r.path, length(r.host || r.path)) AS rule,
    max_by(r.verdict, length(r.host || r.path)) AS verdict
  FROM parts p JOIN {_URL_RULES}
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY p.page_id
)
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.verdict, CASE
    WHEN regexp_matches(p.host, 'casino|adult|porn|xxx|-bets|betting|pills|viagra')
      OR regexp_matches(p.host || p.path, '/wp-login[^/]*$|/cgi-bin/|[.]exe$') THEN 'block' ELSE 'allow' END) AS verdict
FROM parts p LEFT JOIN best b USING (page_id)
"""

_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

LEXICAL = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS ts FROM documents),
items AS (SELECT row_number() OVER () AS iid, item_id, {_TERMS} AS ts FROM benchmark),
asked AS (SELECT iid, item_id, t, count(*) AS q FROM (SELECT iid, item_id, unnest(ts) AS t FROM items) GROUP BY ALL),
held AS (
  SELECT rid, t, count(*) AS tf FROM (SELECT rid, unnest(ts) AS t FROM docs)
  WHERE t IN (SELECT t FROM asked) GROUP BY rid, t
), sums AS (SELECT count(*) FILTER (len(ts) > 0) AS nn, CAST(sum(len(ts)) AS BIGINT) AS ll FROM docs),
weights AS (
  SELECT t, CAST(floor(1000 * ln(CAST(2 * any_value(nn) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM held, sums GROUP BY t
), factors AS (SELECT rid, doc_id, 100 - 25 + ((25 * CAST(len(ts) AS BIGINT) * nn) // ll) AS m FROM docs, sums WHERE len(ts) > 0),
scored AS (
  SELECT iid, item_id, rid, doc_id, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM asked JOIN held USING (t) JOIN weights USING (t) JOIN factors USING (rid) GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST, rid) AS INTEGER) AS rank,
  doc_id, score
FROM scored WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST, rid) <= 20
"""

# The checksum is a sum (xor) of what each byte adds at its distance from the end, so it needs one join and no
# loop over bytes; near words meet in what is left without one letter.
SPELLING = """
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS c
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS w FROM documents)
  GROUP BY ALL
), keyed AS (
  SELECT row_number() OVER () AS id, run, c, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS bytes
  FROM runs WHERE length(run) >= 5
), places AS (
  SELECT id, i, length(bytes) // 2 - 1 - i AS d,
    xor(CAST('0x' || substr(bytes, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT), CASE WHEN i < 4 THEN 255 ELSE 0 END) AS b
  FROM (SELECT id, bytes, unnest(range(length(bytes) // 2)) AS i FROM keyed)
), crc_of_byte AS (
  SELECT b, list_reduce(list_prepend(b, range(8)),
    lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS v
  FROM range(256) AS r(b)
), effect AS (  -- what a byte adds to the checksum at each distance from the end
  SELECT CAST(0 AS BIGINT) AS d, b, v FROM crc_of_byte
  UNION ALL
  SELECT e.d + 1, e.b, xor(e.v >> 8, t.v) FROM effect e JOIN crc_of_byte t ON t.b = e.v & 255
  WHERE e.d < (SELECT max(d) FROM places)
), checks AS (
  SELECT p.id, xor(bit_xor(e.v), 4294967295) AS h FROM places p JOIN effect e ON e.d = p.d AND e.b = p.b GROUP BY p.id
), words AS (
  SELECT word, CAST(sum(c) AS BIGINT) AS n
  FROM (
    SELECT c, CASE WHEN h % 97 = 0
      THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
    FROM keyed JOIN checks USING (id)
  )
  WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3
), shorter AS (
  SELECT word, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS p FROM words)
), near AS (
  SELECT a.word, b.word AS other FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
  UNION
  SELECT a.word, b.word FROM shorter a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, a.word FROM shorter a JOIN words b ON a.rest = b.word
), best AS (
  SELECT near.word, near.other, o.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near
  FROM near JOIN words o ON o.word = near.other
  QUALIFY row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, near.other) = 1
), formed AS (
  SELECT w.word, w.n, CAST(coalesce(b.n_near, 0) AS BIGINT) AS n_near,
    CASE WHEN b.other_n >= 2 * w.n THEN b.other END AS form,
    CASE WHEN b.other_n >= 2 * w.n THEN b.other_n END AS form_n
  FROM words w LEFT JOIN best b USING (word)
), chain AS (
  SELECT word, word AS place FROM formed
  UNION ALL
  SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.place WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.place AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN chain c USING (word) JOIN formed last ON last.word = c.place AND last.form IS NULL
"""

ORACLES: dict[str, str] = {
    "op1_quality_rules": QUALITY,
    "op7_url_filter": URL_FILTER,
    "op10_decontaminate": DECONTAMINATE,
    "op11_lexical_search": LEXICAL,
    "op12_spelling_groups": SPELLING,
}
