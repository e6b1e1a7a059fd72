"""DuckDB SQL for the queries of this subpackage that SQL can express.

The others have no SQL: ids and hashes of libraries, learned models, fingerprints by Spark's own
hash, and windows of bytes over whole tables. They are tested against brute force, the
libraries themselves, exact round trips or held-out accuracy.
"""

from __future__ import annotations

from townhall.llm import quality, superminhash, warc

_WORDS = r"[^\x20\x09-\x0D]+"
_UNSPACED = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}"
_UNSPACED_SIGNS = r"\x{2010}-\x{2027}\x{3000}-\x{303F}\x{30FB}-\x{30FC}\x{FF00}-\x{FF65}"

ORACLE: dict[str, str] = {}

ORACLE["op2_warc_source"] = f"""
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
held AS (
  SELECT payload_digest, payload_bytes, max(page_id) AS holder FROM p
  WHERE payload_bytes >= {warc.MIN_REVISIT_BYTES} GROUP BY ALL)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id <> holder THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> holder THEN holder END AS refers_to
FROM p LEFT JOIN held USING (payload_digest, payload_bytes)"""

ORACLE["op4_quality_cascade"] = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w FROM documents),
windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS three
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, three) > 1),
inside AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM again) GROUP BY doc_id),
lines AS (
  SELECT doc_id, text, w, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORDS}')) AS l FROM d),
counted AS (
  SELECT doc_id, text, w, l, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '{quality.SYMBOLS}', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM lines LEFT JOIN inside USING (doc_id)),
judged AS (
  SELECT *, length(text) - length(regexp_replace(text, '[{_UNSPACED}]', '', 'g')) AS unspaced,
         length(text) - length(replace(text, '!', '')) AS calls,
         regexp_extract_all(regexp_replace(text, '[{_UNSPACED}{_UNSPACED_SIGNS}]+', ' ', 'g'), '{_WORDS}') AS spaced,
         n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEATED_PERCENT} * n_words AS base_failed
  FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words + unspaced
            OR (word_chars > 15 * n_words AND (unspaced = 0 OR length(array_to_string(spaced, '')) > 15 * len(spaced)))
            OR 2 * word_chars < 5 * n_words
            OR 10 * len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) < 7 * n_words
            OR 2 * (length(text) - length(regexp_replace(text, '\p{{Lu}}', '', 'g')))
               > length(text) - length(regexp_replace(text, '\p{{L}}', '', 'g'))
            OR 2 * calls > n_words + unspaced
            OR 2 * len(list_distinct(l)) < len(l)) AS kept
FROM judged"""

ORACLE["op6_superminhash"] = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}') AS w
  FROM documents),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + {superminhash.SHINGLE - 1}], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {superminhash.SHINGLE - 2}, least(len(w), 1) + 1))) AS i FROM d)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * s.n >= {superminhash.PERCENT} * (x.n + y.n - s.n)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS node, doc_id AS least FROM d
  UNION SELECT e.b, r.least FROM reach r JOIN edges e ON e.a = r.node WHERE r.least < e.b)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least AS component_id, doc_id = least AS kept
FROM (SELECT node AS doc_id, min(least) AS least FROM reach GROUP BY node) LEFT JOIN sizes USING (doc_id)"""

_FIELDS = " || ".join(
    f"coalesce(CAST(octet_length(encode(CAST({c} AS VARCHAR))) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
    for c in ("doc_id", "source", "lang", "n_chars", "text"))
# CRC-32 bit by bit, over the digits of the id
_CRC = """xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
  lambda held, x: list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[],
    lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END), xor(held, x)),
  CAST(4294967295 AS BIGINT)), 4294967295)"""
_RUN = "string_agg(hash, '' ORDER BY rank)"

ORACLE["op12_merkle_manifest"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, lang, n_chars, text FROM documents),
leaves AS (
  SELECT doc_id, source, sha256({_FIELDS}) AS leaf, {_CRC} % 2 = 0 AS touched,
         row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS rank, count(*) OVER (PARTITION BY source) AS size
  FROM d),
tampered AS (
  SELECT doc_id, sha256({_FIELDS}) AS leaf FROM (SELECT * REPLACE (replace(text, chr(10), '') AS text) FROM d)),
nodes AS (
  SELECT source, 0 AS level, rank, size, leaf AS hash FROM leaves
  UNION ALL
  SELECT source, level + 1, rank // 3, (max(size) + 2) // 3, sha256({_RUN})
  FROM nodes WHERE size > 1 GROUP BY source, level, rank // 3),
subroots AS (
  SELECT source, hash AS subroot, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS rank, count(*) OVER () AS size
  FROM nodes WHERE size = 1),
tops AS (
  SELECT 0 AS level, rank, size, subroot AS hash FROM subroots
  UNION ALL
  SELECT level + 1, rank // 3, (max(size) + 2) // 3, sha256({_RUN}) FROM tops WHERE size > 1 GROUP BY level, rank // 3),
beside AS (
  SELECT a.source, a.level, a.rank,
         coalesce(string_agg(b.hash, '' ORDER BY b.rank) FILTER (WHERE b.rank < a.rank), '') AS l,
         coalesce(string_agg(b.hash, '' ORDER BY b.rank) FILTER (WHERE b.rank > a.rank), '') AS r
  FROM nodes a JOIN nodes b ON a.source IS NOT DISTINCT FROM b.source AND a.level = b.level AND a.rank // 3 = b.rank // 3
  WHERE a.size > 1 GROUP BY ALL),
beside_top AS (
  SELECT a.level, a.rank,
         coalesce(string_agg(b.hash, '' ORDER BY b.rank) FILTER (WHERE b.rank < a.rank), '') AS l,
         coalesce(string_agg(b.hash, '' ORDER BY b.rank) FILTER (WHERE b.rank > a.rank), '') AS r
  FROM tops a JOIN tops b ON a.level = b.level AND a.rank // 3 = b.rank // 3 WHERE a.size > 1 GROUP BY ALL),
steps AS (
  SELECT x.doc_id, b.level, b.l, b.r FROM leaves x JOIN beside b
    ON b.source IS NOT DISTINCT FROM x.source AND b.rank = x.rank // CAST(3 ** b.level AS BIGINT)
  UNION ALL
  SELECT x.doc_id, 100 + t.level, t.l, t.r FROM leaves x JOIN subroots s ON s.source IS NOT DISTINCT FROM x.source
    JOIN beside_top t ON t.rank = s.rank // CAST(3 ** t.level AS BIGINT)),
way AS (SELECT doc_id, list({{'l': l, 'r': r}} ORDER BY level) AS steps, string_agg(l || r, '' ORDER BY level) AS beside FROM steps GROUP BY doc_id),
held AS (
  SELECT x.doc_id, x.leaf, s.subroot, (SELECT hash FROM tops WHERE size = 1) AS root, sha256(coalesce(w.beside, '')) AS proof_sha256,
         CASE WHEN x.touched THEN t.leaf ELSE x.leaf END AS start, coalesce(w.steps, []) AS steps
  FROM leaves x JOIN tampered t USING (doc_id) JOIN subroots s ON s.source IS NOT DISTINCT FROM x.source LEFT JOIN way w USING (doc_id)),
folded AS (
  SELECT doc_id, 0 AS done, start AS hash, steps FROM held
  UNION ALL
  SELECT doc_id, done + 1, sha256(steps[done + 1].l || hash || steps[done + 1].r), steps FROM folded WHERE done < len(steps))
SELECT h.doc_id, leaf, subroot, root, proof_sha256, f.hash AS folded_root, f.hash = root AS verified
FROM held h JOIN folded f ON f.doc_id = h.doc_id AND f.done = len(h.steps)"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE["op13_ball_search"] = f"""
WITH held AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_TERM}') AS w FROM documents),
sums AS (SELECT count(*) FILTER (WHERE len(w) > 0) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM held),
asked AS (
  SELECT item_id, unnest(list_distinct(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_TERM}'))) AS term
  FROM benchmark),
counted AS (
  SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM held)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weighted AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS weight
  FROM (SELECT term, count(*) AS df FROM counted GROUP BY term), sums),
scored AS (
  SELECT item_id, doc_id,
         CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) AS BIGINT) AS score
  FROM asked JOIN weighted USING (term) JOIN counted USING (term), sums GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10"""
