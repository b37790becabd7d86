"""DuckDB SQL of the queries that SQL can express, over the driver's views."""

# Unsigned CRC-32 of a list of bytes, from its generating rule.
CRC = """
crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
      CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS i)))
"""


def crc32(text: str) -> str:
    """SQL of the checksum of ``text``'s UTF-8 bytes; joins ``crc_table``."""
    h = f"hex(encode({text}))"
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(range(1, length({h}) + 1, 2), lambda p: ('0x' || substr({h}, p, 2))::BIGINT)),
      lambda c, b: xor(c >> 8, crc_table.t[(xor(c, b) & 255) + 1])))"""


CONVERSATION_REPAIR = f"""
WITH RECURSIVE {CRC.strip()},
damage AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS how
  FROM conversations, crc_table
), hurt AS (
  SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
         CASE how WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM damage, (SELECT unnest(range(2)) AS copy) WHERE how <> 0 AND (copy = 0 OR how = 3)
), placed AS (
  SELECT dense_rank() OVER (ORDER BY conv_id) AS c, *,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
  FROM hurt
), marked AS (
  SELECT *, row_number() OVER (PARTITION BY c, role, text ORDER BY i) AS nth,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS seen
  FROM placed
), rows_ AS (
  SELECT *, left(role, 1) AS ini, CASE WHEN seen = '' THEN 1 WHEN nth > 1 THEN 2
           WHEN right(seen, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) AS before
  FROM marked
), pads(a, q, pad, lines) AS (
  VALUES (0, 0, '', []::VARCHAR[]), (0, 2, 'I', ['user:']), (0, 3, 'II', ['user:', 'assistant:']),
         (1, 1, '', []), (1, 2, 'I', ['user:']), (1, 3, 'II', ['user:', 'assistant:']),
         (2, 2, '', []), (2, 3, 'I', ['assistant:']), (3, 3, '', []), (3, 2, 'I', ['user:'])
), enters(q, ini, s, named) AS (
  VALUES (0, 's', 1, NULL::VARCHAR), (0, 'u', 2, 'user'), (1, 'u', 2, 'user'), (3, 'u', 2, 'user'), (2, 'a', 3, 'assistant')
), actions AS (
  SELECT a, pad, lines, q AS s, 'D' AS edit, NULL::VARCHAR AS ini, NULL::VARCHAR AS named, 3 + 2 * length(pad) AS cost FROM pads
  UNION ALL SELECT a, pad, lines, s, 'K', ini, NULL::VARCHAR, 2 * length(pad) FROM pads JOIN enters USING (q)
  UNION ALL SELECT a, pad, lines, s, 'R', NULL::VARCHAR, named, 2 + 2 * length(pad) FROM pads JOIN enters USING (q)
  WHERE named IS NOT NULL
), ways AS (
  SELECT DISTINCT c, 0::BIGINT AS i, 0 AS s, {{'cost': 0::BIGINT, 'audit': '', 'body': []::VARCHAR[]}} AS w FROM rows_
  UNION ALL
  SELECT ways.c, rows_.i, x.s, min({{
           'cost': w.cost + x.cost + CASE WHEN fault = 3 AND edit <> 'D' THEN 1 ELSE 0 END,
           'audit': w.audit || pad || edit,
           'body': w.body || x.lines || CASE edit WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [role || ':' || text]
                   ELSE [named || ':' || text] END}})
  FROM ways JOIN rows_ ON rows_.c = ways.c AND rows_.i = ways.i + 1
       JOIN actions x ON x.a = ways.s AND (edit = 'D' OR fault NOT IN (1, 2)) AND (edit <> 'K' OR x.ini = rows_.ini)
  GROUP BY ways.c, rows_.i, x.s
), ends(s, pad, lines) AS (
  VALUES (0, '', []::VARCHAR[]), (1, 'II', ['user:', 'assistant:']), (2, 'I', ['assistant:']), (3, '', [])
), best AS (
  SELECT c, min({{'cost': w.cost + 2 * length(pad), 'audit': w.audit || pad, 'body': w.body || lines}}) AS w
  FROM ways JOIN ends USING (s) JOIN (SELECT c, max(i) AS i FROM rows_ GROUP BY c) USING (c, i) GROUP BY c
), totals AS (
  SELECT c, any_value(conv_id) AS conv_id,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
         count(*) FILTER (fault = 3) AS truncated,
         count(*) FILTER (i > 1 AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows_ GROUP BY c
)
SELECT k.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(w.cost, 0)::BIGINT AS cost,
       coalesce(w.audit, '') AS audit, sha256(coalesce(array_to_string(w.body, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) k
LEFT JOIN totals ON totals.conv_id IS NOT DISTINCT FROM k.conv_id
LEFT JOIN best ON best.c = totals.c
"""

NEAR_VECTORS = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS e,
         label IS NOT NULL AND embedding IS NOT NULL
         AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS fit
  FROM embeddings
), links AS (
  SELECT a.r AS a, b.r AS b FROM v a JOIN v b
    ON a.label = b.label AND a.r <> b.r AND a.fit AND b.fit AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT r AS a, r AS b FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), low AS (
  SELECT reach.a AS r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.b GROUP BY reach.a
)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = v.r) AS n_links, component_id,
       coalesce(vec_id = component_id, false) AS kept
FROM v JOIN low USING (r)
"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _word_counts(table: str, key: str) -> str:
    return f"""
  SELECT {key} AS id, word, count(*) AS n FROM (
    SELECT {key}, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'),
           '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM {table}) GROUP BY ALL"""


RESAMPLING = f"""
WITH {CRC.strip()},
d AS ({_word_counts("documents", "doc_id")}
), t AS ({_word_counts("benchmark", "item_id")}
), hashed AS (
  SELECT word, {crc32("word")} % 10000 AS bucket
  FROM (SELECT word FROM d UNION SELECT word FROM t), crc_table
), sums AS (
  SELECT bucket, coalesce(sum(s), 0) AS s, coalesce(sum(t), 0) AS t FROM (
    SELECT bucket, n AS s, 0 AS t FROM d JOIN hashed USING (word)
    UNION ALL SELECT bucket, 0, n FROM t JOIN hashed USING (word)) GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM sums) + 10000)::DOUBLE
    / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM sums) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM sums
), weighed AS (
  SELECT id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
  FROM d JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY id
), scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('2024:' || doc_id), 8))::BIGINT + 0.5::DOUBLE)
           / 4294967296::DOUBLE)))::BIGINT AS score
  FROM documents LEFT JOIN weighed ON id = doc_id
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM scored WHERE n_features >= 20
)
SELECT scored.doc_id, n_features, weight, score,
       CASE WHEN place <= 10 * (SELECT count(*) FROM ranked) // 100 THEN place END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""
