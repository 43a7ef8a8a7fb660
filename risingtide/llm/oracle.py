"""DuckDB statements for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from risingtide.llm.quality_rules import MAX_REPEAT_PERCENT, MEASURES, MIN_GROUP, MIN_WORDS, SUB

GAP = r"[\x20\x09-\x0D]+"


def quality_rules() -> str:
    bins = (f"CASE WHEN v < {2**(SUB + 1)} THEN v ELSE (floor(log2(v))::BIGINT - {SUB}) * {2**SUB}"
            f" + (v >> (floor(log2(v))::BIGINT - {SUB})) END")
    floor_of = (f"CASE WHEN bin < {2**(SUB + 1)} THEN bin ELSE (bin - (bin // {2**SUB} - 1) * {2**SUB})"
                f" << (bin // {2**SUB} - 1) END")
    rules = ", ".join(f"('{k}', {r.least}, {r.upper or 'NULL'}, {r.lower or 'NULL'}, {r.ranges})" for k, r in MEASURES.items())
    return f"""
WITH d AS (
  SELECT doc_id, lang, source, row_number() OVER () AS r, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '{GAP}'), lambda x: x <> '') AS w
  FROM documents),
win AS (
  SELECT r, i, w[i:i+4] AS g
  FROM (SELECT r, w, unnest(generate_series(1, len(w) - 4)) AS i FROM d WHERE len(w) >= 5)),
hit AS (SELECT r, i FROM win JOIN (SELECT r, g FROM win GROUP BY r, g HAVING count(*) > 1) USING (r, g)),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(generate_series(i, i + 4)) AS p FROM hit) GROUP BY r),
ln AS (
  SELECT r, count(*) AS n_lines, count(DISTINCT x) AS n_fresh
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\\x20\\x09-\\x0D]')
  GROUP BY r),
m AS (
  SELECT d.r, doc_id, lang, source, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '{GAP}', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(n_lines - n_fresh, 0)::BIGINT AS n_dup_lines, coalesce(n_lines, 0) AS n_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words, len(list_distinct(w)) AS n_distinct
  FROM d LEFT JOIN ln USING (r) LEFT JOIN rep USING (r)),
v AS (
  SELECT r, lang, source, unnest(['symbols', 'dup_lines', 'repeats', 'chars', 'distinct']) AS measure,
         unnest([n_symbols * 1000 // n_words, n_dup_lines * 1000 // n_lines, n_repeat_words * 1000 // n_words,
                 word_chars * 1000 // n_words, n_distinct * 1000 // n_words]) AS v
  FROM m WHERE n_words > 0),
s AS (SELECT lang, source, measure, {bins} AS bin, count(*) AS n FROM v GROUP BY ALL),
rule(measure, least, up, down, ranges) AS (VALUES {rules}),
merged AS (
  SELECT 0 AS level, lang, source, measure, bin, n FROM s
  UNION ALL SELECT 1, lang, NULL, measure, bin, sum(n) FROM s GROUP BY lang, measure, bin
  UNION ALL SELECT 2, NULL, NULL, measure, bin, sum(n) FROM s GROUP BY measure, bin),
c AS (
  SELECT level, lang, source, measure, bin, sum(n) OVER (PARTITION BY level, lang, source, measure ORDER BY bin) AS seen,
         sum(n) OVER (PARTITION BY level, lang, source, measure) AS total FROM merged),
q AS (
  SELECT level, lang, source, measure, max(total) AS total, min(bin) FILTER (seen * 100 >= total) AS b1,
         min(bin) FILTER (seen * 4 >= total) AS b25, min(bin) FILTER (seen * 2 >= total) AS b50,
         min(bin) FILTER (seen * 4 >= total * 3) AS b75, min(bin) FILTER (seen * 100 >= total * 99) AS b99
  FROM c GROUP BY ALL),
p AS (
  SELECT *, {floor_of.replace("bin", "b1")} AS q1, {floor_of.replace("bin", "b25")} AS q25, {floor_of.replace("bin", "b50")} AS q50,
         {floor_of.replace("bin", "(b50 + 1)")} - 1 AS t50, {floor_of.replace("bin", "(b75 + 1)")} - 1 AS t75,
         {floor_of.replace("bin", "(b99 + 1)")} - 1 AS t99
  FROM q),
lv AS (
  SELECT level, lang, source, measure, total,
         t50 + greatest((t99 - t50) * up // 100, ranges * (t75 - q25), least) AS hi,
         q50 - greatest((q50 - q1) * down // 100, ranges * (t75 - q25), least) AS lo, up, down
  FROM p JOIN rule USING (measure)),
wide AS (
  SELECT l.lang, measure, CASE WHEN l.total >= {MIN_GROUP} THEN l.hi ELSE a.hi END AS hi,
         CASE WHEN l.total >= {MIN_GROUP} THEN l.lo ELSE a.lo END AS lo
  FROM lv l JOIN lv a USING (measure) WHERE l.level = 1 AND a.level = 2),
f AS (
  SELECT o.lang, o.source, o.measure,
         CASE WHEN up IS NOT NULL THEN CASE WHEN o.total >= {MIN_GROUP} THEN o.hi ELSE wide.hi END END AS hi,
         CASE WHEN down IS NOT NULL THEN CASE WHEN o.total >= {MIN_GROUP} THEN o.lo ELSE wide.lo END END AS lo
  FROM lv o JOIN wide ON wide.measure = o.measure AND wide.lang IS NOT DISTINCT FROM o.lang WHERE o.level = 0),
ok AS (
  SELECT v.r, bool_and((f.hi IS NULL OR v.v <= f.hi) AND (f.lo IS NULL OR v.v >= f.lo)) AS inside
  FROM v JOIN f ON v.measure = f.measure AND v.lang IS NOT DISTINCT FROM f.lang AND v.source IS NOT DISTINCT FROM f.source
  GROUP BY v.r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)
         AND coalesce(inside, true) AS kept
FROM m LEFT JOIN ok USING (r)
"""


TOPK = """
WITH x AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM x q JOIN x c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM p QUALIFY rank <= 5
"""

_BASE32 = "concat(" + ", ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (('0x' || h[{5 * i + 1}:{5 * i + 5}])::BIGINT >> {s} & 31)::INT + 1, 1)"
    for i in range(8) for s in (15, 10, 5, 0)) + ")"
WARC = f"""
WITH x AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
y AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM x)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN top IS NULL OR page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN top IS NULL OR page_id = top THEN NULL ELSE top END AS refers_to
FROM y
"""

JACCARD = """
WITH RECURSIVE d AS (
  SELECT doc_id, row_number() OVER () AS r, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT r, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
           ELSE [array_to_string(w[i:i+4], ' ') FOR i IN generate_series(1, len(w) - 4)] END)) AS sh FROM d),
k AS (SELECT min(r) AS k, sh, len(sh)::BIGINT AS n FROM s GROUP BY sh),
x AS (SELECT k, n, unnest(sh) AS g FROM k),
e AS (
  SELECT a.k AS a, b.k AS b FROM x a JOIN x b ON a.g = b.g AND a.k <> b.k
  GROUP BY a.k, b.k, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
t AS (SELECT k AS a, k AS b FROM k WHERE n > 0 UNION SELECT t.a, e.b FROM t JOIN e ON t.b = e.a),
id AS (SELECT k.k, min(d.doc_id) AS id FROM k JOIN s ON s.sh = k.sh JOIN d ON d.r = s.r GROUP BY k.k),
c AS (SELECT t.a AS k, min(id.id) AS component_id FROM t JOIN id ON id.k = t.b GROUP BY t.a)
SELECT d.doc_id, k.n AS n_shingles, CASE WHEN k.n = 0 THEN d.doc_id ELSE c.component_id END AS component_id
FROM d JOIN s ON s.r = d.r JOIN k ON k.sh = s.sh LEFT JOIN c ON c.k = k.k
"""

# The unsigned crc32 of a string, by a table of bytes; ``crc_table.t`` must be in scope.
CRC_TABLE = """crc_table AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))
              ORDER BY i) AS t FROM range(256) x(i))"""


def crc32(text: str) -> str:
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      range(0, strlen({text})), lambda i: ('0x' || substr(hex(encode({text})), (2 * i + 1)::INT, 2))::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))"""


VARIANTS = rf"""
WITH RECURSIVE {CRC_TABLE},
d AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc_id, row_number() OVER () AS r,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS w
  FROM documents),
g AS (SELECT doc_id, w, count(*) AS n FROM d GROUP BY ALL),
h AS (SELECT w, n, {crc32("(doc_id || ':' || w)")} AS h FROM g, crc_table WHERE length(w) >= 6),
c AS (
  SELECT CASE WHEN h % 199 = 0 THEN w[:(h % length(w))::INT] || w[(h % length(w) + 2)::INT:] ELSE w END AS word,
         sum(n)::BIGINT AS n
  FROM h GROUP BY 1),
v AS (SELECT word, n FROM c WHERE n >= 5 AND length(word) >= 6),
x AS (SELECT word, i, word[:i - 1] || word[i + 1:] AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
near AS (
  SELECT a.word, b.word AS other FROM x a JOIN x b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT x.word, v.word FROM x JOIN v ON x.rest = v.word
  UNION SELECT v.word, x.word FROM x JOIN v ON x.rest = v.word),
best AS (
  SELECT near.word, count(*) AS n_near, min({{'m': -v.n, 'w': near.other}}) AS b FROM near JOIN v ON v.word = near.other
  GROUP BY near.word),
f AS (
  SELECT v.word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -b.m >= 5 * n THEN b.w END AS form,
         CASE WHEN -b.m >= 5 * n THEN -b.m END AS form_n FROM v LEFT JOIN best USING (word)),
roots AS (
  SELECT word, word AS root, 0 AS depth FROM f
  UNION ALL SELECT roots.word, f.form, depth + 1 FROM roots JOIN f ON f.word = roots.root WHERE f.form IS NOT NULL)
SELECT f.word, form, root, n, n_near, form_n
FROM f JOIN (SELECT word, arg_max(root, depth) AS root FROM roots GROUP BY word) USING (word)
"""

REPAIR = rf"""
WITH RECURSIVE {CRC_TABLE},
h AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS h
  FROM conversations, crc_table),
d AS (
  SELECT conv_id, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role,
         CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE h WHEN 3 THEN 2 ELSE 1 END))
  FROM h WHERE h <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
k AS (
  SELECT conv_id, i, turn, role, text, substr(role, 1, 1) AS own,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 't' ELSE '' END AS fault
  FROM n),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
         count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || own NOT IN ('su', 'ua', 'au')) AS illegal
  FROM k GROUP BY conv_id),
ids AS (SELECT DISTINCT conv_id FROM conversations),
ins AS (
  SELECT * FROM (VALUES
    ('', 0, '', '', []::VARCHAR[]), ('', 1, 'I', 'u', ['user:']), ('', 2, 'II', 'a', ['user:', 'assistant:']),
    ('s', 0, '', 's', []), ('s', 1, 'I', 'u', ['user:']), ('s', 2, 'II', 'a', ['user:', 'assistant:']),
    ('u', 0, '', 'u', []), ('u', 1, 'I', 'a', ['assistant:']), ('u', 2, 'II', 'u', ['assistant:', 'user:']),
    ('a', 0, '', 'a', []), ('a', 1, 'I', 'u', ['user:']), ('a', 2, 'II', 'a', ['user:', 'assistant:'])
  ) x(state, many, letters, mid, lines)),
ops AS (
  SELECT * FROM (VALUES ('', 's', 'K', 's'), ('', 'u', 'K', 'u'), ('s', 'u', 'K', 'u'), ('u', 'a', 'K', 'a'), ('a', 'u', 'K', 'u'),
    ('', NULL, 'R', 'u'), ('s', NULL, 'R', 'u'), ('u', NULL, 'R', 'a'), ('a', NULL, 'R', 'u'),
    ('', NULL, 'D', ''), ('s', NULL, 'D', 's'), ('u', NULL, 'D', 'u'), ('a', NULL, 'D', 'a')) x(mid, own, op, state)),
st AS (
  SELECT conv_id, 0::BIGINT AS i, '' AS state, 0 AS cost, '' AS audit, []::VARCHAR[] AS lines FROM ids
  UNION ALL
  SELECT conv_id, i, state, cost, audit, lines FROM (
    SELECT k.conv_id, k.i, ops.state,
           st.cost + 3 * many + CASE op WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
             + CASE WHEN op <> 'D' AND fault = 't' THEN 3 ELSE 0 END AS cost,
           audit || letters || op AS audit,
           st.lines || ins.lines || CASE op WHEN 'D' THEN [] WHEN 'K' THEN [role || ':' || text]
             ELSE [CASE ops.state WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text] END AS lines
    FROM st JOIN k ON k.conv_id IS NOT DISTINCT FROM st.conv_id AND k.i = st.i + 1
    JOIN ins ON ins.state = st.state JOIN ops ON ops.mid = ins.mid
      AND (op = 'D' OR fault NOT IN ('b', 'd')) AND (op <> 'K' OR ops.own = k.own)
    QUALIFY row_number() OVER (PARTITION BY k.conv_id, ops.state ORDER BY st.cost + 3 * many
      + CASE op WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END + CASE WHEN op <> 'D' AND fault = 't' THEN 3 ELSE 0 END,
      audit || letters || op) = 1)),
ends AS (
  SELECT st.conv_id, cost + 3 * many AS cost, audit || letters AS audit, st.lines || ins.lines AS lines
  FROM st JOIN (SELECT conv_id, max(i) AS i FROM st GROUP BY conv_id) l
    ON l.conv_id IS NOT DISTINCT FROM st.conv_id AND l.i = st.i
  JOIN ins ON ins.state = st.state AND ins.mid IN ('', 'a')
  QUALIFY row_number() OVER (PARTITION BY st.conv_id ORDER BY cost + 3 * many, audit || letters) = 1)
SELECT ends.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost::BIGINT AS cost, audit,
       sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM ends LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM ends.conv_id
"""

EMBEDDINGS = """
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda e: e::DOUBLE) AS v FROM embeddings),
x AS (
  SELECT r, label, v, sqrt(list_dot_product(v, v)) AS size FROM d
  WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda e: e IS NULL OR NOT isfinite(e))) = 0
    AND len(list_filter(v, lambda e: e <> 0)) > 0),
e AS (
  SELECT a.r AS a, b.r AS b FROM x a JOIN x b ON a.label = b.label AND a.r <> b.r AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / (a.size * b.size) >= 0.93),
t AS (SELECT r AS a, r AS b FROM d UNION SELECT t.a, e.b FROM t JOIN e ON t.b = e.a),
c AS (SELECT t.a AS r, min(d.vec_id) AS component_id FROM t JOIN d ON d.r = t.b GROUP BY t.a)
SELECT vec_id, (SELECT count(*) FROM e WHERE e.a = d.r) AS n_links, component_id,
       vec_id IS NOT DISTINCT FROM component_id AS kept
FROM d JOIN c USING (r)
"""

SQL = {
    "op1_quality_rules": quality_rules(),
    "op2_jaccard_join": JACCARD,
    "op6_warc": WARC,
    "op9_topk_search": TOPK,
    "op11_spelling_variants": VARIANTS,
    "op12_conversation_repair": REPAIR,
    "op13_embedding_dedup": EMBEDDINGS,
}
