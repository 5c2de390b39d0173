"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from churnframe.llm import quality_rules as q8


def quality_sql(docs: str, carry: str) -> str:
    """Same measures, sketch, fences and verdicts as ``quality_rules.judge``
    over the relation ``docs``; ``carry`` lists the columns to return."""
    rules = ", ".join(f"('{r.value}', {r.margin}, {str(r.low).lower()})" for r in q8.RULES)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, * FROM {docs}),
t AS (SELECT rid, coalesce(text, '') AS t FROM d),
a AS (SELECT rid, t,
        [x FOR x IN string_split_regex(t, '[\x20\x09-\x0D]+') IF x <> ''] AS w,
        [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS l
      FROM t),
win AS (SELECT rid, i, md5(array_to_string(w[i:i+4], ' ')) AS h
        FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM a WHERE len(w) >= 5)),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, h) AS n FROM win) WHERE n > 1),
rep AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM dup) GROUP BY rid),
m AS (SELECT a.rid, len(w)::BIGINT AS n_words,
        length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
        (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
        coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
        len(regexp_extract_all(t, '[A-Z]'))::BIGINT AS n_upper, len(l)::BIGINT AS n_lines
      FROM a LEFT JOIN rep ON a.rid = rep.rid),
r AS (SELECT m.*, coalesce(d.lang, '') AS g_lang, coalesce(d.source, '') AS g_source,
        CASE WHEN n_words > 0 THEN word_chars * 100 // n_words ELSE 0 END AS word_len,
        CASE WHEN n_words > 0 THEN n_symbols * 1000 // n_words ELSE 0 END AS symbol_rate,
        CASE WHEN n_lines > 0 THEN n_dup_lines * 1000 // n_lines ELSE 0 END AS dup_line_rate,
        CASE WHEN n_words > 0 THEN n_repeat_words * 1000 // n_words ELSE 0 END AS repeat_rate,
        CASE WHEN word_chars > 0 THEN n_upper * 1000 // word_chars ELSE 0 END AS upper_rate
      FROM m JOIN d ON m.rid = d.rid),
v AS (SELECT rid, g_lang, g_source, rule, val FROM r
      UNPIVOT (val FOR rule IN (word_len, symbol_rate, dup_line_rate, repeat_rate, upper_rate))),
s AS (SELECT g_lang, g_source, rule, (val >> sh) << sh AS bucket, count(*) AS n
      FROM (SELECT *, greatest(0, length(bin(val)) - 6) AS sh FROM v) GROUP BY ALL),
oc AS (SELECT *, sum(n) OVER (PARTITION BY g_lang, g_source, rule ORDER BY bucket) AS cum,
         sum(n) OVER (PARTITION BY g_lang, g_source, rule) AS total FROM s),
own AS (SELECT g_lang, g_source, rule, max(total) AS total,
          min(bucket) FILTER (WHERE cum * 100 >= total * 25) AS q25,
          min(bucket) FILTER (WHERE cum * 100 >= total * 75) AS q75 FROM oc GROUP BY ALL),
pc AS (SELECT *, sum(n) OVER (PARTITION BY rule ORDER BY bucket) AS cum, sum(n) OVER (PARTITION BY rule) AS total
       FROM (SELECT rule, bucket, sum(n) AS n FROM s GROUP BY ALL)),
pool AS (SELECT rule, min(bucket) FILTER (WHERE cum * 100 >= total * 25) AS p25,
           min(bucket) FILTER (WHERE cum * 100 >= total * 75) AS p75 FROM pc GROUP BY ALL),
ab AS (SELECT own.g_lang, own.g_source, own.rule,
         CASE WHEN total >= {q8.MIN_GROUP} THEN q25 ELSE p25 END AS a,
         CASE WHEN total >= {q8.MIN_GROUP} THEN q75 ELSE p75 END AS b
       FROM own JOIN pool ON own.rule = pool.rule),
f AS (SELECT ab.*, k.low, greatest(b - a, k.margin) * {q8.FENCE_K} AS spread
      FROM ab JOIN (VALUES {rules}) k(rule, margin, low) ON ab.rule = k.rule),
bad AS (SELECT DISTINCT v.rid FROM v JOIN f ON v.g_lang = f.g_lang AND v.g_source = f.g_source AND v.rule = f.rule
        WHERE v.val > f.b + f.spread OR (f.low AND v.val < f.a - f.spread)),
j AS (SELECT r.rid, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        n_words < {q8.MIN_WORDS} OR n_repeat_words * 100 > n_words * {q8.MAX_REPEAT_PERCENT} AS base_failed,
        bad.rid IS NOT NULL AS out_of_fence
      FROM r LEFT JOIN bad ON r.rid = bad.rid)
SELECT {carry} FROM j JOIN d ON j.rid = d.rid"""


OP8 = quality_sql(
    "documents",
    "d.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, "
    "NOT base_failed AND NOT out_of_fence AS kept")


def line_dedup_sql(docs: str) -> str:
    """Per line of ``docs``: doc_id, line, n distinct words, removed; by joining
    lines that share one of their rarest words (as many as two lines at 0.8
    cannot both differ in)."""
    return rf"""
WITH l AS (SELECT doc_id, line, x FROM (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS x,
          unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS line FROM {docs})),
w AS (SELECT doc_id, line, [y FOR y IN string_split_regex(lower(x), '[\x20\x09-\x0D]+') IF y <> ''] AS w FROM l),
s AS (SELECT doc_id, line, list_sort(list_distinct(w)) AS toks FROM w),
g AS (SELECT row_number() OVER () AS id, * FROM (
        SELECT toks, min(struct_pack(doc_id := doc_id, line := line)) AS first_at FROM s
        WHERE len(toks) > 0 AND doc_id IS NOT NULL GROUP BY toks)),
e AS (SELECT id, first_at, len(toks) AS n, unnest(toks) AS tok FROM g),
f AS (SELECT tok, count(*) AS c FROM e GROUP BY tok),
r AS (SELECT e.* FROM e JOIN f USING (tok) QUALIFY row_number() OVER (PARTITION BY id ORDER BY c, tok) <= n - ceil(n * 8 / 10.0) + 1),
c AS (SELECT DISTINCT a.id AS x, b.id AS y FROM r a JOIN r b ON a.tok = b.tok AND b.first_at < a.first_at
      AND least(a.n, b.n) * 10 >= greatest(a.n, b.n) * 8),
p AS (SELECT x AS id FROM c JOIN g a ON c.x = a.id JOIN g b ON c.y = b.id
      WHERE len(list_intersect(a.toks, b.toks)) * 180 >= (len(a.toks) + len(b.toks)) * 80),
v AS (SELECT s.doc_id, s.line, len(s.toks) AS n,
        coalesce(g.first_at < struct_pack(doc_id := s.doc_id, line := s.line) OR g.id IN (SELECT id FROM p), false) AS removed
      FROM s LEFT JOIN g ON s.toks = g.toks AND s.doc_id IS NOT NULL)"""


OP7 = line_dedup_sql("documents") + """
SELECT doc_id, count(*) FILTER (WHERE n > 0) AS n_lines, count(*) FILTER (WHERE removed) AS n_removed,
  coalesce(string_agg(line::VARCHAR, ',' ORDER BY line) FILTER (WHERE removed), '') AS removed_lines
FROM v GROUP BY doc_id"""


def decontamination_sql(docs: str) -> str:
    """Per document and item: best weighted Jaccard similarity of the windows
    that line up with a common shingle."""
    return rf"""
WITH shingled AS (SELECT kind, id, w, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE [array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)] END AS sh
      FROM (SELECT kind, id, [y FOR y IN string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+') IF y <> ''] AS w
            FROM (SELECT 'd' AS kind, doc_id AS id, text FROM {docs} UNION ALL SELECT 'b', item_id, text FROM benchmark))),
e AS (SELECT kind, id, len(w) AS n, unnest(sh) AS s, unnest(range(len(sh))) AS at FROM shingled),
st AS (SELECT DISTINCT d.id AS doc, b.n AS size, greatest(0, least(d.at - b.at, d.n - b.n)) AS start
       FROM e d JOIN e b ON d.s = b.s WHERE d.kind = 'd' AND b.kind = 'b'),
win AS (SELECT doc, size, start, CASE WHEN len(x) < 5 THEN [array_to_string(x, ' ')]
          ELSE [array_to_string(x[i:i+4], ' ') FOR i IN range(1, len(x) - 3)] END AS sh
        FROM (SELECT doc, size, start, s.w[start + 1:start + size] AS x
              FROM st JOIN shingled s ON s.kind = 'd' AND s.id = st.doc)),
wc AS (SELECT doc, size, start, s, count(*) AS c FROM (SELECT doc, size, start, unnest(sh) AS s FROM win) GROUP BY ALL),
ic AS (SELECT id AS item, n AS size, s, count(*) AS c FROM e WHERE kind = 'b' GROUP BY ALL),
wn AS (SELECT doc, size, start, sum(c) AS t FROM wc GROUP BY ALL), tn AS (SELECT item, size, sum(c) AS t FROM ic GROUP BY ALL),
o AS (SELECT doc, wc.size, start, item, sum(least(wc.c, ic.c)) AS o FROM wc JOIN ic ON wc.s = ic.s AND wc.size = ic.size GROUP BY ALL),
r AS (SELECT o.doc, o.item, o.start, o.o::DOUBLE / (wn.t + tn.t - o.o)::DOUBLE AS similarity
      FROM o JOIN wn ON o.doc = wn.doc AND o.size = wn.size AND o.start = wn.start
      JOIN tn ON o.item = tn.item AND o.size = tn.size
      WHERE o.o * 100 >= (wn.t + tn.t - o.o) * 80)"""


OP3 = decontamination_sql("documents") + """
SELECT doc AS doc_id, item AS item_id, max(similarity) AS similarity,
  arg_min(start, struct_pack(a := -similarity, b := start))::BIGINT AS word FROM r GROUP BY doc, item"""


OP6 = r"""
WITH RECURSIVE w AS (SELECT doc_id, [y FOR y IN string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+') IF y <> ''] AS w FROM documents),
s AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE [array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)] END)) AS sh FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS t FROM s),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.t = b.t AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING count(*) * 100 >= 80 * (a.n + b.n - count(*))),
reach(doc_id, to_id) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.doc_id, l.b FROM reach r JOIN l ON r.to_id = l.a)
SELECT s.doc_id, len(sh)::BIGINT AS n_shingles, m.component_id
FROM s JOIN (SELECT doc_id, min(to_id) AS component_id FROM reach GROUP BY doc_id) m ON s.doc_id = m.doc_id"""


#: the machine accepts an optional system turn, then user and assistant in turn
OP13 = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM (
        SELECT conv_id, turn, role, text FROM conversations
        UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))),
s AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos FROM c),
l AS (SELECT *, (coalesce(before, '') || '>' || role) IN ('>system', '>user', 'system>user', 'user>assistant', 'assistant>user') AS ok,
        CASE WHEN role IN ('system', 'user', 'assistant') THEN length('### ' || role || ': ') END
          + length(text) + length(regexp_replace(text, '[^\\]', '', 'g'))
          + coalesce(list_sum(list_transform(regexp_extract_all(text, '#{3,}'), lambda x: length(x) - 2)), 0)
          + len(regexp_extract_all(text, '</turn>')) + 8 AS chars FROM s)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars, bool_and(ok) AND arg_max(role, pos) = 'assistant' AS valid,
  CASE WHEN bool_and(ok) AND arg_max(role, pos) = 'assistant' THEN NULL
       ELSE coalesce(min(pos) FILTER (WHERE NOT ok), count(*)) END AS bad_turn
FROM l GROUP BY conv_id"""


OP11 = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
q AS (SELECT row_number() OVER () AS pid, lang, string_split_regex(p, '[\x20\x09]+') AS w FROM p),
x AS (SELECT pid, lang, unnest(w) AS x, unnest(range(len(w))) AS i FROM q),
v AS (SELECT lang, x, lead(x) OVER o AS y, lead(x, 2) OVER o AS z FROM x WHERE x <> '' WINDOW o AS (PARTITION BY pid ORDER BY i)),
g AS (SELECT lang, 1 AS size, x AS phrase FROM v
      UNION ALL SELECT lang, 2, x || ' ' || y FROM v WHERE y IS NOT NULL
      UNION ALL SELECT lang, 3, x || ' ' || y || ' ' || z FROM v WHERE z IS NOT NULL),
f AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 10),
k AS (SELECT *, unnest(range(1, size)) AS k FROM c),
s AS (SELECT k.lang, k.phrase, k.a, k.k, l.f AS l, r.f AS r,
        (1000000::HUGEINT * k.a * k.a) // (l.f::HUGEINT * r.f) AS score
      FROM k JOIN f l ON l.lang = k.lang AND l.phrase = array_to_string(w[1:k], ' ')
      JOIN f r ON r.lang = k.lang AND r.phrase = array_to_string(w[k + 1:], ' ')),
b AS (SELECT lang, phrase, a, arg_min(struct_pack(l := l, r := r, score := score), struct_pack(score := score, k := k)) AS c
      FROM s GROUP BY ALL),
i AS (SELECT lang, phrase, max(a) AS longer FROM (
        SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase FROM c WHERE size = 3) GROUP BY ALL),
o AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY c.score DESC, a DESC, b.phrase) AS rank
      FROM b LEFT JOIN i ON i.lang = b.lang AND i.phrase = b.phrase WHERE coalesce(100 * longer < 50 * a, true))
SELECT o.lang, rank, phrase, a, c.l AS l, c.r AS r, n.n::BIGINT AS n, c.score::BIGINT AS score
FROM o JOIN n ON n.lang = o.lang WHERE rank <= 2000"""
