"""DuckDB SQL of the training-data queries that SQL can express: brute force
over the same tables, sharing nothing with the Spark code.

The others are fitted models, compression, sampling, tokenizers or windows
cut by token counts; tests compare them with plain Python."""

WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"

COMPONENTS = """
reach(id, other) AS (
  SELECT id, id FROM nodes UNION
  SELECT r.id, l.b FROM reach r JOIN both_ways l ON r.other = l.a)"""

OP2 = f"""
WITH RECURSIVE valid AS (
  SELECT vec_id, label, [CAST(x AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([1 FOR x IN embedding IF x <> 0]) > 0),
links AS (
  SELECT DISTINCT a.vec_id AS a, b.vec_id AS b FROM valid a
  JOIN valid b ON a.label = b.label AND a.vec_id < b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
nodes AS (SELECT DISTINCT vec_id AS id FROM embeddings),{COMPONENTS},
component AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id),
n AS (SELECT a, count(*) AS n_links FROM both_ways GROUP BY a)
SELECT c.id AS vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, c.id = component_id AS kept
FROM component c LEFT JOIN n ON n.a = c.id"""

OP4 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, {WORDS.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
  FROM documents),
sets AS (
  SELECT DISTINCT doc_id, list_aggregate(w[i : i + 4], 'string_agg', ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * n_both >= 80 * (x.n + y.n - n_both)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
nodes AS (SELECT DISTINCT doc_id AS id FROM documents),{COMPONENTS}
SELECT r.id AS doc_id, CAST(coalesce(max(n), 0) AS BIGINT) AS n_shingles, min(other) AS component_id
FROM reach r LEFT JOIN sizes s ON s.doc_id = r.id GROUP BY r.id"""


def op5() -> str:
    rules = {
        "symbol_permille": (20, "1000 * n_symbols // greatest(word_chars, 1)"),
        "dup_line_permille": (350, "1000 * n_dup_lines // greatest(n_lines, 1)"),
        "repeat_word_permille": (350, "1000 * n_repeat_words // greatest(n_words, 1)"),
        "word_length_percent": (300, "100 * word_chars // greatest(n_words, 1)"),
    }
    measured = ", ".join(f"{sql} AS {name}" for name, (_, sql) in rules.items())
    values = " UNION ALL ".join(f"SELECT lang, source, '{m}' AS m, {m} AS v, {k} AS slack FROM measured WHERE n_words > 0" for k, m in ((r[0], n) for n, r in rules.items()))
    shift = "greatest(CAST(floor(log2(greatest(v, 1) + 0.5)) AS BIGINT) - 4, 0)"
    level = lambda keys, name: f"""
{name} AS (
  SELECT {keys} m, count(*) AS n, quantile_disc(v, 0.25) AS q25, quantile_disc(v, 0.5) AS q50, quantile_disc(v, 0.75) AS q75,
         any_value(slack) AS slack
  FROM bucketed GROUP BY {keys} m)"""  # noqa: E731
    pick = lambda q: f"CASE WHEN g.n >= 30 THEN g.{q} WHEN l.n >= 30 THEN l.{q} ELSE a.{q} END"
    return f"""
WITH texts AS (SELECT row_number() OVER () AS k, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
worded AS (SELECT *, {WORDS.format(text="t")} AS w FROM texts),
triples AS (
  SELECT k, i, count(*) OVER (PARTITION BY k, w[i], w[i + 1], w[i + 2]) AS times
  FROM (SELECT k, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM worded)),
covered AS (
  SELECT k, count(DISTINCT i + j) AS n_repeat_words FROM triples CROSS JOIN (VALUES (0), (1), (2)) x(j)
  WHERE times > 1 GROUP BY k),
lines AS (
  SELECT k, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT k, unnest(string_split(t, chr(10))) AS line FROM texts) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY k),
base AS (
  SELECT worded.k, doc_id, lang, source, len(w) AS n_words, length(list_aggregate(w, 'string_agg', '')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM worded LEFT JOIN covered ON covered.k = worded.k LEFT JOIN lines ON lines.k = worded.k),
filled AS (SELECT * REPLACE (coalesce(word_chars, 0) AS word_chars) FROM base),
measured AS (SELECT *, {measured} FROM filled),
vals AS ({values}),
bucketed AS (SELECT lang, source, m, slack, (v >> {shift}) << {shift} AS v FROM vals),
{level("lang, source,", "own").strip()},
{level("lang,", "langs").strip()},
{level("", "whole").strip()},
fences AS (
  SELECT g.lang, g.source, g.m, {pick("q75")} + 3 * ({pick("q75")} - {pick("q50")}) + g.slack AS hi,
         {pick("q25")} - 3 * ({pick("q50")} - {pick("q25")}) - g.slack AS lo
  FROM own g JOIN langs l ON g.m = l.m AND g.lang IS NOT DISTINCT FROM l.lang JOIN whole a ON g.m = a.m),
failed AS (
  SELECT k, string_agg(CASE WHEN v > hi THEN f.m ELSE f.m || '_low' END, ',') AS failed_rules FROM (
    SELECT k, lang, source, unnest(['symbol_permille', 'dup_line_permille', 'repeat_word_permille', 'word_length_percent']) AS m,
           unnest([symbol_permille, dup_line_permille, repeat_word_permille, word_length_percent]) AS v FROM measured) x
  JOIN fences f ON f.m = x.m AND f.lang IS NOT DISTINCT FROM x.lang AND f.source IS NOT DISTINCT FROM x.source
  WHERE v > hi OR (v < lo AND f.m = 'word_length_percent') GROUP BY k),
judged AS (
  SELECT b.*, b.n_words < 50 OR 100 * b.n_repeat_words > 50 * b.n_words AS base_failed, failed_rules
  FROM filled b LEFT JOIN failed ON failed.k = b.k)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND failed_rules IS NULL AS kept
FROM judged"""


OP12 = """
WITH texts AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text_sha256
FROM texts WINDOW g AS (PARTITION BY text_sha256)"""

#: CRC-32 of a string of digits, bit by bit.
CRC = """xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
    flatten([[CAST(ord(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1] FOR x IN string_split(CAST({id} AS VARCHAR), '')])),
    lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"""

OP13 = f"""
WITH filled AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL),
named AS (
  SELECT c, turn, sha256(CAST(length(r) AS VARCHAR) || ':' || r || t) AS g, len({WORDS.format(text="t")}) AS words FROM filled),
own AS (SELECT c, g, words, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, g) - 1 AS p FROM named),
lens AS (SELECT c, count(*) AS n FROM own GROUP BY c),
convs AS (
  SELECT x.c, x.c - x.c % 20 AS base, {CRC.format(id="x.c")} % 4 AS h, least(h, coalesce(b.n, 0)) AS m
  FROM lens x LEFT JOIN lens b ON b.c = x.c - x.c % 20),
turns AS (
  SELECT convs.c, p AS i, g, words FROM convs JOIN own ON own.c = base WHERE p < m
  UNION ALL SELECT convs.c, p - h + m, g, words FROM convs JOIN own ON own.c = convs.c WHERE p >= h),
paths AS (
  SELECT c, i + 1 AS d, words, string_agg(g, ',') OVER (PARTITION BY c ORDER BY i) AS k,
         coalesce(string_agg(g, ',') OVER (PARTITION BY c ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS pk
  FROM turns UNION ALL SELECT c, 0, 0, '', NULL FROM convs),
deepest AS (SELECT c, max(d) AS d FROM paths GROUP BY c),
nodes AS (
  SELECT k, any_value(pk) AS pk, min(paths.c) AS conv_id, any_value(paths.d) AS depth, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(CASE WHEN deepest.d = paths.d THEN CAST(paths.c AS VARCHAR) END, ',' ORDER BY paths.c), '')) AS ends_sha256
  FROM paths JOIN deepest ON deepest.c = paths.c GROUP BY k),
kids AS (SELECT pk, count(*) AS n_children FROM nodes WHERE pk IS NOT NULL GROUP BY pk),
inside AS (SELECT DISTINCT x.k AS top, y.k FROM paths x JOIN paths y ON x.c = y.c AND x.d <= y.d),
sums AS (
  SELECT top, CAST(count(*) FILTER (kids.pk IS NULL) AS BIGINT) AS n_leaves, CAST(sum((n_convs - 1) * words) AS BIGINT) AS saved_tokens
  FROM inside JOIN nodes USING (k) LEFT JOIN kids ON kids.pk = nodes.k GROUP BY top)
SELECT v.conv_id, CAST(v.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, v.n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves, saved_tokens, v.ends_sha256
FROM nodes v LEFT JOIN nodes up ON up.k = v.pk LEFT JOIN kids ON kids.pk = v.k JOIN sums ON sums.top = v.k"""


ORACLES = {"op12_exact_dedup": OP12, "op13_conversation_trie": OP13, "op2_embedding_near_dedup": OP2, "op4_ngram_jaccard_join": OP4, "op5_quality_rules": op5()}
