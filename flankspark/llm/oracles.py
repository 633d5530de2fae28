"""SQL of the queries that SQL can express; DuckDB runs it on the same tables."""

from __future__ import annotations

from flankspark.llm.quality import STOP_WORDS
from flankspark.llm.urls import LOWER, UPPER

SPACES = r"[ \x09-\x0D]+"
WORDS = f"list_filter(string_split_regex(coalesce(text, ''), '{SPACES}'), lambda w: w <> '')"
LOW = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
STOP = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))

OP4 = f"""WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex({LOW}, '{SPACES}'), lambda w: w <> '') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] WHEN len(w) > 0 THEN [concat('short ', array_to_string(w, ' '))] ELSE []::VARCHAR[] END) AS x FROM d),
n AS (SELECT doc_id, len(x)::BIGINT AS n FROM s), e AS (SELECT doc_id, unnest(x) AS x FROM s),
c AS (SELECT a.doc_id AS i, b.doc_id AS j, count(*) AS c FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT i, j FROM c JOIN n p ON p.doc_id = i JOIN n q ON q.doc_id = j WHERE 100 * c >= 75 * (p.n + q.n - c)),
b AS (SELECT i, j FROM l UNION SELECT j, i FROM l),
r AS (SELECT doc_id AS i, doc_id AS j FROM documents UNION SELECT r.i, b.j FROM r JOIN b ON r.j = b.i)
SELECT n.doc_id, any_value(n.n) AS n_shingles, min(r.j) AS component_id FROM n JOIN r ON r.i = n.doc_id GROUP BY n.doc_id"""

OP6 = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \\x09-\\x0D]')) AS li FROM documents),
g AS (SELECT doc_id, t, w, li, CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] ELSE []::VARCHAR[] END AS f FROM d),
x AS (SELECT doc_id, unnest(f) AS f, generate_subscripts(f, 1) AS i FROM g),
p AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, f) AS k FROM x) WHERE k > 1),
h AS (SELECT doc_id, count(DISTINCT i + o.o) AS n FROM p, (SELECT unnest(range(5)) AS o) AS o GROUP BY doc_id),
m AS (SELECT g.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum([length(z) FOR z IN w]), 0)::BIGINT AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(li) - len(list_distinct(li)))::BIGINT AS n_dup_lines, coalesce(h.n, 0)::BIGINT AS n_repeat_words,
  len(li) AS n_lines, len(list_filter(w, lambda z: lower(z) IN ({STOP}))) AS n_stop, len(regexp_extract_all(t, '[0-9]')) AS n_digits, len(regexp_extract_all(t, '[!?#*$%&|<>]')) AS n_marks FROM g LEFT JOIN h USING (doc_id)),
r AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  n_words < 10 OR n_repeat_words > 0.2 * n_words OR word_chars < 2 * n_words OR word_chars > 25 * n_words OR n_symbols > 0.25 * n_words OR n_marks > 0.75 * n_words OR n_digits > 0.5 * word_chars OR (n_words >= 40 AND n_stop < 0.004 * n_words) OR (n_lines > 0 AND n_dup_lines > 0.6 * n_lines) AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT failed AS kept FROM r"""

_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _alnum(columns: str, source: str) -> str:
    return f"SELECT {columns}, list_filter(string_split_regex({LOW}, '{_ALNUM}'), lambda w: w <> '') AS w FROM {source}"


OP9 = f"""WITH d AS ({_alnum("doc_id", "documents")}), b AS ({_alnum("item_id", "benchmark")}),
i AS (SELECT item_id, len(w) AS n, unnest(CASE WHEN len(w) >= 13 THEN [array_to_string(w[k:k + 12], ' ') FOR k IN range(1, len(w) - 11)] ELSE [array_to_string(w, ' ')] END) AS g FROM b WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, least(n, 13) AS n, g FROM i), sizes AS (SELECT DISTINCT n FROM q),
x AS (SELECT doc_id, sizes.n, unnest(range(1, len(w) - sizes.n + 2)) AS k, w FROM d, sizes WHERE len(w) >= sizes.n),
y AS (SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS g FROM x),
z AS (SELECT doc_id, y.n, k, item_id FROM y JOIN q ON q.n = y.n AND q.g = y.g),
hits AS (SELECT doc_id, count(DISTINCT k + o) AS n_hit FROM (SELECT doc_id, k, unnest(range(n)) AS o FROM z) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM z) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""

_CONTROL = "contains(t, '<|')"
OP10 = f"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(concat(role, chr(10), t, chr(10)), '' ORDER BY turn, role, t)) AS turns_sha256, coalesce(sum(length(t)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn, role, t) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(24 + length(role) + length(t) + CASE WHEN {_CONTROL} THEN len(regexp_extract_all(t, '<[|]')) ELSE 0 END)::BIGINT AS formatted_chars FROM c GROUP BY conv_id"""

#: crc32 of each distinct word: a table of 256 entries by its rule, then a fold over the bytes.
OP13 = f"""WITH d AS ({_alnum("doc_id", "documents")}), b AS ({_alnum("item_id", "benchmark")}),
rule AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c FROM range(256) r(i))),
w AS (SELECT DISTINCT unnest(w) AS x FROM (SELECT w FROM d UNION ALL SELECT w FROM b)),
h AS (SELECT x, [('0x' || hex(x)[2 * k + 1:2 * k + 2])::BIGINT FOR k IN range(strlen(x))] AS bytes FROM w),
c AS (SELECT x, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, y: xor(t[xor(c, y) % 256 + 1], c // 256)), 4294967295) % 10000 AS k FROM h, rule),
s AS (SELECT k, count(*) AS s FROM (SELECT unnest(w) AS x FROM d) JOIN c USING (x) GROUP BY k), t AS (SELECT k, count(*) AS t FROM (SELECT unnest(w) AS x FROM b) JOIN c USING (x) GROUP BY k),
g AS (SELECT k, floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * (coalesce((SELECT sum(s) FROM s), 0) + 10000.0::DOUBLE) / ((coalesce(s, 0) + 1.0::DOUBLE) * (coalesce((SELECT sum(t) FROM t), 0) + 10000.0::DOUBLE))))::BIGINT AS g FROM (SELECT DISTINCT k FROM c) LEFT JOIN s USING (k) LEFT JOIN t USING (k)),
f AS (SELECT doc_id, sum(g)::BIGINT AS weight FROM (SELECT doc_id, unnest(w) AS x FROM d) JOIN c USING (x) JOIN g USING (k) GROUP BY doc_id),
p AS (SELECT d.doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight, ('0x' || sha256('2024:' || d.doc_id)[1:8])::BIGINT AS h FROM d LEFT JOIN f USING (doc_id)),
q AS (SELECT *, (weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score FROM p),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM q WHERE n_features >= 20 QUALIFY row_number() OVER (ORDER BY score DESC, doc_id) <= 10 * count(*) OVER () // 100)
SELECT doc_id, n_features, weight, score, rank FROM q LEFT JOIN r USING (doc_id)"""

ORACLES = {"op4_jaccard_join": OP4, "op6_quality_rules": OP6, "op9_decontamination": OP9, "op10_chat_formatting": OP10, "op13_importance_resampling": OP13}
