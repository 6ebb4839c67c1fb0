"""DuckDB SQL for the registered training-data queries that SQL can express."""

from __future__ import annotations

from starhouse.llm import quality_rules as Q
from starhouse.llm.chat_format import CONTROL, END, ESCAPE, START
from starhouse.llm.common import LOWER, UPPER


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _escaped(x: str) -> str:
    out = f"replace({x}, {_q(ESCAPE)}, {_q(ESCAPE + '0')})"
    for c in CONTROL:
        out = f"replace({out}, {_q(c)}, {_q(c[0] + ESCAPE + '1' + c[1:])})"
    return out


OP1 = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({len(START) + 1 + len(END)} + length(replace({_escaped('role')}, chr(10), {_q(ESCAPE + '2')}))
      + length({_escaped('text')})) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""


_JS = "sqrt(greatest(0.0, least(1.0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)))"

OP5 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS lang FROM documents),
w AS (SELECT doc_id, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws, t, lang FROM d),
s AS (SELECT doc_id, lang, len(ws) AS n_words,
        CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        length(t) - length(regexp_replace(t, '\p{{Lu}}', '', 'g')) AS n_upper,
        length(t) - length(regexp_replace(t, '\p{{Nd}}', '', 'g')) AS n_digit,
        length(t) - length(regexp_replace(t, '[!-/:-@\[-`{{-~]', '', 'g')) AS n_mark,
        length(t) - length(regexp_replace(t, '[^\p{{L}}\p{{Nd}}\x09-\x0D\x20-\x7E]', '', 'g')) AS n_other,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM w),
u AS (SELECT doc_id, unnest(ws) AS a, generate_subscripts(ws, 1) AS i FROM w),
tri AS (SELECT doc_id, i, a, lead(a) OVER v AS b, lead(a, 2) OVER v AS c FROM u WINDOW v AS (PARTITION BY doc_id ORDER BY i)),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM tri WHERE c IS NOT NULL),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) WHERE n >= 2 GROUP BY doc_id),
pw AS (SELECT doc_id, lang, unnest(list_filter(string_split_regex(lower(t), '[\x09-\x0D\x20-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+'), lambda x: x <> '')) AS x FROM d),
lw AS (SELECT lang, x, count(*) AS n, sum(count(*)) OVER (PARTITION BY lang) AS total FROM pw GROUP BY lang, x),
ref AS (SELECT lang, x, n / total AS q FROM lw WHERE n >= {Q.MIN_SHARE} * total),
refn AS (SELECT lang, max(total) AS total FROM lw GROUP BY lang),
dn AS (SELECT doc_id, lang, count(*) AS n FROM pw GROUP BY doc_id, lang),
dc AS (SELECT doc_id, lang, x, count(*) AS n FROM pw GROUP BY doc_id, lang, x),
cells AS (SELECT dn.doc_id, ref.x, coalesce(dc.n, 0) / dn.n AS p, ref.q FROM dn JOIN ref USING (lang)
          LEFT JOIN dc ON dc.doc_id = dn.doc_id AND dc.x = ref.x),
allcells AS (SELECT * FROM cells UNION ALL SELECT doc_id, '', greatest(0, 1 - sum(p)), greatest(0, 1 - sum(q)) FROM cells GROUP BY doc_id),
wd AS (SELECT doc_id, {_JS} AS dist FROM allcells GROUP BY doc_id),
cl AS (SELECT doc_id, lang, word_chars, [greatest(0, word_chars - n_upper - n_digit - n_mark - n_other), n_upper, n_digit, n_mark, n_other] AS v FROM s),
cr AS (SELECT lang, k, sum(v[k]) AS n FROM cl, (SELECT unnest([1, 2, 3, 4, 5]) AS k) GROUP BY lang, k),
crn AS (SELECT lang, sum(n) AS total FROM cr GROUP BY lang),
cd AS (SELECT doc_id, {_JS} AS dist FROM (SELECT doc_id, v[k] / word_chars AS p, cr.n / crn.total AS q FROM cl JOIN cr USING (lang) JOIN crn USING (lang)
       WHERE word_chars >= {Q.MIN_CHARS}) GROUP BY doc_id),
f AS (SELECT s.doc_id, n_words, word_chars, n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
        CASE WHEN refn.total >= {Q.MIN_REFERENCE} THEN coalesce(cd.dist, 0) > {Q.MAX_CHAR_DISTANCE}
          OR (coalesce(dn.n, 0) >= {Q.MIN_WORDS} AND coalesce(wd.dist, 0) > {Q.MAX_WORD_DISTANCE}) ELSE false END AS far
      FROM s LEFT JOIN rep USING (doc_id) LEFT JOIN wd USING (doc_id) LEFT JOIN cd USING (doc_id) LEFT JOIN dn USING (doc_id) LEFT JOIN refn ON refn.lang = s.lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT far AS kept FROM f
"""

OP6 = f"""
WITH l AS (SELECT doc_id, unnest(x) AS line, generate_subscripts(x, 1) AS pos FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM l),
many AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
m AS (SELECT k.*, first IS NOT NULL AND first <> doc_id AS dropped FROM k LEFT JOIN many USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(dropped AS INT)) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

_W9 = rf"list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
OP9 = f"""
WITH d AS (SELECT doc_id, {_W9} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS id, {_W9} AS w FROM benchmark),
bw AS (SELECT id, n, array_to_string(w[s : s + n - 1], ' ') AS g FROM (
        SELECT id, w, least(13, len(w)) AS n, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') AS g FROM (
        SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, dw.n, s, id FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, list_sort(list_distinct(list(id))) AS ids FROM hit GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(ids), 0) AS n_items,
  sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""


_CODES_START = """
WITH q AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 1024)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (
  SELECT vec_id, p, v[p * (len(v) // 4) + 1 : (p + 1) * (len(v) // 4)] AS x
  FROM q, (SELECT unnest(range(4)) AS p)),
b0 AS (
  SELECT p, e, x AS c FROM (SELECT p, x, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM parts) WHERE e < 256),"""

# a: distance * 256 + entry of each part, so that its least value is the nearest entry, ties to the lower one
_CODES_ASSIGN = """
a{n} AS (
  SELECT t.vec_id, t.p, min(CAST(list_inner_product(t.x, t.x) - 2 * list_inner_product(t.x, b.c) + list_inner_product(b.c, b.c) AS BIGINT) * 256 + b.e) AS m
  FROM parts t JOIN b{n} b ON t.p = b.p GROUP BY t.vec_id, t.p)"""

_CODES_ROUND = """,
s{n} AS (
  SELECT p, e, list(c ORDER BY i) AS c FROM (
    SELECT p, e, i, floor(sum(x) / count(*)) AS c FROM (
      SELECT a.p, a.m % 256 AS e, unnest(t.x) AS x, unnest(range(len(t.x))) AS i
      FROM a{n} a JOIN parts t ON a.vec_id = t.vec_id AND a.p = t.p) GROUP BY p, e, i) GROUP BY p, e),
b{next} AS (
  SELECT b.p, b.e, coalesce(s.c, b.c) AS c FROM b{n} b LEFT JOIN s{n} s ON b.p = s.p AND b.e = s.e),"""

_CODES_END = """,
coded AS (
  SELECT vec_id, string_agg(lpad(lower(to_hex(m % 256)), 2, '0'), '' ORDER BY p) AS code, CAST(sum(m // 256) AS BIGINT) AS error
  FROM a4 GROUP BY vec_id),
books AS (
  SELECT sha256(string_agg(CAST(CAST(c AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256
  FROM (SELECT p, e, unnest(c) AS c, unnest(range(len(c))) AS i FROM b4))
SELECT d.vec_id, d.code, d.error, CAST(sum(d.error) OVER (PARTITION BY q.label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded d JOIN q ON d.vec_id = q.vec_id, books"""

VECTOR_CODES = _CODES_START + "".join(_CODES_ASSIGN.format(n=n) + _CODES_ROUND.format(n=n, next=n + 1) for n in range(4)) \
    + _CODES_ASSIGN.format(n=4) + _CODES_END


def oracles() -> dict[str, str]:
    return {"op1_chat_format": OP1, "op5_quality_rules": OP5, "op6_line_dedup": OP6, "op9_decontamination": OP9,
            "op13_vector_codes": VECTOR_CODES}
