"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from evergreen.llm.bpe import op6_bpe
from evergreen.llm.brown import op3_lm_scoring
from evergreen.llm.chat import op9_chat
from evergreen.llm.decontaminate import op5_decontamination
from evergreen.llm.html_text import op4_html_text
from evergreen.llm.langid import op10_language
from evergreen.llm.phrases import op13_phrases
from evergreen.llm.quality import op2_quality
from evergreen.llm.quantise import op12_vector_dedup
from evergreen.llm.simhash import op7_simhash
from evergreen.llm.topk import op8_topk
from evergreen.llm.toxicity import op1_toxicity
from evergreen.llm.whiten import op11_whitening


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_toxicity, op2_quality, op3_lm_scoring, op4_html_text, op5_decontamination,
        op6_bpe, op7_simhash, op8_topk, op9_chat, op10_language,
        op11_whitening, op12_vector_dedup, op13_phrases,
    )
    return {f.__name__: f for f in found}


SHINGLES_SQL = r"""
WITH items AS (
  SELECT item_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(5, len(w)) AS n FROM items WHERE len(w) > 0),
wanted AS (
  SELECT item_id, n, unnest(list_distinct([array_to_string(w[i:i + n - 1], ' ') FOR i IN range(1, len(w) - n + 2)])) AS s
  FROM sized),
need AS (SELECT item_id, n, count(*) AS wanted FROM wanted GROUP BY 1, 2),
docs AS (
  SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
own AS (
  SELECT doc_id, l.n, unnest(list_distinct([array_to_string(w[i:i + l.n - 1], ' ') FOR i IN range(1, len(w) - l.n + 2)])) AS s
  FROM docs JOIN (SELECT DISTINCT n FROM sized) l ON len(w) >= l.n),
shared AS (
  SELECT o.doc_id, x.item_id, x.n, count(DISTINCT x.s) AS shared FROM own o JOIN wanted x USING (n, s) GROUP BY 1, 2, 3)
SELECT doc_id, item_id, shared, CAST(wanted AS INT) AS wanted, shared / wanted AS containment
FROM shared JOIN need USING (item_id, n) WHERE shared * 5 >= wanted * 4
"""

TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

CHAT_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
m AS (
  SELECT *, length(regexp_replace(text, '[\\\[<]', '..', 'g')) AS escaped,
    CASE role WHEN 'user' THEN length('[INST] ') + length(' [/INST]') WHEN 'assistant' THEN length('</s>')
      WHEN 'system' THEN length('[SYS]') + length('[/SYS]')
      ELSE length('[ROLE ') + length(regexp_replace(role, '[\\\[<]', '..', 'g')) + length('[:]') + length('[/ROLE]') END AS marks
  FROM t),
g AS (
  SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
    CAST(length('<s>') + sum(escaped + marks) AS BIGINT) AS formatted_chars
  FROM m GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g
"""

VECTOR_DEDUP_SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS node, vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
u AS (
  SELECT * FROM v WHERE label IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda x: x <> 0)) > 0
    AND len(list_filter(v, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
pairs AS (
  SELECT a.node AS a, b.node AS b FROM u a JOIN u b ON a.label = b.label AND a.node <> b.node AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (SELECT node, node AS other FROM v UNION SELECT r.node, p.b FROM reach r JOIN pairs p ON p.a = r.other),
comp AS (SELECT r.node, min(v.vec_id) AS component_id FROM reach r JOIN v ON v.node = r.other GROUP BY 1),
deg AS (SELECT a AS node, count(*) AS n_links FROM pairs GROUP BY 1)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN comp USING (node) LEFT JOIN deg USING (node)
"""

PHRASES_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \x09]+'), lambda x: x <> '') AS w FROM p),
n AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY 1),
g AS (
  SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
  FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k),
c AS MATERIALIZED (SELECT lang, k AS size, phrase, count(*) AS f FROM g GROUP BY 1, 2, 3 HAVING count(*) >= 100),
f AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS w FROM c),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, s.k, l.f AS l, r.f AS r, CAST(n.n AS HUGEINT) AS n,
    (1000::HUGEINT * c.f * n.n) // (l.f::HUGEINT * r.f) AS score
  FROM f c JOIN (SELECT unnest([1, 2, 3, 4]) AS k) s ON s.k < c.size JOIN n USING (lang)
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:s.k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[s.k + 1:c.size], ' ')),
low AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (
  SELECT * FROM low WHERE NOT EXISTS (
    SELECT 1 FROM f x WHERE x.lang = low.lang AND x.f >= low.a AND len(x.w) > len(string_split(low.phrase, ' '))
      AND contains(' ' || x.phrase || ' ', ' ' || low.phrase || ' '))),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op5_decontamination": SHINGLES_SQL,
        "op8_topk": TOPK_SQL,
        "op9_chat": CHAT_SQL,
        "op12_vector_dedup": VECTOR_DEDUP_SQL,
        "op13_phrases": PHRASES_SQL,
    }
