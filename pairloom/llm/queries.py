"""Queries of the training-data operators, by name, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pairloom.llm.conversation_trie import op13_conversation_trie
from pairloom.llm.embedding_dedup import op11_embedding_dedup
from pairloom.llm.hard_negatives import op12_hard_negatives
from pairloom.llm.html_text import op2_html_text
from pairloom.llm.licenses import op8_licenses
from pairloom.llm.mixing import op3_mixing
from pairloom.llm.packing import op4_best_fit_packing
from pairloom.llm.pii import op7_pii
from pairloom.llm.quality import op10_quality_rules
from pairloom.llm.simhash import op1_simhash
from pairloom.llm.token_counts import op9_token_counts
from pairloom.llm.topk import op6_topk
from pairloom.llm.url_filter import op5_url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op10_quality_rules": op10_quality_rules,
    "op11_embedding_dedup": op11_embedding_dedup,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_conversation_trie": op13_conversation_trie,
    "op2_html_text": op2_html_text,
    "op3_mixing": op3_mixing,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_url_filter": op5_url_filter,
    "op6_topk": op6_topk,
    "op7_pii": op7_pii,
    "op8_licenses": op8_licenses,
    "op9_token_counts": op9_token_counts,
}

ORACLE_SQL: dict[str, str] = {
    "op11_embedding_dedup": """
        WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) w FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS (SELECT a.vec_id a, b.vec_id b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_inner_product(a.w, b.w) / sqrt(list_inner_product(a.w, a.w)) / sqrt(list_inner_product(b.w, b.w)) >= 0.93),
        reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
        counts AS (SELECT a vec_id, count(*) n FROM links GROUP BY 1), least AS (SELECT a vec_id, min(b) c FROM reach GROUP BY 1)
        SELECT vec_id, coalesce(n, 0) AS n_links, c AS component_id, coalesce(c = vec_id, true) AS kept FROM embeddings LEFT JOIN counts USING (vec_id) LEFT JOIN least USING (vec_id)""",
    "op12_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END l, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) w FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
        scored AS (SELECT a.vec_id anchor_id, b.vec_id, a.l = b.l same, CAST(list_inner_product(a.w, b.w) AS BIGINT) s FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        positives AS (SELECT anchor_id, vec_id positive_id, s FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, vec_id) <= 5)
        SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY n.s DESC, n.vec_id) AS INTEGER) AS rank, n.vec_id AS negative_id, p.s AS positive_score, n.s AS negative_score
        FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.s <= 100 * n.s AND 100 * n.s <= 100 * p.s QUALIFY rank <= 5""",
    "op13_conversation_trie": """
        WITH turns AS (SELECT conv_id, coalesce(role, '') r, coalesce(text, '') t, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 i FROM conversations WHERE conv_id IS NOT NULL),
        convs AS (SELECT DISTINCT conv_id, conv_id - conv_id % 100 base, CASE WHEN conv_id % 100 = 0 THEN 0 ELSE xor(4294967295, list_reduce(list_transform(str_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
            lambda crc, byte: list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda c, k: xor(c >> 1, (c & 1) * 3988292384), xor(crc, byte)), CAST(4294967295 AS BIGINT))) % 6 END h FROM turns),
        parts AS (SELECT c.conv_id, 0 k, i, r, t FROM convs c JOIN turns b ON b.conv_id = base AND i < h UNION ALL SELECT conv_id, 1, i, r, t FROM convs JOIN turns USING (conv_id) WHERE i >= h),
        sequences AS (SELECT conv_id, coalesce(list({'r': r, 't': t} ORDER BY k, i) FILTER (WHERE t IS NOT NULL), []) s FROM convs LEFT JOIN parts USING (conv_id) GROUP BY 1),
        members AS (SELECT conv_id, d, s[1:d] p, len(s) n, CASE WHEN d > 0 THEN length(s[d].t) ELSE 0 END chars FROM sequences, LATERAL (SELECT unnest(range(0, len(s) + 1)) d)),
        nodes AS (SELECT p, d, min(conv_id) conv_id, count(*) n_convs, max(chars) chars, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) ends FROM members GROUP BY 1, 2),
        children AS (SELECT p[1:d-1] p, d - 1 d, count(*) n FROM nodes WHERE d > 0 GROUP BY 1, 2),
        all_ AS (SELECT nodes.*, coalesce(n, 0) n_children FROM nodes LEFT JOIN children USING (p, d)),
        subtrees AS (SELECT a.p, a.d, sum((b.n_children = 0)::INT) leaves, sum((b.n_convs - 1) * b.chars) saved FROM all_ a JOIN all_ b ON b.d >= a.d AND b.p[1:a.d] = a.p GROUP BY 1, 2)
        SELECT a.conv_id, CAST(a.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, a.n_convs, a.n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, a.ends AS ends_sha256
        FROM all_ a JOIN subtrees s ON s.p = a.p AND s.d = a.d LEFT JOIN all_ up ON a.d > 0 AND up.d = a.d - 1 AND up.p = a.p[1:a.d-1]""",
    "op5_url_filter": """
        WITH rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END r FROM pages),
        parts AS (SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) path FROM rest),
        rules(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
        judged AS (SELECT *, (SELECT {'rule': h || p, 'verdict': v} FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) ORDER BY length(h || p) DESC, length(h) DESC LIMIT 1) best FROM parts)
        SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM judged""",
    "op6_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) w FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
        scored AS (SELECT q.vec_id query_id, c.vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) score FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored QUALIFY rank <= 10""",
}
