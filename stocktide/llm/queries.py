"""The operators as queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stocktide.llm import (
    exact, infill, licenses, merkle, mixing, packing, pii, quality, shards, simhash, substrings, topk, wavelet,
)
from stocktide.llm.text import read_table


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
        return read_table(spark, sf_dir, "documents")

    return {
        "op1_skip_chain_pii": lambda s, d: pii.query(docs(s, d)),
        "op2_label_propagation_shards": lambda s, d: shards.query(docs(s, d)),
        "op3_maxscore_top_k": lambda s, d: topk.query(read_table(s, d, "embeddings")),
        "op4_compression_quality": lambda s, d: quality.query(docs(s, d), read_table(s, d, "labels")),
        "op5_suffix_automaton_dedup": lambda s, d: substrings.query(docs(s, d)),
        "op6_source_mix": lambda s, d: mixing.query(docs(s, d)),
        "op7_golay_simhash": lambda s, d: simhash.query(docs(s, d)),
        "op8_genetic_packing": lambda s, d: packing.query(docs(s, d)),
        "op9_stream_dedup": lambda s, d: exact.query(docs(s, d)),
        "op10_license_scan": lambda s, d: licenses.query(docs(s, d)),
        "op11_wavelet_tokens": lambda s, d: wavelet.query(docs(s, d)),
        "op12_fenwick_infill": lambda s, d: infill.query(docs(s, d)),
        "op13_merkle_manifest": lambda s, d: merkle.query(docs(s, d)),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_maxscore_top_k": TOP_K, "op9_stream_dedup": STREAM_DEDUP, "op12_fenwick_infill": INFILL, "op13_merkle_manifest": MERKLE,
    }


#: A-Z only, as DuckDB's lower() also changes other letters.
STREAM_DEDUP = """
WITH plain AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
    FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM plain WINDOW same AS (PARTITION BY body)
"""

TOP_K = """
WITH parts AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, p.vec_id, CAST(list_inner_product(q.v, p.v) AS BIGINT) AS score
    FROM parts q JOIN parts p ON q.vec_id <> p.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM scored
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM ranked WHERE n <= 20
"""

INFILL = """
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS body, length(coalesce(text, '')) AS n,
           sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
    FROM documents
), numbers AS (
    SELECT *, CAST('0x' || substr(digest, 1, 8) AS BIGINT) % (n + 1) AS a, CAST('0x' || substr(digest, 9, 8) AS BIGINT) % (n + 1) AS b,
           CAST('0x' || substr(digest, 17, 8) AS BIGINT) % 100 AS c, CAST('0x' || substr(digest, 25, 8) AS BIGINT) % 100 AS d
    FROM drawn
), cut AS (
    SELECT *, least(a, b) AS first, greatest(a, b) AS last,
           CASE WHEN n = 0 OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') OR c >= 90 THEN 'plain'
                WHEN d < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM numbers
), parts AS (
    SELECT *, substring(body, 1, first) AS prefix, substring(body, first + 1, last - first) AS middle,
           substring(body, last + 1) AS suffix
    FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN first END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN last - first END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(body) AS restored_sha256
FROM parts
"""

#: CRC-32 goes over a list of the bytes with eight shifts (-1) behind each. Trees are climbed level by level,
#: then each leaf is folded up its own path: ``lower`` and ``upper`` are the siblings on its two sides.
MERKLE = """
WITH RECURSIVE fields AS (
    SELECT doc_id, source, text,
           coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-')
           || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
           || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') AS head,
           list_reduce(
               list_concat([4294967295], flatten(list_transform(
                   string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
               lambda acc, e: CASE WHEN e >= 0 THEN xor(acc, e) ELSE xor(acc >> 1, 3988292384 * (acc & 1)) END) AS register
    FROM documents
), hashed AS (
    SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
           -- the register is inverted at the end, so an even checksum has its last bit set here
           CASE WHEN register & 1 = 1 THEN sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-'))
                ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS altered
    FROM fields
), sources AS (
    SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS grp, count(*) AS n FROM documents GROUP BY source
), leaves AS (
    SELECT h.*, s.grp, s.n, row_number() OVER (PARTITION BY s.grp ORDER BY h.doc_id NULLS FIRST, h.leaf) - 1 AS pos
    FROM hashed h JOIN sources s ON h.source IS NOT DISTINCT FROM s.source
), low AS (
    SELECT grp, 0 AS level, pos, n, leaf AS node FROM leaves
    UNION ALL
    SELECT grp, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(node, '' ORDER BY pos))
    FROM low WHERE n > 1 GROUP BY grp, level, pos // 3, n
), subroots AS (
    SELECT grp, level AS height, node AS subroot FROM low WHERE n = 1
), high AS (
    SELECT 0 AS level, grp AS pos, (SELECT count(*) FROM sources) AS n, subroot AS node FROM subroots
    UNION ALL
    SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(node, '' ORDER BY pos))
    FROM high WHERE n > 1 GROUP BY level, pos // 3, n
), paths AS (
    SELECT l.grp, l.pos, b.level AS step, b.pos AS place, l.pos // CAST(pow(3, b.level) AS BIGINT) AS own, b.node
    FROM leaves l JOIN low b ON b.grp = l.grp AND b.n > 1 AND b.pos // 3 = l.pos // CAST(pow(3, b.level + 1) AS BIGINT)
    UNION ALL
    SELECT l.grp, l.pos, s.height + b.level, b.pos, l.grp // CAST(pow(3, b.level) AS BIGINT), b.node
    FROM leaves l JOIN subroots s ON s.grp = l.grp
    JOIN high b ON b.n > 1 AND b.pos // 3 = l.grp // CAST(pow(3, b.level + 1) AS BIGINT)
), steps AS (
    SELECT grp, pos, step, coalesce(string_agg(node, '' ORDER BY place) FILTER (place < own), '') AS lower,
           coalesce(string_agg(node, '' ORDER BY place) FILTER (place > own), '') AS upper
    FROM paths GROUP BY grp, pos, step
), folded AS (
    SELECT grp, pos, 0 AS step, altered AS node FROM leaves
    UNION ALL
    SELECT f.grp, f.pos, f.step + 1, sha256(s.lower || f.node || s.upper)
    FROM folded f JOIN steps s ON s.grp = f.grp AND s.pos = f.pos AND s.step = f.step
), proofs AS (
    SELECT grp, pos, sha256(string_agg(lower || upper, '' ORDER BY step)) AS proof_sha256 FROM steps GROUP BY grp, pos
), last AS (
    SELECT grp, pos, arg_max(node, step) AS folded_root FROM folded GROUP BY grp, pos
), top AS (
    SELECT node AS root FROM high WHERE n = 1
)
SELECT l.doc_id, l.leaf, s.subroot, top.root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256, f.folded_root,
       f.folded_root = top.root AS verified
FROM leaves l JOIN subroots s ON s.grp = l.grp JOIN last f ON f.grp = l.grp AND f.pos = l.pos
LEFT JOIN proofs p ON p.grp = l.grp AND p.pos = l.pos CROSS JOIN top
"""
