"""The registered queries of this package and their oracle SQL."""

from __future__ import annotations

from quarry.llm import (
    alignment,
    bpe,
    filter_audit,
    language,
    licenses,
    mixing,
    near_embeddings,
    quality,
    shingle_join,
    spotsigs,
    substrings,
    toxicity,
    warc,
)
from quarry.llm.common import prepare
from quarry.plans.registry import Query


def _prepared(fn: Query) -> Query:
    def run(spark, sf_dir):
        prepare(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


QUERIES: dict[str, Query] = {fn.__name__: _prepared(fn) for fn in (
    bpe.op1_byte_bpe,
    licenses.op2_license_scan,
    near_embeddings.op3_embedding_near_dedup,
    toxicity.op4_toxicity_crf,
    warc.op5_warc,
    mixing.op6_source_mixing,
    shingle_join.op7_ngram_jaccard_join,
    spotsigs.op8_spotsigs,
    quality.op9_quality_ftrl,
    substrings.op10_suffix_dedup,
    language.op11_language_id,
    alignment.op12_token_alignment,
    filter_audit.op13_filter_audit,
)}

# Components of a table link(a, b) that holds every link both ways, as label(a, low).
_COMPONENTS = """
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
label AS (SELECT a, least(a, min(b)) AS low FROM reach GROUP BY a)"""

ORACLES: dict[str, str] = {
    "op2_license_scan": licenses.oracle(),
    "op13_filter_audit": filter_audit.oracle(),
    # every pair of vectors
    "op3_embedding_near_dedup": f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
ok AS (SELECT * FROM v WHERE len(x) > 0 AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0
       AND len(list_filter(x, lambda c: c <> 0)) > 0),
link AS (SELECT p.vec_id AS a, q.vec_id AS b FROM ok p JOIN ok q
         ON p.vec_id <> q.vec_id AND len(p.x) = len(q.x) AND list_cosine_similarity(p.x, q.x) >= 0.9),
{_COMPONENTS}
SELECT v.vec_id, (SELECT count(*) FROM link WHERE a = v.vec_id) AS n_links,
       coalesce(label.low, v.vec_id) AS component_id, coalesce(label.low, v.vec_id) = v.vec_id AS kept
FROM v LEFT JOIN label ON label.a = v.vec_id""",
    # 20 bits of the digest are five hexadecimal or four base-32 digits
    "op5_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS payload_bytes, min(page_id) OVER (PARTITION BY body) AS low,
             list_transform(range(8), lambda g: CAST('0x' || substr(sha1(body), g * 5 + 1, 5) AS INTEGER)) AS v
      FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(v, lambda n: array_to_string(list_transform([15, 10, 5, 0], lambda s:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (n >> s) % 32 + 1, 1)), '')), '') AS payload_digest,
       CASE WHEN page_id = low THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> low THEN low END AS refers_to FROM d""",
    # every pair of documents that share a 5-gram
    "op7_ngram_jaccard_join": f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}_]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(list_transform(range(greatest(1, len(w) - 4)),
          lambda i: array_to_string(w[i + 1:i + 5], ' '))) AS gram FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
c AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS shared FROM g p JOIN g q
      ON p.gram = q.gram AND p.doc_id <> q.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
         WHERE shared >= 0.8 * (x.n + y.n - shared)),
{_COMPONENTS}
SELECT d.doc_id, (SELECT count(*) FROM link WHERE a = d.doc_id) AS n_links,
       coalesce(label.low, d.doc_id) AS class_id, coalesce(label.low, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN label ON label.a = d.doc_id""",
}
