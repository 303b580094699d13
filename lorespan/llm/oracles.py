"""DuckDB SQL for the operator queries that SQL can express on whole tables."""

from lorespan.llm import licenses

_WARC = """
WITH p AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
    SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_digest FROM p
), f AS (
    SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY 1
)
SELECT page_id, payload_bytes, d.payload_digest,
       CASE WHEN first_id IS NULL OR first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
"""

_LEAKS = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), iw AS (
    SELECT DISTINCT item_id, CASE WHEN len(w) >= 10 THEN w[k : k + 9] ELSE w END AS win
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM i WHERE len(w) > 0)
), widths AS (
    SELECT DISTINCT len(win) AS n FROM iw
), dw AS (
    SELECT doc_id, k, n, w[k : k + n - 1] AS win
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, widths WHERE len(w) >= n)
), m AS (
    SELECT doc_id, k, n, item_id FROM dw JOIN iw USING (win)
), h AS (
    SELECT doc_id, count(DISTINCT place)::BIGINT AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS place FROM m) GROUP BY 1
), t AS (
    SELECT doc_id, count(DISTINCT item_id)::BIGINT AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
    FROM m GROUP BY 1
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""

_TOP_K = """
WITH v AS (
    SELECT vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)
), r AS (
    SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

_LICENSES = r"""
WITH d AS (
    SELECT row_number() OVER () AS row, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), p(label, phrase) AS (VALUES {phrases}
), b AS (
    SELECT row, label, k - 1 AS place
    FROM (SELECT row, w, label, phrase, unnest(range(1, len(w) - len(phrase) + 2)) AS k FROM d, p WHERE len(w) >= len(phrase))
    WHERE w[k : k + len(phrase) - 1] = phrase
), base AS (
    SELECT row, count(*)::BIGINT AS n_base, min(place)::BIGINT AS first_word, max(place)::BIGINT AS last_word FROM b GROUP BY 1
), t(label, words, least, half) AS (VALUES {templates}
), halves AS (
    SELECT DISTINCT half FROM t
), blocks AS (
    SELECT row, half, w[k * half + 1 : k * half + 2 * half] AS own
    FROM (SELECT row, w, half, unnest(range(0, greatest(ceil(len(w) / half)::BIGINT - 1, 1))) AS k FROM d, halves WHERE len(w) > 0)
), m AS (
    SELECT row, label, len(list_intersect(words, own)) AS held, len(words) AS size, least FROM blocks JOIN t USING (half)
), best AS (
    SELECT row, max(held::DOUBLE / size::DOUBLE) AS share FROM m WHERE held >= least GROUP BY 1
), named AS (
    SELECT row, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
    FROM (SELECT row, label, true AS base FROM b UNION SELECT row, label, false FROM m WHERE held >= least) GROUP BY 1
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN base USING (row) LEFT JOIN best USING (row) LEFT JOIN named USING (row)
"""


def _licenses() -> str:
    def words(found) -> str:
        return "[" + ", ".join(f"'{w}'" for w in found) + "]"

    phrases = ", ".join(f"('{label}', {words(licenses.words_of(phrase))})" for phrase, label in licenses.PHRASES.items())
    templates = ", ".join(
        f"('{t.label}', {words(t.words)}, {t.least}, {t.half})" for t in licenses.prepared(licenses.TEMPLATES, licenses.PERCENT)
    )
    return _LICENSES.replace("{phrases}", phrases).replace("{templates}", templates)


_SEARCH = r"""
WITH d AS (
    SELECT row_number() OVER () AS row, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), s AS (
    SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0
), tf AS (
    SELECT row, doc_id, n, term, count(*)::BIGINT AS tf
    FROM (SELECT row, doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM i) GROUP BY ALL
), df AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
    FROM tf, s GROUP BY term, n_docs
), q AS (
    SELECT item_id, term, count(*)::BIGINT AS times FROM i GROUP BY ALL
), r AS (
    SELECT item_id, doc_id, row, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
    FROM q JOIN df USING (term) JOIN tf USING (term), s GROUP BY ALL
), k AS (
    SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
    FROM r WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 20
"""

SQL: dict[str, str] = {
    "op3_warc_round_trip": _WARC,
    "op4_benchmark_decontamination": _LEAKS,
    "op8_exact_top_k": _TOP_K,
    "op12_license_scan": _licenses(),
    "op13_ranked_search": _SEARCH,
}
