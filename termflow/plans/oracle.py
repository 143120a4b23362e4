"""Independent SQL (DuckDB dialect) for every deterministic registered query.

Tables are the pre-registered views ``documents``, ``pages``, ... Column
names and types match the Spark results. The text rules are re-stated in
SQL: line breaks ``\\r\\n | \\r | \\n``, split on single spaces with Java's
rules, lower-case, keep tokens longer than 3 chars made of letters only.
"""

from __future__ import annotations

# Documents as the feeder sent them: lines joined by single spaces, each
# line followed by one space.
_NORMALIZED = r"""
    SELECT doc_id,
           CASE WHEN text = '' THEN ''
                ELSE regexp_replace(regexp_replace(text, '(\r\n|\r|\n)\z', ''),
                                    '\r\n|\r|\n', ' ', 'g') || ' ' END AS content
    FROM documents"""


def _tokens(source: str, keep: str = "") -> str:
    """Term occurrences of ``source(content, ...)``."""
    k = f"{keep}, " if keep else ""
    return f"""
    SELECT {k}term FROM (
        SELECT {k}unnest(string_split(lower(content), ' ')) AS term FROM ({source}) s
    ) t WHERE length(term) > 3 AND regexp_full_match(term, '\\p{{L}}+')"""


_DOC_TOKENS = _tokens(_NORMALIZED, "doc_id")

_LANG_SOURCE = _NORMALIZED.replace("SELECT doc_id,", "SELECT doc_id, lang,")
_CONV_SOURCE = _NORMALIZED.replace("doc_id,", "").replace("documents", "conversations")
_LANG_TOKENS = _tokens(_LANG_SOURCE, "lang")

_TERM_COUNTS = f"SELECT term, count(*) AS cnt FROM ({_DOC_TOKENS}) x GROUP BY term"

_RANKED = f"""
    SELECT term, cnt, row_number() OVER (ORDER BY cnt DESC, term ASC) - 1 AS rank,
           count(*) OVER () AS total
    FROM ({_TERM_COUNTS}) c"""

_VOCAB = f"""
    SELECT term, cnt, rank AS term_idx FROM ({_RANKED}) r
    WHERE rank < total - 20"""

_LINES = r"""
    SELECT doc_id, unnest(range(len(arr))) AS line_no, unnest(arr) AS value FROM (
        SELECT doc_id,
               CASE WHEN text = '' THEN []::VARCHAR[]
                    ELSE regexp_split_to_array(regexp_replace(text, '(\r\n|\r|\n)\z', ''),
                                               '\r\n|\r|\n') END AS arr
        FROM documents) d"""

_LABEL_TOPICS = f"""
    SELECT tf.lang AS topic, tf.term, tf.tf, tf.tf / tot.total AS weight
    FROM (SELECT lang, term, count(*) AS tf FROM ({_LANG_TOKENS}) a GROUP BY lang, term) tf
    JOIN (SELECT lang, count(*) AS total FROM ({_LANG_TOKENS}) b GROUP BY lang) tot
      ON tf.lang = tot.lang"""

_TOP_TERMS = f"""
    SELECT topic, CAST(rank AS INTEGER) AS rank, term, tf, weight FROM (
        SELECT *, row_number() OVER (PARTITION BY topic ORDER BY weight DESC, term ASC) - 1
                  AS rank
        FROM ({_LABEL_TOPICS}) t) r
    WHERE rank < 10"""

_MERGED_LAST = f"SELECT term, arg_max(weight, topic) AS score FROM ({_TOP_TERMS}) t GROUP BY term"
_MERGED_MAX = f"SELECT term, max(weight) AS score FROM ({_TOP_TERMS}) t GROUP BY term"
_TOP_SCORES = f"SELECT term, score FROM ({_MERGED_LAST}) m ORDER BY score DESC, term ASC LIMIT 10"

# The edge texts: blank, null, carriage returns, adjacent and trailing spaces.
_EDGE = r"""(SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN NULL
    WHEN 1 THEN ' ' || chr(9) || chr(13) || chr(10) || chr(0) || ' '
    WHEN 2 THEN replace(text, chr(10), chr(13)) WHEN 3 THEN replace(text, chr(10), chr(13) || chr(10))
    WHEN 4 THEN replace(text, ' ', '  ') WHEN 5 THEN text || '  ' || chr(10) || chr(10)
    ELSE text END AS text FROM documents) e"""


def _by_source(sql: str) -> str:
    return sql.replace("lang", "source")


_BATCH_TOKENS = _tokens(_NORMALIZED.replace("SELECT doc_id,", "SELECT doc_id % 4 AS batch_id,"), "batch_id")

CORPUS_SQL = {
    "term_counts": _TERM_COUNTS,
    "term_rank": f"SELECT term, cnt, rank FROM ({_RANKED}) r",
    "tail_dropped_terms": f"SELECT term, cnt FROM ({_RANKED}) r WHERE rank >= total - 20",
    "vocabulary": _VOCAB,
    "vocab_size": f"SELECT count(*) - 20 AS vocab_size FROM ({_TERM_COUNTS}) c",
    "doc_term_tf": f"""
        SELECT t.doc_id, v.term_idx, count(*) AS tf
        FROM ({_DOC_TOKENS}) t JOIN ({_VOCAB}) v ON t.term = v.term
        GROUP BY t.doc_id, v.term_idx""",
    "word_count_raw": f"""
        SELECT word, count(*) AS cnt FROM (
            SELECT unnest(CASE WHEN value = '' THEN ['']
                               WHEN rtrim(value, ' ') = '' THEN []::VARCHAR[]
                               ELSE string_split(rtrim(value, ' '), ' ') END) AS word
            FROM ({_LINES}) l) w
        GROUP BY word""",
    "doc_lines": f"SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, value FROM ({_LINES}) l",
    "nonblank_lines": f"""
        SELECT doc_id, CAST(line_no AS INTEGER) AS line_no FROM ({_LINES}) l
        WHERE value IS NOT NULL AND regexp_matches(value, '[^\\x00-\\x20]')""",
    "doc_filter": """
        SELECT doc_id FROM documents
        WHERE text IS NOT NULL AND regexp_matches(text, '[^\\x00-\\x20]')""",
    "normalized_docs": _NORMALIZED,
    "arrival_notices": """
        SELECT page_id, 'New doc received: ' || url AS value FROM pages WHERE url IS NOT NULL""",
    "conversation_term_counts": f"""
        SELECT term, count(*) AS cnt FROM ({_tokens(_CONV_SOURCE)}) x
        GROUP BY term""",
    "quality_term_counts": f"""
        SELECT quality, term, count(*) AS cnt FROM ({_tokens(
            _NORMALIZED.replace('SELECT doc_id,', 'SELECT quality,')
            .replace('FROM documents', 'FROM documents JOIN labels USING (doc_id)'), 'quality')}) x
        GROUP BY quality, term""",
    "top_terms_by_label": _TOP_TERMS,
    "merged_scores_last": _MERGED_LAST,
    "merged_scores_max": _MERGED_MAX,
    "top_scores": _TOP_SCORES,
    "score_json_roundtrip": _TOP_SCORES,
    "display_words": f"""
        SELECT term AS text, CAST(trunc(10 + score * 1000) AS INTEGER) AS size
        FROM ({_TOP_SCORES}) s ORDER BY size DESC, text ASC""",
    "edge_doc_filter": f"""
        SELECT doc_id FROM {_EDGE}
        WHERE text IS NOT NULL AND regexp_matches(text, '[^\\x00-\\x20]')""",
    "edge_normalized_docs": _NORMALIZED.replace("FROM documents", f"FROM {_EDGE}"),
    "edge_arrival_notices": """
        SELECT page_id, 'New doc received: ' || url AS value FROM pages
        WHERE url IS NOT NULL AND page_id % 3 <> 0""",
    "source_scores_last": _by_source(_MERGED_LAST),
    "source_scores_max": _by_source(_MERGED_MAX),
    "batch_union_counts": f"""
        SELECT b.batch_id, t.term, count(*) AS cnt FROM ({_BATCH_TOKENS}) t
        JOIN (SELECT unnest(range(4)) AS batch_id) b ON t.batch_id <= b.batch_id GROUP BY 1, 2""",
    "document_index": """
        SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) - 1 AS doc_idx
        FROM conversations""",
    "score_messages": """
        SELECT doc_id, raw, CASE WHEN kind = 5 THEN 1 WHEN kind = 4 THEN 0 END AS n_scores,
               CASE WHEN kind = 5 THEN doc_id / 8 END AS score
        FROM (SELECT doc_id, doc_id % 6 AS kind, CASE doc_id % 6 WHEN 0 THEN good || ' junk'
              WHEN 1 THEN '[' || good || ']' WHEN 2 THEN 'w' || doc_id WHEN 3 THEN '{"w' || doc_id || '":"x"}'
              WHEN 4 THEN '{}' ELSE good END AS raw
              FROM (SELECT doc_id, '{"w' || doc_id || '":' || CAST(doc_id / 8 AS VARCHAR) || '}' AS good
                    FROM documents) g) r""",
}
CORPUS_SQL["edge_word_count_raw"] = CORPUS_SQL["word_count_raw"].replace("FROM documents", f"FROM {_EDGE}")
