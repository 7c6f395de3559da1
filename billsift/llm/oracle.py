"""DuckDB SQL for the queries that SQL can answer on whole tables.

The others run trained models, tokenizers or edit distances; tests compare them with
brute force, a library or labels.
"""

from __future__ import annotations

_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
judged AS (
  SELECT *, CASE
      WHEN regexp_matches(role, '\\[\\#<:]|\\$') OR regexp_matches(text, '\\[\\#<:]|\\$') THEN 2
      WHEN regexp_matches(role, '### |</turn>|: ') OR regexp_matches(text, '### |</turn>') THEN 1
      ELSE 0 END AS escapes
  FROM turns
),
formatted AS (
  SELECT *, 14 + length(role) + length(text) + CASE escapes
      WHEN 2 THEN len(regexp_extract_all(role, '[\\#<:]')) + len(regexp_extract_all(text, '[\\#<:]'))
      WHEN 1 THEN len(regexp_extract_all(role, '### |</turn>|: ')) + len(regexp_extract_all(text, '### |</turn>|: '))
      ELSE 0 END AS chars
  FROM judged
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars,
  count(*) FILTER (WHERE escapes > 0) AS escaped_turns
FROM formatted GROUP BY conv_id
"""

_SUBSTRINGS = f"""
WITH split AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS words FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(words[i : i + 12], ' ') AS window_text
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM split)
),
owners AS (SELECT window_text, min(doc_id) AS owner FROM windows GROUP BY window_text),
lost AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS place
  FROM windows JOIN owners USING (window_text) WHERE owner < doc_id
),
placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM split),
judged AS (
  SELECT placed.doc_id, count(lost.place) AS n_removed,
    string_agg(word, ' ' ORDER BY placed.place) FILTER (WHERE lost.place IS NULL) AS left_text
  FROM placed LEFT JOIN lost ON lost.doc_id = placed.doc_id AND lost.place = placed.place
  GROUP BY placed.doc_id
)
SELECT split.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(left_text, '')) AS kept_sha256
FROM split LEFT JOIN judged USING (doc_id)
"""

_SIMILAR = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, {_WORDS.format(f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} AS words FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i : i + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM split WHERE len(words) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN sizes s ON s.doc_id = a.doc_id JOIN sizes t ON t.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, s.n, t.n
  HAVING 100 * count(*) >= 80 * (s.n + t.n - count(*))
),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT reached.doc_id, y FROM reached JOIN links ON x = other
)
SELECT split.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM split LEFT JOIN sizes USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) USING (doc_id)
"""

_TERMS = (
    "regexp_extract_all(translate(coalesce({0}, ''), '" + _UPPER + "', '" + _LOWER + "'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)
_LEXICAL = f"""
WITH occurrences AS (
  SELECT CAST(doc_id AS BIGINT) AS doc_id, unnest({_TERMS.format('text')}) AS term
  FROM documents WHERE doc_id IS NOT NULL
),
postings AS (SELECT doc_id, term, CAST(count(*) AS BIGINT) AS tf FROM occurrences GROUP BY ALL),
lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM postings GROUP BY doc_id),
totals AS (SELECT CAST(count(*) AS BIGINT) AS nd, CAST(sum(n) AS BIGINT) AS l FROM lengths),
frequencies AS (SELECT term, CAST(count(*) AS BIGINT) AS df FROM postings GROUP BY term),
asked AS (SELECT item_id, unnest({_TERMS.format('text')}) AS term FROM benchmark),
queries AS (SELECT item_id, term, CAST(count(*) AS BIGINT) AS q FROM asked GROUP BY ALL),
scores AS (
  SELECT queries.item_id, postings.doc_id, CAST(sum(
      queries.q
      * CAST(floor(1000.0 * ln((2.0 * totals.nd + 2) / (2.0 * frequencies.df + 1))) AS BIGINT)
      * ((1000000000 * postings.tf) // (1000 * postings.tf + 8 * (25 + (75 * lengths.n * totals.nd) // totals.l)))
    ) AS BIGINT) AS score
  FROM queries JOIN postings USING (term) JOIN frequencies USING (term) JOIN lengths USING (doc_id), totals
  GROUP BY ALL
),
ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM scores WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLES: dict[str, str] = {
    "op1_chat_formatting": _CHAT,
    "op4_substring_dedup": _SUBSTRINGS,
    "op7_ngram_jaccard_join": _SIMILAR,
    "op12_lexical_search": _LEXICAL,
}
