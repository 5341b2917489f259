"""SQL of the queries that DuckDB can express, written apart from the Spark code."""

from __future__ import annotations

NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS g
  FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reached(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
lowest AS (SELECT a, min(b) AS b FROM reached GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(b, d.doc_id)) AS component_id,
  d.doc_id = least(d.doc_id, coalesce(b, d.doc_id)) AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest ON lowest.a = d.doc_id
"""

# Control strings of the template and of others (fixed values).
_CONTROLS = (
    "<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|startoftext|>", "<|endoftext|>", "<s>", "</s>", "<unk>", "<pad>", "[INST]", "[/INST]",
    "<<SYS>>", "<</SYS>>",
)


def _escaped_length(column: str) -> str:
    text = rf"replace({column}, '\', '\\')"
    for mark in _CONTROLS:
        text = rf"replace({text}, '{mark}', '{mark[0]}\{mark[1:]}')"
    return f"length({text})"


CHAT = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), joined AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
    sum({_escaped_length("role")} + {_escaped_length("text")} + {sum(map(len, _CONTROLS[:3]))})::BIGINT AS formatted_chars
  FROM said GROUP BY 1
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM joined
"""
