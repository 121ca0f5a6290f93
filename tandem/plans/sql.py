"""Shared DuckDB SQL fragments for the oracles (1-based lists)."""

# Pair fixture: every consecutive line pair of every document (an odd last
# line with an empty one), each with a score from events; whitespace word
# counts.
PAIRS_CTE = """
l AS (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents),
lk AS (SELECT doc_id, a, unnest(range(0, (len(a) + 1) // 2)) AS k FROM l),
p AS (SELECT doc_id * (SELECT max((len(a) + 1) // 2) FROM l) + k AS id, a[2*k+1] AS en,
             coalesce(a[2*k+2], '') AS vi,
             (doc_id*10 + k) % (SELECT count(*) FROM events) AS score_key FROM lk),
sent AS (SELECT id * 2 AS sent_id, 'en' AS lang, en AS t FROM p
         UNION ALL SELECT id * 2 + 1, 'vi', vi FROM p),
ps AS (SELECT p.id, p.en, p.vi, CAST(e.value/50 AS FLOAT) AS score
       FROM p LEFT JOIN events e ON e.event_id = p.score_key),
pl AS (SELECT ps.*,
              CAST(len(regexp_extract_all(coalesce(en, ''), '\\S+')) AS BIGINT) AS len_en,
              CAST(len(regexp_extract_all(coalesce(vi, ''), '\\S+')) AS BIGINT) AS len_vi
       FROM ps)
"""

LEN_OK = "len_en BETWEEN 3 AND 150 AND len_vi BETWEEN 3 AND 150"
RATIO_OK = "len_en > 0 AND len_vi > 0 AND len_en*2.0 >= len_vi AND len_vi*2.0 >= len_en"
SCORE_OK = "NOT isnan(score) AND score > CAST(1.0872 AS FLOAT)"


def md5_sql(seed: str, *parts: str) -> str:
    """The seeded 60-bit number of ``batching.md5_key`` in SQL."""
    text = " || ':' || ".join([f"'{seed}'", *(f"({p})::VARCHAR" for p in parts)])
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


def with_pairs(body: str) -> str:
    return "WITH " + PAIRS_CTE.strip() + "\n" + body.strip()
