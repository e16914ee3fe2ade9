"""DuckDB SQL for the queries that SQL over whole tables can express.

The others train, round at random, walk trees or need a tokenizer; ``tests/llm``
holds them against brute-force versions, the libraries and held-out accuracy.
"""

from __future__ import annotations

OP12 = r"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda v : v <> '') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
        FROM documents)),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
counts AS MATERIALIZED (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*)::HUGEINT AS f
  FROM starts, (SELECT unnest([1, 2, 3]) AS k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT lang, phrase, k, a, cut, array_to_string(w[1:cut], ' ') AS head, array_to_string(w[cut + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates)),
scored AS (
  SELECT c.lang, c.phrase, c.k, c.a, c.cut, x.f AS l, y.f AS r, (1000000::HUGEINT * c.a * c.a) // (x.f * y.f) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.head JOIN counts y ON y.lang = c.lang AND y.phrase = c.tail),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (
  SELECT lang, phrase, max(a) AS a
  FROM (SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM candidates WHERE k = 3) GROUP BY ALL),
kept AS (SELECT c.* FROM weakest c LEFT JOIN longer g ON g.lang = c.lang AND g.phrase = c.phrase WHERE g.a IS NULL OR 100 * g.a < 50 * c.a)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r,
       n, score::BIGINT AS score
FROM kept k JOIN totals t ON t.lang = k.lang QUALIFY rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op12_collocations": OP12}
