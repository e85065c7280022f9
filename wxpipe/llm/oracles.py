"""What the registered queries must return, as SQL for DuckDB over the same tables."""

from __future__ import annotations

_KEPT_VECTORS = """
kept AS MATERIALIZED (
    SELECT vec_id, label,
           list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)"""

_OP11 = f"""
WITH {_KEPT_VECTORS},
flipped AS MATERIALIZED (
    SELECT vec_id, CAST(v AS DOUBLE[]) AS v,
           CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
    FROM kept WHERE label IS NOT NULL AND vec_id IS NOT NULL
),
scored AS MATERIALIZED (
    SELECT a.vec_id AS anchor_id, o.vec_id AS other_id, a.label = o.label AS alike,
           CAST(list_dot_product(a.v, o.v) AS BIGINT) AS score
    FROM flipped a JOIN flipped o ON a.vec_id % 100 = 0 AND a.vec_id <> o.vec_id
),
positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score
    FROM scored WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (
           PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id
       ) AS INTEGER) AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.alike
WHERE 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
QUALIFY rank <= 5
"""


def _rounds(rounds: int) -> str:
    """Common tables ``near0..n`` (entry of each part) and ``book0..n`` of k-means by part."""
    gap = " + ".join(f"(q.x[{i}] - b.x[{i}]) * (q.x[{i}] - b.x[{i}])" for i in range(1, 5))
    steps = []
    for n in range(rounds + 1):
        steps.append(f"""
near{n} AS MATERIALIZED (
    SELECT q.vec_id, q.p, any_value(q.x) AS x,
           min(({gap}) * 64 + b.e) % 64 AS e, min(({gap}) * 64 + b.e) // 64 AS gap
    FROM parts q JOIN book{n} b ON q.p = b.p GROUP BY q.vec_id, q.p
)""")
        if n < rounds:
            means = ", ".join(
                f"(sum(x[{i}]) - ((sum(x[{i}]) % count(*)) + count(*)) % count(*)) // count(*)"
                for i in range(1, 5)
            )
            steps.append(f"""
mean{n} AS (SELECT p, e, [{means}] AS x FROM near{n} GROUP BY p, e),
book{n + 1} AS MATERIALIZED (
    SELECT b.p, b.e, CAST(coalesce(m.x, b.x) AS BIGINT[]) AS x
    FROM book{n} b LEFT JOIN mean{n} m ON b.p = m.p AND b.e = m.e
)""")
    return ",".join(steps)


_OP12 = f"""
WITH {_KEPT_VECTORS},
parts AS MATERIALIZED (
    SELECT vec_id, p, v[p * 4 + 1 : p * 4 + 4] AS x FROM kept, range(16) AS r(p)
),
book0 AS MATERIALIZED (
    SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x
    FROM parts WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 64)
),
{_rounds(2)},
coded AS (
    SELECT vec_id, string_agg(lower(printf('%02x', CAST(e AS INTEGER))), '' ORDER BY p) AS code,
           CAST(sum(gap) AS BIGINT) AS error
    FROM near2 GROUP BY vec_id
),
final AS (
    SELECT sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256
    FROM (SELECT p, e, unnest(x) AS y, unnest(range(4)) AS i FROM book2)
)
SELECT c.vec_id, c.code, c.error,
       CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded c JOIN kept k ON c.vec_id = k.vec_id, final
"""


_BEFORE_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lower(text: str) -> str:
    """A-Z in lower case, everything else as it is; null is empty."""
    return f"translate(coalesce({text}, ''), '{_BEFORE_LOWER}', '{_BEFORE_LOWER.lower()}')"


def _escaped(text: str) -> str:
    """Length of a text in which three characters take two."""
    return rf"(length({text}) + length(regexp_replace({text}, '[^\\<>]', '', 'g')))"


_OP2 = rf"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations
    UNION ALL
    VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'),
           (-7, 1, 'assistant', '\### Assistant: </turn> ok')
),
marked AS (
    SELECT *, lag(role) OVER in_order IS DISTINCT FROM role AS begins
    FROM turns WINDOW in_order AS (PARTITION BY conv_id ORDER BY turn, role, text)
),
joined AS (
    SELECT conv_id, count(*) AS n_turns,
           string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS whole,
           coalesce(string_agg(text, '' ORDER BY turn, role, text)
                    FILTER (WHERE role = 'assistant'), '') AS loss,
           -- <turn:ROLE> and </turn> with its line end, or <next> between turns of one role
           CAST(sum({_escaped('text')}
                    + CASE WHEN begins THEN {_escaped('role')} + 15 ELSE 6 END) AS BIGINT)
               AS formatted_chars,
           CAST(count(*) FILTER (WHERE begins) AS BIGINT) AS n_blocks
    FROM marked GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars, n_blocks
FROM joined
"""

_WORD, _NO_WORD = r"[^\x20\x09-\x0D]+", r"^[\x20\x09-\x0D]*$"

_OP3 = rf"""
WITH split AS MATERIALIZED (
    SELECT doc_id, source, coalesce(text, '') AS body,
           regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda line: NOT regexp_matches(line, '{_NO_WORD}')) AS lines
    FROM documents
),
windows AS (
    SELECT doc_id, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM split)
),
again AS (
    SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
    FROM (SELECT doc_id, i FROM windows
          QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1), range(3) AS r(k)
    GROUP BY doc_id
),
rules AS MATERIALIZED (
    SELECT doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
           CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
           CAST(len(regexp_extract_all(body, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
           len(words) < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * len(words) AS base_failed
    FROM split LEFT JOIN again USING (doc_id)
),
hosts AS (
    SELECT source, CAST(count(*) AS DOUBLE) AS docs,
           CAST(count(*) FILTER (WHERE base_failed) AS DOUBLE) AS failed
    FROM rules WHERE source IS NOT NULL GROUP BY source
),
seen AS (
    SELECT count(*) AS hosts, sum(docs) AS docs, sum(failed) / sum(docs) AS mean,
           sum(failed * failed / docs) / sum(docs) AS square
    FROM hosts
),
-- the correlation within hosts, by the method of moments
moments AS (
    SELECT *, CASE WHEN mean * (1 - mean) > 0 AND hosts / docs < 1
                   THEN ((square - mean * mean) / (mean * (1 - mean)) - hosts / docs)
                        / (1 - hosts / docs) ELSE 0 END AS rho
    FROM seen
),
prior AS (
    SELECT least(greatest(mean, 1 / (docs + 2)), 1 - 1 / (docs + 2)) AS mean,
           CASE WHEN rho > 1e-6 AND rho < 1 THEN (1 - rho) / rho ELSE docs / hosts END AS strength
    FROM moments
),
heights AS (
    SELECT (i + 0.5) / 200000 AS pos,
           (mean * strength - 1) * ln((i + 0.5) / 200000)
           + ((1 - mean) * strength - 1) * ln(1 - (i + 0.5) / 200000) AS height
    FROM prior, range(200000) AS r(i)
),
quantile AS (
    SELECT min(pos) AS pos FROM (
        SELECT pos, sum(mass) OVER (ORDER BY pos) AS so_far, sum(mass) OVER () AS total
        FROM (SELECT pos, exp(height - max(height) OVER ()) AS mass FROM heights)
    ) WHERE so_far >= 0.99 * total
),
rejected AS (
    SELECT source FROM hosts, prior, quantile
    WHERE (failed + mean * strength) / (docs + strength)
          > greatest(least(quantile.pos, 0.5), 3 * mean / (1 + 2 * mean))
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       rejected.source IS NOT NULL AS host_rejected,
       NOT base_failed AND rejected.source IS NULL AS kept
FROM rules LEFT JOIN rejected USING (source)
"""

_PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_OP5 = rf"""
WITH docs AS MATERIALIZED (
    SELECT doc_id, regexp_extract_all({_lower('text')}, '{_PLAIN_WORD}') AS words FROM documents
),
items AS (
    SELECT item_id, regexp_extract_all({_lower('text')}, '{_PLAIN_WORD}') AS words FROM benchmark
),
windows AS MATERIALIZED (
    SELECT DISTINCT item_id, size, array_to_string(words[i : i + size - 1], ' ') AS part
    FROM (SELECT item_id, words, least(len(words), 13) AS size,
                 unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS i
          FROM items WHERE len(words) > 0)
),
places AS (
    SELECT doc_id, i, size, array_to_string(words[i : i + size - 1], ' ') AS part
    FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i
          FROM docs, (SELECT DISTINCT size FROM windows))
),
hits AS MATERIALIZED (SELECT doc_id, i, size, item_id FROM places JOIN windows USING (size, part)),
covered AS (
    SELECT doc_id, count(DISTINCT pos) AS n_hit
    FROM (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS pos FROM hits) GROUP BY doc_id
),
found AS (
    SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

_OP7 = rf"""
WITH RECURSIVE split AS MATERIALIZED (
    SELECT doc_id, regexp_extract_all({_lower('text')}, '{_WORD}') AS words FROM documents
),
shingles AS MATERIALIZED (
    SELECT DISTINCT doc_id, array_to_string(words[i : i + 2], ' ') AS part
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS i
          FROM split WHERE len(words) > 0)
),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both
    FROM shingles a JOIN shingles b ON a.part = b.part AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id
),
links AS MATERIALIZED (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * n_both >= 85 * (x.n + y.n - n_both)
),
reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
),
least_of AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id,
       doc_id = component_id AS kept
FROM documents JOIN least_of USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

# Texts as hex, two digits a byte, first cut into stretches so that substrings are found fast.
_OP9 = r"""
WITH bodies AS MATERIALIZED (
    SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS body FROM documents
),
stretches AS (
    SELECT doc_id, s, substring(body, s * 2000 + 1, 2098) AS part
    FROM (SELECT doc_id, body, unnest(range(0, length(body) // 2000 + 1)) AS s FROM bodies)
),
windows AS MATERIALIZED (
    SELECT doc_id, s * 1000 + k AS pos, substring(part, 2 * k + 1, 100) AS piece
    FROM (SELECT doc_id, s, part,
                 unnest(range(0, least(1000, length(part) // 2 - 49))) AS k FROM stretches)
),
firsts AS (SELECT piece, min(doc_id) AS first_id FROM windows GROUP BY piece),
gone AS MATERIALIZED (
    SELECT doc_id, pos FROM windows JOIN firsts USING (piece) WHERE doc_id > first_id
),
-- runs of windows that overlap or touch
runs AS (
    SELECT doc_id, min(pos) AS lo, max(pos) + 50 AS hi
    FROM (SELECT doc_id, pos, sum(fresh) OVER (PARTITION BY doc_id ORDER BY pos) AS run
          FROM (SELECT doc_id, pos,
                       CASE WHEN pos - lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) <= 50
                            THEN 0 ELSE 1 END AS fresh FROM gone))
    GROUP BY doc_id, run
),
edges AS (
    SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS before
    FROM runs
),
kept AS (
    SELECT doc_id, sum(hi - lo) AS n_removed, count(*) AS n_spans, max(hi) AS last,
           string_agg(substring(body, 2 * before + 1, 2 * (lo - before)), '' ORDER BY lo) AS front
    FROM edges JOIN bodies USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, CAST(length(body) // 2 AS BIGINT) AS n_bytes,
       CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(front, '') || substring(body, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM bodies LEFT JOIN kept USING (doc_id)
"""

#: Scores, samples and page texts have no SQL; lines within an edit distance would take hours.
ORACLES: dict[str, str] = {
    "op2_chat_format": _OP2,
    "op3_host_rules": _OP3,
    "op5_benchmark_scan": _OP5,
    "op7_chosen_path": _OP7,
    "op9_repeat_index": _OP9,
    "op11_threshold_join": _OP11,
    "op12_ball_codes": _OP12,
}
