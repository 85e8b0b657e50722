"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from stratalake.llm.mixing import MAX_REPEATS, SEEDS, WEIGHTS, WORD
from stratalake.llm.queries import HOSTILE

_DRAW = "('0x' || substr(md5('{k}:' || coalesce(doc_id::varchar, '') || ':' || mark), 1, 13))::bigint::double / 4503599627370496.0"
_EXTRA = ", ".join(
    f"sum(CASE WHEN {_DRAW.format(k=k)} < rate - floor(rate) THEN size ELSE 0 END) AS x{k}" for k in range(SEEDS)
)
_OFF = "list_value(" + ", ".join(f"abs(target - f - x{k})" for k in range(SEEDS)) + ")"
_SEED_DRAW = "CASE seed " + " ".join(f"WHEN {k} THEN {_DRAW.format(k=k)}" for k in range(SEEDS)) + " END"

OP1 = f"""
WITH d AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::bigint AS size,
        substr(md5(coalesce(text, '')), 1, 16) AS mark FROM documents
), s AS (
    SELECT source, sum(size)::bigint AS source_size FROM d GROUP BY source
), w AS (
    SELECT *, list_value({', '.join(map(str, WEIGHTS))})[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1)::bigint]::double AS weight,
        source_size * {float(MAX_REPEATS)} AS cap FROM s
), o AS (
    -- Sources in the order in which they meet their caps; the capped ones are a prefix of it.
    SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS all_w,
        coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
        coalesce(sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_before
    FROM w
), l AS (
    -- Capping too few or too many leaves a smaller share.
    SELECT max((total - cap_before) / (all_w - w_before)) AS share FROM o
), t AS (
    SELECT source, source_size, least(cap, weight * (SELECT share FROM l)) AS target FROM w
), r AS (
    SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM t
), x AS (
    SELECT d.source, max(target) AS target, sum(floor(rate) * size) AS f, {_EXTRA}
    FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source GROUP BY d.source
), b AS (
    SELECT source, list_position({_OFF}, list_min({_OFF})) - 1 AS seed FROM x
)
SELECT doc_id, size, source_size, target,
    (size * (floor(rate) + CASE WHEN {_SEED_DRAW} < rate - floor(rate) THEN 1 ELSE 0 END))::bigint AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source JOIN b ON d.source IS NOT DISTINCT FROM b.source
"""

OP10 = rf"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '{HOSTILE}' UNION ALL SELECT -1, 1, 'assistant', '{HOSTILE}'
), e AS (
    SELECT *, regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') AS escaped,
        replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<', '\l') AS escaped_role FROM t
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::bigint AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(length('<|im_start|>') + length(escaped_role) + 1 + length(escaped) + length('<|im_end|>') + 1)::bigint AS formatted_chars,
    list_reduce(list_prepend('start', list(role ORDER BY turn NULLS LAST, role, text)), lambda state, role: CASE
        WHEN state = 'start' AND role IN ('system', 'user') THEN role WHEN state = 'system' AND role = 'user' THEN role
        WHEN state = 'user' AND role = 'assistant' THEN role WHEN state = 'assistant' AND role = 'user' THEN role
        ELSE 'refused' END) AS state, state <> 'refused' AS valid
FROM e GROUP BY conv_id
"""

OP5 = """
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), s AS (
    SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')) END) AS shingles FROM w
), n AS (
    SELECT doc_id, len(shingles)::bigint AS n FROM s
), u AS (
    SELECT doc_id, unnest(shingles) AS shingle FROM s
), i AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM u x JOIN u y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL
), l AS (
    SELECT a, b FROM i JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * common >= 85 * (na.n + nb.n - common)
), r AS (
    SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
)
SELECT n.doc_id, n.n AS n_shingles, least(n.doc_id, coalesce(min(r.b), n.doc_id)) AS component_id
FROM n LEFT JOIN r ON r.a = n.doc_id GROUP BY n.doc_id, n.n
"""

OP11 = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::double)) AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.e, b.e)::bigint AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 100 = 0
), p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::int AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

OP12 = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), w AS (
    SELECT doc_id, s, md5(array_to_string(words[s:s + 19], ' ')) AS passage FROM (SELECT *, unnest(range(1, len(words) - 18)) AS s FROM d)
), f AS (
    SELECT passage, min((doc_id, s)) AS first FROM w GROUP BY passage HAVING count(*) > 1
), g AS (
    -- Words of later windows, once each.
    SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS k FROM w JOIN f USING (passage) WHERE (doc_id, s) <> first
), l AS (
    SELECT doc_id, list(k) AS gone FROM g GROUP BY doc_id
), k AS (
    SELECT doc_id, len(words)::bigint AS n_words, len(coalesce(gone, []))::bigint AS n_removed, CASE WHEN gone IS NULL THEN words ELSE
        list_transform(list_filter(list_zip(words, range(1, len(words) + 1)), lambda p: NOT list_contains(gone, p[2])), lambda p: p[1]) END AS kept
    FROM d LEFT JOIN l USING (doc_id)
)
SELECT doc_id, n_words, n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k
"""

OP13 = r"""
WITH d AS (
    SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents
), k AS (
    SELECT lang, term FROM (SELECT lang, unnest(list_distinct(words)) AS term FROM d) GROUP BY ALL HAVING count(*) >= 30
), c AS (
    SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(words) AS term FROM d) SEMI JOIN k USING (lang, term) GROUP BY ALL
), v AS (
    SELECT lang, count(*) AS v FROM k GROUP BY lang
), g AS (
    SELECT g.lang, g.source, coalesce(v, 0) AS v, coalesce(total, 0) AS total FROM (SELECT DISTINCT lang, source FROM d) g
    LEFT JOIN v USING (lang) LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) USING (lang, source)
), p AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
        (1 + 1000000000::hugeint * (coalesce(c.n, 0) + 5) // (g.total + 5 * g.v))::bigint AS p
    FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), l AS (
    SELECT lang, term, (1 + 1000000000::hugeint * (sum(n) + 5) // (sum(sum(n)) OVER (PARTITION BY lang) + 5 * any_value(v)))::bigint AS q
    FROM c JOIN v USING (lang) GROUP BY lang, term
), f AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), r AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0)::bigint AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
    UNION ALL SELECT lang, source, 'term', term, p - q FROM p JOIN l USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::int AS rank
FROM r QUALIFY part = 'pair' OR rank <= 50
"""

ORACLE: dict[str, str] = {"op1_mix_sources": OP1, "op5_ngram_join": OP5, "op10_chat_format": OP10, "op11_hard_negatives": OP11, "op12_substring_dedup": OP12, "op13_source_divergence": OP13}
