"""The queries that SQL can express, in SQL over the given tables."""

from __future__ import annotations

from tulha.llm.chat import CLOSE, ESCAPED_OPEN, OPEN, SEPARATOR
from tulha.llm.mixing import SEED, SIZE_PATTERN
from tulha.llm.secrets import BASE_RULES, RULES
from tulha.llm.resampling import BUCKETS, LEAST_WORDS, PERCENT
from tulha.llm.resampling import SEED as DRAW_SEED
from tulha.llm.words import LOWER, UPPER, WORD_PATTERN

_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD_PATTERN}')"



def _secrets() -> str:
    """Each rule searched in every text; places follow from the lengths of what is between the matches."""
    parts = []
    for place, rule in enumerate(RULES):
        pattern = rule.pattern.replace("'", "''")
        least = f"AND length(regexp_extract(m[i], '{pattern}', {rule.group})) >= {rule.least}" if rule.least else ""
        parts.append(
            f"SELECT r, {place} AS place, '{rule.kind}' AS kind, list_sum(list_transform(g[1:i], lambda x: length(x))) "
            f"+ coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS s, length(m[i]) AS n "
            f"FROM (SELECT r, m, g, unnest(range(1, len(m) + 1)) AS i FROM (SELECT r, regexp_extract_all(text, '{pattern}') AS m, "
            f"regexp_split_to_array(text, '{pattern}') AS g FROM docs)) WHERE true {least}"
        )
    named = "kind || ':' || s::bigint || ':' || (s + n)::bigint"
    base = f"place < {len(BASE_RULES)}"
    counts = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE_RULES)
    counted = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE_RULES)
    return f"""
        WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
        spans AS ({" UNION ALL ".join(parts)}),
        joined AS (
            SELECT r, {counted}, string_agg({named}, ',' ORDER BY s, place) AS spans,
                string_agg({named}, ',' ORDER BY s, place) FILTER ({base}) AS base FROM spans GROUP BY r)
        SELECT doc_id, {counts}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM docs LEFT JOIN joined USING (r)"""


ORACLE_SQL: dict[str, str] = {
    "op1_secrets": _secrets(),
    "op2_chat_format": f"""
        WITH whole AS MATERIALIZED (
            SELECT conv_id, list(struct_pack(turn := turn, role := role, text := text) ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS t
            FROM conversations GROUP BY conv_id),
        prefixes AS (SELECT t AS longer, t[1:i] AS t FROM (SELECT DISTINCT t, unnest(range(1, len(t))) AS i FROM whole)),
        kept AS (
            SELECT t, min(conv_id) AS conv_id, count(*) AS copies FROM whole WHERE t NOT IN (SELECT t FROM prefixes) GROUP BY t)
        SELECT conv_id, len(t) AS n_turns,
            (copies - 1 + (SELECT count(*) FROM whole w WHERE len(w.t) < len(kept.t) AND kept.t[1:len(w.t)] = w.t))::bigint AS n_collapsed,
            list_aggregate(list_transform(t, lambda x: '{OPEN}' || replace(coalesce(x.role, 'unknown'), '{OPEN}', '{ESCAPED_OPEN}') || '{SEPARATOR}'
                || replace(coalesce(x.text, ''), '{OPEN}', '{ESCAPED_OPEN}') || chr(10) || '{CLOSE}'), 'string_agg', '') AS rendered
        FROM kept""",
    "op4_ngram_jaccard": f"""
        WITH RECURSIVE words AS MATERIALIZED (SELECT doc_id, {_WORDS} AS w FROM documents),
        grams AS MATERIALIZED (
            SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
        sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
        shared AS MATERIALIZED (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
        links AS MATERIALIZED (
            SELECT a, b, shared.n = x.n AND x.n = y.n AS same FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
            WHERE 5 * shared.n >= 4 * (x.n + y.n - shared.n)),
        reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT doc_id, b FROM reach JOIN links ON other = a)
        SELECT d.doc_id, (SELECT min(other) FROM reach r WHERE r.doc_id = d.doc_id) AS class_id,
            (SELECT count(*) FROM links WHERE a = d.doc_id) AS n_links,
            1 + (SELECT count(*) FROM links WHERE a = d.doc_id AND same) AS n_copies,
            coalesce((SELECT n FROM sizes s WHERE s.doc_id = d.doc_id), 0) AS n_grams
        FROM documents d""",
    "op5_decontamination": f"""
        WITH items AS (SELECT coalesce(item_id::varchar, '') AS item_id, {_WORDS} AS w FROM benchmark),
        windows AS MATERIALIZED (
            SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS k
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
        docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
        stretches AS (
            SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS k
            FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
        found AS MATERIALIZED (SELECT r, i, n, item_id FROM stretches JOIN windows USING (n, k)),
        hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM found) GROUP BY r),
        named AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY r)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)""",
    "op8_mixing": f"""
        WITH sized AS MATERIALIZED (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{SIZE_PATTERN}')) AS size FROM documents),
        sizes AS (SELECT source, sum(size)::bigint AS source_size FROM sized GROUP BY source),
        weighed AS (
            SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight, 2 * source_size AS cap FROM sizes),
        levels AS (
            SELECT *, (1.5::double * sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0)::double)
                / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0))::double AS level
            FROM weighed WINDOW o AS (ORDER BY cap::double / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        level AS (SELECT level FROM levels WHERE weight * level <= cap ORDER BY cap::double / weight, source NULLS LAST LIMIT 1),
        targets AS (
            SELECT source, source_size, least(cap::double, coalesce(weight * (SELECT level FROM level), cap::double)) AS target FROM weighed),
        wanted AS (SELECT *, least(round(target)::bigint, 2 * source_size) AS words FROM targets),
        placed AS (
            SELECT s.*, w.source_size, w.target, CASE WHEN w.source_size > 0 THEN words // w.source_size ELSE 0 END AS uses,
                words - CASE WHEN w.source_size > 0 THEN words // w.source_size ELSE 0 END * w.source_size AS rest,
                coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY md5('{SEED}:' || coalesce(doc_id::varchar, '') || ':' || size::varchar)
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::bigint AS before
            FROM sized s JOIN wanted w ON s.source IS NOT DISTINCT FROM w.source)
        SELECT doc_id, size::bigint AS size, source_size, target, (size * uses + greatest(0, least(size, rest - before)))::bigint AS taken FROM placed""",
    # The checksum goes byte by byte over all distinct features at once.
    "op12_resampling": f"""
        WITH RECURSIVE bits(x, n, v) AS (
            SELECT x, 0, x FROM range(256) t(x)
            UNION ALL SELECT x, n + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE n < 8),
        bytes AS MATERIALIZED (SELECT x, v FROM bits WHERE n = 8),
        texts AS (
            SELECT row_number() OVER () AS r, doc_id, true AS own, {_WORDS} AS w FROM documents
            UNION ALL SELECT NULL, NULL, false, {_WORDS} FROM benchmark),
        runs AS MATERIALIZED (
            SELECT r, doc_id, own, array_to_string(w[i:i + k - 1], ' ') AS f
            FROM (SELECT r, doc_id, own, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM texts, range(1, 4) t(k) WHERE len(w) >= k)),
        crc(f, hx, p, v) AS (
            SELECT f, hex(encode(f)), 1, 4294967295::bigint FROM (SELECT DISTINCT f FROM runs)
            UNION ALL
            SELECT f, hx, p + 2, xor(crc.v >> 8, bytes.v) FROM crc JOIN bytes ON bytes.x = xor(crc.v & 255, ('0x' || substr(hx, p, 2))::bigint)
            WHERE p < length(hx)),
        bucket AS MATERIALIZED (SELECT f, xor(v, 4294967295) % {BUCKETS} AS b FROM crc WHERE p > length(hx)),
        totals AS (SELECT count(*) FILTER (own)::double AS s_all, count(*) FILTER (NOT own)::double AS t_all FROM runs),
        gains AS MATERIALIZED (
            SELECT b, floor(1000 * ln((t + 1) * (s_all + {BUCKETS}) / ((s + 1) * (t_all + {BUCKETS}))))::bigint AS gain
            FROM (SELECT b, count(*) FILTER (own)::double AS s, count(*) FILTER (NOT own)::double AS t FROM runs JOIN bucket USING (f) GROUP BY b), totals),
        weighed AS (SELECT r, count(*) AS n_features, sum(gain)::bigint AS weight FROM runs JOIN bucket USING (f) JOIN gains USING (b) WHERE own GROUP BY r),
        scored AS (
            SELECT doc_id, len(w) >= {LEAST_WORDS} AS enough, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{DRAW_SEED}:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint AS score
            FROM texts LEFT JOIN weighed USING (r) WHERE own),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY enough ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place,
                5 * count(*) FILTER (enough) OVER () // 100 AS draws FROM scored)
        SELECT doc_id, n_features, weight, score, CASE WHEN enough AND place <= draws THEN place END AS rank FROM ranked""".replace("5 * count", f"{PERCENT} * count"),
    # Every document through every order, one step after another.
    "op13_filter_audit": r"""
        WITH RECURSIVE said AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
        docs AS (
            SELECT coalesce(source, '') AS part, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least FROM documents),
        tested AS MATERIALIZED (
            SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, map {
                'A': len(w) < 50, 'B': 100 * len(list_distinct(w)) < 65 * len(w),
                'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t),
                'D': regexp_matches(t, '[#$%&*|]'), 'E': coalesce(d.doc_id > least, false)} AS fails
            FROM docs d LEFT JOIN said s ON d.doc_id = s.doc_id),
        kinds AS MATERIALIZED (SELECT part, good, toxic, fails, count(*) AS n FROM tested GROUP BY ALL),
        orders(o) AS (
            SELECT unnest(['A', 'B', 'C', 'D', 'E'])
            UNION ALL SELECT o || l FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l) WHERE length(o) < 5 AND NOT contains(o, l)),
        steps AS (SELECT o, s, o[s] AS l FROM orders, range(1, 6) t(s) WHERE length(o) = 5),
        acted AS (
            SELECT part, o, s, l, good, toxic, n, fails[l] AS own,
                len(list_filter(range(1, s), lambda i: fails[o[i]])) > 0 AS gone,
                len(list_filter(map_values(fails), lambda x: x)) AS n_fails
            FROM kinds, steps),
        counted AS (
            SELECT part, o, s, l, coalesce(sum(n) FILTER (NOT gone AND NOT own), 0)::bigint AS kept, coalesce(sum(n) FILTER (own AND NOT gone), 0)::bigint AS removed,
                coalesce(sum(n) FILTER (own AND gone), 0)::bigint AS redundant, coalesce(sum(n) FILTER (own AND n_fails = 1), 0)::bigint AS unique_fails,
                coalesce(sum(n) FILTER (own AND NOT gone AND good), 0)::bigint AS good_lost, coalesce(sum(n) FILTER (own AND NOT gone AND toxic), 0)::bigint AS toxic_lost
            FROM acted GROUP BY ALL)
        SELECT part, o AS filter_order, s::integer AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
            sum(removed) OVER (PARTITION BY part, l)::bigint AS shapley FROM counted""".replace(chr(92) * 2, chr(92)),
}
