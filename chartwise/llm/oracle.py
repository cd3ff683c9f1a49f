"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_OP2 = f"""
WITH item AS (SELECT DISTINCT item_id, {_WORDS.format("text")} AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(ws), 13) AS size,
               unnest(list_transform(generate_series(1, greatest(len(ws) - 12, 1)), lambda i: array_to_string(ws[i:i + 12], ' '))) AS w
        FROM item WHERE len(ws) > 0),
doc AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
seen AS (SELECT r, size, unnest(generate_series(1, len(ws) - size + 1)) AS pos, ws
         FROM doc, (SELECT DISTINCT size FROM win) WHERE len(ws) >= size),
hit AS (SELECT r, pos, seen.size, item_id FROM (SELECT r, size, pos, array_to_string(ws[pos:pos + size - 1], ' ') AS w FROM seen) AS seen
        JOIN win ON win.w = seen.w AND win.size = seen.size),
covered AS (SELECT r, count(DISTINCT pos) AS n FROM (SELECT r, unnest(generate_series(pos, pos + size - 1)) AS pos FROM hit) GROUP BY r),
named AS (SELECT r, count(*) AS n, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT r, item_id::VARCHAR AS i FROM hit) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_hit, coalesce(m.n, 0)::BIGINT AS n_items,
       sha256(coalesce(m.ids, '')) AS items_sha256, coalesce(c.n, 0) > 0 AND 20 * coalesce(c.n, 0) >= len(ws) AS contaminated
FROM doc LEFT JOIN covered c USING (r) LEFT JOIN named m USING (r)
"""

_OP11 = r"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
seen AS (SELECT r, coalesce(doc_id, 9223372036854775807) AS d, pos, array_to_string(ws[pos:pos + 12], ' ') AS w
         FROM (SELECT *, unnest(generate_series(1, len(ws) - 12)) AS pos FROM doc)),
hit AS (SELECT r, pos FROM seen JOIN (SELECT w, min(d) AS least FROM seen GROUP BY w) USING (w) WHERE least < d),
covered AS (SELECT DISTINCT r, unnest(generate_series(pos, pos + 12)) AS pos FROM hit),
lost AS (SELECT r, count(*) AS n FROM covered GROUP BY r),
word AS (SELECT r, unnest(generate_series(1, len(ws))) AS pos, unnest(ws) AS w FROM doc),
kept AS (SELECT r, string_agg(w, ' ' ORDER BY pos) AS t FROM word ANTI JOIN covered USING (r, pos) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(lost.n, 0)::BIGINT AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM doc LEFT JOIN lost USING (r) LEFT JOIN kept USING (r)
"""

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

_OP12 = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ws FROM documents),
stat AS (SELECT count(*) AS docs, sum(len(ws))::BIGINT AS words FROM doc WHERE len(ws) > 0),
item AS (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS ws FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)),
asked AS (SELECT q, t, count(*) AS times FROM (SELECT q, unnest(ws) AS t FROM item) GROUP BY q, t),
held AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ws) AS t FROM doc) WHERE t IN (SELECT t FROM asked) GROUP BY r, t),
weight AS (SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
           FROM (SELECT t, count(*) AS df FROM held GROUP BY t), stat),
scored AS (SELECT q, r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
           FROM held JOIN asked USING (t) JOIN weight USING (t)
                JOIN (SELECT r, 25 + (75 * len(ws)::BIGINT * docs) // words AS m FROM doc, stat) USING (r)
           GROUP BY q, r),
ranked AS (SELECT q, r, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank
           FROM scored JOIN doc USING (r) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked JOIN item USING (q) JOIN doc USING (r) WHERE rank <= 10
"""

_OP13 = r"""
WITH piece AS (SELECT row_number() OVER () AS p, lang, regexp_extract_all(t, '[^\x20\x09]+') AS ws
               FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS t FROM documents)),
place AS (SELECT lang, ws, unnest(generate_series(1, len(ws))) AS i FROM piece),
counted AS (SELECT lang, w, array_to_string(w, ' ') AS phrase, len(w) AS words, count(*) AS a
            FROM (SELECT lang, ws[i:i + size - 1] AS w FROM place, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE i + size - 1 <= len(ws))
            GROUP BY lang, w HAVING count(*) >= 30),
cut AS (SELECT c.lang, c.phrase, c.a, k, array_to_string(c.w[1:k], ' ') AS head, array_to_string(c.w[k + 1:], ' ') AS tail
        FROM counted c, (SELECT unnest([1, 2, 3]) AS k) WHERE k < words),
scored AS (SELECT cut.lang, cut.phrase, cut.a, h.a AS l, t.a AS r, (2000000 * cut.a::HUGEINT) // (h.a + t.a) AS score
           FROM cut JOIN counted h ON h.lang = cut.lang AND h.phrase = cut.head JOIN counted t ON t.lang = cut.lang AND t.phrase = cut.tail
           QUALIFY row_number() OVER (PARTITION BY cut.lang, cut.phrase ORDER BY score, k) = 1),
part AS (SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(a) AS longer
         FROM counted, (SELECT unnest([1, 2, 3]) AS i), (SELECT unnest([2, 3]) AS size) WHERE size < words AND i + size - 1 <= words GROUP BY ALL),
total AS (SELECT lang, count(*) AS n FROM place GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::INTEGER AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM scored LEFT JOIN part USING (lang, phrase) JOIN total USING (lang)
WHERE longer IS NULL OR 100 * longer < 80 * a
QUALIFY rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_decontaminate": _OP2, "op11_substrings": _OP11, "op12_search": _OP12, "op13_phrases": _OP13}
