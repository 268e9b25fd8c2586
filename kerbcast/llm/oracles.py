"""The text queries in SQL for DuckDB, where SQL can express them over whole tables."""

from __future__ import annotations

ORACLES: dict[str, str] = {
    "op4_exact_copies": """
        WITH rows AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                            'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
            FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, text_sha256
        FROM rows WINDOW g AS (PARTITION BY text_sha256)""",
    "op11_divergence": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents),
        words AS (
            SELECT d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM docs),
        kept AS (
            SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT d) >= 3),
        v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
        counts AS (
            SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
        groups AS (SELECT DISTINCT lang, source FROM docs),
        full_counts AS (
            SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n
            FROM groups g JOIN kept k ON g.lang = k.lang
            LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
        p AS (
            SELECT f.lang, source, term, n,
                   1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER (PARTITION BY f.lang, source) + v) AS p
            FROM full_counts f JOIN v USING (lang)),
        q AS (
            SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER (PARTITION BY lang) + v) AS q
            FROM (SELECT lang, term, sum(n) AS n FROM full_counts GROUP BY lang, term) JOIN v USING (lang)),
        pairs AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
                   coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0)::BIGINT AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
            LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
            GROUP BY ALL),
        terms AS (
            SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value
            FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
        ranked AS (
            SELECT *, row_number() OVER (
                PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
            FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
        SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200""",
    # The visits of a source take its line from the front, over again when it is used up, until the target.
    "op12_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
            FROM documents),
        sources AS (
            SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS cap,
                   CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                       WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
            FROM sized GROUP BY source),
        levels AS (
            SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (
                           ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
                      / (sum(weight) OVER (
                           ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
            FROM sources),
        targets AS (SELECT *, least(cap::DOUBLE, max(level) OVER () * weight) AS target FROM levels),
        line AS (
            SELECT *, coalesce(sum(size) OVER (
                       PARTITION BY source ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id NULLS FIRST, size
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
            FROM sized)
        SELECT doc_id, size, source_size, target,
               CASE WHEN size = 0 THEN 0 ELSE
                   floor(target + 0.5)::BIGINT // source_size * size
                   + greatest(least(start + size, floor(target + 0.5)::BIGINT % source_size) - start, 0)
               END::BIGINT AS taken
        FROM line JOIN targets ON line.source IS NOT DISTINCT FROM targets.source""",
}
