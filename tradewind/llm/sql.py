"""DuckDB SQL for the rows of the queries that SQL can express."""

from __future__ import annotations

from tradewind.llm import centroids, divergence

_APART = "CAST(list_sum(list_transform(list_zip(k.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)"


def _nearest(number: int) -> str:
    """The nearest of centroids c<number> of each kept vector."""
    return f"""a{number} AS MATERIALIZED (
    SELECT r, vec_id, v, cluster, distance
    FROM (
        SELECT k.r, k.vec_id, k.v, c.c AS cluster, {_APART} AS distance
        FROM kept k CROSS JOIN c{number} c
    )
    QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, cluster) = 1
)"""


def _moved(number: int) -> str:
    """Centroids c<number + 1>: the floor of the means, or the centroid of an empty cluster as it is."""
    return f"""m{number} AS (
    SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v
    FROM (SELECT cluster, i, sum(x) AS s, count(*) AS n FROM (
        SELECT cluster, unnest(v) AS x, unnest(range(1, {centroids.DIMENSIONS + 1})) AS i FROM a{number}) GROUP BY cluster, i)
    GROUP BY cluster
),
c{number + 1} AS MATERIALIZED (
    SELECT c.c, coalesce(m.v, c.v) AS v FROM c{number} c LEFT JOIN m{number} m ON m.cluster = c.c
)"""


_ROUNDS = ",\n".join(f"{_nearest(n)},\n{_moved(n)}" for n in range(centroids.ROUNDS))
CENTROID_CLUSTERING = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id,
        list_transform(embedding, lambda x: CAST(floor({centroids.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE len(embedding) = {centroids.DIMENSIONS}
        AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {centroids.DIMENSIONS}
),
c0 AS MATERIALIZED (
    SELECT place - 1 AS c, v
    FROM (SELECT v, row_number() OVER (ORDER BY sha256('{centroids.SEED}:' || vec_id), v) AS place FROM kept WHERE vec_id IS NOT NULL)
    WHERE place <= {centroids.CENTROIDS}
),
{_ROUNDS},
{_nearest(centroids.ROUNDS)}
SELECT a.vec_id, CAST(a.cluster AS INTEGER) AS cluster, a.distance,
    CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
    CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
    sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{centroids.ROUNDS} a JOIN c{centroids.ROUNDS} c ON c.c = a.cluster
"""

_SHARE = "1 + (CAST({one} AS HUGEINT) * ({count} + {prior})) // ({total} + {prior} * {kept})"


def _share(count: str, total: str, kept: str) -> str:
    return _SHARE.format(one=divergence.ONE, prior=divergence.PRIOR, count=count, total=total, kept=kept)


SOURCE_DIVERGENCE = rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
),
w AS MATERIALIZED (SELECT r, lang, source, unnest(terms) AS term FROM d),
kept AS MATERIALIZED (
    SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= {divergence.LEAST_DOCS}
),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
counts AS MATERIALIZED (
    SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term
),
groups AS MATERIALIZED (
    SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total
    FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN counts c USING (lang, source) GROUP BY g.lang, g.source
),
p AS MATERIALIZED (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, {_share("coalesce(c.n, 0)", "g.total", "v.v")} AS p
    FROM groups g JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN counts c USING (lang, source, term)
),
q AS (
    SELECT c.lang, c.term, {_share("sum(c.n)", "any_value(t.total)", "any_value(v.v)")} AS q
    FROM counts c JOIN (SELECT lang, sum(total) AS total FROM groups GROUP BY lang) t USING (lang) JOIN v USING (lang)
    GROUP BY c.lang, c.term
),
apart AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
),
more AS (
    SELECT p.lang, p.source, 'term' AS part, p.term AS item, p.p - q.q AS value
    FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM more)
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= {divergence.TOP}
"""
