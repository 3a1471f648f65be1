"""DuckDB twin of the clustering query: every round spelled out as two tables."""
from __future__ import annotations


def rounds_sql(clusters: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: str = "2") -> str:
    distance = "list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    parts = [f"""kept AS MATERIALIZED (
            SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::HUGEINT) AS v FROM embeddings
            WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims})""",
             f"""c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
            FROM (SELECT sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM kept ORDER BY h, v LIMIT {clusters}))"""]
    for t in range(rounds + 1):
        parts.append(f"""a{t} AS MATERIALIZED (
            SELECT k.vec_id, any_value(k.v) AS v, min({{'d': {distance}, 'c': c.c}}) AS best
            FROM (SELECT *, row_number() OVER () AS r FROM kept) k, c{t} c GROUP BY k.r, k.vec_id)""")
        if t < rounds:
            parts.append(f"""c{t + 1} AS MATERIALIZED (
            SELECT o.c, coalesce(n.v, o.v) AS v FROM c{t} o LEFT JOIN (
                SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY d) AS v
                FROM (SELECT best.c AS c, d, sum(v[d]) AS s, count(*)::HUGEINT AS n FROM a{t}, range(1, {dims + 1}) r(d) GROUP BY ALL) GROUP BY c) n
            ON n.c = o.c)""")
    return "WITH " + ",\n        ".join(parts) + f"""
        SELECT a.vec_id, a.best.c::INTEGER AS cluster, a.best.d::BIGINT AS distance,
               (sum(a.best.d) OVER (PARTITION BY a.best.c))::BIGINT AS cluster_inertia, (sum(a.best.d) OVER ())::BIGINT AS inertia,
               sha256(array_to_string(c.v, ',')) AS centroid_sha256
        FROM a{rounds} a JOIN c{rounds} c ON c.c = a.best.c"""
