"""Independent SQL for the operators that plain SQL can express, for DuckDB."""

from __future__ import annotations

from tulha.llm.vectorcodes import ENTRIES, PARTS, ROUNDS, SCALE


def vector_codes() -> str:
    """Rounds of vector codes, every distance of every round computed."""
    ctes = {
        "kept": """
            SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) - 1 AS place, vec_id, label, embedding
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len([v FOR v IN embedding IF v IS NULL OR isnan(v) OR isinf(v)]) = 0""",
        "parts": f"""
            SELECT place, (d - 1) // (size // {PARTS}) AS part, (d - 1) % (size // {PARTS}) AS pos,
                   CAST(floor({SCALE} * CAST(v AS DOUBLE)) AS BIGINT) AS c
            FROM (SELECT place, len(embedding) AS size, unnest(embedding) AS v,
                         unnest(range(1, len(embedding) + 1)) AS d FROM kept)""",
        "book0": f"SELECT part, place AS entry, pos, c FROM parts WHERE place < {ENTRIES}",
    }
    for k in range(ROUNDS + 1):
        ctes[f"chosen{k}"] = f"""
            SELECT place, part, entry, dist
            FROM (SELECT p.place, p.part, b.entry, sum((p.c - b.c) * (p.c - b.c)) AS dist
                  FROM parts p JOIN book{k} b ON b.part = p.part AND b.pos = p.pos GROUP BY 1, 2, 3)
            QUALIFY row_number() OVER (PARTITION BY place, part ORDER BY dist, entry) = 1"""
        if k < ROUNDS:
            ctes[f"book{k + 1}"] = f"""
                SELECT b.part, b.entry, b.pos, coalesce(m.c, b.c) AS c
                FROM book{k} b
                LEFT JOIN (SELECT part, entry, pos, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS c
                           FROM (SELECT a.part, a.entry, p.pos, CAST(sum(p.c) AS BIGINT) AS s, count(*) AS n
                                 FROM chosen{k} a JOIN parts p ON p.place = a.place AND p.part = a.part
                                 GROUP BY 1, 2, 3)) m
                  ON m.part = b.part AND m.entry = b.entry AND m.pos = b.pos"""
    ctes["coded"] = f"""
        SELECT place, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(dist) AS BIGINT) AS error
        FROM chosen{ROUNDS} GROUP BY place"""
    ctes["digest"] = f"""
        SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256
        FROM book{ROUNDS}"""
    steps = ", ".join(f"{name} AS MATERIALIZED ({text})" for name, text in ctes.items())
    return f"""
        WITH {steps}
        SELECT k.vec_id, c.code, c.error,
               CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
               (SELECT codebooks_sha256 FROM digest) AS codebooks_sha256
        FROM kept k JOIN coded c ON c.place = k.place"""
