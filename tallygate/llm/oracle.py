"""Reference SQL (DuckDB) of the operators that SQL can express."""

from __future__ import annotations

import re

from tallygate.llm import hard_negatives, secret_scan, threshold_clusters
from tallygate.llm.line_dedup import Window

_FOLD = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
         "'abcdefghijklmnopqrstuvwxyz')")


def _exact() -> str:
    return f"""
        WITH d AS (SELECT doc_id, {_FOLD} AS folded FROM documents),
        g AS (
            SELECT folded, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY folded
        )
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept,
               sha256(d.folded) AS text_sha256
        FROM d JOIN g USING (folded)
    """


def line_ctes(how: Window = Window(), source: str = "documents") -> str:
    """CTEs ending in ``lines`` (doc_id, i, line, gone), comparing whole lines.

    A line is gone if it lies in a stretch that occurs earlier and has three lines, or fewer with
    enough words.  Every line of a longer stretch lies in one of three lines.
    """
    if how.lines != 3 or not how.ends:
        raise ValueError("written out for windows of three lines, extended both ways")
    return f"""
        l AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS i
            FROM {source}
        ),
        e AS (
            SELECT doc_id, i, line, length(line) - length(replace(line, ' ', '')) + 1 AS w,
                   row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k
            FROM l WHERE replace(line, ' ', '') <> ''
        ),
        n AS (
            SELECT *, lead(line) OVER o AS line1, lead(line, 2) OVER o AS line2,
                   lead(w) OVER o AS w1, lead(i) OVER o AS i1, lead(i, 2) OVER o AS i2
            FROM e WINDOW o AS (PARTITION BY doc_id ORDER BY i)
        ),
        v AS (
            SELECT doc_id, k, i, i AS last, [line] AS content FROM n WHERE w >= {how.words}
            UNION ALL
            SELECT doc_id, k, i, i1, [line, line1] FROM n WHERE w + w1 >= {how.words}
            UNION ALL
            SELECT doc_id, k, i, i2, [line, line1, line2] FROM n WHERE line2 IS NOT NULL
        ),
        f AS (
            SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, k) AS nth FROM v
        ),
        gone AS (
            SELECT DISTINCT e.doc_id, e.i
            FROM f JOIN e ON e.doc_id = f.doc_id AND e.i BETWEEN f.i AND f.last WHERE f.nth > 1
        ),
        lines AS (
            SELECT l.doc_id, l.i, l.line, gone.i IS NOT NULL AS gone
            FROM l LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.i = l.i
        )"""


def _line_dedup() -> str:
    return f"""
        WITH {line_ctes()},
        r AS (
            SELECT doc_id, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS run
            FROM lines WHERE gone
        ),
        runs AS (
            SELECT doc_id, string_agg(concat(lo, '-', hi), ',' ORDER BY lo) AS runs
            FROM (SELECT doc_id, min(i) AS lo, max(i) AS hi FROM r GROUP BY doc_id, run)
            GROUP BY doc_id
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_deleted,
               coalesce(any_value(runs.runs), '') AS runs,
               coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text
        FROM lines LEFT JOIN runs USING (doc_id) GROUP BY doc_id
    """


def _either_case(pattern: str) -> str:
    """``(?i:...)`` as letter classes: DuckDB's flag also folds letters beyond ASCII into them."""
    def classes(m: re.Match) -> str:
        return "(?:" + re.sub("[a-z]", lambda c: f"[{c[0].upper()}{c[0]}]", m[1]) + ")"

    return re.sub(r"\(\?i:([^()]*)\)", classes, pattern)


def _spans(kind: int) -> str:
    name, pattern, group, least = secret_scan.KINDS[kind]
    p = _either_case(pattern).replace("'", "''")
    if "(?i" in p:
        raise ValueError(f"case folding left in {p}")
    return f"""
        SELECT doc_id, {kind} AS kind, e - length(m) AS s, e FROM (
            SELECT doc_id, m, v,
                   sum(length(g) + length(m)) OVER (PARTITION BY doc_id ORDER BY j) AS e
            FROM (
                SELECT doc_id, unnest(regexp_extract_all(text, '{p}', 0)) AS m,
                       unnest(regexp_extract_all(text, '{p}', {group})) AS v,
                       unnest(string_split_regex(text, '{p}')[:-2]) AS g,
                       generate_subscripts(regexp_extract_all(text, '{p}', 0), 1) AS j
                FROM documents WHERE text IS NOT NULL
            )
        ) WHERE length(v) >= {least}"""


def _secrets(scope: int = secret_scan.Scope().scope) -> str:
    number = {name: k for k, (name, *_) in enumerate(secret_scan.KINDS)}
    names = ", ".join(f"'{n}'" for n in number)
    secret, ident = "(0, 2, 4)", "(1, 3)"

    def near(kinds: str) -> str:
        return (f"EXISTS (SELECT 1 FROM p q WHERE q.doc_id = p.doc_id AND q.kind IN {kinds} "
                f"AND q.s <= p.e + {scope} AND q.e >= p.s - {scope})")

    text = f"concat(([{names}])[kind + 1], ':', s, ':', e)"
    return f"""
        WITH p AS ({" UNION ALL ".join(_spans(k) for k in range(len(number)))}),
        x AS (
            SELECT * FROM p WHERE kind < 3 OR (kind = 3 AND {near(secret)})
            OR (kind = 4 AND ({near(ident)} OR {near("(5)")}))
            OR (kind = 5 AND {near(ident)} AND {near(secret)})
        ),
        a AS (
            SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign,
                   count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
                   string_agg({text}, ',' ORDER BY s, kind) FILTER (kind < 3) AS base,
                   string_agg({text}, ',' ORDER BY s, kind) AS spans
            FROM x GROUP BY doc_id
        )
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
               coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
               coalesce(spans, '') AS spans
        FROM documents LEFT JOIN a USING (doc_id)
    """


def _clusters(how: threshold_clusters.KMeans | None = None) -> str:
    """k-means round by round: long rows (vector, dimension), one centroid table a round."""
    how = how or threshold_clusters.KMeans()
    ctes = [f"""
        v AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id, embedding) AS n, vec_id,
                   list_transform(embedding, lambda x: floor({how.scale} * x::DOUBLE)::BIGINT) AS x
            FROM embeddings
            WHERE len(embedding) = {how.dims} AND len(list_filter(embedding, lambda x:
                  x IS NULL OR NOT isfinite(x))) = 0
        ),
        c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('{how.seed}:' || vec_id), x) - 1 AS cluster, x
            FROM v WHERE vec_id IS NOT NULL
            QUALIFY cluster < {how.clusters}
        )"""]

    def assigned(c: str) -> str:
        return f"""
            SELECT n, any_value(vec_id) AS vec_id, arg_min(cluster, (d, cluster)) AS cluster,
                   min(d) AS d
            FROM (SELECT n, vec_id, cluster, list_sum(list_transform(list_zip(v.x, {c}.x),
                         lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM v, {c})
            GROUP BY n"""

    for i in range(how.rounds):
        ctes.append(f"""
        a{i} AS MATERIALIZED ({assigned(f"c{i}")}),
        s{i} AS (
            SELECT cluster, j, sum(x[j])::BIGINT AS s, count(*) AS m
            FROM a{i} JOIN v USING (n), range(1, {how.dims + 1}) AS r(j) GROUP BY cluster, j
        ),
        c{i + 1} AS MATERIALIZED (
            SELECT cluster, coalesce(y, x) AS x FROM c{i} LEFT JOIN (
                SELECT cluster, list((s - ((s % m) + m) % m) // m ORDER BY j) AS y
                FROM s{i} GROUP BY cluster
            ) USING (cluster)
        )""")
    last = f"c{how.rounds}"
    return f"""
        WITH {",".join(ctes)},
        f AS MATERIALIZED ({assigned(last)})
        SELECT vec_id, cluster::INTEGER AS cluster, d AS distance,
               sum(d) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
               sum(d) OVER ()::BIGINT AS inertia,
               sha256(array_to_string({last}.x, ',')) AS centroid_sha256
        FROM f JOIN {last} USING (cluster)
    """


def _negatives(how: hard_negatives.Mining | None = None) -> str:
    how = how or hard_negatives.Mining()
    shifted = "label::BIGINT" if not how.shift_step else (
        f"CASE WHEN vec_id % {how.shift_step} = 0 THEN (label::BIGINT + 1) % {how.labels} "
        "ELSE label END")
    return f"""
        WITH r AS MATERIALIZED (
            SELECT vec_id, {shifted} AS label,
                   list_transform(embedding, lambda x: floor({how.scale} * x::DOUBLE)) AS x
            FROM embeddings
            WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        s AS MATERIALIZED (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                   list_dot_product(a.x, b.x)::BIGINT AS score
            FROM r a JOIN r b ON a.vec_id <> b.vec_id OR a.label <> b.label
            WHERE a.vec_id % {how.anchor_step} = 0
        ),
        p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id)
                    <= {how.positives}
        )
        SELECT anchor_id, positive_id,
               row_number() OVER (PARTITION BY anchor_id, positive_id
                                  ORDER BY score DESC, vec_id)::INTEGER AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE NOT same AND {how.low_percent} * positive_score <= 100 * score
          AND 100 * score <= {how.high_percent} * positive_score
        QUALIFY rank <= {how.negatives}
    """


ORACLE_SQL: dict[str, str] = {
    "op2_secret_scan": _secrets(),
    "op3_exact_dedup": _exact(),
    "op7_line_dedup": _line_dedup(),
    "op12_threshold_clusters": _clusters(),
    "op13_hard_negatives": _negatives(),
}
