"""DuckDB SQL for the full-text and search oracles.

The SQL is an independent formulation of the same semantics (rows, window
functions, self-joins, ``product()``), driven by the same parsed query
literal; it is what ``queries()`` is checked against.
"""

from __future__ import annotations

from quarry import config
from quarry.functions import fulltext as ft
from quarry.functions.text import WORD_RE



def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def _in_list(lexs: list[str]) -> str:
    return ", ".join(q(x) for x in lexs) if lexs else "NULL"


def entries_ctes(src: str, lexs: list[str], content: str = "content",
                 meta: str | None = "metadata") -> str:
    """CTEs ``ent(id, lexeme, pos, w, j)`` with the text-vector limits, for the
    rows of CTE ``src`` (which has ``id``, content and metadata text)."""
    inl = _in_list(lexs)
    meta_part = ""
    if meta is not None:
        meta_part = f""",
tb AS (SELECT id, unnest(l) AS lexeme, generate_subscripts(l, 1) AS i
       FROM (SELECT id, regexp_extract_all(lower(coalesce({meta}, '')), '{WORD_RE}') AS l FROM {src})),
eb0 AS (SELECT DISTINCT tb.id, tb.lexeme, tb.i + mx.maxpos AS pos
        FROM tb JOIN mx ON tb.id = mx.id WHERE tb.lexeme IN ({inl})),
eb1 AS (SELECT *, row_number() OVER (PARTITION BY id, lexeme ORDER BY pos) AS jb FROM eb0),
ebk AS (SELECT eb1.id, eb1.lexeme, eb1.pos, coalesce(a.na, 0) + eb1.jb AS j
        FROM eb1 LEFT JOIN astat a ON a.id = eb1.id AND a.lexeme = eb1.lexeme)"""
    b_union = f"\n    UNION ALL SELECT id, lexeme, pos, {config.RANK_WEIGHTS['B']} AS w, j FROM ebk" \
        if meta is not None else ""
    return f"""
ta AS (SELECT id, unnest(l) AS lexeme, generate_subscripts(l, 1) AS i
       FROM (SELECT id, regexp_extract_all(lower(coalesce({content}, '')), '{WORD_RE}') AS l FROM {src})),
mx AS (SELECT id, len(regexp_extract_all(lower(coalesce({content}, '')), '{WORD_RE}')) AS maxpos FROM {src}),
ea0 AS (SELECT DISTINCT id, lexeme, i AS pos FROM ta WHERE lexeme IN ({inl})),
ea1 AS (SELECT *, row_number() OVER (PARTITION BY id, lexeme ORDER BY pos) AS j FROM ea0),
eak AS (SELECT id, lexeme, pos, j FROM ea1),
astat AS (SELECT id, lexeme, count(*) AS na, max(pos) AS lasta FROM eak GROUP BY id, lexeme){meta_part},
ent AS (SELECT id, lexeme, pos, {config.RANK_WEIGHTS['A']} AS w, j FROM eak{b_union}),
lists AS (SELECT id{''.join(f", coalesce(list(pos ORDER BY pos) FILTER (WHERE lexeme = {q(x)}), []) AS p_{k}" for k, x in enumerate(lexs))}
          FROM ent GROUP BY id)"""


def match_sql(node: ft.Node, idx: dict[str, int], alias: str = "ls") -> str:
    def p(x):
        return f"coalesce({alias}.p_{idx[x]}, [])"
    if node.op == "lex":
        return f"(len({p(node.lexeme)}) > 0)"
    if node.op in ("and", "or"):
        j = " AND " if node.op == "and" else " OR "
        return "(" + j.join(match_sql(k, idx, alias) for k in node.kids) + ")"
    if node.op == "not":
        return f"(NOT {match_sql(node.kids[0], idx, alias)})"
    if node.op == "phrase":
        first = node.kids[0].lexeme
        conds = " AND ".join(f"list_contains({p(k.lexeme)}, x + {o})"
                             for o, k in enumerate(node.kids[1:], start=1))
        return f"(len(list_filter({p(first)}, lambda x: {conds})) > 0)"
    raise ValueError(node.op)


def rank_ctes(tq: ft.TextQuery) -> str:
    """CTE ``rk(id, rank)`` over ``ent``."""
    lexs = tq.distinct_lexemes()
    if tq.tree is not None and tq.tree.op in ("and", "phrase") and len(lexs) >= 2:
        d = "CASE WHEN abs(e1.pos - e2.pos) > 100 THEN 1e-30 ELSE 1.0 / (1.005 + 0.05 * exp(abs(e1.pos - e2.pos) / 1.5 - 2)) END"
        return f""",
pr AS (SELECT e1.id, product(1 - sqrt(e1.w * e2.w * {d})) AS prod, count(*) AS np
       FROM ent e1 JOIN ent e2 ON e1.id = e2.id AND e1.lexeme < e2.lexeme AND e1.pos <> e2.pos
       GROUP BY e1.id),
rk AS (SELECT l.id, CASE WHEN coalesce(pr.np, 0) > 0 THEN 1 - pr.prod ELSE 1e-20 END AS rank
       FROM lists l LEFT JOIN pr ON pr.id = l.id)"""
    n = max(len(lexs), 1)
    return f""",
pl AS (SELECT id, lexeme, max(w) AS wmax, sum(w / (j * j)) AS s FROM ent GROUP BY id, lexeme),
pj AS (SELECT e.id, e.lexeme, min(e.j) AS jm FROM ent e JOIN pl ON pl.id = e.id AND pl.lexeme = e.lexeme
       WHERE e.w = pl.wmax GROUP BY e.id, e.lexeme),
rk AS (SELECT pl.id, sum((pl.wmax + pl.s - pl.wmax / (pj.jm * pj.jm)) / {ft.ZETA2}) / {n} AS rank
       FROM pl JOIN pj ON pj.id = pl.id AND pj.lexeme = pl.lexeme GROUP BY pl.id)"""


def lexical_sql(tq: ft.TextQuery | None, qtext: str | None, alias_row: str = "p",
                alias_lists: str = "ls", alias_rank: str = "rk") -> str:
    """Q4 as an SQL expression over the row, its lists and its rank."""
    if tq is None:
        return "0.0"
    if tq.tree is None:
        match = "FALSE"
    else:
        idx = {x: k for k, x in enumerate(tq.distinct_lexemes())}
        match = match_sql(tq.tree, idx, alias_lists)
    pat = q(ft.like_pattern(qtext))
    return (f"coalesce(CASE WHEN {match} THEN {alias_rank}.rank "
            f"WHEN {alias_row}.content ILIKE {pat} ESCAPE '\\' THEN 1.0 ELSE 0.0 END, 0.0)")


def dist_sql(metric: str, emb: str, qv: str) -> str:
    e = f"{emb}::DOUBLE[]"
    if metric == "cosine":
        return (f"CASE WHEN sqrt(list_dot_product({e}, {e})) * sqrt(list_dot_product({qv}, {qv})) = 0 "
                f"THEN 'NaN'::DOUBLE ELSE 1 - list_dot_product({e}, {qv}) / "
                f"(sqrt(list_dot_product({e}, {e})) * sqrt(list_dot_product({qv}, {qv}))) END")
    return f"(-list_dot_product({e}, {qv}))"


def search_sql(chunks_sql: str, qv_sql: str, qtext: str | None, match_count: int = 5,
               filter_json: str | None = None, weight_vec: float = 0.6, weight_lex: float = 0.4,
               min_score: float = 0.1, pool_multiplier: int = 10, metric: str = "cosine",
               min_cos_sim: float | None = None, final: bool = True) -> str:
    tq = ft.text_query(qtext)
    lexs = tq.distinct_lexemes() if tq is not None else []
    where = f"WHERE json_contains(c.metadata, {q(filter_json)})" if filter_json else ""
    floor = f"WHERE dist <= {1.0 - min_cos_sim!r}" if min_cos_sim is not None else ""
    ctes = f"""WITH chunks AS ({chunks_sql}),
qv AS (SELECT {qv_sql} AS q),
scored AS (SELECT c.id, c.content, c.metadata, {dist_sql(metric, 'c.embedding', 'qv.q')} AS dist
           FROM chunks c, qv {where}),
pool AS (SELECT * FROM scored {floor} ORDER BY dist, id LIMIT {int(match_count) * int(pool_multiplier)}),"""
    ctes += entries_ctes("pool", lexs)
    if tq is not None and lexs:
        ctes += rank_ctes(tq)
        joins = "LEFT JOIN lists ls ON ls.id = p.id LEFT JOIN rk ON rk.id = p.id"
    else:
        ctes += ",\nrk AS (SELECT NULL::BIGINT AS id, 0.0 AS rank)"
        joins = "LEFT JOIN lists ls ON ls.id = p.id LEFT JOIN rk ON rk.id = p.id"
    lex = lexical_sql(tq, qtext)
    ctes += f""",
s2 AS (SELECT p.id, p.content, p.metadata, 1 - p.dist AS sim, {lex} AS lex FROM pool p {joins}),
fin AS (SELECT id, content, metadata, sim, lex,
               CASE WHEN lex > 0 THEN {float(weight_vec)!r} * sim + {float(weight_lex)!r} * lex ELSE sim END AS score
        FROM s2)"""
    if not final:
        return ctes
    return ctes + f"""
SELECT id, content, metadata, round(score, 6) AS score FROM fin
WHERE score >= {float(min_score)!r} ORDER BY score DESC, id LIMIT {int(match_count)}"""
