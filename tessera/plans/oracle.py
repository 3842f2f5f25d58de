"""DuckDB SQL for each named query (the correctness oracle).

The SQL re-derives every input from the base tables, exactly as the Spark
code does, and rounds floating results to the same number of digits.
Shared CTEs are kept in ``CTES`` and pulled in by name in dependency order.
"""

from __future__ import annotations

ROUND = 6

MD5_INT = "CAST('0x' || substr(md5({k}), 1, 8) AS BIGINT)"


def md5_int(expr: str) -> str:
    return MD5_INT.format(k=expr)


CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "ratings": ((), """
        SELECT o_custkey AS user_id, l_partkey AS item_id,
               MAX(CAST(ceil(l_quantity / 5) AS DOUBLE) / 2) AS rating
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        GROUP BY o_custkey, l_partkey"""),
    "split": (("ratings",), f"""
        SELECT user_id, item_id, rating,
               CASE WHEN b < 8 THEN 'train' WHEN b < 9 THEN 'valid' ELSE 'test' END AS split
        FROM (SELECT *, {md5_int("concat(user_id, '_', item_id, '_1')")} % 10 AS b
              FROM ratings) t"""),
    "train": (("split",), "SELECT user_id, item_id, rating FROM split WHERE split = 'train'"),
    "evalpairs": (("split",), "SELECT user_id, item_id, rating, split FROM split WHERE split <> 'train'"),
    "testpairs": (("split",), "SELECT user_id, item_id, rating FROM split WHERE split = 'test'"),
    "user_avg": (("train",), """
        SELECT user_id, SUM(rating) / (COUNT(*) + 1e-9) AS user_avg FROM train GROUP BY user_id"""),
    "item_avg": (("train",), """
        SELECT item_id, SUM(rating) / (COUNT(*) + 1e-9) AS item_avg FROM train GROUP BY item_id"""),
    "global_avg": (("train",), "SELECT SUM(rating) / COUNT(*) AS global_avg FROM train"),
}


def with_ctes(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in CTES[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    parts = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order)
    return f"WITH {parts}\n{body}"


def r(expr: str, digits: int = ROUND) -> str:
    return f"round({expr}, {digits})"


def define(name: str, deps: tuple[str, ...], sql: str) -> None:
    CTES[name] = (deps, sql)


def baseline_pred_sql(method: str) -> tuple[str, tuple[str, ...]]:
    """SELECT list producing ``pred`` for eval pairs ``p`` and its CTE deps."""
    if method == "global":
        return "(SELECT global_avg FROM global_avg)", ("global_avg",)
    if method == "user":
        return "COALESCE(ua.user_avg, 0)", ("user_avg",)
    if method == "item":
        return "COALESCE(ia.item_avg, 0)", ("item_avg",)
    g = "(SELECT global_avg FROM global_avg)"
    return (f"({g} + (COALESCE(ua.user_avg, 0) - {g}) + (COALESCE(ia.item_avg, 0) - {g}))",
            ("global_avg", "user_avg", "item_avg"))


def baseline_join(pairs: str) -> str:
    return (f"{pairs} p LEFT JOIN user_avg ua ON p.user_id = ua.user_id "
            f"LEFT JOIN item_avg ia ON p.item_id = ia.item_id")


# ------------------------------------------------------- neighbourhood CF -----

def _other(entity: str) -> str:
    return "item_id" if entity == "user_id" else "user_id"


def cf_ctes(entity: str, k: int, targets: str | None, prefix: str) -> list[str]:
    """CTE bodies (name, deps, sql) for stats, centred rows, sims and top-k.

    ``targets`` is a CTE with an ``entity`` column restricting the left side
    of the self-join (None = all entities).
    """
    f = _other(entity)
    p = prefix
    define(f"{p}stat", ("train",), f"""
        SELECT {entity}, n, s / n AS mean, s / (n + 1e-9) AS avg,
               sqrt(greatest(ss - s * s / n, 0)) AS norm
        FROM (SELECT {entity}, COUNT(*) AS n, SUM(rating) AS s, SUM(rating * rating) AS ss
              FROM train GROUP BY {entity}) t""")
    define(f"{p}cent", (f"{p}stat",), f"""
        SELECT t.{entity}, t.{f}, t.rating - s.mean AS c,
               (t.rating - s.mean) / (s.norm + 1e-9) AS cn
        FROM train t JOIN {p}stat s ON t.{entity} = s.{entity}
        WHERE t.rating - s.mean <> 0""")
    where = f"WHERE x.{entity} IN (SELECT {entity} FROM {targets})" if targets else ""
    deps = (f"{p}cent",) + ((targets,) if targets else ())
    define(f"{p}sims", deps, f"""
        SELECT x.{entity} AS a, y.{entity} AS b, SUM(x.cn * y.cn) AS sim
        FROM {p}cent x JOIN {p}cent y ON x.{f} = y.{f} AND x.{entity} <> y.{entity}
        {where}
        GROUP BY x.{entity}, y.{entity}""")
    define(f"{p}nent", ("ratings",), f"SELECT COUNT(DISTINCT {entity}) AS n FROM ratings")
    define(f"{p}nbrs", (f"{p}sims", f"{p}nent"), f"""
        SELECT a, b, sim, rank FROM (
            SELECT a, b, sim, row_number() OVER (PARTITION BY a ORDER BY round(sim, 9) DESC, b) AS rank
            FROM {p}sims WHERE sim > 0) t WHERE rank <= {k}
        UNION ALL
        SELECT a, b, sim, ((SELECT n FROM {p}nent) - 1) - nn + j AS rank FROM (
            SELECT a, b, sim, row_number() OVER (PARTITION BY a ORDER BY round(sim, 9) DESC, b) AS j,
                   COUNT(*) OVER (PARTITION BY a) AS nn
            FROM {p}sims WHERE sim < 0) t
        WHERE j <= {k} AND ((SELECT n FROM {p}nent) - 1) - nn + j <= {k}""")
    return [f"{p}nbrs", f"{p}stat", f"{p}cent"]


def cf_predict_sql(entity: str, k: int, pairs: str, bias: bool = True,
                   select: str | None = None, tail: str = "", digits: int | None = ROUND):
    """Prediction SQL for the rows of the ``pairs`` CTE."""
    f = _other(entity)
    p = f"{entity[0]}{'b' if bias else 'r'}{k}_"
    define(f"{p}tgt", (pairs,), f"SELECT DISTINCT {entity} FROM {pairs}")
    names = cf_ctes(entity, k, f"{p}tgt", p)
    if bias:
        vals = f"SELECT {entity} AS b, {f}, c AS v FROM {p}cent"
    else:
        vals = f"SELECT {entity} AS b, {f}, rating AS v FROM train"
    define(f"{p}contrib", (pairs, f"{p}nbrs", f"{p}cent"), f"""
        SELECT q.user_id, q.item_id, SUM(n.sim * v.v) AS num, SUM(n.sim) AS den
        FROM (SELECT DISTINCT user_id, item_id FROM {pairs}) q
        JOIN {p}nbrs n ON n.a = q.{entity}
        JOIN ({vals}) v ON v.b = n.b AND v.{f} = q.{f}
        GROUP BY q.user_id, q.item_id""")
    ratio = "COALESCE(c.num, 0) / (COALESCE(c.den, 0) + 1e-9)"
    pred = f"COALESCE(s.avg, 0) + {ratio}" if bias else ratio
    sel = select or "q.user_id, q.item_id, q.rating"
    body = f"""
SELECT {sel}, {r(pred, digits) if digits is not None else pred} AS pred
FROM {pairs} q LEFT JOIN {p}contrib c ON q.user_id = c.user_id AND q.item_id = c.item_id
LEFT JOIN {p}stat s ON q.{entity} = s.{entity}
{tail}"""
    return body, names + [f"{p}contrib"]
