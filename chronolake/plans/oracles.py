"""SQL of least squares, tests and filters, which the models' queries are held against.

The library sums cross products and solves them; this SQL goes another way and takes regressors out of each other
one by one (Gram-Schmidt) with window sums, so that what is left of the last regressor and of the left side gives
its coefficient and its error.
"""

from __future__ import annotations

Named = dict[str, str]


def residuals(rel: str, group: str, xs: Named, ys: Named, weight: str = "1.0") -> str:
    """``rel`` with what is left of each regressor (v0, v1, ...) and of each left side (e_name), and the shares taken out."""
    cast = lambda e, name: f"CAST({e} AS DOUBLE) AS {name}"
    sql = f"SELECT *, {', '.join([cast(weight, 'w_'), *(cast(e, f'v{i}') for i, e in enumerate(xs.values())), *(cast(e, f'e_{y}') for y, e in ys.items())])} FROM {rel}"
    for i in range(len(xs)):
        later = [f"v{j}" for j in range(i + 1, len(xs))] + [f"e_{y}" for y in ys]
        shares = ", ".join(f"sum(w_ * v{i} * {v}) OVER g / sum(w_ * v{i} * v{i}) OVER g AS r{i}_{v}" for v in later)
        sql = f"SELECT *, {shares} FROM ({sql}) WINDOW g AS (PARTITION BY {group})"
        sql = f"SELECT * REPLACE ({', '.join(f'{v} - v{i} * r{i}_{v} AS {v}' for v in later)}) FROM ({sql})"
    return f"({sql})"


def system(rel: str, group: str, xs: Named, ys: Named) -> str:
    """A row per group: b_y_x of every left side and regressor, ssr_a_b of every two left sides, and n."""
    k, names = len(xs), list(xs)
    picks = [f"any_value(r{i}_{v}) AS r{i}_{v}" for i in range(k) for v in [*(f"v{j}" for j in range(i + 1, k)), *(f"e_{y}" for y in ys)]]
    picks += [f"sum(e_{a} * e_{b}) AS ssr_{a}_{b}" for a in ys for b in ys]
    solved = [f"r{i}_e_{y}" + "".join(f" - r{i}_v{j} * b_{y}_{names[j]}" for j in range(i + 1, k)) + f" AS b_{y}_{names[i]}" for y in ys for i in reversed(range(k))]
    return f"(SELECT *, {', '.join(solved)} FROM (SELECT {group}, count(*) AS n, {', '.join(picks)} FROM {residuals(rel, group, xs, ys)} GROUP BY {group}))"


def term(rel: str, group: str, order: str, xs: Named, of: str, y: str, lags: str | None = None, weight: str = "1.0") -> str:
    """A row per group: coef, se, n, dof and r2 for the regressor ``of``; Newey-West with ``lags``."""
    last = {k: v for k, v in xs.items() if k != of} | {of: xs[of]}
    k = len(xs)
    own = f"v{k - 1}"
    base = f"(SELECT *, r{k - 1}_e_y AS coef_, {y} AS y_ FROM {residuals(rel, group, last, {'y': y}, weight)})"
    total = "(sum(w_ * y_ * y_) - sum(w_ * y_) * sum(w_ * y_) / sum(w_))"
    plain = f"SELECT {group}, any_value(coef_) AS coef, sum(w_ * {own} * {own}) AS d_, sum(w_ * e_y * e_y) AS ssr_, count(*) AS n, count(*) - {k} AS dof, 1 - sum(w_ * e_y * e_y) / {total} AS r2 FROM {base} GROUP BY {group}"
    if lags is None:
        return f"(SELECT *, sqrt(ssr_ / dof / d_) AS se FROM ({plain}))"
    scores = f"SELECT {group}, row_number() OVER (PARTITION BY {group} ORDER BY {order}) AS ix_, w_ * {own} * e_y AS u_, {lags} AS lags_ FROM {base}"
    same = " AND ".join(f"a.{g.strip()} = b.{g.strip()}" for g in group.split(","))
    both = f"SELECT {', '.join(f'a.{g.strip()}' for g in group.split(','))}, sum(CASE WHEN a.ix_ = b.ix_ THEN 1.0 ELSE 2.0 END * (1 - (a.ix_ - b.ix_) / (a.lags_ + 1.0)) * a.u_ * b.u_) AS meat_ FROM ({scores}) a JOIN ({scores}) b ON {same} AND a.ix_ - b.ix_ BETWEEN 0 AND a.lags_ GROUP BY {', '.join(f'a.{g.strip()}' for g in group.split(','))}"
    return f"(SELECT p.*, sqrt(m.meat_) / d_ AS se FROM ({plain}) p JOIN ({both}) m USING ({group}))"


def p_normal(stat: str) -> str:
    """Two-sided p-value by the series of the error function; what is beyond five deviations is 0 to six digits."""
    z = f"(abs({stat}) / sqrt(2.0))"
    return f"CASE WHEN abs({stat}) > 5 THEN 0.0 ELSE 1 - 2 / sqrt(pi()) * list_sum([CASE WHEN j % 2 = 0 THEN 1.0 ELSE -1.0 END * pow({z}, 2 * j + 1) / (gamma(j + 1.0) * (2 * j + 1)) FOR j IN range(80)]) END"


def p_student(stat: str, dof: str) -> str:
    """Two-sided p-value of Student's t for whole degrees of freedom, by its finite sums."""
    angle = f"atan(abs({stat}) / sqrt({dof}))"
    even = f"sin({angle}) * coalesce(list_sum([gamma(j + 0.5) / (sqrt(pi()) * gamma(j + 1.0)) * pow(cos({angle}), 2 * j) FOR j IN range(CAST({dof} // 2 AS BIGINT))]), 0.0)"
    odd = f"2 / pi() * ({angle} + sin({angle}) * coalesce(list_sum([sqrt(pi()) / 2 * gamma(j + 1.0) / gamma(j + 1.5) * pow(cos({angle}), 2 * j + 1) FOR j IN range(CAST(({dof} - 1) // 2 AS BIGINT))]), 0.0))"
    return f"1 - CASE WHEN {dof} % 2 = 0 THEN {even} ELSE {odd} END"


def hp(rel: str, group: str, name: str = "hp", smoothing: float = 1600.0) -> str:
    """Common tables, the last one ``name`` (group, period, value, trend): the banded system eliminated row by row, there and back.

    Goes into WITH RECURSIVE.
    """
    s = f"{smoothing:.1f}"
    return f"""
{name}_h AS (SELECT {group}, period, value, row_number() OVER (PARTITION BY {group} ORDER BY period) AS i, count(*) OVER (PARTITION BY {group}) AS n FROM {rel} WHERE value IS NOT NULL),
{name}_m AS (SELECT *, 1 + {s} * CASE WHEN i IN (1, n) THEN 1 WHEN i IN (2, n - 1) THEN 5 ELSE 6 END AS m, {s} * CASE WHEN i = n THEN 0 WHEN i IN (1, n - 1) THEN -2 ELSE -4 END AS o, CASE WHEN i <= n - 2 THEN {s} ELSE 0.0 END AS t FROM {name}_h WHERE n >= 8),
{name}_f AS (
  SELECT {group}, i, n, CAST(m AS DOUBLE) AS d, CAST(o / m AS DOUBLE) AS a, CAST(t / m AS DOUBLE) AS b, CAST(value AS DOUBLE) AS z, CAST(0 AS DOUBLE) AS d1, CAST(0 AS DOUBLE) AS b1, CAST(0 AS DOUBLE) AS z1 FROM {name}_m WHERE i = 1
  UNION ALL
  SELECT {group}, i, n, e, CAST((o - ab) / e AS DOUBLE), CAST(t / e AS DOUBLE), y, d, b, z FROM (
    SELECT m.{group}, m.i, m.n, m.o, m.t, m.m - f.a * f.a * f.d - f.b1 * f.b1 * f.d1 AS e, f.a * f.b * f.d AS ab, m.value - f.a * f.z - f.b1 * f.z1 AS y, f.d, f.b, f.z
    FROM {name}_f f JOIN {name}_m m ON m.{group} = f.{group} AND m.i = f.i + 1)
),
{name}_b AS (
  SELECT {group}, i, z / d AS x, CAST(0 AS DOUBLE) AS x1 FROM {name}_f WHERE i = n
  UNION ALL
  SELECT f.{group}, f.i, f.z / f.d - f.a * b.x - f.b * b.x1, b.x FROM {name}_b b JOIN {name}_f f ON f.{group} = b.{group} AND f.i = b.i - 1
),
{name} AS (SELECT h.{group}, h.period, h.value, x AS trend FROM {name}_h h LEFT JOIN {name}_b b ON h.{group} = b.{group} AND h.i = b.i)"""


def lagged(rel: str, group: str, columns: list[str], lags: int, name: str) -> str:
    """A common table: ``rel`` with lags of columns as l1_a, l1_b, ..., complete rows only."""
    cols = [f"lag({c}, {p}) OVER w AS l{p}_{c}" for p in range(1, lags + 1) for c in columns]
    return f"{name} AS (SELECT * FROM (SELECT *, {', '.join(cols)} FROM {rel} WINDOW w AS (PARTITION BY {group} ORDER BY period)) WHERE {' AND '.join(f'l{lags}_{c} IS NOT NULL' for c in columns)})"


def var_system(rel: str, group: str, columns: list[str], lags: int) -> str:
    """``system`` of a vector autoregression on lagged rows."""
    return system(rel, group, {"const": "1.0"} | {f"l{p}_{c}": f"l{p}_{c}" for p in range(1, lags + 1) for c in columns}, {c: c for c in columns})


def determinant(m: list[list[str]]) -> str:
    if len(m) == 1:
        return m[0][0]
    minors = [determinant([r[:j] + r[j + 1 :] for r in m[1:]]) for j in range(len(m))]
    return "(" + " + ".join(f"{1 if j % 2 == 0 else -1} * ({x}) * {minor}" for j, (x, minor) in enumerate(zip(m[0], minors, strict=True))) + ")"


def irf(fit: str, group: str, columns: list[str], lags: int, horizon: int) -> str:
    """Common tables up to irf_long (group, shock, response, h, value): the recursion from the Cholesky factor. Goes into WITH RECURSIVE."""
    k = len(columns)
    dof = f"(n - {k * lags + 1})"
    factor = []  # by rows, each entry from those before
    for i in range(k):
        for j in range(i + 1):
            left = f"ssr_{columns[i]}_{columns[j]} / {dof}" + "".join(f" - f{i}{m} * f{j}{m}" for m in range(j))
            factor.append(f"sqrt({left}) AS f{i}{j}" if i == j else f"({left}) / f{j}{j} AS f{i}{j}")
    at = [(i, s) for i in range(k) for s in range(k)]
    ago = lambda p: "p" if p == 1 else f"o{p}_"
    begin = [f"{f'f{i}{s}' if s <= i else 'CAST(0 AS DOUBLE)'} AS p{i}{s}" for i, s in at] + [f"CAST(0 AS DOUBLE) AS o{p}_{i}{s}" for p in range(2, lags + 1) for i, s in at]
    step = [" + ".join(f"c.b_{columns[i]}_l{p}_{columns[m]} * t.{ago(p)}{m}{s}" for p in range(1, lags + 1) for m in range(k)) for i, s in at]
    step += [f"t.{ago(p - 1)}{i}{s}" for p in range(2, lags + 1) for i, s in at]
    long = " UNION ALL ".join(f"SELECT {group}, '{columns[s]}' AS shock, '{columns[i]}' AS response, h, p{i}{s} AS value FROM irf_steps" for i, s in at)
    return f"""
irf_fit AS (SELECT *, {", ".join(factor)} FROM {fit}),
irf_steps AS (
  SELECT {group}, 0 AS h, {", ".join(begin)} FROM irf_fit
  UNION ALL SELECT t.{group}, t.h + 1, {", ".join(step)} FROM irf_steps t JOIN irf_fit c ON t.{group} = c.{group} WHERE t.h < {horizon}
),
irf_long AS ({long})"""


def spectral_radius(fit: str, group: str, columns: list[str], lags: int, doublings: int = 30) -> str:
    """Common tables up to radius (group, max_root): norms of the companion matrix squared again and again. Goes into WITH RECURSIVE."""
    k = len(columns)
    m = k * lags
    at = [(i, j) for i in range(m) for j in range(m)]
    begin = [f"CAST({f'b_{columns[i]}_l{j // k + 1}_{columns[j % k]}' if i < k else int(j == i - k)} AS DOUBLE) AS m{i}_{j}" for i, j in at]
    square = [f"{' + '.join(f'm{i}_{h} * m{h}_{j}' for h in range(m))} AS m{i}_{j}" for i, j in at]
    size = f"greatest({', '.join(f'abs(m{i}_{j})' for i, j in at)})"
    scaled = ", ".join(f"m{i}_{j} / size_ AS m{i}_{j}" for i, j in at)
    return f"""
powers AS (
  SELECT {group}, 0 AS step, CAST(0 AS DOUBLE) AS log_, {", ".join(begin)} FROM {fit}
  UNION ALL SELECT {group}, step + 1, 2 * log_ + ln(size_), {scaled} FROM (SELECT *, {size} AS size_ FROM (SELECT {group}, step, log_, {", ".join(square)} FROM powers WHERE step < {doublings}))
),
radius AS (SELECT {group}, exp((log_ + ln({size})) / pow(2.0, step)) AS max_root FROM powers WHERE step = {doublings})"""


def rotations(columns: list[str], draws: int, seed: int, name: str = "rot") -> str:
    """A CTE ``name`` (draw, shock, s, q): normal numbers by their place, made orthonormal column by column."""
    k = len(columns)
    uniform = lambda kind: f"(CAST('0x' || substr(md5('{seed}:{kind}:' || i), 1, 13) AS BIGINT) + 0.5) / 4503599627370496"
    ctes = [
        f"{name}_z AS (SELECT CAST(i // {k * k} AS INTEGER) AS draw, i % {k * k} AS c, sqrt(-2 * ln({uniform('radius')})) * cos(2 * pi() * {uniform('angle')}) AS z FROM range({draws * k * k}) t(i))",
        f"{name}_0 AS (SELECT draw, " + ", ".join(f"max(z) FILTER (c = {i * k + j}) AS z{i}{j}" for i in range(k) for j in range(k)) + f" FROM {name}_z GROUP BY draw)",
    ]
    for j in range(k):
        along = {p: "(" + " + ".join(f"q{i}{p} * z{i}{j}" for i in range(k)) + ")" for p in range(j)}
        left = [f"z{i}{j}" + "".join(f" - {along[p]} * q{i}{p}" for p in range(j)) for i in range(k)]
        ctes.append(f"{name}_r{j} AS (SELECT *, " + ", ".join(f"{x} AS r{i}{j}" for i, x in enumerate(left)) + f" FROM {name}_{j})")
        length = "sqrt(" + " + ".join(f"r{i}{j} * r{i}{j}" for i in range(k)) + ")"
        ctes.append(f"{name}_{j + 1} AS (SELECT *, " + ", ".join(f"r{i}{j} / {length} AS q{i}{j}" for i in range(k)) + f" FROM {name}_r{j})")
    ctes.append(f"{name} AS (" + " UNION ALL ".join(f"SELECT draw, '{c}' AS shock, {j} AS s, q{i}{j} AS q FROM {name}_{k}" for i, c in enumerate(columns) for j in range(k)) + ")")
    return ", ".join(ctes)
