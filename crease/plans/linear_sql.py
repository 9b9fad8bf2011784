"""Linear models in SQL: moments, Gaussian elimination and back substitution as one
common table expression each, for the oracles of the fitted linear queries."""

from __future__ import annotations


def solve_ctes(name: str, source: str, features: list[str], label: str, group: list[str] | None = None, alpha: str = "0.0") -> list[str]:
    """CTEs that end with ``{name}`` (group..., w0.., intercept, n): least squares of
    ``label`` on ``features`` over the rows of ``source`` by group, ``alpha`` added to
    the diagonal; a constant feature weighs 0."""
    d, group = len(features), group or []
    g = "".join(f"{c}, " for c in group)
    by = f" GROUP BY {', '.join(group)}" if group else ""
    using = f"JOIN {name}_m USING ({', '.join(group)})" if group else f", {name}_m"
    upper = [(i, j) for i in range(d) for j in range(i, d)]
    dev = [f"({c} - m{i})" for i, c in enumerate(features)]
    out = [f"{name}_m AS (SELECT {g}COUNT(*) AS n, AVG({label}) AS my, " + ", ".join(f"AVG({c}) AS m{i}" for i, c in enumerate(features)) +
           f" FROM {source}{by})",
           f"{name}_0 AS (SELECT {g}" + ", ".join(
               f"SUM({dev[i]} * {dev[j]})" + (f" + ANY_VALUE({alpha})" if i == j else "") + f" AS a{i}_{j}" for i, j in upper) + ", " + ", ".join(
               f"SUM({dev[i]} * ({label} - my)) AS b{i}" for i in range(d)) + f" FROM {source} {using}{by})"]
    inverse = lambda k: f"CASE WHEN a{k}_{k} > 1e-6 THEN 1 / a{k}_{k} ELSE 0 END"
    for k in range(d - 1):
        cells = [f"a{i}_{j}" if i <= k else f"a{i}_{j} - a{k}_{i} * a{k}_{j} * {inverse(k)} AS a{i}_{j}" for i, j in upper]
        sides = [f"b{i}" if i <= k else f"b{i} - a{k}_{i} * b{k} * {inverse(k)} AS b{i}" for i in range(d)]
        out.append(f"{name}_{k + 1} AS (SELECT {g}{', '.join(cells + sides)} FROM {name}_{k})")
    back = [f"(b{i}" + "".join(f" - a{i}_{j} * w{j}" for j in range(i + 1, d)) + f") * {inverse(i)} AS w{i}" for i in reversed(range(d))]
    out.append(f"{name} AS (SELECT {g}n, {', '.join(back)}, my" + "".join(f" - m{i} * w{i}" for i in range(d)) +
               f" AS intercept FROM {name}_{d - 1} {using})")
    return out


def value(features: list[str]) -> str:
    """The fitted value of a row."""
    return "intercept" + "".join(f" + w{i} * {c}" for i, c in enumerate(features))
