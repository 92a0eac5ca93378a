"""Fuzzy concession rate as one closed expression.

The output set is sampled on a grid of 501 points and its centre of gravity is the rate. The accumulated set is the
maximum of clipped trapezoids of which only neighbours overlap, so its sums over the grid are
``sum(clipped terms) - sum(clipped overlaps)``, and each piece is a ramp or a plateau whose grid sums have a closed
form. Nothing is exploded, joined or shuffled: the rate costs the same few arithmetic operations on every row.

The expressions are written as SQL text over column names: one parse instead of thousands of driver calls.
"""

from __future__ import annotations

from math import floor

from pyspark.sql import DataFrame

from offerwell import constants as K


def num(v: float) -> str:
    """Double literal."""
    return f"{float(v)!r}D"


def membership(x: str, corners: tuple[float, float, float, float]) -> str:
    """Trapezoid membership of a non-missing value; equal corners make a shoulder or a triangle."""
    a, b, c, d = corners
    out = f"CASE WHEN {x} < {num(a)} OR {x} > {num(d)} THEN 0.0D "
    if b > a:
        out += f"WHEN {x} < {num(b)} THEN ({x} - {num(a)}) / {num(b - a)} "
    if d > c:
        out += f"WHEN {x} > {num(c)} THEN ({num(d)} - {x}) / {num(d - c)} "
    return out + "ELSE 1.0D END"


def activations() -> dict[str, str]:
    """Activation of each output term from the columns ``gap``, ``progress`` and ``trend``.

    AND is the minimum; several rules of one term combine by the maximum.
    """
    fired: dict[str, list[str]] = {}
    for conditions, term in K.FUZZY_RULES:
        parts = [membership(variable, K.FUZZY_INPUTS[(variable, value)]) for variable, value in conditions]
        fired.setdefault(term, []).append(f"least({', '.join(parts)})" if len(parts) > 1 else parts[0])
    return {t: f"greatest({', '.join(fired[t])})" if len(fired[t]) > 1 else fired[t][0] for t in K.FUZZY_OUTPUTS}


def _ramps() -> list[tuple[str, str | None, float, int, int, float, float]]:
    """(term, neighbour or None, start, step, last, width, sign) of every sloped piece of the accumulated set.

    A piece covers the grid points ``start + step * j`` for j = 0..last, where the unclipped height is ``j / width``.
    A piece with a neighbour is the part counted twice where two terms overlap; it is taken off again.
    """
    out = []
    terms = list(K.FUZZY_OUTPUTS.items())
    for term, (a, b, c, d) in terms:
        if b > a:
            out.append((term, None, a, 1, b - a - 1, float(b - a), 1.0))
        if d > c:
            out.append((term, None, d, -1, d - c - 1, float(d - c), 1.0))
    for (one, (_, _, c1, end)), (two, (start, b2, _, _)) in zip(terms, terms[1:]):
        up, down = float(b2 - start), float(end - c1)
        crossing = (start * down + end * up) / (up + down)
        rising = floor(crossing)
        out.append((one, two, start, 1, rising - start, up, -1.0))
        out.append((one, two, end, -1, end - rising - 1, down, -1.0))
    return out


def with_concession_rate(df: DataFrame, out: str = "rate") -> DataFrame:
    """Add the centre of gravity of the accumulated output set; the default rate when no rule fires.

    Reads the columns ``gap``, ``progress`` and ``trend``.
    """
    kept = df.columns
    df = df.selectExpr("*", *[f"{sql} AS _act_{term}" for term, sql in activations().items()])
    levels, reach = [], []
    for i, (term, other, _, _, last, width, _) in enumerate(_ramps()):
        level = f"least(_act_{term}, _act_{other})" if other else f"_act_{term}"
        levels.append(level)
        # Points of the slope that stay below the activation level.
        reach.append(f"cast(least(floor({level} * {num(width)}), {last}) AS double) AS _reach_{i}")
    df = df.selectExpr("*", *reach)
    area, moment = [], []
    for i, (_, _, start, step, last, width, sign) in enumerate(_ramps()):
        n, level = f"_reach_{i}", levels[i]
        height = f"({n} * ({n} + 1D) / {num(2 * width)} + {level} * ({num(last)} - {n}))"
        tilt = (
            f"({n} * ({n} + 1D) * (2D * {n} + 1D) / {num(6 * width)} + "
            f"{level} * ({num(last * (last + 1))} - {n} * ({n} + 1D)) / 2D)"
        )
        area.append(f"{height} * {num(sign)}")
        moment.append(f"({height} * {num(start)} + {tilt} * {num(step)}) * {num(sign)}")
    for term, (_, b, c, _) in K.FUZZY_OUTPUTS.items():
        area.append(f"_act_{term} * {num(c - b + 1)}")
        moment.append(f"_act_{term} * {num((c * (c + 1) - b * (b - 1)) / 2)}")
    df = df.selectExpr("*", f"{' + '.join(area)} AS _area", f"{' + '.join(moment)} AS _moment")
    silent = f"greatest({', '.join('_act_' + t for t in K.FUZZY_OUTPUTS)}) <= 0"
    rate = f"CASE WHEN {silent} THEN {num(K.DEFAULT_RATE)} ELSE try_divide(_moment, _area) / 1000D END"
    return df.selectExpr(*kept, f"{rate} AS {out}")


def fallback_rate(gap: str = "gap", progress: str = "progress") -> str:
    """Step table used when no fuzzy value exists; more generous near the end."""
    rate = (
        f"CASE WHEN {gap} > 45 THEN 0.02D WHEN {gap} > 30 THEN 0.06D WHEN {gap} > 15 THEN 0.18D "
        f"WHEN {gap} > 5 THEN 0.32D ELSE 0.45D END"
    )
    return f"CASE WHEN {progress} > 0.7D THEN least(0.5D, {rate} + 0.1D) ELSE {rate} END"
