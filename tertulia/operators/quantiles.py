"""Exact quantiles by radix selection: scans that narrow, and no exchange of values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits that are left out of a value's code in each scan: its sign, exponent and ten bits
#: first, then as many more as a scan can count, then all.
LEVELS = (42, 21, 0)
_FRACTION = 52
_BIAS = 1023
_LEAST_NORMAL = 2.0 ** -1022


#: Steps from rows with a value `_v` to the same with its `_code`: a whole number of 64 bits in
#: the same order, its exponent and fraction as a double holds them, negative for negative
#: values. Every part is exact; the power that the logarithm suggests is set right where it was
#: rounded across a power of two.
_CODED = (
    "guessed AS (SELECT *, abs(_v) AS _size, floor(log2(least(abs(_v), 1.7976931348623157E308D))) AS _guess FROM {values})",
    "powered AS (SELECT *, _guess - if(pow(2D, _guess) > _size, 1, 0) + if(pow(2D, _guess + 1) <= _size, 1, 0) AS _power FROM guessed)",
    f"""coded AS (SELECT *, CASE WHEN _size = 0 THEN 0L WHEN _size = double('inf') THEN {(2 * _BIAS + 1) << _FRACTION}L
        WHEN _size < {_LEAST_NORMAL!r}D THEN bigint(_size * {2.0**537!r}D * {2.0**537!r}D)
        ELSE (_power + {_BIAS}) * {1 << _FRACTION}L + bigint((_size / pow(2D, _power) - 1) * {2.0**_FRACTION!r}D) END
        * if(_v < 0, -1L, 1L) AS _code FROM powered)""",
)


def _position(p: float, rule: str) -> str:
    """0-based fractional rank of quantile `p` among `_total` sorted values."""
    if rule == "linear":
        return f"((_total - 1) * {p!r}D)"
    if rule == "hazen":
        return f"least(greatest(_total * {p!r}D - 0.5D, 0D), double(_total - 1))"
    raise ValueError(f"unknown rule: {rule}")


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    rule: str = "linear",
    weight: str | None = None,
) -> DataFrame:
    """One row per group: the `by` columns and `quantiles`, an array in the order of `probs`.

    Every value has a code of 64 bits that sorts as it does. The first scan counts values by
    the leading bits of their codes: a task sends one count for each bin it has met, never a
    value, however many values there are and however often one repeats. Running totals over the
    bins of a group tell which of them hold the wanted ranks. Where such a bin has more than one
    value, the next scan counts its values alone, by more bits, and a third one by all; a scan
    that nothing is left for does not run. No bin is ever sorted or gathered.

    `rule` is the interpolation: "linear" (rank p·(n-1)) or "hazen" (rank p·n - 1/2). `weight` is a
    column that says how often a row's value counts, a whole number of 1 or more.
    """
    keys = [f"_k{i}" for i in range(len(by))] or ["_k0"]
    group = [F.col(c).alias(k) for c, k in zip(by, keys)] or [F.lit(0).alias("_k0")]
    values = df.where(F.col(value).isNotNull()).select(
        *group, F.col(value).cast("double").alias("_v"), *([F.col(weight).cast("bigint").alias("_weight")] if weight else [])).where("NOT isnan(_v)")
    at = [_position(float(p), rule) for p in probs]
    # One entry per wanted rank: the two whole ranks around each fractional position.
    ranks = ", ".join(f"struct({i} AS i, {r}({h}) AS rank)" for i, h in enumerate(at) for r in ("floor", "ceil"))
    held = "filter({}, w -> w.rank >= _start AND w.rank < _start + _n) AS _ranks"
    n = "sum({}_weight)" if weight else "count(*)"
    k, figures = ", ".join(keys), f"{n.format('')} AS _n, min(_v) AS _lo, max(_v) AS _hi"
    steps = [
        *_CODED,
        f"c0 AS (SELECT {k}, shiftright(_code, {LEVELS[0]}) AS _bin, {figures} FROM coded GROUP BY {k}, shiftright(_code, {LEVELS[0]}))",
        f"t0 AS (SELECT *, sum(_n) OVER (PARTITION BY {k} ORDER BY _bin) - _n AS _start, sum(_n) OVER (PARTITION BY {k}) AS _total FROM c0)",
        f"h0 AS (SELECT * FROM (SELECT *, {held.format(f'array_distinct(array({ranks}))')} FROM t0) WHERE size(_ranks) > 0)",
    ]
    # Without groups there are two ranks a quantile at most, so that many bins to broadcast.
    hint = "" if by else "/*+ BROADCAST(h) */"
    same = " AND ".join(f"v.{c} <=> h.{c}" for c in keys)
    for level, (above, bits) in enumerate(zip(LEVELS, LEVELS[1:]), 1):
        carried = ", ".join(f"first(h.{c}) AS {name}" for c, name in (("_total", "_total"), ("_start", "_base"), ("_ranks", "_all")))
        steps += [
            f"""c{level} AS (SELECT {hint} {", ".join(f"v.{c}" for c in keys)}, h._bin AS _of, shiftright(v._code, {bits}) AS _bin,
                {n.format('v.')} AS _n, min(v._v) AS _lo, max(v._v) AS _hi, {carried}
                FROM coded v JOIN h{level - 1} h ON {same} AND shiftright(v._code, {above}) = h._bin AND h._lo < h._hi
                GROUP BY {", ".join(f"v.{c}" for c in keys)}, h._bin, shiftright(v._code, {bits}))""",
            f"t{level} AS (SELECT *, _base + sum(_n) OVER (PARTITION BY {k}, _of ORDER BY _bin) - _n AS _start FROM c{level})",
            f"h{level} AS (SELECT * FROM (SELECT *, {held.format('_all')} FROM t{level}) WHERE size(_ranks) > 0)",
        ]
    found = " UNION ALL ".join(
        f"SELECT {k}, _total, _lo AS _v, explode(_ranks) AS _w FROM h{level} WHERE _lo = _hi" for level in range(len(LEVELS)))
    ends = ", ".join(f"{f}(CASE WHEN _w.i = {i} THEN _v END) AS _{f}{i}" for i in range(len(at)) for f in ("min", "max"))
    between = ", ".join(f"_min{i} + ({h} - floor({h})) * (_max{i} - _min{i})" for i, h in enumerate(at))
    names = "".join(f"{key} AS `{c}`, " for c, key in zip(by, keys))
    return df.sparkSession.sql(
        f"""WITH {", ".join(steps)}, found AS ({found}),
        picks AS (SELECT {k}, max(_total) AS _total, {ends} FROM found GROUP BY {k})
        SELECT {names} array({between}) AS quantiles FROM picks""", values=values)


def approx_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), accuracy: int = 10000
) -> DataFrame:
    """Same shape as `exact_quantiles`, in one pass, with rank error at most 1/accuracy."""
    return df.groupBy(*by).agg(
        F.percentile_approx(F.col(value).cast("double"), list(probs), accuracy).alias("quantiles"))
