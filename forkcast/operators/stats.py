"""Exact quantiles with bounded memory (AGG11, the quantiles of PRF6).

Spark's exact ``percentile``/``median`` aggregates keep a map of every
distinct value and merge it in ONE task, which does not survive 100 TB.
Here every order statistic that is asked for is found by bracketing:

1. ``percentile_approx`` (a bounded sketch, combined map-side) inside the
   rank's bracket proposes two data values just around the rank;
2. one aggregate pass counts exactly what lies below, on, between and on
   the other of the two; the rank is one of the two values, or lies strictly
   between them, or the sketch missed and the margin is widened;
3. a bracket of at most ``max_exact`` ROWS is finished by a running count of
   its values in Spark, and only the answer leaves it.

The bracket is open on both sides, so a value that holds most of the rows is
either the answer or outside, however heavy it is: every round shrinks the
bracket or widens the margin, and neither can go on for ever.  The driver
gets counts and answers, never values of a bracket.  Result = linear
interpolation between the two neighbouring order statistics, the definition
used by pandas ``quantile``/``median`` and SQL ``quantile_cont``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forkcast.functions.text import nan_to_null


def _lit_double(v):
    return F.lit(v).cast("double") if v is not None else F.lit(None).cast("double")


def _ranks(q: float, n: int) -> tuple[float, int, int]:
    """(position, lower rank, upper rank) of a quantile among n values."""
    pos = q * (n - 1)
    if abs(pos - round(pos)) < 1e-9:       # an exact rank asked for as a ratio
        pos = float(round(pos))
    return pos, math.floor(pos), math.ceil(pos)


def _inside(x: Column, lo, hi) -> Column:
    """x strictly inside an open bracket (None: no bound)."""
    cond = x.isNotNull()
    if lo is not None:
        cond = cond & (x > F.lit(lo))
    if hi is not None:
        cond = cond & (x < F.lit(hi))
    return cond


def exact_quantiles(df: DataFrame, cols: list[str], qs: list[float] | dict[str, list[float]],
                    accuracy: int = 20000, max_exact: int = 50000) -> dict[str, list[float | None]]:
    """{column: [quantile value per q]} over non-null, non-NaN values.
    ``qs`` is one list for every column, or a dict of lists per column.

    Jobs: one pass for the counts and the first sketches, one exact-count
    check per narrowing round, and one read that finishes every small
    bracket at once."""
    qmap = qs if isinstance(qs, dict) else {c: list(qs) for c in cols}
    base = df.select(*[nan_to_null(F.col(c)).alias(c) for c in cols])
    margin0 = 3.0 / accuracy
    first = [F.count(c).alias(f"n_{i}") for i, c in enumerate(cols)]
    first += [F.percentile_approx(c, [p for q in qmap[c] for p in (max(0.0, q - margin0), min(1.0, q + margin0))],
                                  accuracy).alias(f"a_{i}") for i, c in enumerate(cols)]
    r0 = base.agg(*first).first()
    wanted, targets = [], {}
    for ci, c in enumerate(cols):
        n, approx = int(r0[f"n_{ci}"]), r0[f"a_{ci}"]
        for qi, q in enumerate(qmap[c]):
            if n == 0:
                continue
            pos, k1, k2 = _ranks(q, n)
            wanted.append((c, qi, pos, k1, k2))
            for k in (k1, k2):             # one bracket per rank
                targets.setdefault((c, k), dict(col=c, k=k, lo=None, hi=None, below=0, m=n, margin=margin0,
                                                prop=(approx[2 * qi], approx[2 * qi + 1]), value=None))
    while still := [t for t in targets.values() if t["value"] is None]:
        _finish(base, [t for t in still if t["m"] <= max_exact])
        still = [t for t in still if t["value"] is None]
        if still:
            _sketch(base, [t for t in still if t["prop"] is None], accuracy)
            _narrow(base, still)
    out = {c: [None] * len(qmap[c]) for c in cols}
    for c, qi, pos, k1, k2 in wanted:
        v1, v2 = targets[c, k1]["value"], targets[c, k2]["value"]
        out[c][qi] = v1 + (pos - k1) * (v2 - v1)
    return out


def _sketch(base: DataFrame, targets: list[dict], accuracy: int) -> None:
    """Propose two values around each rank, from sketches of the brackets (one pass)."""
    if not targets:
        return
    exprs = []
    for i, t in enumerate(targets):
        x = F.col(t["col"])
        at = (t["k"] - t["below"]) / max(t["m"] - 1, 1)
        span = [max(0.0, at - t["margin"]), min(1.0, at + t["margin"])]
        exprs.append(F.percentile_approx(F.when(_inside(x, t["lo"], t["hi"]), x), span, accuracy).alias(f"p{i}"))
    found = base.agg(*exprs).first()
    for i, t in enumerate(targets):
        t["prop"] = tuple(found[f"p{i}"])


def _narrow(base: DataFrame, targets: list[dict]) -> None:
    """Check every proposal with exact counts (one pass)."""
    checks = []
    for i, t in enumerate(targets):
        a, b = t["prop"]
        x = F.col(t["col"])
        inside = _inside(x, t["lo"], t["hi"])
        checks += [F.count_if(inside & (x < F.lit(a))).alias(f"under{i}"), F.count_if(x == F.lit(a)).alias(f"on{i}"),
                   F.count_if((x > F.lit(a)) & (x < F.lit(b))).alias(f"mid{i}"), F.count_if(x == F.lit(b)).alias(f"end{i}")]
    found = base.agg(*checks).first()
    for i, t in enumerate(targets):
        a, b = t["prop"]
        t["prop"] = None
        start = t["below"] + found[f"under{i}"]                # first rank that is a
        inner = start + found[f"on{i}"]                        # first rank beyond a
        last = inner + found[f"mid{i}"]                        # first rank that is b
        if start <= t["k"] < inner:
            t["value"] = float(a)
        elif inner <= t["k"] < last:
            t.update(lo=a, hi=b, below=inner, m=last - inner)
        elif a != b and last <= t["k"] < last + found[f"end{i}"]:
            t["value"] = float(b)
        else:                                                  # the sketch missed
            t["margin"] *= 4


def _finish(base: DataFrame, targets: list[dict]) -> None:
    """Order statistics of small brackets, from ONE scan: each row emits its
    value for the brackets that hold it, and a running count of values per
    bracket (at most ``max_exact`` rows each) picks the rank.  One row per
    target is collected."""
    if not targets:
        return
    hits = F.array(*[F.when(_inside(F.col(t["col"]), t["lo"], t["hi"]),
                            F.struct(F.lit(i).alias("t"), F.col(t["col"]).cast("double").alias("v"), F.lit(t["k"] - t["below"]).cast("long").alias("k")))
                     for i, t in enumerate(targets)])
    pairs = base.select(F.explode(F.filter(hits, lambda h: h.isNotNull())).alias("h")).select("h.*")
    for row in _pick(pairs.groupBy("t", "k", "v").agg(F.count(F.lit(1)).alias("n")), ["t"]).select("t", "v").collect():
        targets[row["t"]]["value"] = row["v"]


def _pick(counted: DataFrame, by: list[str]) -> DataFrame:
    """The rows (by, k, v, n: how often v stands there) that hold rank k of their bracket."""
    upto = F.sum("n").over(Window.partitionBy(*by).orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return counted.withColumn("upto", upto).where((F.col("upto") > F.col("k")) & (F.col("upto") - F.col("n") <= F.col("k")))


def exact_median(df: DataFrame, col: str, **kw) -> float | None:
    return exact_quantiles(df, [col], [0.5], **kw)[col][0]


def median_literal(df: DataFrame, col: str) -> Column:
    """The exact median as a DOUBLE literal column (NULL for no values)."""
    return _lit_double(exact_median(df, col))


_GRID = 1000          # sketch grid of a group: narrows a bracket several hundred times per round


def grouped_exact_quantiles(df: DataFrame, key: str, col: str, qs: list[float], accuracy: int = 20000,
                            max_exact: int = 50000) -> DataFrame:
    """Exact interpolated quantiles of ``col`` per value of ``key``, for any
    number of groups, as a DataFrame (key, q0, q1, ...).

    Same bracketing as ``exact_quantiles``, carried as a table of one row per
    group with a bracket for each of its ranks.  A round is one grouped
    sketch (the first needs no join) and one grouped count; rows meet their
    group's brackets in a join that AQE broadcasts or splits by runtime size,
    and are combined before the shuffle, so a dominant group never sits in
    one task.  Brackets of at most ``max_exact`` rows are finished by a
    running count.  No per-group data reaches the driver."""
    from forkcast.session import materialize

    base = materialize(df.select(F.col(key).alias("_g"), nan_to_null(F.col(col)).cast("double").alias("_x"))
                         .where(F.col("_g").isNotNull() & F.col("_x").isNotNull()), "gq-base")
    grid = [i / _GRID for i in range(_GRID + 1)]
    ranks = [(qi, up) for qi in range(len(qs)) for up in (False, True)]
    x = F.col("_x")

    def position(q: float) -> Column:
        pos = F.lit(float(q)) * (F.col("n") - 1)
        return F.when(F.abs(pos - F.round(pos)) < 1e-9, F.round(pos)).otherwise(pos)

    def field(name: str, i: int) -> Column:
        return F.col(f"{name}{i}")

    def inside(i: int) -> Column:
        return (field("lo", i).isNull() | (x > field("lo", i))) & (field("hi", i).isNull() | (x < field("hi", i)))

    def proposals(i: int) -> list[Column]:
        """The grid values on both sides of a rank."""
        span = F.greatest(field("m", i) - 1, F.lit(1)).cast("double")
        at = (field("k", i) - field("below", i)) / span * _GRID
        down = F.greatest(F.lit(0), F.floor(at).cast("int") - field("widen", i).cast("int"))
        up = F.least(F.lit(_GRID), F.ceil(at).cast("int") + field("widen", i).cast("int"))
        return [F.element_at(field("sketch", i), down + 1).alias(f"a{i}"), F.element_at(field("sketch", i), up + 1).alias(f"b{i}")]

    start = base.groupBy("_g").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("_x", grid, accuracy).alias("sketch"))
    cols = [F.col("_g"), F.col("n")]
    for i, (qi, up) in enumerate(ranks):
        cols += [(F.ceil if up else F.floor)(position(qs[qi])).cast("long").alias(f"k{i}"), F.lit(None).cast("double").alias(f"lo{i}"),
                 F.lit(None).cast("double").alias(f"hi{i}"), F.lit(0).cast("long").alias(f"below{i}"), F.col("n").alias(f"m{i}"),
                 F.lit(1).cast("long").alias(f"widen{i}"), F.lit(None).cast("double").alias(f"value{i}"), F.col("sketch").alias(f"sketch{i}")]
    state = start.select(*cols)
    kept = [c for i in range(len(ranks)) for c in (f"k{i}", f"lo{i}", f"hi{i}", f"below{i}", f"m{i}", f"widen{i}", f"value{i}")]
    while True:
        proposed = materialize(state.select("_g", "n", *kept, *[c for i in range(len(ranks)) for c in proposals(i)]), "gq-state")
        wide = base.join(proposed, "_g")
        counts = [c for i in range(len(ranks)) for c in (
            F.count_if(inside(i) & (x < field("a", i))).alias(f"under{i}"), F.count_if(x == field("a", i)).alias(f"on{i}"),
            F.count_if((x > field("a", i)) & (x < field("b", i))).alias(f"mid{i}"), F.count_if(x == field("b", i)).alias(f"end{i}"))]
        checked = proposed.join(wide.groupBy("_g").agg(*counts), "_g")
        cols = [F.col("_g"), F.col("n")]
        for i in range(len(ranks)):
            k, known = field("k", i), field("value", i).isNotNull()
            first = field("below", i) + field("under", i)
            inner, last = first + field("on", i), first + field("on", i) + field("mid", i)
            on_a = (first <= k) & (k < inner)
            mid = (inner <= k) & (k < last) & ~known
            on_b = (last <= k) & (k < last + field("end", i)) & (field("a", i) < field("b", i))
            pick = lambda name, new: F.when(mid, new).otherwise(field(name, i)).alias(f"{name}{i}")
            cols += [k, pick("lo", field("a", i)), pick("hi", field("b", i)), pick("below", inner), pick("m", field("mid", i)),
                     F.when(known | on_a | mid | on_b, F.lit(1).cast("long")).otherwise(F.least(field("widen", i) * 8, F.lit(2 * _GRID).cast("long"))).alias(f"widen{i}"),
                     F.when(known, field("value", i)).when(on_a, field("a", i)).when(on_b, field("b", i)).alias(f"value{i}")]
        state = materialize(checked.select(*cols), "gq-check")
        open_ = [field("value", i).isNull() & (field("m", i) > max_exact) for i in range(len(ranks))]
        some = open_[0]
        for o in open_[1:]:
            some = some | o
        if state.where(some).isEmpty():
            break
        sketched = (base.join(state.where(some), "_g").groupBy("_g").agg(
            *[F.percentile_approx(F.when(inside(i) & open_[i], x), grid, accuracy).alias(f"sketch{i}") for i in range(len(ranks))]))
        state = state.join(sketched, "_g", "left")
    small = [F.when(field("value", i).isNull() & inside(i), F.struct(F.lit(i).alias("i"), (field("k", i) - field("below", i)).alias("k"))) for i in range(len(ranks))]
    left = (base.join(state, "_g").select("_g", x.alias("v"), F.explode(F.filter(F.array(*small), lambda s: s.isNotNull())).alias("s"))
            .groupBy("_g", F.col("s.i").alias("i"), F.col("s.k").alias("k"), "v").agg(F.count(F.lit(1)).alias("n")))
    got = _pick(left, ["_g", "i"]).groupBy("_g").agg(*[F.max(F.when(F.col("i") == i, F.col("v"))).alias(f"got{i}") for i in range(len(ranks))])
    done = state.join(got, "_g", "left")
    value = [F.coalesce(field("value", i), field("got", i)) for i in range(len(ranks))]
    out = [value[2 * qi] + (position(q) - F.col(f"k{2 * qi}")) * (value[2 * qi + 1] - value[2 * qi]) for qi, q in enumerate(qs)]
    return done.select(F.col("_g").alias(key), *[v.alias(f"q{i}") for i, v in enumerate(out)])
