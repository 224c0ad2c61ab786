"""Exact, linearly interpolated quantiles of large columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

# An exact percentile aggregate keeps every distinct value in memory, so it is
# only used on value ranges holding at most this many rows per column.
EXACT_LIMIT = 100_000
SKETCH_ACCURACY = 10_000


def exact_quantiles(df: DataFrame, values: Mapping[str, Column], probs: Sequence[float],
                    limit: int = EXACT_LIMIT) -> dict[str, list[float | None]]:
    """Quantiles of several expressions at once, NULLs ignored."""
    return quantiles_and(df, values, probs, {}, limit)[0]


def quantiles_and(df: DataFrame, values: Mapping[str, Column], probs: Sequence[float], more: Mapping[str, Column],
                  limit: int = EXACT_LIMIT) -> tuple[dict[str, list[float | None]], Row]:
    """Quantiles, and the row of the aggregates ``more`` from the same first pass.

    Each pass is one aggregation without a data shuffle. The first takes
    ranges, counts and a mergeable sketch, which proposes a bracket per
    (expression, probability). A second counts the rows below and inside the
    brackets, and the exact aggregate reads what they hold in a third. A
    bracket that misses its rank is rejected by the counts, and one that holds
    many rows is narrowed again, so the answer does not depend on the sketch.
    """
    names = list(values)
    cols = {n: values[n].cast("double") for n in names}
    slack = 2.0 / SKETCH_ACCURACY
    points = [x for p in probs for x in (max(0.0, p - slack), min(1.0, p + slack + 1.0 / limit))]
    first = df.agg(*[a for i, n in enumerate(names) for a in (
        F.count(cols[n]).alias(f"n{i}"), F.min(cols[n]).alias(f"lo{i}"), F.max(cols[n]).alias(f"hi{i}"),
        F.percentile_approx(cols[n], points, SKETCH_ACCURACY).alias(f"sketch{i}"))],
        *[c.alias(n) for n, c in more.items()]).first()
    # (name, prob) -> position, low, high, rows below low, rows inside
    brackets, sketched = {}, {}
    for i, n in enumerate(names):
        count = first[f"n{i}"]
        for j, p in enumerate(probs):
            if count:
                brackets[n, p] = ((count - 1) * p, first[f"lo{i}"], first[f"hi{i}"], 0, count)
                sketched[n, p] = first[f"sketch{i}"][2 * j:2 * j + 2]

    while True:
        wide = [k for k, (_, lo, hi, _, inside) in brackets.items() if inside > limit and lo < hi]
        if not wide:
            break
        before = {k: brackets[k] for k in wide}
        known = [sketched.pop(k) for k in wide] if all(k in sketched for k in wide) else None
        for k, b in zip(wide, _shrink(df, cols, [(k[0], *before[k]) for k in wide], known)):
            brackets[k] = b
        if all(brackets[k][1:3] == before[k][1:3] for k in wide):
            break

    out: dict[str, list[float | None]] = {n: [None] * len(probs) for n in names}
    aggs, spots = [], []
    for (n, p), (pos, lo, hi, below, inside) in brackets.items():
        if lo == hi:
            out[n][list(probs).index(p)] = lo
            continue
        share = 0.0 if inside == 1 else min(1.0, max(0.0, (pos - below) / (inside - 1)))
        c = cols[n]
        aggs.append(F.percentile(F.when(c.between(lo, hi), c), share).alias(f"q{len(spots)}"))
        spots.append((n, list(probs).index(p)))
    if aggs:
        row = df.agg(*aggs).first()
        for j, (n, i) in enumerate(spots):
            out[n][i] = row[f"q{j}"]
    return out, first


def _sketch(df, cols, items):
    """Proposed brackets from a sketch of what the brackets hold."""
    slack = 2.0 / SKETCH_ACCURACY
    aggs = []
    for j, (n, pos, lo, hi, below, inside) in enumerate(items):
        rel = (pos - below) / max(inside - 1, 1)
        points = [max(0.0, rel - slack), min(1.0, rel + slack + 1.0 / inside)]
        c = F.when(cols[n].between(lo, hi), cols[n])
        aggs.append(F.percentile_approx(c, points, SKETCH_ACCURACY).alias(f"s{j}"))
    return list(df.agg(*aggs).first())


def _shrink(df, cols, items, sketch=None):
    """One narrowing pass over brackets ``(name, position, low, high, below, inside)``."""
    slack = 2.0 / SKETCH_ACCURACY
    sketch = sketch or _sketch(df, cols, items)
    proposed = []
    for (n, pos, lo, hi, below, inside), (a, b) in zip(items, sketch):
        rel = (pos - below) / max(inside - 1, 1)
        proposed.append((lo if rel - slack <= 0 else a, hi if rel + slack >= 1 else b))
    counts = df.agg(*[x for j, (n, *_), (a, b) in zip(range(len(items)), items, proposed) for x in (
        F.count_if(cols[n] < a).alias(f"b{j}"),
        F.count_if(cols[n].between(a, b)).alias(f"i{j}"))]).first()
    out = []
    for j, ((n, pos, lo, hi, below, inside), (a, b)) in enumerate(zip(items, proposed)):
        new_below, new_inside = counts[f"b{j}"], counts[f"i{j}"]
        holds = new_below <= pos and pos <= new_below + new_inside - 1
        out.append((pos, a, b, new_below, new_inside) if holds else (pos, lo, hi, below, inside))
    return out
