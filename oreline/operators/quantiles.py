"""Exact interpolated quantiles without holding all distinct values in one buffer.

The built-in exact percentile keeps every distinct value of a column in memory. It is used
only where few distinct values are left; otherwise a mergeable sketch brackets each wanted
rank and further aggregates narrow the bracket. No pass shuffles the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import materialize

SKETCH_ACCURACY = 2_000
GROUP_VALUES = 100_000   # distinct values of a group (or of a bracket of it) that one task sorts
CUTS = 32                # parts a bracket is cut into


def present(column: str):
    """The value as a double, NaN taken as missing."""
    x = F.col(column).cast("double")
    return F.when(~F.isnan(x), x)


def column_quantiles(df: DataFrame, columns: list[str], probs: list[float], limit: int = 200_000,
                     sizes: dict | None = None) -> dict[str, list[float | None]]:
    """Quantiles of each column, linearly interpolated; missing values are ignored.

    ``limit`` bounds the distinct values the exact step may hold; ``sizes`` are approximate
    distinct counts, if the caller has them from a pass of its own.
    """
    if not columns:
        return {}
    x = {c: present(c) for c in columns}
    if sizes is None:
        sizes = df.agg(*[F.approx_count_distinct(x[c]).alias(c) for c in columns]).first().asDict()
    small = [c for c in columns if sizes[c] <= limit]
    wide = [c for c in columns if c not in small]
    out = {}
    if small:
        wanted = F.array(*[F.lit(float(p)) for p in probs])
        row = df.agg(*[F.percentile(x[c], wanted).alias(c) for c in small]).first()
        out.update({c: list(row[c]) if row[c] is not None else [None] * len(probs) for c in small})
    for c in wide:
        out[c] = _narrowed(df.select(x[c].alias("x")), probs, limit)
    return out


def _narrowed(values: DataFrame, probs, limit) -> list[float]:
    x = F.col("x")
    n = values.agg(F.count(x)).first()[0]
    ranks = [(n - 1) * p for p in probs]
    # bracket per wanted rank: closed interval [a, b], rows below a
    brackets = [(float("-inf"), float("inf"), 0, n) for _ in ranks]
    while True:
        wanted = []
        for r, (a, b, below, inside) in zip(ranks, brackets):
            lo = (int(r) - below) / inside - 2.0 / SKETCH_ACCURACY
            hi = (int(r) + 1 - below) / inside + 2.0 / SKETCH_ACCURACY
            wanted.append([min(max(lo, 0.0), 1.0), min(max(hi, 0.0), 1.0)])
        # wanted ranks that share a bracket share one sketch (all of them in the first round)
        shared: dict[tuple, list[int]] = {}
        for i, (a, b, *_) in enumerate(brackets):
            shared.setdefault((a, b), []).append(i)
        sketches = [F.percentile_approx(F.when(x.between(a, b), x), F.array(*[F.lit(p) for i in who for p in wanted[i]]),
                                        F.lit(SKETCH_ACCURACY)) for (a, b), who in shared.items()]
        ends = values.agg(*sketches).first()
        tight = [None] * len(ranks)
        for found, who in zip(ends, shared.values()):
            for at, i in enumerate(who):
                tight[i] = (found[2 * at], found[2 * at + 1])
        counts = values.agg(*[e for i, (a, b) in enumerate(tight) for e in (
            F.count_if(x < a).alias(f"l{i}"), F.count_if(x.between(a, b)).alias(f"m{i}"),
            F.approx_count_distinct(F.when(x.between(a, b), x)).alias(f"d{i}"))]).first()
        fits = []
        for i, r in enumerate(ranks):
            below, inside = counts[f"l{i}"], counts[f"m{i}"]
            good = below <= int(r) and below + inside >= min(int(r) + 2, n)
            fits.append(good and counts[f"d{i}"] <= limit)
            if good:
                brackets[i] = (*tight[i], below, inside)
        if all(fits):
            break
    row = values.agg(*[F.percentile(F.when(x.between(a, b), x),
                                    F.lit(min(max((r - below) / max(inside - 1, 1), 0.0), 1.0))).alias(f"q{i}")
                       for i, (r, (a, b, below, inside)) in enumerate(zip(ranks, brackets))]).first()
    return list(row)


def grouped_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float], limit: int = GROUP_VALUES) -> DataFrame:
    """Exact interpolated quantiles per group: (keys, p1, p2, ...). Null and NaN values are ignored, groups without others left out.

    Equal values are folded before they move. A group of up to ``limit`` distinct values is sorted in one task. For larger
    groups each wanted rank keeps a bracket of values, and all brackets of all groups are narrowed by the same passes: a
    sketch cuts a bracket in ``CUTS`` parts, the parts are counted, and those that hold the rank stay.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    values = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], present(value).alias("_x")).where("_x IS NOT NULL")
    folded = materialize(values.groupBy(*names, "_x").agg(F.count(F.lit(1)).alias("_c")))
    ranks = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)])
    groups = (folded.groupBy(*names).agg(F.sum("_c").alias("_n"), F.count(F.lit(1)).alias("_m"))
              .select(*names, "_m", "_n", F.explode(ranks).alias("r"))
              .select(*names, "_m", F.col("r.i").alias("_i"), ((F.col("_n") - 1) * F.col("r.p")).alias("_h"),
                      F.lit(float("-inf")).alias("_lo"), F.lit(float("inf")).alias("_hi"), F.lit(0).cast("bigint").alias("_below")))
    brackets = materialize(groups)
    while (brackets.agg(F.max("_m")).first()[0] or 0) > limit:
        brackets = materialize(_tighter(folded, brackets.where(F.col("_m") > limit), names).unionByName(brackets.where(F.col("_m") <= limit)))
    # a value with c copies holds the 0-based ranks [last - c + 1, last]
    along = W.partitionBy(*names, "_i").orderBy("_x").rowsBetween(W.unboundedPreceding, 0)
    run = _within(folded, brackets, names).withColumn("_last", F.col("_below") + F.sum("_c").over(along) - 1)
    first = F.col("_last") - F.col("_c") + 1

    def at(rank):
        return F.max(F.when((first <= rank) & (F.col("_last") >= rank), F.col("_x")))
    found = run.groupBy(*names, "_i").agg(at(F.floor("_h")).alias("_a"), at(F.ceil("_h")).alias("_b"), (F.max("_h") - F.floor(F.max("_h"))).alias("_f"))
    value_at = F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_f")
    wide = found.groupBy(*names).agg(*[F.max(F.when(F.col("_i") == i, value_at)).alias(f"p{i + 1}") for i in range(len(probs))])
    return wide.select(*[F.col(n).alias(k) for k, n in zip(keys, names)], *[f"p{i + 1}" for i in range(len(probs))])


def _within(folded: DataFrame, brackets: DataFrame, names: list[str]) -> DataFrame:
    """The folded values inside each bracket of their group."""
    b = brackets.select(*[F.col(n).alias(f"b{n}") for n in names], *[c for c in brackets.columns if c not in names])
    same = [F.col(n).eqNullSafe(F.col(f"b{n}")) for n in names]
    return folded.join(b, [*same, F.col("_x").between(F.col("_lo"), F.col("_hi"))]).drop(*[f"b{n}" for n in names])


def _tighter(folded: DataFrame, brackets: DataFrame, names: list[str]) -> DataFrame:
    """Brackets around the parts that hold the ranks below and above each wanted one."""
    steps = F.array(*[F.lit(i / CUTS) for i in range(1, CUTS)])
    cuts = _within(folded, brackets, names).groupBy(*names, "_i").agg(F.percentile_approx("_x", steps, F.lit(20 * CUTS)).alias("_cuts"))
    b = brackets.select(*[F.col(n).alias(f"c{n}") for n in names], F.col("_i").alias("_ci"), *[c for c in brackets.columns if c not in (*names, "_i")])
    same = [F.col(n).eqNullSafe(F.col(f"c{n}")) for n in names]
    both = cuts.join(b, [*same, F.col("_i") == F.col("_ci")]).drop("_ci", *[f"c{n}" for n in names])
    part = sum([(F.col("_x") > F.col("_cuts")[j]).cast("int") for j in range(CUTS - 1)], F.lit(0))
    counted = (_within(folded, both, names).withColumn("_part", part).groupBy(*names, "_i", "_part")
               .agg(F.sum("_c").alias("_w"), F.count(F.lit(1)).alias("_m"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"),
                    F.max("_h").alias("_h"), F.max("_below").alias("_below")))
    along = W.partitionBy(*names, "_i").orderBy("_part").rowsBetween(W.unboundedPreceding, 0)       # at most CUTS rows
    placed = counted.withColumn("_before", F.col("_below") + F.sum("_w").over(along) - F.col("_w"))
    holds = (F.col("_before") <= F.ceil("_h")) & (F.col("_before") + F.col("_w") > F.floor("_h"))
    return placed.where(holds).groupBy(*names, "_i").agg(
        F.sum("_m").alias("_m"), F.max("_h").alias("_h"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"), F.min("_before").alias("_below"))
