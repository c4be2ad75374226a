"""Exact quantiles by selection."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devpulse.sources.sinks import cut_lineage

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
# the sketch's rank error is one in this many rows
ACCURACY = 10_000
SLICES = 256


def _same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """An inner join on keys of which NULLs match; the right side's keys go."""
    renamed = right.withColumnsRenamed({k: f"_r{i}" for i, k in enumerate(keys)})
    same = [F.col(k).eqNullSafe(F.col(f"_r{i}")) for i, k in enumerate(keys)]
    return left.join(renamed, same).drop(*[f"_r{i}" for i in range(len(keys))])


def group_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Mapping[str, float] = QUARTILES,
    further: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Exact, interpolated quantiles of `value` per key, by selection; NULL values don't count.
    `further` are aggregates of the group that the first pass makes as well.

    The first pass sketches each group.  A sketch's rank error is bounded, so the values at either
    side of a wanted rank, by twice that error, are sure to hold it between them.  The second pass
    counts: what lies outside such brackets becomes one number a gap, what lies inside is counted
    by value in `SLICES` slices a bracket.  The slices' totals say which of them holds a rank, and
    only its values come together.  No window, and no task holds a group or a bracket, however
    many rows a group has and however open the values' domain is."""
    margin = 2 / ACCURACY
    places = list(probabilities.values())
    wanted = [x for p in places for x in (max(0.0, p - margin), min(1.0, p + margin))]
    rows = df.where(F.col(value).isNotNull()).withColumn("_v", F.col(value).cast("double"))
    sketched = rows.groupBy(*keys).agg(
        F.percentile_approx("_v", wanted, ACCURACY).alias("_at"),
        F.count(F.lit(1)).alias("_total"),
        F.min("_v").alias("_least"),
        F.max("_v").alias("_most"),
        *[c.alias(name) for name, c in (further or {}).items()],
    )
    ends = [
        (
            "_least" if p <= margin else f"_at[{2 * i}]",
            "_most" if p >= 1 - margin else f"_at[{2 * i + 1}]",
        )
        for i, p in enumerate(places)
    ]
    # a small group is one bracket, where the sketch's margin would be less than a rank or two
    small = f"_total <= {4 * ACCURACY}"
    brackets = ", ".join(
        f"named_struct('low', IF({small}, _least, {low}), 'high', IF({small}, _most, {high}))"
        for low, high in ends
    )
    groups = cut_lineage(
        sketched.withColumn("_brackets", F.expr(f"array({brackets})"))
        .withColumn("_edges", F.expr("array_sort(array_distinct(flatten(transform(_brackets, b -> array(b.low, b.high)))))"))
        .select(*keys, "_total", "_brackets", "_edges", *(further or {}))
    )
    # a value's region: odd on an edge, even between two; the i-th gap lies below the i-th edge
    placed = (
        _same_key(rows.select(*keys, "_v"), groups.select(*keys, "_brackets", "_edges"), keys)
        .withColumn("_i", F.expr("size(filter(_edges, e -> e < _v))"))
        .withColumn("_edge", F.expr("array_contains(_edges, _v)"))
        .withColumn("_low", F.expr("IF(_i > 0, _edges[_i - 1], NULL)"))
        .withColumn("_high", F.expr("IF(_i < size(_edges), _edges[_i], NULL)"))
        .withColumn("_kept", F.expr("_edge OR exists(_brackets, b -> b.low <= _low AND _high <= b.high)"))
    )
    part = f"greatest(0, least({SLICES - 1}, int({SLICES} * ((_v - _low) / (_high - _low)))))"
    counted = cut_lineage(
        placed.select(
            *keys,
            F.expr("2 * _i + int(_edge)").alias("_region"),
            F.expr(f"IF(_kept AND NOT _edge, {part}, 0)").alias("_slice"),
            F.expr("IF(_kept, _v, NULL)").alias("_v"),
        )
        .groupBy(*keys, "_region", "_slice", "_v")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return _at_ranks(counted, groups, keys, probabilities).select(*keys, *(further or {}), *probabilities)


def _at_ranks(
    counted: DataFrame, groups: DataFrame, keys: Sequence[str], probabilities: Mapping[str, float]
) -> DataFrame:
    """`groups` with the interpolated value at each wanted rank, of values that are counted by
    region and slice."""
    slices = counted.groupBy(*keys, "_region", "_slice").agg(F.sum("_n").alias("_n"))
    ordered = F.array_sort(F.collect_list(F.struct("_region", "_slice", "_n"))).alias("_slices")
    listed = _same_key(groups, slices.groupBy(*keys).agg(ordered), keys)
    # the whole rank at or below each place, and the next; the slice that holds it, and its rank there
    ranks = ", ".join(
        f"named_struct('name', '{i}{side}', 'rank', bigint({side}({p}D * (_total - 1))))"
        for i, p in enumerate(probabilities.values())
        for side in ("floor", "ceil")
    )
    search = """aggregate(_slices, named_struct('seen', 0L, 'region', int(NULL), 'slice', int(NULL), 'inside', bigint(NULL)),
        (a, s) -> named_struct('seen', a.seen + s._n,
            'region', IF(a.region IS NULL AND r.rank < a.seen + s._n, s._region, a.region),
            'slice', IF(a.region IS NULL AND r.rank < a.seen + s._n, s._slice, a.slice),
            'inside', IF(a.region IS NULL AND r.rank < a.seen + s._n, r.rank - a.seen, a.inside)))"""
    found = listed.select(
        *keys, F.expr(f"inline(transform(array({ranks}), r -> struct(r.name AS _name, {search} AS _to)))")
    ).select(*keys, "_name", "_to.region", "_to.slice", "_to.inside")
    at = found.withColumnsRenamed({"region": "_region", "slice": "_slice"})
    values = _same_key(counted.where("_v IS NOT NULL"), at, [*keys, "_region", "_slice"])
    picked = values.groupBy(*keys, "_name", "inside").agg(
        F.array_sort(F.collect_list(F.struct("_v", "_n"))).alias("_values")
    )
    pick = """aggregate(_values, named_struct('seen', 0L, 'v', double(NULL)),
        (a, x) -> named_struct('seen', a.seen + x._n, 'v', IF(a.v IS NULL AND inside < a.seen + x._n, x._v, a.v))).v"""
    one = picked.select(*keys, "_name", F.expr(pick).alias("_value"))
    names = [f"{i}{side}" for i in range(len(probabilities)) for side in ("floor", "ceil")]
    wide = one.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_name") == n, F.col("_value"))).alias(f"_{n}") for n in names]
    )
    results = []
    for i, (name, p) in enumerate(probabilities.items()):
        place = F.lit(p) * (F.col("_total") - 1)
        low, high = F.col(f"_{i}floor"), F.col(f"_{i}ceil")
        results.append((low + (high - low) * (place - F.floor(place))).alias(name))
    return _same_key(groups, wide, keys).select("*", *results)
