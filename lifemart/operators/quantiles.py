"""Exact order statistics of whole tables, without a task that holds a row for each value.

exact_ranks narrows an open interval around each wanted rank: a sketch (merged from tasks, of a bounded size) proposes two
values, one scan counts what lies below, at, between and above them, and the rank goes on in the part that holds it. Each round
leaves a few ten-thousandths of the rows, and the counts, not the sketch, decide; at most SMALL rows are sorted at the end.

ranks_as_of answers the same for many moments at once: the value of a rank among the rows known by then.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of an interval that are sorted; accuracy of the sketch, and how many of its errors the proposed values lie apart.
SMALL, ACCURACY, APART = 200_000, 10_000, 2.0
#: Ranges of values that ranks_as_of counts in.
RANGES = 256


@dataclass
class _Search:
    """A rank (from 0) among the values of a column: what is known of it so far."""

    column: str
    rank: int
    inside: int
    low: float | None = None
    high: float | None = None
    below: int = 0
    value: float | None = None
    ends: tuple[float, float] = field(default=(0.0, 0.0))

    def within(self, x: Column) -> Column:
        """Whether x lies in the open interval."""
        out = x.isNotNull()
        if self.low is not None:
            out &= x > F.lit(self.low)
        if self.high is not None:
            out &= x < F.lit(self.high)
        return out

    def narrow(self, less: int, first: int, between: int, last: int) -> None:
        """Goes on in the part that holds the rank; the counts are of values below the first end, at it, between, and at the last."""
        a, b = self.ends
        r = self.rank - self.below
        if r < less:
            self.high, self.inside = a, less
        elif r < less + first:
            self.value = a
        elif r < less + first + between:
            self.low, self.high, self.below, self.inside = a, b, self.below + less + first, between
        elif r < less + first + between + last:
            self.value = b
        else:
            known = less + first + between + last
            self.low, self.below, self.inside = b, self.below + known, self.inside - known


def _number(column: str) -> Column:
    x = F.col(column).cast("double")
    return F.when(~F.isnan(x), x)


def _rounds(df: DataFrame, searches: list[_Search], small: int) -> None:
    """Narrows searches until each is found or has at most small rows inside."""
    while live := [s for s in searches if s.value is None and s.inside > small]:
        spans: dict[tuple, list[_Search]] = {}  # searches of one interval share a sketch and counts
        for s in live:
            spans.setdefault((s.column, s.low, s.high), []).append(s)
        groups, shares = list(spans.values()), []
        for group in groups:
            places = [(s.rank - s.below + 0.5) / s.inside for s in group]
            ends = [x for p in places for x in (max(0.0, p - APART / ACCURACY), min(1.0, p + APART / ACCURACY))]
            shares.append(F.percentile_approx(F.when(group[0].within(_number(group[0].column)), _number(group[0].column)), F.array(*map(F.lit, ends)), ACCURACY))
        for group, ends in zip(groups, df.agg(*(x.alias(f"s{i}") for i, x in enumerate(shares))).first(), strict=True):
            for k, s in enumerate(group):
                s.ends = (ends[2 * k], ends[2 * k + 1])
        points, counts = [(group, sorted({e for s in group for e in s.ends})) for group in groups], []
        for i, (group, ends) in enumerate(points):
            x = _number(group[0].column)
            inside = group[0].within(x)
            for k, e in enumerate(ends):
                counts += [F.count_if(inside & (x < e)).alias(f"l{i}_{k}"), F.count_if(inside & (x == e)).alias(f"e{i}_{k}")]
        found = iter(df.agg(*counts).first())
        for group, ends in points:
            seen = {e: (next(found), next(found)) for e in ends}  # below it and at it
            for s in group:
                (less, first), (upto, last) = (seen[e] for e in s.ends)
                a, b = s.ends
                s.narrow(less, first, max(0, upto - less - first), last if a < b else 0)


def exact_ranks(df: DataFrame, ranks: dict[str, list[int]], counts: dict[str, int], small: int = SMALL) -> dict[tuple[str, int], float]:
    """The value of each rank (from 0, below the column's count of values) of each column."""
    searches = [_Search(c, r, counts[c]) for c, rs in ranks.items() for r in sorted(set(rs))]
    _rounds(df, searches, small)
    left = [s for s in searches if s.value is None]
    if left:
        held = [F.when(s.within(_number(s.column)), F.struct(F.lit(i).alias("i"), _number(s.column).alias("x"))) for i, s in enumerate(left)]
        values = df.select(F.inline(F.array_compact(F.array(*held)))).groupBy("i", "x").agg(F.count("*").alias("n"))  # at most small rows for each
        upto = values.withColumn("upto", F.sum("n").over(Window.partitionBy("i").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)))
        wanted = F.element_at(F.array(*(F.lit(s.rank - s.below) for s in left)), F.col("i") + 1)
        for r in upto.where((F.col("upto") > wanted) & (F.col("upto") - F.col("n") <= wanted)).select("i", "x").collect():  # a row for each rank
            left[r["i"]].value = r["x"]
    return {(s.column, s.rank): s.value for s in searches}


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: list[float], small: int = SMALL) -> dict[tuple[str, float], float | None]:
    """The interpolated quantile of each column at each probability; nulls and NaN are no values, None where a column has none."""
    counts = dict(zip(columns, df.agg(*(F.count(_number(c)) for c in columns)).first(), strict=True))
    places = {(c, p): p * (counts[c] - 1) for c in columns for p in probabilities if counts[c]}
    ranks: dict[str, list[int]] = {}
    for (c, _), at in places.items():
        ranks.setdefault(c, []).extend((math.floor(at), math.ceil(at)))
    found = exact_ranks(df, ranks, counts, small) if ranks else {}
    out: dict[tuple[str, float], float | None] = {(c, p): None for c in columns for p in probabilities}
    for (c, p), at in places.items():
        low, high = found[c, math.floor(at)], found[c, math.ceil(at)]
        out[c, p] = low if low == high else low + (high - low) * (at - math.floor(at))
    return out


def grouped_quantiles(df: DataFrame, group: str, column: str, probabilities: list[float], name: str, small: int = SMALL) -> DataFrame:
    """group, name: the interpolated quantiles of column in each group, an array. Groups should be few: each is a column of the search, and none is held by a task."""
    values = [r[group] for r in df.select(group).distinct().collect()]  # a value for each group
    parts = {f"_x{i}": F.when(F.col(group).eqNullSafe(F.lit(v)), F.col(column)) for i, v in enumerate(values)}
    found = exact_quantiles(df.select(*(x.alias(c) for c, x in parts.items())), list(parts), probabilities, small)
    rows = [(v, q if None not in (q := [found[f"_x{i}", p] for p in probabilities]) else None) for i, v in enumerate(values)]
    return df.sparkSession.createDataFrame(rows, f"{group} {df.schema[group].dataType.simpleString()}, {name} array<double>")


def discrete_quantiles(df: DataFrame, columns: list[str], probability: float, small: int = SMALL) -> dict[str, float | None]:
    """The least value of each column that a share of probability of its values does not exceed; nulls and NaN are no values, None where a column has none."""
    counts = dict(zip(columns, df.agg(*(F.count(_number(c)) for c in columns)).first(), strict=True))
    ranks = {c: max(1, math.ceil(Fraction(str(probability)) * n)) - 1 for c, n in counts.items() if n}
    found = exact_ranks(df, {c: [r] for c, r in ranks.items()}, counts, small) if ranks else {}
    return {c: found[c, ranks[c]] if c in ranks else None for c in columns}


def numeric_profile(df: DataFrame, columns: list[str], small: int = SMALL) -> DataFrame:
    """A row for each column: observations, null and zero rates, moments, quantiles. NaN counts as null.

    Skewness and kurtosis have the small-sample corrections, and are null below 3 and 4 values or without spread; the deviation of
    one value is 0. Moments take one scan, quantiles those of exact_ranks.
    """
    probabilities = [0.05, 0.25, 0.5, 0.75, 0.95]
    quantiles = exact_quantiles(df, columns, probabilities, small)
    parts = []
    for c in columns:
        x = _number(c)
        n = F.count(x).cast("double")
        skew = F.when((n > 2) & (F.var_pop(x) > 0), F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2))
        kurt = F.when((n > 3) & (F.var_pop(x) > 0), (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(x) + 6))
        parts.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.count("*").alias("observations"),
                F.when(F.count("*") > 0, 1 - n / F.count("*")).alias("null_rate"),
                F.when(n > 0, F.count_if(x == 0) / n).alias("zero_rate"),
                F.avg(x).alias("mean"),
                F.when(n > 1, F.stddev_samp(x)).when(n == 1, 0.0).alias("sd"),
                F.min(x).alias("lo"),
                *(F.lit(quantiles[c, p]).cast("double").alias(f"q{round(100 * p):02d}") for p in probabilities),
                F.max(x).alias("hi"),
                skew.alias("skew"),
                kurt.alias("kurtosis"),
            )
        )
    return df.agg(F.array(*parts).alias("parts")).select(F.inline("parts"))


def ranks_as_of(values: DataFrame, wanted: DataFrame, keys: list[str], time: str, value: str, at: str = "at", rank: str = "rank", ranges: int = RANGES) -> DataFrame:
    """wanted (keys, at, rank) with value: that of the rank (from 1) among the rows of values with its key and a time not after at.

    Values fall into ranges of their key. Running counts of a key's ranges in time, a row for each range and moment, say in which range a
    rank lies at each moment; only values of such ranges meet their moments. Rows of wanted whose rank has no value are left out.
    """
    known = values.where(F.col(value).isNotNull() & F.col(time).isNotNull()).select(*keys, F.col(time).alias("_t"), F.col(value).cast("double").alias("_x"))
    spans = known.groupBy(*keys).agg(F.min("_x").alias("_lo"), F.percentile_approx("_x", 0.999, ACCURACY).alias("_hi"))
    place = F.when(F.col("_hi") > F.col("_lo"), F.width_bucket("_x", "_lo", "_hi", F.lit(ranges))).otherwise((F.col("_x") > F.col("_hi")).cast("long"))
    parted = known.join(spans, keys).withColumn("_part", place).groupBy(*keys, "_part", "_t", "_x").agg(F.count("*").alias("_n"))
    ask = wanted.select(*keys, F.col(at).alias("_at"), F.col(rank).cast("long").alias("_rank")).distinct()
    moves = parted.groupBy(*keys, "_part", "_t").agg(F.sum("_n").alias("_n"))
    stops = moves.select(*keys, "_part").distinct().join(ask.select(*keys, "_at").distinct(), keys)
    both = moves.select(*keys, "_part", "_t", "_n", F.lit(False).alias("_stop")).unionByName(stops.select(*keys, "_part", F.col("_at").alias("_t"), F.lit(0).cast("long").alias("_n"), F.lit(True).alias("_stop")))
    upto = F.sum("_n").over(Window.partitionBy(*keys, "_part").orderBy("_t").rangeBetween(Window.unboundedPreceding, 0))
    held = both.withColumn("_held", upto).where("_stop and _held > 0").select(*keys, "_part", F.col("_t").alias("_at"), "_held")
    before = F.sum("_held").over(Window.partitionBy(*keys, "_at").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_held")
    hits = held.withColumn("_before", before).join(ask, [*keys, "_at"]).where((F.col("_rank") > F.col("_before")) & (F.col("_rank") <= F.col("_before") + F.col("_held")))
    near = parted.join(hits.select(*keys, "_part", "_at", "_rank", "_before"), [*keys, "_part"]).where("_t <= _at")
    near = near.groupBy(*keys, "_at", "_rank", "_before", "_x").agg(F.sum("_n").alias("_n"))
    end = F.sum("_n").over(Window.partitionBy(*keys, "_at", "_rank").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)) + F.col("_before")
    found = near.withColumn("_end", end).where((F.col("_end") >= F.col("_rank")) & (F.col("_end") - F.col("_n") < F.col("_rank")))
    return wanted.join(found.select(*keys, F.col("_at").alias(at), F.col("_rank").alias(rank), F.col("_x").alias(value)), [*keys, at, rank])
