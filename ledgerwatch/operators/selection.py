"""Exact order statistics and exact-size hash samples in two scans, without a global sort.

The first scan takes, for all columns in one aggregate, counts, ends and a mergeable rank-error sketch. The
sketch brackets each wanted rank between two values. The second scan counts the rows below each
bracket and gathers the values inside it with their counts, combined in the map tasks: a fixed share
of the rows. The rank is then found among those values alone.

Where many values lie in a bracket they are narrowed: every pass counts how many rows fall into
each of ``BUCKETS`` equal parts of the interval known to hold the rank and keeps the one part
that holds it; where equal parts do not spread the rows, because values differ by orders of magnitude,
the next pass cuts on a logarithmic scale. Weighted rows, and a rank that the sketch missed, are
narrowed over the table itself. One line per wanted rank reaches the driver, and no task ever
holds more of a column than the sketch, BUCKETS or FETCH_ROWS lines.
"""

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from math import floor, inf

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 256
FETCH_ROWS = 2048
#: Size of a sketch and about the share of ranks by which it may err; brackets are three times as wide.
SKETCH_K, SKETCH_ERROR = 2048, 0.0015
_HUGE = 1.7976931348623157e308  # largest finite double: stands in for infinity


@dataclass
class Located:
    """A value with the weight strictly below it and the weight at it."""

    value: float
    below: int
    at: int


@dataclass
class _Interval:
    """The part of a series known to hold some ranks."""

    series: int
    low: float
    high: float
    below: int
    rows: int
    total: int
    ranks: list[int] = field(default_factory=list)
    log: bool = False


class OrderStatistics:
    """Finds values by 0-based rank in several numeric series of one frame.

    Nulls and NaN are left out. Whole-number series are kept exact and must each span less
    than 2**63; mixed with others they are read as doubles. With ``weight`` a row counts as
    that many equal rows.
    """

    def __init__(self, df: DataFrame, series: Mapping[str, Column], weight: Column | None = None):
        self.names = list(series)
        types = df.select(*[c.alias(f"s{i}") for i, c in enumerate(series.values())]).schema
        self.whole = all(isinstance(f.dataType, T.IntegralType) for f in types)
        self.kind = "long" if self.whole else "double"
        self.sketched = weight is None
        w = (F.lit(1) if weight is None else weight).cast("long").alias("w")
        self.table = df.select(w, *[self._clean(c.cast(self.kind)).alias(f"s{i}") for i, c in enumerate(series.values())])
        self.head = {name: h for name, h in zip(self.names, self._ends(), strict=True) if h["c"]}

    def _clean(self, v: Column) -> Column:
        if self.whole:
            return v
        return F.when(v.isNotNull() & ~F.isnan(v), F.greatest(F.least(v, F.lit(_HUGE)), F.lit(-_HUGE)))

    def _ends(self) -> list[dict]:
        """Weight, rows, ends and sketch of every series, from one aggregate."""
        sketch = F.kll_sketch_agg_bigint if self.whole else F.kll_sketch_agg_double
        parts = []
        for i in range(len(self.names)):
            v = F.col(f"s{i}")
            fields = {"w": F.sum(F.when(v.isNotNull(), F.col("w"))), "c": F.count(v), "lo": F.min(v), "hi": F.max(v)}
            if self.sketched:
                fields["sketch"] = F.when(F.count(v) > FETCH_ROWS, sketch(v, F.lit(SKETCH_K)))
            parts.append(F.struct(*[x.alias(k) for k, x in fields.items()]).alias(f"s{i}"))
        return [x.asDict() for x in self.table.agg(*parts).first()] if parts else []

    def _long(self) -> DataFrame:
        """A line per row and series with a value."""
        values = F.array(*[F.col(f"s{i}") for i in range(len(self.names))])
        return self.table.select("w", F.posexplode(values).alias("i", "v")).where(F.col("v").isNotNull())

    def count(self, name: str) -> int:
        return self.head[name]["w"] if name in self.head else 0

    def locate(self, ranks: Mapping[str, Iterable[int]]) -> dict[tuple[str, int], Located]:
        intervals, brackets = [], []
        for name, wanted in ranks.items():
            wanted = sorted(set(wanted))
            if not wanted:
                continue
            total = self.count(name)
            if wanted[0] < 0 or wanted[-1] >= total:
                raise ValueError(f"rank outside 0..{total - 1} for {name}")
            h, i = self.head[name], self.names.index(name)
            it = _Interval(i, h["lo"], h["hi"], 0, h["c"], total, wanted)
            (brackets if h.get("sketch") is not None and h["lo"] < h["hi"] else intervals).append(it)
        found: dict[tuple[int, int], Located] = {}
        if brackets:
            intervals += self._by_brackets(self._brackets(brackets), found)
        if intervals:
            found.update(self._search(self._long(), intervals))
        return {(self.names[i], rank): x for (i, rank), x in found.items()}

    def _brackets(self, intervals: Sequence[_Interval]) -> list[_Interval]:
        """Values between which the sketches put the ranks; ranks close to each other share a bracket."""
        spark = self.table.sparkSession
        places, out = [], []  # of each bracket the shares of rows below its ends
        for it in intervals:
            first = len(out)
            for r in it.ranks:
                low, high = ((r + 0.5) / it.total + d * 3 * SKETCH_ERROR for d in (-1, 1))
                if len(out) > first and low <= places[-1][1]:
                    places[-1][1] = high
                    out[-1].ranks.append(r)
                else:
                    places.append([low, high])
                    out.append(_Interval(it.series, it.low, it.high, 0, it.rows, it.total, [r]))
        used = sorted({it.series for it in intervals})
        sketches = [tuple(self.head[self.names[i]]["sketch"] for i in used)]
        quantile = F.kll_sketch_get_quantile_bigint if self.whole else F.kll_sketch_get_quantile_double
        asked = spark.createDataFrame(sketches, ", ".join(f"s{i} binary" for i in used)).select(
            *[
                quantile(F.col(f"s{it.series}"), F.array(F.lit(max(0.0, low)), F.lit(min(1.0, high)))).alias(f"q{n}")
                for n, (it, (low, high)) in enumerate(zip(out, places, strict=True))
            ]
        )
        for it, (low, high), (at_low, at_high) in zip(out, places, asked.first(), strict=True):
            if low > 0:
                it.low = at_low
            if high < 1:
                it.high = at_high
        return out

    def _by_brackets(self, brackets: Sequence[_Interval], found: dict) -> list[_Interval]:
        """The second scan; returns intervals of the table for ranks that are not in their bracket."""
        lines = []
        for n, it in enumerate(brackets):
            v, low = F.col(f"s{it.series}"), F.lit(it.low)
            held = F.struct(F.lit(n).alias("i"), (v < low).alias("under"), F.when(v >= low, v).alias("v"))
            lines.append(F.when(v <= F.lit(it.high), held))
        rows = self.table.select("w", F.explode(F.array(*lines)).alias("x")).where("x is not null").select("w", "x.*")
        rows = rows.groupBy("i", "under", "v").agg(F.sum("w").alias("w")).persist()
        try:
            inside = F.when(~F.col("under"), F.col("w"))
            ends = rows.groupBy("i").agg(
                F.coalesce(F.sum(F.when(F.col("under"), F.col("w"))), F.lit(0)).alias("below"), F.coalesce(F.sum(inside), F.lit(0)).alias("w"),
                F.count("v").alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi"),
            )
            missed, narrow = [], []
            for e in ends.collect():
                it = brackets[e["i"]]
                here = [r for r in it.ranks if e["below"] <= r < e["below"] + e["w"]]
                if here:
                    narrow.append(_Interval(e["i"], e["lo"], e["hi"], e["below"], e["c"], e["w"], here))
                if len(here) < len(it.ranks):
                    h = self.head[self.names[it.series]]
                    missed.append(_Interval(it.series, h["lo"], h["hi"], 0, h["c"], h["w"], [r for r in it.ranks if r not in here]))
            if narrow:
                kept = rows.where(~F.col("under")).select("w", "i", "v")
                for (n, rank), x in self._search(kept, narrow).items():
                    found[brackets[n].series, rank] = x
        finally:
            rows.unpersist()
        return missed

    def _search(self, rows: DataFrame, wide: list[_Interval]) -> dict[tuple[int, int], Located]:
        """(series, rank) -> value, by narrowing over ``rows`` (w, i, v)."""
        found: dict[tuple[int, int], Located] = {}
        small: list[_Interval] = []
        while wide:
            still = []
            for it in wide:
                if it.low == it.high:
                    for r in it.ranks:
                        found[it.series, r] = Located(self._value(it.low), it.below, it.total)
                elif it.rows <= FETCH_ROWS:
                    small.append(it)
                else:
                    still.append(it)
            wide = self._narrow(rows, still) if still else []
        if small:
            self._count_out(rows, small, found)
        return found

    def _value(self, v):
        return inf if v == _HUGE else -inf if v == -_HUGE else v

    def _inside(self, rows: DataFrame, intervals: Sequence[_Interval]) -> DataFrame:
        """The rows of each interval; the joined table has one line per interval."""
        spark = rows.sparkSession
        lines = [(it.series, n, it.low, it.high, it.log) for n, it in enumerate(intervals)]
        table = spark.createDataFrame(lines, f"i int, n int, low {self.kind}, high {self.kind}, log boolean")
        return rows.join(F.broadcast(table), "i").where("v between low and high")

    def _bucket(self) -> Column:
        if self.whole:
            return F.expr(f"cast((v - low) div ((high - low) div {BUCKETS}L + 1L) as int)")
        even = (F.col("v") / 2 - F.col("low") / 2) / (F.col("high") / 2 - F.col("low") / 2)
        v, low, high = (_signed_log(F.col(c)) for c in ("v", "low", "high"))
        part = F.floor(F.when(F.col("log"), (v - low) / (high - low)).otherwise(even) * BUCKETS)
        return F.least(part, F.lit(BUCKETS - 1)).cast("int")

    def _holding(self, parts: DataFrame, order: str, intervals: Sequence[_Interval]) -> dict[int, list]:
        """The parts that hold a wanted rank, with the weight before them: n -> (rank, part).

        Running sums go over the parts of one interval, at most BUCKETS or FETCH_ROWS lines.
        """
        spark = parts.sparkSession
        wanted = [(n, r - it.below) for n, it in enumerate(intervals) for r in it.ranks]
        ranks = spark.createDataFrame(wanted, "n int, rank long")
        run = Window.partitionBy("n").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        before = parts.withColumn("before", F.coalesce(F.sum("w").over(run), F.lit(0)))
        held = before.join(F.broadcast(ranks), "n").where("rank >= before and rank < before + w")
        out: dict[int, list] = {}
        for p in held.collect():
            out.setdefault(p["n"], []).append((p["rank"] + intervals[p["n"]].below, p))
        return out

    def _narrow(self, rows: DataFrame, intervals: list[_Interval]) -> list[_Interval]:
        parts = (
            self._inside(rows, intervals).groupBy("n", self._bucket().alias("b"))
            .agg(F.sum("w").alias("w"), F.count("*").alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        )
        out = []
        for n, held in self._holding(parts, "b", intervals).items():
            it, kept = intervals[n], {}
            for rank, p in held:
                if p["b"] not in kept:
                    log = not self.whole and 4 * p["c"] > it.rows and _differs_widely(p["lo"], p["hi"])
                    kept[p["b"]] = _Interval(
                        it.series, p["lo"], p["hi"], it.below + p["before"], p["c"], p["w"], [], log
                    )
                kept[p["b"]].ranks.append(rank)
            out += kept.values()
        return out

    def _count_out(self, rows: DataFrame, intervals: list[_Interval], found: dict) -> None:
        values = self._inside(rows, intervals).groupBy("n", "v").agg(F.sum("w").alias("w"))
        for n, held in self._holding(values, "v", intervals).items():
            it = intervals[n]
            for rank, p in held:
                found[it.series, rank] = Located(self._value(p["v"]), it.below + p["before"], p["w"])


def _signed_log(x: Column) -> Column:
    """Rises with x through zero: 746 exceeds -ln of the smallest positive double."""
    return F.when(x == 0, F.lit(0.0)).otherwise(F.signum(x) * (F.ln(F.abs(x)) + 746))


def _differs_widely(low: float, high: float) -> bool:
    return low <= 0 <= high or not 1 / 16 < low / high < 16


def exact_quantiles(
    df: DataFrame, series: Sequence[str] | Mapping[str, Column], probs: Sequence[float]
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per series; None for a series without values."""
    if not isinstance(series, Mapping):
        series = {c: F.col(c).cast("double") for c in series}
    stats = OrderStatistics(df, series)
    places = {
        name: [(stats.count(name) - 1) * q for q in probs] if stats.count(name) else []
        for name in series
    }
    top = {name: stats.count(name) - 1 for name in series}
    found = stats.locate(
        {n: [r for x in xs for r in (floor(x), min(floor(x) + 1, top[n]))] for n, xs in places.items()}
    )
    out: dict[str, list[float | None]] = {}
    for name, xs in places.items():
        out[name] = [None] * len(probs)
        for j, x in enumerate(xs):
            low = found[name, floor(x)].value
            high = found[name, min(floor(x) + 1, top[name])].value
            part = x - floor(x)
            out[name][j] = low if low == high or not part else low + (high - low) * part
    return out


def key_hash(key: Sequence[str], seed: int) -> Column:
    """62 bits that depend on the row's key and the seed, not on its partition."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *[F.col(c) for c in key]), 2)


def pick_smallest_hashes(
    df: DataFrame,
    key: Sequence[str],
    wanted: Mapping[str, tuple[Column, int]],
    seed: int,
) -> Column:
    """A predicate that holds for exactly ``n`` rows of each stratum.

    ``wanted`` maps a stratum name to (its condition, n). Rows are ordered by a hash of their
    key, so the choice is the same under any partitioning. Keys must be unique.
    """
    return _pick(df, key, dict(wanted), seed, None)


def _pick(df, key, wanted, seed, previous_ties) -> Column:
    h = key_hash(key, seed)
    stats = OrderStatistics(df, {name: F.when(cond, h) for name, (cond, _) in wanted.items()})
    short = {name: n for name, (_, n) in wanted.items() if n > stats.count(name)}
    if short:
        raise ValueError(f"strata smaller than the rows asked for: {short}")
    cuts = stats.locate({name: [n - 1] for name, (_, n) in wanted.items() if n > 0})
    picked = F.lit(False)
    for (name, _), cut in cuts.items():
        cond, n = wanted[name]
        if cut.below + cut.at == n:
            picked = picked | (cond & (h <= cut.value))
            continue
        if cut.at == previous_ties:
            raise ValueError(f"key {list(key)} is not unique: {cut.at} rows share one key")
        tied = cond & (h == cut.value)
        among = _pick(df.where(tied), key, {name: (F.lit(True), n - cut.below)}, seed + 1, cut.at)
        picked = picked | (cond & (h < cut.value)) | (tied & among)
    return picked
