"""Charts from words, boxes and pixels that are given as tables: axes, bars, labels, markers, lines, arrows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def clustered(values: Column, tolerance: float) -> Column:
    """For sorted values the number of the cluster of each: one joins the last cluster if it is near that one's mean."""
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("n"), F.lit(-1).alias("g"), F.array().cast("array<int>").alias("out"))

    def step(s: Column, v: Column) -> Column:
        near = (s["n"] > 0) & (F.abs(v - s["sum"] / s["n"]) <= tolerance)
        g = F.when(near, s["g"]).otherwise(s["g"] + 1)
        return F.struct(F.when(near, s["sum"] + v).otherwise(v).alias("sum"), F.when(near, s["n"] + 1).otherwise(1).alias("n"), g.alias("g"), F.concat(s["out"], F.array(g)).alias("out"))

    return F.aggregate(values, start, step, lambda s: s["out"])


def axis_bands(ticks: DataFrame) -> DataFrame:
    """(chart, axis, band, slope, intercept, r2, n): the line through each band of ticks (chart, axis, band, pixel, value)
    that can be an axis: it fits, rises to the right, or falls down the page."""
    slope, r2, n = F.regr_slope("value", "pixel"), F.regr_r2("value", "pixel"), F.count(F.lit(1))
    b = ticks.groupBy("chart", "axis", "band").agg(slope.alias("slope"), F.regr_intercept("value", "pixel").alias("intercept"), r2.alias("r2"), n.alias("n"))
    rises = F.when(F.col("axis") == "x", F.col("slope") > 0).otherwise(F.col("slope") < 0)
    return b.where((F.col("n") >= 2) & (F.col("r2") >= 0.95) & rises)


def _fit_band(x: np.ndarray, y: np.ndarray, good: float) -> tuple | None:
    """(slope, intercept, r2, n) of ticks in order, the one that fits worst dropped until the rest fits or two are left."""
    while len(x) >= 2 and len(np.unique(x)) >= 2:
        slope, intercept = np.polyfit(x, y, 1)
        off = np.abs(y - slope * x - intercept)
        r2 = 1 - (off**2).sum() / (((y - y.mean()) ** 2).sum() or 1e-9)
        if r2 >= good or len(x) == 2:
            return slope, intercept, r2, len(x)
        keep = np.arange(len(x)) != off.argmax()
        x, y = x[keep], y[keep]
    return None


def _fit_bands(x: np.ndarray, y: np.ndarray, size: np.ndarray, good: float) -> tuple[np.ndarray, np.ndarray]:
    """Of bands, of so many ticks each in order, the fits that _fit_band gives, as rows (slope, intercept, r2, n), n 0 for
    none; all bands at once, each round dropping a tick of those that don't fit yet. Second, the bands where rounding
    decides: ticks that fit equally badly, fits near a limit, flat lines."""
    out, close = np.zeros((len(size), 4)), np.zeros(len(size), bool)
    ids = np.arange(len(size))
    while len(ids):
        enough = size >= 2
        x, y = x[np.repeat(enough, size)], y[np.repeat(enough, size)]
        ids, size = ids[enough], size[enough]
        if not len(ids):
            break
        at = np.concatenate(([0], np.cumsum(size)[:-1]))
        total = lambda v: np.add.reduceat(v, at)  # noqa: B023, E731
        each = lambda v: np.repeat(v, size)  # noqa: B023, E731
        mx, my = total(x) / size, total(y) / size
        dx, dy = x - each(mx), y - each(my)
        some = np.minimum.reduceat(x, at) != np.maximum.reduceat(x, at)
        slope = np.divide(total(dx * dy), total(dx * dx), out=np.zeros(len(size)), where=some)
        off = np.abs(dy - each(slope) * dx)
        syy, high = total(dy * dy), np.maximum.reduceat(np.abs(y), at)
        flat = syy <= 1e-18 * size * high * high
        r2 = 1 - total(off * off) / np.where(syy == 0, 1e-9, syy)
        worst = np.maximum.reduceat(off, at)
        done = some & ((r2 >= good) | (size == 2))
        near = some & ((np.abs(r2 - good) < 1e-9) & (size > 2) | flat)
        # as bad as the worst, but for rounding
        as_bad = off >= each(worst) - 1e-7 * each(np.maximum(worst, 1e-9 * high))
        near |= some & ~done & (total(as_bad.astype(np.int64)) > 1)
        close[ids[near]] = True
        over = done & ~near
        out[ids[over]] = np.column_stack((slope, my - slope * mx, r2, size))[over]
        on = some & ~done & ~near
        keep = each(on) & ~as_bad
        x, y, ids, size = x[keep], y[keep], ids[on], size[on] - 1
    return out, close


def fit_axes(ticks: DataFrame, good: float = 0.99, enough: float = 0.95) -> DataFrame:
    """(chart, axis, slope, intercept, r2, n): the best band's line for each axis, after ticks that fit worst are dropped
    one by one until the rest fits. The ticks of an axis are few and gathered into its row; batches of rows are fitted at
    once. Ticks without a pixel, value or band are left out."""
    kinds = {f.name: f.dataType.simpleString() for f in ticks.schema}

    def fit(batches):
        for batch in batches:
            lists, axis = batch.column(2), np.array(batch.column(1).to_pylist(), dtype=object)
            n, (band, x, y) = lists.value_lengths().to_numpy(zero_copy_only=False), lists.flatten().flatten()
            band, x, y = (v.to_numpy(zero_copy_only=False) for v in (band, x, y))
            if not len(x):
                continue
            row = np.repeat(np.arange(len(n)), n)
            first = np.concatenate(([True], (row[1:] != row[:-1]) | (band[1:] != band[:-1])))
            start = np.flatnonzero(first)
            size, row = np.diff(np.append(start, len(x))), row[first]
            fits, close = _fit_bands(x, y, size, good)
            for _ in range(2):
                for k in np.flatnonzero(close):
                    fits[k] = _fit_band(x[start[k] : start[k] + size[k]], y[start[k] : start[k] + size[k]], good) or 0
                fine = (fits[:, 3] > 0) & (fits[:, 2] >= enough) & ((fits[:, 0] > 0) == (axis[row] == "x")) & (fits[:, 0] != 0)
                score = np.where(fine, fits[:, 2] * fits[:, 3], -1.0)
                order = np.lexsort((np.arange(len(row)), -score, row))
                lead = np.concatenate(([True], row[order][1:] != row[order][:-1]))
                # bands that are as good but for rounding, or near the limit, are fitted one by one
                tied = ~lead[1:] & (score[order][1:] > 0) & (score[order][:-1] - score[order][1:] < 1e-9)
                again = np.abs(fits[:, 2] - enough) < 1e-9
                again[order[1:][tied]] = again[order[:-1][tied]] = True
                again &= ~close
                if not again.any():
                    break
                close = again
            best = order[lead]
            best = best[score[best] > 0]
            cols = [batch.column(0).take(pa.array(row[best])), batch.column(1).take(pa.array(row[best])), *[pa.array(fits[best, i]) for i in range(3)], pa.array(fits[best, 3].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(cols, names=["chart", "axis", "slope", "intercept", "r2", "n"])

    tick = F.struct("band", F.col("pixel").cast("double").alias("pixel"), F.col("value").cast("double").alias("value"))
    some = ticks.where(F.col("band").isNotNull() & F.col("pixel").isNotNull() & F.col("value").isNotNull())
    g = some.groupBy("chart", "axis").agg(F.sort_array(F.collect_list(tick)).alias("ticks"))
    return g.mapInArrow(fit, f"chart {kinds['chart']}, axis string, slope double, intercept double, r2 double, n long")


def bar_boxes(boxes: DataFrame, width: float, height: float) -> DataFrame:
    """Of components (chart, x, y, w, h, area) those that can be upright bars of a plot of that size."""
    w, h = F.col("w"), F.col("h")
    fine = (F.col("area") >= 0.001 * width * height) & (w >= 3) & (h >= 3) & (h / w >= 0.3) & (h >= 0.05 * height) & (w <= 0.5 * width) & (F.col("area") / (w * h) >= 0.55)
    return boxes.where(fine)


def bar_values(bars: DataFrame, axes: DataFrame, height: float) -> DataFrame:
    """(chart, x, value, status) of bars (chart, x, y, w, h) under axes (chart, slope, intercept).

    A bar that doesn't stand on zero counts from its foot. A chart with one bar, or without a baseline that three
    quarters of its bars share, is none.
    """
    foot = F.col("y") + F.col("h")
    band, w = max(8.0, 0.05 * height), Window.partitionBy("chart")
    shared = F.count(F.lit(1)).over(w.orderBy("_foot").rangeBetween(0, int(1000 * band)))  # in thousandths
    b = bars.join(axes, "chart").withColumn("_foot", F.round(1000 * foot).cast("long")).withColumn("_k", shared)
    b = b.withColumns({"_n": F.count(F.lit(1)).over(w), "_most": F.max("_k").over(w)})
    at = lambda p: p * F.col("slope") + F.col("intercept")
    on_zero = F.abs(foot - (-F.col("intercept") / F.col("slope"))) <= 0.05 * height
    value = F.round(F.when(on_zero, at(F.col("y"))).otherwise(at(F.col("y")) - at(foot)), 3)
    is_chart = (F.col("_n") >= 2) & (F.col("_most") >= F.greatest(F.lit(2), F.floor(0.75 * F.col("_n"))))
    status = F.when(F.abs("slope") < 1e-12, "no_axis").when(is_chart, "ok").otherwise("no_bars")
    return b.select("chart", F.floor(F.col("x") + F.col("w") / 2).cast("long").alias("x"), F.when(status == "ok", value).alias("value"), status.alias("status"))


def labelled(centres: Column, words: Column, spacing: Column) -> Column:
    """A label for each centre of a bar: the nearest word (at, text) not yet taken, within 0.7 of the spacing, or its number."""
    start = F.struct(F.array().cast("array<int>").alias("used"), F.array().cast("array<string>").alias("out"))

    def step(s: Column, c: Column) -> Column:
        free = F.filter(F.transform(words, lambda x, i: F.struct(F.abs(x["at"] - c).alias("d"), i.alias("i"), x["text"].alias("text"))), lambda x: ~F.array_contains(s["used"], x["i"]))
        best = F.array_min(free)
        near = best["d"] < 0.7 * spacing
        name = F.when(near, best["text"]).otherwise(F.concat(F.lit("Category "), F.size(s["out"]) + 1))
        return F.struct(F.when(near, F.concat(s["used"], F.array(best["i"]))).otherwise(s["used"]).alias("used"), F.concat(s["out"], F.array(name)).alias("out"))

    return F.aggregate(centres, start, step, lambda s: s["out"])


def markers(boxes: DataFrame, width: float, height: float) -> DataFrame:
    """Of components (chart, w, h, area) those that can be markers of a scatter plot of that size."""
    big, small = F.greatest("w", "h"), F.least("w", "h")
    return boxes.where((F.col("area") >= 4) & (F.col("area") <= 0.01 * width * height) & (big <= 30) & (big / F.greatest(F.lit(1), small) <= 2.5))


def line_like(points: DataFrame) -> DataFrame:
    """(chart, n, status) of points (chart, x): too few, a line (one point in most bins of x), or a scatter."""
    r = points.groupBy("chart").agg(F.min("x").alias("_lo"), F.max("x").alias("_hi"), F.count(F.lit(1)).alias("n"))
    r = r.withColumn("_bins", F.greatest(F.lit(10), F.floor((F.col("_hi") - F.col("_lo")) / 6)))
    b = points.join(r, "chart").withColumn("_b", F.floor((F.col("x") - F.col("_lo")) / F.nullif(F.col("_hi") - F.col("_lo"), F.lit(0.0)) * F.col("_bins")))
    full = b.groupBy("chart", "n", "_bins").agg(F.count_distinct("_b").alias("_full"))
    line = (F.col("n") / F.col("_full") < 1.5) & (F.col("_full") > 0.7 * F.col("_bins"))
    return full.select("chart", "n", F.when(F.col("n") < 3, "too few").when((F.col("_full") > 0) & line, "line").otherwise("scatter").alias("status"))


def line_series(pixels: DataFrame, width: float, most: int = 6) -> DataFrame:
    """(chart, hue, n, place): the largest series of pixels (chart, hue, x) that are long enough to be lines of a plot."""
    s = pixels.groupBy("chart", "hue").agg(F.count(F.lit(1)).alias("n"), (F.max("x") - F.min("x")).alias("_w")).where((F.col("n") >= 60) & (F.col("_w") >= 0.4 * width))
    return s.withColumn("place", F.row_number().over(Window.partitionBy("chart").orderBy(F.desc("n"), "hue"))).where(F.col("place") <= most).drop("_w")


def far_ends(pixels: DataFrame) -> DataFrame:
    """(fig, edge, x1, y1, x2, y2): of a component's extreme pixels the two that are farthest apart."""
    p, at = F.struct("x", "y"), lambda f, *by: f(F.struct("x", "y"), F.struct(*by))
    g = pixels.groupBy("fig", "edge").agg(at(F.min_by, "x", "y").alias("a"), at(F.max_by, "x", "y").alias("b"), at(F.min_by, "y", "x").alias("c"), at(F.max_by, "y", "x").alias("d"))
    far = lambda a, b: (F.col(f"{a}.x") - F.col(f"{b}.x")) * (F.col(f"{a}.x") - F.col(f"{b}.x")) + (F.col(f"{a}.y") - F.col(f"{b}.y")) * (F.col(f"{a}.y") - F.col(f"{b}.y"))
    pairs = [F.struct((-far(a, b)).alias("n"), F.lit(i).alias("i"), F.col(a).alias("p"), F.col(b).alias("q")) for i, (a, b) in enumerate(("ab", "ac", "ad", "bc", "bd", "cd"))]
    g = g.withColumn("m", F.array_min(F.array(*pairs)))
    return g.select("fig", "edge", F.col("m.p.x").alias("x1"), F.col("m.p.y").alias("y1"), F.col("m.q.x").alias("x2"), F.col("m.q.y").alias("y2"))


def arrowheads(pixels: DataFrame, ends: DataFrame, radius: int = 14) -> DataFrame:
    """(fig, edge, head): at which end (1 or 2) of an edge its pixels spread, or are denser; 0 where neither stands out.

    The spread around the main direction is the root of the smaller eigenvalue of the pixels' covariance near the end.
    """
    j = pixels.join(ends, ["fig", "edge"])

    def near(k: int) -> dict[str, Column]:
        inside = (F.abs(F.col("x") - F.col(f"x{k}")) <= radius) & (F.abs(F.col("y") - F.col(f"y{k}")) <= radius)
        x, y = F.when(inside, F.col("x")), F.when(inside, F.col("y"))
        return {f"n{k}": F.count(x), f"xx{k}": F.var_pop(x), f"yy{k}": F.var_pop(y), f"xy{k}": F.covar_pop(x, y)}

    g = j.groupBy("fig", "edge").agg(*[c.alias(name) for k in (1, 2) for name, c in near(k).items()])

    def spread(k: int) -> Column:
        xx, yy, xy = (F.col(f"{c}{k}") for c in ("xx", "yy", "xy"))
        half = (xx + yy) / 2
        low = half - F.sqrt(F.greatest(F.lit(0.0), half * half - (xx * yy - xy * xy)))
        return F.when(F.col(f"n{k}") < 6, 0.0).otherwise(F.sqrt(F.greatest(F.lit(0.0), low)))

    s1, s2, n1, n2 = spread(1), spread(2), F.col("n1"), F.col("n2")
    wide, dense = F.greatest(s1, s2), F.greatest(n1, n2)
    head = F.when((n1 < 6) & (n2 < 6), 0).when((wide > 0.6) & (F.abs(s1 - s2) / wide >= 0.35), F.when(s1 > s2, 1).otherwise(2))
    return g.select("fig", "edge", head.when(F.abs(n1 - n2) / dense >= 0.25, F.when(n1 > n2, 1).otherwise(2)).otherwise(0).alias("head"))
