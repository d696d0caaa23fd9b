"""Tree models on a cube of sufficient statistics (ML9-ML12).

Flags and ordinals take few values, so rows reduce exactly to cells:
(segment of the time order, feature vector) -> count, sum of y, sum of y².
Every split gain, leaf value and error of a tree is a function of these sums.
One scan of the rows gives the cube, one more the bagged cubes (row weights
drawn from a hash of the row and the replicate, summed per cell), and all
folds, grid points and trees are fitted from cells, spread over Spark tasks.

The cube's size is segments x replicates x distinct feature vectors, whatever
the number of rows; continuous features belong in ``models.tune_trees``.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from itertools import product

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from islet.operators.ordered import with_global_index
from islet.operators.validate import indexed, inner_fold_bounds, rolling_fold_bounds

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the fits travel with their jobs

#: The source's search grids (a depth of 0 is an open depth).
FOREST_GRID = {"n_trees": [100, 200], "depth": [2, 3, 5, 0], "min_leaf": [2, 4, 6]}
BOOSTED_GRID = {"rounds": [50, 100, 200], "depth": [2, 3, 4], "rate": [0.05, 0.1, 0.2], "subsample": [0.7, 1.0]}

PRIME = 2147483647  # draws are uniform below it
HELD = 1 << 20  # cells x replicates that a task sums before it sends them on
SEGMENT, REPLICATE = "segment", "replicate"


# --------------------------------------------------------------- the cubes

def ranked(df: DataFrame, order: Sequence[str], features: Sequence[str], label: str, folds: int = 3, start: float = 0.35,
           n_blocks: int | None = None) -> tuple[DataFrame, int, list[tuple[int, int]]]:
    """(complete rows with their rank ``_j``, how many, the rolling folds as
    ranks).  Fold bounds are positions among all rows; incomplete rows go
    afterwards, as in ``models.rolling_cv_ridge``."""
    x = indexed(df, order, "_i", n_blocks)
    first = x.select("n").first()
    bounds = rolling_fold_bounds(first[0] if first else 0, folds, start) if folds else []
    complete = with_global_index(x.dropna(subset=[*features, label]).select("_i", *order, *features, label), ["_i"], "_j", n_blocks=n_blocks)
    cuts = sorted({c for b in bounds for c in b})
    before = complete.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("_i") < c).alias(f"c{c}") for c in cuts]).first()
    return complete, before["n"], [(before[f"c{lo}"], before[f"c{hi}"]) for lo, hi in bounds]


def cuts_of(outer: Sequence[tuple[int, int]], k: int = 3) -> list[int]:
    """Borders of all outer windows and of the inner splits of their trains."""
    return sorted({c for lo, hi in outer for c in (0, lo, hi, *(v for b in inner_fold_bounds(lo, k) for v in b))})


def with_segment(df: DataFrame, cuts: Sequence[int], rank: str = "_j") -> DataFrame:
    """The number of borders at or below a row's rank."""
    return df.withColumn(SEGMENT, _reached(F.col(rank), cuts).cast("int"))


def _reached(value: Column, steps: Sequence[int]) -> Column:
    """How many steps a value has reached, inside code generation."""
    return sum(((value >= F.lit(s).cast("long")).cast("long") for s in steps), F.lit(0).cast("long"))


def cube(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Rows with a segment -> (segment, features.., n, sum_y, sum_yy)."""
    y = F.col(label).cast("double")
    return df.groupBy(SEGMENT, *features).agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("sum_y"), F.sum(y * y).alias("sum_yy"))


def coefficients(key: Sequence[str]) -> list[Column]:
    """Three whole numbers below ``PRIME`` from a row's key."""
    digest = F.md5(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key]).cast("binary"))
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") % PRIME for i in range(3)]


def draw(a: Column, b: Column, c: Column, replicate: Column) -> Column:
    """A whole number below ``PRIME``: a quadratic in the replicate with the
    row's coefficients, so that it needs no state, any partitioning gives the
    same, and replicates are independent by threes."""
    return (a + b * replicate + c * replicate * replicate) % PRIME


def poisson(u: Column) -> Column:
    """Poisson(1) weight of a draw: how often a bootstrap takes the row."""
    return _reached(u, poisson_steps())


def poisson_steps() -> list[int]:
    """The draws from which on the weight is 1, 2, .."""
    steps, p, total = [], float(np.exp(-1)), 0.0
    for k in range(12):
        total += p
        steps.append(int(total * PRIME))
        p /= k + 1
    return steps


def replicate_cube(df: DataFrame, features: Sequence[str], label: str, key: Sequence[str], replicates: int, share: float | None = None) -> DataFrame:
    """Rows with a segment -> (segment, replicate, features.., n: rows drawn,
    weight, sum_y: weighted).  Weights are Poisson(1), or 1 for ``share`` of
    the rows.  A task draws its rows' weights replicate by replicate and sums
    them by cell as it reads; Spark adds up the sums of all tasks."""
    keys = [SEGMENT, *features]
    x = df.select(*keys, F.col(label).cast("double").alias("_y"), *[c.alias(f"_k{i}") for i, c in enumerate(coefficients(key))])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in x.select(*keys).schema)

    def run(batches):
        held: dict = {}  # a cell's key -> its sums, a row each of n, weight, sum_y and rows with a y

        def sums():
            import pyarrow as pa

            vectors, (n, w, s, known) = list(held), np.stack(list(held.values()), 1)
            at, rep = np.nonzero(n)
            columns = [pa.array([v[i] for v in vectors], t).take(pa.array(at)) for i, t in enumerate(types)]
            held.clear()
            return pa.RecordBatch.from_arrays([*columns, pa.array(rep, pa.int64()), pa.array(n[at, rep].astype(np.int64)), pa.array(w[at, rep].astype(np.int64)), pa.array(s[at, rep], mask=known[at, rep] == 0)], names=[*keys, REPLICATE, "n", "weight", "sum_y"])

        for batch in batches:
            if not batch.num_rows:
                continue
            types = [batch[c].type for c in keys]
            for vector, own in _drawn(batch, keys, replicates, share):
                held[vector] = held[vector] + own if vector in held else own
            if len(held) * replicates > HELD:
                yield sums()
        if held:
            yield sums()

    drawn = x.mapInArrow(run, f"{kinds}, {REPLICATE} long, n long, weight long, sum_y double")
    return drawn.groupBy(SEGMENT, REPLICATE, *features).agg(*[F.sum(c).alias(c) for c in ("n", "weight", "sum_y")])


def _drawn(batch, keys: Sequence[str], replicates: int, share: float | None):
    """(key, sums) of each cell of a batch with columns ``_y`` and ``_k0.._k2``;
    sums has a column for each replicate.  ``draw`` is stepped from a replicate
    to the next by its differences, all below twice ``PRIME``, so in 32 bits."""
    code = np.zeros(batch.num_rows, np.int64)
    for c in keys:
        own = batch[c].dictionary_encode(null_encoding="encode").indices.to_numpy()
        code = np.unique(code * (int(own.max()) + 1) + own, return_inverse=True)[1].reshape(-1)
    order = np.argsort(code, kind="stable")
    starts = np.concatenate(([0], np.flatnonzero(np.diff(code[order])) + 1))
    a, b, c = (batch[f"_k{i}"].to_numpy()[order].astype(np.uint32) for i in range(3))
    known = ~batch["_y"].is_null().to_numpy(zero_copy_only=False)[order]
    y = np.where(known, batch["_y"].to_numpy(zero_copy_only=False)[order], 0.0)
    p, steps = np.uint32(PRIME), np.array(poisson_steps(), np.uint32)
    below = lambda v: np.minimum(v, v - p)  # noqa: E731  v modulo PRIME: less than PRIME wraps round
    u, step, twice = a, below(b + c), below(c + c)
    plain = np.isfinite(y).all()
    out = np.empty((4, replicates, len(starts)))
    for r in range(replicates):
        if share is None:
            count = np.zeros(len(u), np.uint8)
            for s in steps[steps <= u.max()]:
                count += (u >= s).view(np.uint8)
            w = count.astype(float)
        else:
            w = (u < np.uint32(int(share * PRIME))).astype(float)
        taken = w > 0
        product = w * y if plain else np.where(taken, w * np.where(taken, y, 0.0), 0.0)
        out[0, r], out[1, r], out[2, r] = (np.add.reduceat(v, starts) for v in (taken.astype(float), w, product))
        out[3, r] = out[0, r] if known.all() else np.add.reduceat((taken & known).astype(float), starts)
        u, step = below(u + step), below(step + twice)
    first = order[starts]
    vectors = zip(*[batch[c].take(first).to_pylist() for c in keys])
    return [(v, out[:, :, i]) for i, v in enumerate(vectors)]


# ------------------------------------------------------------ trees on cells

def grow(x: np.ndarray, n: np.ndarray, w: np.ndarray, s: np.ndarray, depth: int, least: float, ridge: float = 0.0) -> np.ndarray:
    """The value of each cell (row of ``x``) by least-squares trees, one for
    each row of n (rows), w (weight) and s (weighted sum), all grown at once.

    Splits lie half-way between values that have rows, a leaf holds ``least``
    (one at least) rows or more, a depth of 0 is open.  Cells without rows
    follow the splits.  Equal gains go to the first feature and lowest value.
    """
    trees, m = n.shape
    cell, node = np.tile(np.arange(m), trees), np.repeat(np.arange(trees), m)
    n, w, s = n.ravel(), w.ravel(), s.ravel()
    coded = [np.unique(x[:, j], return_inverse=True) for j in range(x.shape[1])]
    active, level = np.ones(trees, bool), 0
    while True:
        size = len(active)
        tn, tw, ts = (np.bincount(node, v, size) for v in (n, w, s))
        if (depth and level == depth) or not active.any():
            break
        with np.errstate(divide="ignore", invalid="ignore"):
            whole = np.where(tw + ridge > 0, ts * ts / (tw + ridge), 0.0)
            best, feature, cut = 1e-12 * np.maximum(1.0, whole), np.full(size, -1), np.zeros(size)
            for j, (values, code) in enumerate(coded):
                k = len(values)
                if k < 2:
                    continue
                at = node * k + code[cell]
                here, hw, hs = (np.bincount(at, v, size * k).reshape(size, k) for v in (n, w, s))
                ln, lw, ls = (np.cumsum(v, 1) for v in (here, hw, hs))
                ok = (here > 0) & (ln >= least) & (tn[:, None] - ln >= least) & active[:, None]
                rw, rs = tw[:, None] - lw, ts[:, None] - ls
                gain = np.where(ok, ls * ls / (lw + ridge) + rs * rs / (rw + ridge) - whole[:, None], -np.inf)
                i = gain.argmax(1)
                own = gain[np.arange(size), i]
                better = own > best * (1 + 1e-12)
                after = np.full((size, k), k - 1)  # the next value with rows
                for v in range(k - 2, -1, -1):
                    after[:, v] = np.where(here[:, v + 1] > 0, v + 1, after[:, v + 1])
                middle = (values[i] + values[after[np.arange(size), i]]) / 2
                best, feature, cut = np.where(better, own, best), np.where(better, j, feature), np.where(better, middle, cut)
        split = feature >= 0
        right = split[node] & (x[cell, np.maximum(feature[node], 0)] > cut[node])
        keys, node = np.unique(2 * node + right, return_inverse=True)
        active, level = split[keys // 2], level + 1
    return np.divide(ts, tw + ridge, out=np.zeros(len(ts)), where=tw + ridge > 0)[node].reshape(trees, m)


class _Held:
    """A group's cells as arrays by segment and feature vector."""

    def __init__(self, frame, features, n_segments: int, replicates: int):
        self.x, code = np.unique(frame[list(features)].to_numpy(dtype=float), axis=0, return_inverse=True)
        seg, rep = frame[SEGMENT].to_numpy(), frame[REPLICATE].to_numpy()
        code = code.reshape(-1)
        plain, drawn = rep < 0, rep >= 0

        def table(column, rows, lead):
            out = np.zeros((*lead, n_segments + 1, len(self.x)))
            at = (rep[rows], seg[rows], code[rows]) if len(lead) else (seg[rows], code[rows])
            np.add.at(out, at, frame[column].to_numpy(dtype=float)[rows])
            return out

        self.n, self.s, self.ss = (table(c, plain, ()) for c in ("n", "sum_y", "sum_yy"))
        self.bag = [table(c, drawn, (replicates,)) for c in ("n", "weight", "sum_y")] if drawn.any() else None

    def rmse(self, pred: np.ndarray, a: int, b: int) -> tuple[float, int]:
        n, s, ss = (t[a:b].sum(0) for t in (self.n, self.s, self.ss))
        total = n.sum()
        error = float(np.sum(ss - 2 * pred * s + pred * pred * n))
        return (float(np.sqrt(max(error, 0.0) / total)) if total else float("nan")), int(total)


def _forest_points(held: _Held, grid: dict, depth: int, ends: Sequence[int]):
    """({point}, split, predictions by cell) of all forests of one depth; split
    i is fitted on the segments before ``ends[i]``."""
    for i, to in enumerate(ends):
        n, w, s = (t[:, :to].sum(1) for t in held.bag)
        for least in grid["min_leaf"]:
            upto = np.cumsum(grow(held.x, n, w, s, depth, least), 0)
            for n_trees in grid["n_trees"]:
                yield {"n_trees": n_trees, "depth": depth, "min_leaf": least}, i, upto[n_trees - 1] / n_trees


def _boosted_points(held: _Held, grid: dict, depth: int, share: float, ends: Sequence[int], ridge: float = 1.0, least: float = 1.0):
    """The same of all boosted models of one depth and subsample: least-squares
    gradient boosting from the mean, leaves shrunk by ``ridge``.  A round
    grows the next tree of every rate and split."""
    rates, m = grid["rate"], len(held.x)
    spread = lambda t: np.broadcast_to(t, (len(rates), *t.shape)).reshape(-1, m)
    n, s = (spread(np.stack([t[:to].sum(0) for to in ends])) for t in (held.n, held.s))
    bag = None if share == 1.0 else [np.stack([t[:, :to].sum(1) for to in ends], 1) for t in held.bag]
    rate = np.repeat(rates, len(ends))[:, None]
    total = n.sum(1, keepdims=True)
    pred = np.divide(s.sum(1, keepdims=True), total, out=np.zeros_like(total), where=total > 0) + np.zeros((1, m))
    for r in range(max(grid["rounds"])):
        rows, w, sums = (n, n, s) if bag is None else (spread(t[r]) for t in bag)
        pred = pred + rate * grow(held.x, rows, w, sums - w * pred, depth, least, ridge)
        if r + 1 in grid["rounds"]:
            for b in range(len(pred)):
                yield {"rounds": r + 1, "depth": depth, "rate": rates[b // len(ends)], "subsample": share}, b % len(ends), pred[b]


POINT = ["n_trees", "rounds", "depth", "min_leaf", "rate", "subsample"]


def search(df: DataFrame, order: Sequence[str], features: Sequence[str], label: str, kind: str = "forest", grid: dict | None = None,
           folds: int = 3, start: float = 0.35, k: int = 3, whole: bool = False, n_blocks: int | None = None) -> DataFrame:
    """ML9 / ML10 / ML12: the error of every grid point on every split.

    Rows (outer, part, point.., rmse, n_train, n_test): part 0..k-1 are the
    inner time-series splits of the rows before an outer window, part -1 is
    the window itself, scored by a refit on all rows before it.  With
    ``whole`` there is one outer split more, of all rows, without a window.
    Row draws come from the ``order`` columns, which tell rows apart.
    """
    grid = grid or (FOREST_GRID if kind == "forest" else BOOSTED_GRID)
    rows, total, outer = ranked(df, order, features, label, folds, start, n_blocks)
    outer = outer + [(total, total)] if whole else outer
    outer = [(lo, hi) for lo, hi in outer if lo > k]
    cuts = cuts_of(outer, k)
    seg = {c: i + 1 for i, c in enumerate(cuts)}  # the segment that begins at a border
    rows = with_segment(rows, cuts)
    plain = cube(rows, features, label).withColumns({REPLICATE: F.lit(-1).cast("long"), "weight": F.col("n")})
    names = [SEGMENT, REPLICATE, *features, "n", "weight", "sum_y", "sum_yy"]
    cells = plain.select(*names)
    shares = [None] if kind == "forest" else sorted(grid["subsample"])
    replicates = max(grid["n_trees"] if kind == "forest" else grid["rounds"])
    tasks = [(o, d, s) for o, d, s in product(range(len(outer)), grid["depth"], shares)]
    task = lambda own: F.array(*[F.lit(i) for i, t in enumerate(tasks) if own(t)])
    cells = cells.withColumn("task", F.explode(task(lambda t: True))) if tasks else cells.withColumn("task", F.lit(0)).limit(0)
    for share in shares:
        own = task(lambda t, share=share: t[2] == share)
        if share != 1.0 and tasks:
            bag = replicate_cube(rows, features, label, order, replicates, share).withColumn("sum_yy", F.lit(0.0))
            cells = cells.unionByName(bag.select(*names).withColumn("task", F.explode(own)))
    features, n_segments = list(features), len(cuts)
    parts = [[(part, a, b) for part, (a, b) in [*enumerate(inner_fold_bounds(lo, k)), (-1, (lo, hi))] if 0 < a < b] for lo, hi in outer]

    def fit(frame):
        import pandas as pd

        o, depth, share = tasks[int(frame["task"].iloc[0])]
        held = _Held(frame, features, n_segments, replicates)
        out, splits = [], parts[o]
        ends = [seg[a] for _, a, _ in splits]
        points = _forest_points(held, grid, depth, ends) if kind == "forest" else _boosted_points(held, grid, depth, share, ends)
        for point, i, pred in points if splits else ():
            part, a, b = splits[i]
            rmse, n_test = held.rmse(pred, seg[a], seg[b])
            out.append((o, part, *[point.get(c) for c in POINT], rmse, a, n_test))
        return pd.DataFrame(out, columns=["outer", "part", *POINT, "rmse", "n_train", "n_test"]).astype({c: "Int64" for c in ("n_trees", "rounds", "min_leaf")} | {"rate": float, "subsample": float})

    schema = "outer int, part int, n_trees long, rounds long, depth long, min_leaf long, rate double, subsample double, rmse double, n_train long, n_test long"
    return cells.groupBy("task").applyInPandas(fit, schema)


def nested_cv(scores: DataFrame, point: Sequence[str]) -> DataFrame:
    """ML3 + ML9: of each outer fold its best point by mean inner error (equal
    means: the first by its values) and that point's error on the window."""
    mean = scores.filter("part >= 0").groupBy("outer", *point).agg(F.avg("rmse").alias("cv_rmse"))
    best = mean.groupBy("outer").agg(F.min(F.struct("cv_rmse", *point)).alias("b")).select("outer", "b.*")
    window = scores.filter("part = -1").select("outer", *point, "rmse", "n_train", "n_test")
    return best.join(window, ["outer", *point]).withColumnRenamed("outer", "fold")


def landscape(scores: DataFrame, point: Sequence[str]) -> DataFrame:
    """ML12: mean and population spread of each point over the inner splits."""
    return scores.filter("part >= 0").groupBy(*point).agg(F.avg("rmse").alias("mean_rmse"), F.stddev_pop("rmse").alias("std_rmse"))


def best_per_cell(scape: DataFrame, cell: Sequence[str]) -> DataFrame:
    """ML12: of each cell of the heat map the point with the least mean, with
    that point's own spread."""
    rest = [c for c in scape.columns if c not in (*cell, "mean_rmse", "std_rmse")]
    best = scape.groupBy(*cell).agg(F.min(F.struct("mean_rmse", *rest, "std_rmse")).alias("b"))
    return best.select(*cell, "b.*")


# -------------------------------------------------- bagged stumps in the plan

def stumps(bag: DataFrame, features: Sequence[str], least: int = 2) -> DataFrame:
    """ML9: a bagged tree of depth 1 for each replicate, all found by one
    aggregate and windows over distinct values: (replicate, feature, threshold,
    left_mean, right_mean, gain).  Replicates without a split are left out."""
    held = bag.groupBy(REPLICATE, *features).agg(*[F.sum(c).alias(c) for c in ("n", "weight", "sum_y")])
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("place"), F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for i, f in enumerate(features)]))
    by_value = held.select(REPLICATE, "n", "weight", "sum_y", each.alias("f")).groupBy(REPLICATE, "f.place", "f.feature", "f.value").agg(*[F.sum(c).alias(c) for c in ("n", "weight", "sum_y")])
    whole = Window.partitionBy(REPLICATE, "place")
    upto = whole.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    sums = {}
    for c in ("n", "weight", "sum_y"):
        sums |= {f"l_{c}": F.sum(c).over(upto), f"t_{c}": F.sum(c).over(whole)}
    split = by_value.withColumns(sums | {"next": F.lead("value").over(whole.orderBy("value"))})
    split = split.filter((F.col("l_n") >= least) & (F.col("t_n") - F.col("l_n") >= least))
    rw, rs = F.col("t_weight") - F.col("l_weight"), F.col("t_sum_y") - F.col("l_sum_y")
    gain = F.col("l_sum_y") ** 2 / F.col("l_weight") + rs**2 / rw - F.col("t_sum_y") ** 2 / F.col("t_weight")
    best = split.withColumn("gain", gain).groupBy(REPLICATE).agg(F.max(F.struct(
        "gain", (-F.col("place")).alias("p"), (-F.col("value")).alias("v"), "feature", ((F.col("value") + F.col("next")) / 2).alias("threshold"),
        (F.col("l_sum_y") / F.col("l_weight")).alias("left_mean"), (rs / rw).alias("right_mean"))).alias("b"))
    return best.select(REPLICATE, "b.feature", "b.threshold", "b.left_mean", "b.right_mean", "b.gain")


def stump_forest(rows: DataFrame, found: DataFrame, features: Sequence[str], name: str = "prediction") -> DataFrame:
    """Distinct feature vectors of ``rows`` with the stumps' mean prediction.
    Each vector meets each stump's one feature: vectors are few, so the pairs
    are vectors x replicates, whatever the number of rows."""
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features]))
    long = rows.select(*features).distinct().withColumn("f", each).select(*features, "f.*")
    side = F.when(F.col("value") <= F.col("threshold"), F.col("left_mean")).otherwise(F.col("right_mean"))
    return long.join(found, "feature").groupBy(*features).agg(F.avg(side).alias(name))
