"""Rank correlation, overlap-robust errors and the lead-lag grid.

A cell (series, entry lag, horizon, signal) has one row per week. Everything a
cell needs is computed as windows over the cell's own partitioning, so a whole
grid costs one shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from firstprint.operators.ranks import average_rank, expanding_rank

T_BAR = 2.5
MIN_CELL = 30
MIN_CONTROL = 100


def _standard(c: Column, keys: list[str]) -> Column:
    """Population z-score within the keys; zero when the column is constant."""
    w = Window.partitionBy(*keys)
    sd = F.stddev_pop(c).over(w)
    return F.when(sd == 0, c - F.avg(c).over(w)).otherwise((c - F.avg(c).over(w)) / sd)


def rank_scores(df: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """Add `zx` and `zy`: standardized average-tie ranks within the keys."""
    df = df.withColumn("_rx", average_rank(keys, x)).withColumn("_ry", average_rank(keys, y))
    return (df.withColumn("zx", _standard(F.col("_rx"), keys))
            .withColumn("zy", _standard(F.col("_ry"), keys)).drop("_rx", "_ry"))


def _enough(c: Column, least: int = MIN_CELL) -> Column:
    return F.when(F.col("n") >= least, c)


def spearman_corr(df: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """Spearman rho per cell; NULL under 30 rows."""
    cells = rank_scores(df, keys, x, y).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col("zx") * F.col("zy")).alias("rho"))
    return cells.withColumn("rho", _enough(F.col("rho")))


def _overlap(series: Column, horizon: Column) -> Column:
    """Twice the Bartlett-weighted sum of the lagged products of an array, for the lags 1 to `horizon`."""
    last = F.least(F.coalesce(horizon.cast("int"), F.lit(0)), F.size(series) - 1)

    def products(lag: Column) -> Column:
        pairs = F.zip_with(F.slice(series, lag + 1, F.size(series) - lag), F.slice(series, 1, F.size(series) - lag), lambda a, b: a * b)
        return F.aggregate(pairs, F.lit(0.0), lambda total, x: total + x)

    weighted = F.aggregate(F.sequence(F.lit(1), last), F.lit(0.0),
                           lambda total, lag: total + 2.0 * (1.0 - lag / (horizon + 1)) * products(lag))
    return F.when(last >= 1, weighted).otherwise(0.0)


def _in_order(order: str, *columns: str) -> Column:
    """The columns of a cell as one array of structs in date order; a cell is no longer than its calendar."""
    return F.sort_array(F.collect_list(F.struct(order, *columns)))


def score_columns(df: DataFrame, keys: list[str]) -> DataFrame:
    """Add the score u of the rank regression."""
    rho = F.avg(F.col("zx") * F.col("zy")).over(Window.partitionBy(*keys))
    df = df.withColumn("_rho", rho)
    return df.withColumn("_u", F.col("zx") * (F.col("zy") - F.col("_rho") * F.col("zx")))


def hac_aggregates(order: str) -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.max("_rho").alias("rho"),
            F.avg(F.col("zx") * F.col("zx")).alias("_sxx"),
            F.avg(F.col("_u") * F.col("_u")).alias("_s0"), _in_order(order, "_u").alias("_us")]


def hac_t(horizon: Column) -> Column:
    """t of rho from the Bartlett-weighted long-run variance of the score; the lag length is the horizon."""
    s = F.col("_s0") + _overlap(F.col("_us._u"), horizon) / F.col("n")
    var = F.try_divide(s, F.col("_sxx") * F.col("_sxx")) / F.col("n")
    return F.when((F.col("n") >= MIN_CELL) & (var > 0), F.col("rho") / F.sqrt(var))


def newey_west_t(df: DataFrame, keys: list[str], order: str, x: str, y: str, horizon: str) -> DataFrame:
    """rho and its t-statistic per cell; the lag length is the cell's horizon."""
    scored = score_columns(rank_scores(df, keys, x, y), keys)
    cells = scored.groupBy(*keys).agg(*hac_aggregates(order))
    return cells.select(*keys, "n", _enough(F.col("rho")).alias("rho"), hac_t(F.col(horizon)).alias("t_nw"))


def quintile_columns(df: DataFrame, keys: list[str], order: str, x: str, min_history: int,
                     turn: Column | None = None) -> DataFrame:
    """Add `_side`: +1 in the top fifth of the signal's own past, -1 in the bottom."""
    df = expanding_rank(df, keys, order, x, "_past", min_history)
    side = F.when(F.col("_past") >= 80, 1).when(F.col("_past") < 20, -1).otherwise(0)
    if turn is not None:
        side = F.when(turn, F.signum(F.col(x)).cast("int")).otherwise(side)
    return df.withColumn("_side", side).drop("_past")


def quintile_aggregates(y: str) -> list[Column]:
    top, bottom = F.col("_side") == 1, F.col("_side") == -1
    return [((F.avg(F.when(top, F.col(y))) - F.avg(F.when(bottom, F.col(y)))) * 100)
            .alias("top_minus_bottom_pct"),
            F.count_if(top).alias("top_n"), F.count_if(bottom).alias("bottom_n")]


def quintile_spread(df: DataFrame, keys: list[str], order: str, x: str, y: str,
                    min_history: int = 104, turn: Column | None = None) -> DataFrame:
    """Mean outcome in the signal's top fifth less its bottom fifth, in percent."""
    return (quintile_columns(df, keys, order, x, min_history, turn)
            .groupBy(*keys).agg(*quintile_aggregates(y)))


def half_columns(df: DataFrame, keys: list[str], date: str, split, x: str, y: str) -> DataFrame:
    """Add `_half` and the average-tie ranks within each half of the cell."""
    df = df.withColumn("_half", F.when(F.col(date) < split, 1).otherwise(2))
    halves = [*keys, "_half"]
    return (df.withColumn("_hx", average_rank(halves, x)).withColumn("_hy", average_rank(halves, y)))


def half_aggregates() -> list[Column]:
    out = []
    for half in (1, 2):
        mine = F.col("_half") == half
        x, y = F.when(mine, F.col("_hx")), F.when(mine, F.col("_hy"))
        corr = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
        out.append(F.when(F.count_if(mine) >= MIN_CELL, F.coalesce(corr, F.lit(0.0)))
                   .alias(f"rho_half{half}"))
    return out


def consistent_mark(t: Column, rho: Column, half1: Column, half2: Column) -> Column:
    """'yes' when the t clears the bar and all three signs agree."""
    agree = ((half1 > 0) == (half2 > 0)) & ((half2 > 0) == (rho > 0))
    return F.when((F.abs(t) >= T_BAR) & agree, "yes").otherwise("")


def split_half_consistency(df: DataFrame, keys: list[str], date: str, split, x: str, y: str,
                           horizon: str) -> DataFrame:
    """rho of both halves beside the whole cell's rho and t, and the verdict."""
    scored = score_columns(rank_scores(df, keys, x, y), keys)
    cells = half_columns(scored, keys, date, split, x, y).groupBy(*keys).agg(
        *hac_aggregates(date), *half_aggregates())
    cells = cells.withColumn("t_nw", hac_t(F.col(horizon)))
    return cells.select(
        *keys, "n", _enough(F.col("rho")).alias("rho"), "t_nw", "rho_half1", "rho_half2",
        consistent_mark(F.col("t_nw"), F.col("rho"), F.col("rho_half1"), F.col("rho_half2"))
        .alias("consistent"))


def signal_grid(pairs: DataFrame, keys: list[str], date: str, x: str, y: str, split,
                signal: str = "signal", horizon: str = "horizon", min_history: int = 104) -> DataFrame:
    """Every statistic of every cell in one grouped job."""
    df = score_columns(rank_scores(pairs, keys, x, y), keys)
    df = half_columns(df, keys, date, split, x, y)
    df = quintile_columns(df, keys, date, x, min_history, turn=F.col(signal) == "turn")
    cells = df.groupBy(*keys).agg(*hac_aggregates(date), *half_aggregates(),
                                  *quintile_aggregates(y))
    cells = cells.withColumn("t_nw", hac_t(F.col(horizon)))
    return cells.select(
        *keys, "n", _enough(F.col("rho")).alias("rho"), "t_nw", "top_minus_bottom_pct", "top_n",
        "bottom_n", "rho_half1", "rho_half2",
        consistent_mark(F.col("t_nw"), F.col("rho"), F.col("rho_half1"), F.col("rho_half2"))
        .alias("consistent"))


SINGULAR = 1e-10


def ols_hac_cells(df: DataFrame, keys: list[str], order: str, y: str, xs: list[str], horizon: str) -> DataFrame:
    """n, and coef_x and t_x of each regressor x, of y on any number of standardized regressors, for every cell.

    Standardizing makes the intercept orthogonal to the rest, so the normal equations are the regressors' correlations: window
    means over the cell. They are split by Cholesky, column by column, and inverted from the triangle. Each coefficient's
    variance is then the long-run variance of one score series, with the cell's horizon as lag length. A regressor that is
    constant or a combination of earlier ones leaves no pivot: all numbers of the cell but n are NULL. Cells under 100 rows
    are dropped.
    """
    k, cell = range(len(xs)), Window.partitionBy(*keys)
    df = df.withColumns({"_y": _standard(F.col(y), keys), **{f"_x{i}": _standard(F.col(c), keys) for i, c in enumerate(xs)}})
    mean = lambda a, b: F.avg(F.col(a) * F.col(b)).over(cell)
    df = df.withColumns({"n": F.count(F.lit(1)).over(cell), **{f"_r{i}_{j}": mean(f"_x{i}", f"_x{j}") for i in k for j in range(i + 1)},
                         **{f"_g{i}": mean(f"_x{i}", "_y") for i in k}})
    total = lambda terms: sum(terms, F.lit(0.0))
    lower = lambda i, j: F.col(f"_l{i}_{j}")
    for j in k:  # the triangle
        pivot = F.col(f"_r{j}_{j}") - total(lower(j, p) * lower(j, p) for p in range(j))
        df = df.withColumn(f"_l{j}_{j}", F.when(pivot > SINGULAR, F.sqrt(pivot)))
        df = df.withColumns({f"_l{i}_{j}": (F.col(f"_r{i}_{j}") - total(lower(i, p) * lower(j, p) for p in range(j))) / lower(j, j)
                             for i in k if i > j} or {"_done": F.lit(True)})
    turned = lambda i, j: F.col(f"_m{i}_{j}")
    for i in k:  # its inverse
        df = df.withColumns({f"_m{i}_{j}": (F.lit(1.0 if i == j else 0.0) - total(lower(i, p) * turned(p, j) for p in range(j, i))) / lower(i, i)
                             for j in range(i + 1)})
    inverse = {(i, j): total(turned(p, i) * turned(p, j) for p in k if p >= max(i, j)) for i in k for j in k}
    df = df.withColumns({f"_a{i}_{j}": inverse[i, j] for i in k for j in k})
    df = df.withColumns({f"_b{i}": total(F.col(f"_a{i}_{j}") * F.col(f"_g{j}") for j in k) for i in k})
    df = df.withColumn("_u", (F.col("_y") - total(F.col(f"_b{i}") * F.col(f"_x{i}") for i in k)) / F.col("n"))
    df = df.withColumns({f"_q{i}": F.col("_u") * total(F.col(f"_a{i}_{j}") * F.col(f"_x{j}") for j in k) for i in k})
    cells = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), *[F.max(f"_b{i}").alias(f"coef_{x}") for i, x in enumerate(xs)],
        *[F.sum(F.col(f"_q{i}") * F.col(f"_q{i}")).alias(f"_v{i}") for i in k],
        _in_order(order, *[f"_q{i}" for i in k]).alias("_qs")).where(F.col("n") >= MIN_CONTROL)
    variance = [F.col(f"_v{i}") + _overlap(F.col(f"_qs._q{i}"), F.col(horizon)) for i in k]
    return cells.select(*keys, "n", *[f"coef_{x}" for x in xs],
                        *[F.when(v > 0, F.col(f"coef_{x}") / F.sqrt(v)).alias(f"t_{x}") for x, v in zip(xs, variance)])


def ols_hac(df: DataFrame, keys: list[str], order: str, y: str, xs: list[str], horizon: str) -> DataFrame:
    """The signal, the past flow and the past price move as three regressors of one outcome, under their usual names."""
    if len(xs) != 3:
        raise ValueError("ols_hac: three regressors")
    cells = ols_hac_cells(df, keys, order, y, xs, horizon)
    names = dict(zip(xs, ("signal", "past_flow", "past_price")))
    return cells.select(*keys, "n", F.col(f"coef_{xs[0]}").alias("coef_signal"), *[F.col(f"t_{x}").alias(f"t_{name}") for x, name in names.items()])
