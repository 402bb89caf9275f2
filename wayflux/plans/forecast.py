"""Feature tables, ridge tuning from Gram matrices, prediction, mobility scenarios."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

from wayflux.operators import windows

NODE_VALUES = {
    "interal_movement": "inner_movement", "internal_degree": "inner_degree", "internal_cases": "cases",
    "in_degree": "in_degree", "in_movement": "in_movement", "in_cases": "in_cases",
}
GRAPH_VALUES = {
    "interal_movement": "inner_movement", "internal_degree": "inner_degree", "external_degree": "in_degree",
    "external_movement": "in_movement", "num_cases": "cases",
}


def daily_group_values(nodes: DataFrame, edges: DataFrame, groups: DataFrame | None, key: str = "group_id") -> DataFrame:
    """Per group of nodes and day: own flow, cases and degree, and the same of incoming edges.

    groups(group_id, node_id); None treats the whole graph as one group.
    """
    if groups is None:
        groups = nodes.select("node_id").distinct().withColumn(key, F.lit("all"))
    own = (
        nodes.join(groups, "node_id")
        .groupBy(key, "date_time", "day")
        .agg(
            F.coalesce(F.sum("inner_movement"), F.lit(0.0)).alias("inner_movement"),
            F.coalesce(F.sum(F.col("inner_movement") * F.col("num_cases")), F.lit(0.0)).alias("inner_degree"),
            F.sum("num_cases").alias("cases"),
        )
    )
    source = nodes.select(F.col("node_id").alias("start_id"), "date_time", F.col("num_cases").alias("c"))
    into = (
        edges.join(source, ["start_id", "date_time"])
        .join(groups.withColumnRenamed("node_id", "end_id"), "end_id")
        .groupBy(key, "date_time")
        .agg(
            F.sum(F.col("movement") * F.col("c")).alias("in_degree"), F.sum("movement").alias("in_movement"), F.sum("c").alias("in_cases")
        )
    )
    return own.join(into, [key, "date_time"], "left").na.fill(0.0)


def feature_names(days_back: int, values: dict[str, str] = NODE_VALUES) -> list[str]:
    return [f"{name}_{k}" for k in range(days_back, 0, -1) for name in values] + ["elapsed_days"]


def prediction_table(
    nodes: DataFrame, edges: DataFrame, groups: DataFrame | None, days_back: int = 5, days_ahead: int = 8, smooth_days: int = 1,
    max_day: int | None = None, mobility_ratio: float = 1.0, values: dict[str, str] = NODE_VALUES, key: str = "group_id",
) -> DataFrame:
    """One row per group and current day: the last `days_back` days as features, the count ahead as target."""
    n = nodes.withColumn("inner_movement", F.col("inner_movement") * mobility_ratio)
    e = edges.withColumn("movement", F.col("movement") * mobility_ratio)
    if smooth_days > 1:
        n = windows.smooth_curve(n, ["node_id"], "day", "num_cases", smooth_days)
    daily = daily_group_values(n, e, groups, key)
    lagged = windows.lag_features(daily, [key], "day", values, days_back)
    out = (
        lagged.withColumn("target_num_cases", windows.lead_target([key], "day", "cases", days_ahead))
        .withColumn("_rn", F.row_number().over(W.partitionBy(key).orderBy("day")))
        .filter(F.col("_rn") > days_back)
        .select(
            key, *[F.col(f) if f != "elapsed_days" else F.col("day").cast("double").alias("elapsed_days") for f in feature_names(days_back, values)],
            F.col("date_time").alias("current_date"), F.date_add("date_time", days_ahead).alias("target_date"), "target_num_cases",
        )
    )
    return out if max_day is None else out.filter(F.col("elapsed_days") <= max_day)


def gram_matrices(table: DataFrame, features: list[str], target: str, keys: list[str], rounds: int, folds: int = 5, seed: int = 7) -> pd.DataFrame:
    """Gram matrix of [1, x, y] per (round, part); part 0 is the hold-out, 1..folds the folds.

    One pass over the rows whatever the number of rounds: a task adds its own matrices and
    sends one small row per (round, part). A row's part is a hash of its key and the round.
    """
    width = len(features) + 2
    data = table.select(*keys, *features, target).na.drop()
    rows = data.select(F.xxhash64(F.lit(seed), *keys).alias("h"), F.array(F.lit(1.0), *features, target).alias("v"))

    def add(batches):
        total = np.zeros((rounds + 1, folds + 1, width, width))
        for pdf in batches:
            if not len(pdf):
                continue
            x = np.vstack(pdf["v"].to_numpy())
            h = pdf["h"].to_numpy().astype(np.uint64)
            total[0, 0] += x.T @ x
            for r in range(1, rounds + 1):
                mixed = (h ^ np.uint64(r * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
                mixed ^= mixed >> np.uint64(31)
                held = mixed % np.uint64(5) == 0
                part = np.where(held, 0, 1 + (mixed >> np.uint64(8)) % np.uint64(folds)).astype(int)
                for p in range(folds + 1):
                    sub = x[part == p]
                    total[r, p] += sub.T @ sub
        yield pd.DataFrame(
            [{"r": r, "p": p, "g": total[r, p].ravel()} for r in range(rounds + 1) for p in range(folds + 1) if r or not p]
        )

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{"r": pdf["r"].iloc[0], "p": pdf["p"].iloc[0], "g": np.sum(pdf["g"].tolist(), axis=0)}])

    schema = "r int, p int, g array<double>"
    summed = rows.mapInPandas(add, schema).groupBy("r", "p").applyInPandas(merge, schema)
    out = summed.toPandas()  # (rounds × parts) small matrices, independent of the rows
    out["g"] = [np.asarray(g).reshape(width, width) for g in out["g"]]
    return out


def ridge_from_gram(g: np.ndarray, alpha: float) -> tuple[np.ndarray, float, np.ndarray, np.ndarray]:
    """Weights on standardised features, intercept, feature means and deviations."""
    n = g[0, 0]
    mean, my = g[0, 1:-1] / n, g[0, -1] / n
    cov = g[1:-1, 1:-1] / n - np.outer(mean, mean)
    std = np.sqrt(np.maximum(np.diag(cov), 0.0))
    std = np.where(std > 0, std, 1.0)
    xx = n * cov / np.outer(std, std)
    xy = (g[1:-1, -1] - n * mean * my) / std
    return np.linalg.solve(xx + alpha * np.eye(len(mean)), xy), my, mean, std


def score_gram(g: np.ndarray, w: np.ndarray, b: float, mean: np.ndarray, std: np.ndarray) -> tuple[float, float]:
    """R² and RMSE of a fit on the rows a Gram matrix summarises."""
    n = g[0, 0]
    coef = np.concatenate([[b - (w / std * mean).sum()], w / std])
    sse = max(g[-1, -1] - 2 * coef @ g[:-1, -1] + coef @ g[:-1, :-1] @ coef, 0.0)
    sst = g[-1, -1] - g[0, -1] ** 2 / n
    return (1 - sse / sst if sst > 0 else 0.0), float(np.sqrt(sse / n))


def tune_ridge(grams: pd.DataFrame, alphas: list[float]) -> dict[str, float]:
    """Most often chosen alpha over the rounds, with median hold-out R² and RMSE."""
    chosen, r2s, rmses = [], [], []
    for r, part in grams[grams.r > 0].groupby("r"):
        g = {int(p): m for p, m in zip(part["p"], part["g"])}
        train = sum(m for p, m in g.items() if p)
        folds = [p for p in g if p and g[p][0, 0] > 0]
        quality = {}
        for a in alphas:
            fits = [ridge_from_gram(train - g[p], a) for p in folds]
            quality[a] = np.mean([score_gram(g[p], *f)[0] for p, f in zip(folds, fits)])
        best = max(alphas, key=lambda a: quality[a])
        r2, rmse = score_gram(g[0], *ridge_from_gram(train, best))
        chosen.append(best)
        r2s.append(r2)
        rmses.append(rmse)
    alpha = max(alphas, key=chosen.count)
    return {"final_alpha": float(alpha), "median_r2": float(np.median(r2s)), "median_rmse": float(np.median(rmses))}


class Ridge:
    """A fitted model: small arrays only, applied as a column expression."""

    def __init__(self, gram: np.ndarray, features: list[str], alpha: float):
        self.features, self.alpha = features, alpha
        self.weights, self.level, self.mean, self.std = ridge_from_gram(gram, alpha)

    def predict(self):
        out = F.lit(float(self.level))
        for f, w, m, s in zip(self.features, self.weights, self.mean, self.std):
            out = out + (F.col(f) - float(m)) / float(s) * float(w)
        return out

    def predict_array(self, x: np.ndarray) -> np.ndarray:
        return self.level + (x - self.mean) / self.std @ self.weights


def fit(table: DataFrame, features: list[str], keys: list[str], alphas=(80, 100, 120, 160, 180), rounds: int = 50) -> tuple[Ridge, dict[str, float]]:
    grams = gram_matrices(table, features, "target_num_cases", keys, rounds)
    summary = tune_ridge(grams, list(alphas))
    whole = grams[grams.r == 0]["g"].iloc[0]
    model = Ridge(whole, features, summary["final_alpha"])
    summary["global_r2"], summary["global_rmse"] = score_gram(whole, model.weights, model.level, model.mean, model.std)
    return model, summary


def weights_table(spark: SparkSession, model: Ridge) -> DataFrame:
    rows = [(f, float(w), abs(float(w))) for f, w in zip(model.features, model.weights)]
    return spark.createDataFrame(rows, "coef string, weight double, abs_weight double").orderBy(F.col("abs_weight").desc())


def predictions(table: DataFrame, model: Ridge, key: str = "group_id") -> DataFrame:
    """Predicted and real counts per group and target day, with running totals."""
    run = W.partitionBy(key).orderBy("target_date").rowsBetween(W.unboundedPreceding, 0)
    p = table.withColumn("predicted_num_cases", model.predict())
    return p.select(
        key, "target_date", "target_num_cases", "predicted_num_cases",
        F.when(F.col("target_num_cases").isNotNull(), F.sum("target_num_cases").over(run)).alias("target_num_cases_accum"),
        F.sum("predicted_num_cases").over(run).alias("predicted_num_cases_accum"),
    )


def local_scores(pred: DataFrame, key: str = "group_id") -> DataFrame:
    """R² and RMSE of each group, by sums."""
    y, p = F.col("target_num_cases"), F.col("predicted_num_cases")
    s = pred.filter(y.isNotNull()).groupBy(key).agg(
        F.avg((y - p) * (y - p)).alias("mse"), F.var_pop("target_num_cases").alias("var")
    )
    return s.select(key, (1 - F.col("mse") / F.nullif(F.col("var"), F.lit(0.0))).alias("local_r2"), F.sqrt("mse").alias("local_rmse"))


SCENARIO_SCHEMA = "group_id string, ratio double, target_date date, target_num_cases double, predicted_num_cases double"


def scenarios(
    nodes: DataFrame, edges: DataFrame, groups: DataFrame, model: Ridge, ratios: list[float], days_back: int = 5, days_ahead: int = 8,
    smooth_days: int = 1, from_days: int = 90,
) -> DataFrame:
    """Forecasts under scaled mobility, predicted cases being fed back as the group's own cases.

    Inputs are the last `from_days` days of each group, summed per day in Spark; only the
    day-by-day recursion of one (group, ratio) runs in a task.
    """
    last = nodes.agg(F.date_sub(F.max("date_time"), from_days).alias("_s"))
    n = nodes.join(last, F.col("date_time") >= F.col("_s")).drop("_s")
    e = edges.join(last, F.col("date_time") >= F.col("_s")).drop("_s")
    n = windows.smooth_curve(n, ["node_id"], "day", "num_cases", smooth_days)
    daily = daily_group_values(n, e, groups).withColumn("ratio", F.explode(F.array(*[F.lit(float(r)) for r in ratios])))
    names = model.features

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("day").reset_index(drop=True)
        ratio = pdf["ratio"].iloc[0]
        move = pdf["inner_movement"].to_numpy(float) * ratio
        cases = pdf["cases"].to_numpy(float, copy=True)
        # degree of the group per unit of its cases, so that fed-back cases change it too
        per_case = np.divide(pdf["inner_degree"].to_numpy(float), cases, out=np.zeros(len(pdf)), where=cases != 0) * ratio
        fixed = {c: pdf[c].to_numpy(float) for c in ("in_degree", "in_movement", "in_cases")}
        out = []
        for t in range(days_back, len(pdf)):
            row = []
            for f in names:
                base, _, k = f.rpartition("_")
                if f == "elapsed_days":
                    row.append(float(pdf["day"].iloc[t]))
                    continue
                i = t - int(k)
                row.append({
                    "interal_movement": move[i], "internal_degree": per_case[i] * cases[i], "internal_cases": cases[i],
                    "in_degree": fixed["in_degree"][i] * ratio, "in_movement": fixed["in_movement"][i] * ratio, "in_cases": fixed["in_cases"][i],
                }[base])
            guess = float(model.predict_array(np.array([row]))[0])
            ahead = t + days_ahead
            real = cases[ahead] if ahead < len(pdf) else np.nan
            out.append((pdf["group_id"].iloc[0], ratio, pdf["date_time"].iloc[t] + pd.Timedelta(days=days_ahead), real, guess))
            if ahead < len(pdf) and real != 0:
                cases[ahead] = guess
        res = pd.DataFrame(out, columns=["group_id", "ratio", "target_date", "target_num_cases", "predicted_num_cases"])
        return res

    return daily.groupBy("group_id", "ratio").applyInPandas(run, SCENARIO_SCHEMA)


def scenario_label(ratio):
    pct = F.bround(100 * F.abs(1 - ratio), 0).cast("int").cast("string")
    return (
        F.when(ratio == 1, F.lit("Sin Cambio"))
        .when(ratio < 1, F.concat(F.lit("Disminución "), pct, F.lit("%")))
        .otherwise(F.concat(F.lit("Aumento "), pct, F.lit("%")))
    )


def union_forecast(pred: DataFrame, real: DataFrame, coverage: float | DataFrame) -> DataFrame:
    """Areas summed per target day, scaled by the covered share, with error bands for the projection.

    pred(target_date, target_num_cases, predicted_num_cases, predicted_num_cases_accum),
    real(target_date, cases). Columns: kind (real / past / ahead), cases, cases_accum, bands.
    """
    share = coverage if isinstance(coverage, DataFrame) else pred.sparkSession.range(1).select(F.lit(float(coverage)).alias("share"))
    scaled = pred.crossJoin(share)  # one-row side
    agg = [
        (F.sum("predicted_num_cases") / F.max("share")).alias("cases"), (F.sum("predicted_num_cases_accum") / F.max("share")).alias("cases_accum"),
    ]
    past = scaled.filter(F.col("target_num_cases").isNotNull()).groupBy("target_date").agg(*agg)
    start = pred.filter(F.col("target_num_cases").isNull()).agg(F.date_sub(F.min("target_date"), 1).alias("_s"))
    ahead = scaled.join(start, F.col("target_date") >= F.col("_s")).groupBy("target_date").agg(*agg)
    run = W.orderBy("target_date").rowsBetween(W.unboundedPreceding, 0)  # one row per day
    r = real.join(past.select("target_date"), "target_date", "right").na.fill(0.0).withColumn("cases_accum", F.sum("cases").over(run))
    both = r.select("target_date", F.col("cases").alias("y")).join(past.select("target_date", F.col("cases").alias("p")), "target_date")
    err = both.agg(
        F.sqrt(F.avg((F.col("y") - F.col("p")) * (F.col("y") - F.col("p")))).alias("rmse"),
        (100 * F.avg(F.abs(F.col("y") - F.col("p")) / (F.col("y") + 1))).alias("mpe"),
    )
    i = F.row_number().over(W.orderBy("target_date"))  # one row per day
    banded = ahead.crossJoin(err).select(
        "target_date", F.lit("ahead").alias("kind"), "cases", "cases_accum",
        (F.col("cases") - F.col("rmse")).alias("low"), (F.col("cases") + F.col("rmse")).alias("high"),
        (F.col("cases_accum") - F.col("rmse") * i).alias("low_accum"), (F.col("cases_accum") + F.col("rmse") * i).alias("high_accum"),
    )
    null = F.lit(None).cast("double")

    def plain(df, kind):
        return df.select(
            "target_date", F.lit(kind).alias("kind"), "cases", "cases_accum",
            null.alias("low"), null.alias("high"), null.alias("low_accum"), null.alias("high_accum"),
        )

    return plain(r, "real").unionByName(plain(past, "past")).unionByName(banded)


def forecast_errors(pairs: DataFrame) -> DataFrame:
    """RMSE and mean percentage error of (y, p) pairs."""
    y, p = F.col("y"), F.col("p")
    return pairs.agg(F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"), (100 * F.avg(F.abs(y - p) / (y + 1))).alias("mpe"))
