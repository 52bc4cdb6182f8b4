"""Statistics over many tests: adjustment, tables, intervals, models, scores."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .kernels import Firth, clopper_pearson, fisher_two_sided


def bh_adjust(df: DataFrame, p: str, family: list[str]) -> DataFrame:
    """ST-2: Benjamini-Hochberg q-values inside each family; null p-values get none and are not counted."""
    own = Window.partitionBy(*family)
    n, rank = F.count(p).over(own), F.row_number().over(own.orderBy(F.asc_nulls_last(p)))
    rows = df.withColumns({"_n": n, "_r": rank})
    q = F.min(F.col(p) * F.col("_n") / F.col("_r")).over(own.orderBy(F.desc("_r")).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("q_value", F.when(F.col(p).isNotNull(), F.least(q, F.lit(1.0)))).drop("_n", "_r")


def holm_adjust(df: DataFrame, p: str, family: list[str]) -> DataFrame:
    """ST-3: Holm's step-down values; a skipped test (null) counts as p = 1 and keeps a null result."""
    own = Window.partitionBy(*family)
    rows = df.withColumn("_p", F.coalesce(F.col(p), F.lit(1.0)))
    rows = rows.withColumns({"_n": F.count(F.lit(1)).over(own), "_r": F.row_number().over(own.orderBy("_p"))})
    run = F.max(F.col("_p") * (F.col("_n") - F.col("_r") + 1)).over(own.orderBy("_r").rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("holm_p", F.when(F.col(p).isNotNull(), F.least(run, F.lit(1.0)))).drop("_p", "_n", "_r")


def two_by_two(df: DataFrame) -> DataFrame:
    """ST-4: from counts a, b, c, d: risk difference and ratio, odds ratio with 0.5 added to all cells if one is 0, 95 % interval, Fisher's exact p."""

    @F.pandas_udf("double")
    def fisher(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series([fisher_two_sided(*map(int, x)) for x in zip(a, b, c, d, strict=True)], dtype=float)

    zero = (F.col("a") == 0) | (F.col("b") == 0) | (F.col("c") == 0) | (F.col("d") == 0)
    cell = {k: F.col(k) + F.when(zero, 0.5).otherwise(0.0) for k in "abcd"}
    odds = cell["a"] * cell["d"] / (cell["b"] * cell["c"])
    error = F.sqrt(1 / cell["a"] + 1 / cell["b"] + 1 / cell["c"] + 1 / cell["d"])
    risk1, risk0 = F.try_divide(F.col("a"), F.col("a") + F.col("b")), F.try_divide(F.col("c"), F.col("c") + F.col("d"))
    z = 1.959963984540054
    return df.withColumns({"risk_difference": risk1 - risk0, "risk_ratio": F.try_divide(risk1, risk0), "odds_ratio": odds, "or_low": F.exp(F.log(odds) - z * error), "or_high": F.exp(F.log(odds) + z * error), "fisher_p": fisher("a", "b", "c", "d")})


def carrier_counts(cells: DataFrame, keys: list[str]) -> DataFrame:
    """ST-5: carriers and callable people of each group with an exact binomial interval. Rows: carrier 1, 0 or null."""

    @F.pandas_udf("lower double, upper double")
    def interval(k: pd.Series, n: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([clopper_pearson(int(a), int(b)) for a, b in zip(k, n, strict=True)], columns=["lower", "upper"])

    g = cells.groupBy(*keys).agg(F.count("carrier").alias("callable"), F.coalesce(F.sum("carrier"), F.lit(0)).alias("carriers"))
    return g.withColumn("_i", interval("carriers", "callable")).select(*keys, "callable", "carriers", F.col("_i.lower").alias("ci_low"), F.col("_i.upper").alias("ci_high"))


def firth_tests(rows: DataFrame, key: str, outcome: str, predictor: str, covariates: list[str], min_carriers: int = 3) -> DataFrame:
    """ST-6: one penalised logistic regression for each value of `key` (a group has one row a person): coefficient, odds ratio with its 95 % profile interval, p, status.

    p and interval come from the same profile: the penalised likelihood with the predictor's coefficient held, at zero for p. An end of the
    interval that lies beyond a coefficient of 50 is null.
    """
    from math import erfc, sqrt

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        name = pdf[key].iloc[0]
        pdf = pdf.dropna(subset=[outcome, predictor, *covariates])
        y, carrier = pdf[outcome].to_numpy(float), pdf[predictor].to_numpy(float)
        base = {"n": len(pdf), "beta": None, "odds_ratio": None, "ci_low": None, "ci_high": None, "p_value": None}

        def out(status: str, reason: str = "", **more) -> pd.DataFrame:
            return pd.DataFrame([{key: name, **base, **more, "status": status, "reason": reason}])

        if len(set(y)) < 2:
            return out("SKIPPED", "one outcome group")
        if min(carrier.sum(), (1 - carrier).sum()) < min_carriers:
            return out("SKIPPED", "sparse carriers")
        rest = np.column_stack([np.ones(len(pdf)), *(pdf[c].to_numpy(float) for c in covariates)])
        model = Firth(np.column_stack([rest, carrier]), y)
        if not model.full_rank() or len(pdf) <= model.x.shape[1]:
            return out("SKIPPED", "rank-deficient design")
        beta, best = model.fit()
        chi = max(0.0, 2 * (best - model.fit(len(beta) - 1, 0.0)[1]))
        low, high = model.interval(len(beta) - 1, beta, best)
        raised = lambda b: None if b is None else float(np.exp(b))
        return out("ESTIMATED", beta=float(beta[-1]), odds_ratio=raised(beta[-1]), ci_low=raised(low), ci_high=raised(high), p_value=erfc(sqrt(chi / 2)))

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, outcome, predictor, *covariates).groupBy(key).applyInPandas(run, f"{key} {kind}, n long, beta double, odds_ratio double, ci_low double, ci_high double, p_value double, status string, reason string")


def binary_scores(df: DataFrame, keys: list[str], label: str, score: str) -> DataFrame:
    """ST-9: log loss, Brier score and AUC (by average ranks) of each group. Equal scores are summed first, so only distinct scores are ordered."""
    p = F.greatest(F.least(F.col(score), F.lit(1 - 1e-15)), F.lit(1e-15))
    y = F.col(label)
    base = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("positives"), F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("log_loss"), F.avg((F.col(score) - y) ** 2).alias("brier"))
    tied = df.groupBy(*keys, score).agg(F.count(F.lit(1)).alias("_n"), F.sum(label).alias("_pos"))
    below = F.coalesce(F.sum("_n").over(Window.partitionBy(*keys).orderBy(score).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranks = tied.withColumn("_rank", below + (F.col("_n") + 1) / 2).groupBy(*keys).agg(F.sum(F.col("_rank") * F.col("_pos")).alias("_r"))
    j = base.join(ranks, keys)
    pos, neg = F.col("positives"), F.col("n") - F.col("positives")
    return j.withColumn("auc", F.when((pos > 0) & (neg > 0), (F.col("_r") - pos * (pos + 1) / 2) / (pos * neg))).drop("_r")


def group_bootstrap(df: DataFrame, keys: list[str], group: str, value: str, n: int = 1000, seed: int = 1) -> DataFrame:
    """ST-10: mean and 95 % interval by resampling groups; only one sum and count a group reach the task."""
    sums = df.groupBy(*keys, group).agg(F.sum(value).alias("_s"), F.count(value).alias("_c"))
    types = {f.name: f.dataType.simpleString() for f in df.schema}

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(group)
        s, c = pdf["_s"].to_numpy(float), pdf["_c"].to_numpy(float)
        w = np.random.default_rng(seed).multinomial(len(s), np.full(len(s), 1 / len(s)), n)
        means = (w @ s) / np.maximum(w @ c, 1)
        return pd.DataFrame([{**{k: pdf[k].iloc[0] for k in keys}, "mean": s.sum() / c.sum(), "ci_low": np.quantile(means, 0.025), "ci_high": np.quantile(means, 0.975)}])

    return sums.groupBy(*keys).applyInPandas(run, ", ".join(f"{k} {types[k]}" for k in keys) + ", mean double, ci_low double, ci_high double")
