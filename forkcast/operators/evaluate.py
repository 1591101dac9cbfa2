"""Model evaluation as aggregates (EV1-EV8, SET1).

Metrics are one aggregate pass over the scored frame; nothing is
collected but the metric row.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def regression_metrics(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """MSE and R^2 = 1 - SSE/SST (not the squared correlation), in one pass."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    base = pred.where(y.isNotNull() & p.isNotNull())
    sse, sst = F.sum(F.pow(y - p, 2)), F.var_pop(y) * F.count(F.lit(1))
    # constant labels (SST = 0): 1.0 for a perfect fit, else 0.0 (finite R^2)
    r2 = F.when(sst == 0, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0))).otherwise(F.lit(1.0) - sse / sst)
    return base.agg(F.avg(F.pow(y - p, 2)).alias("mse"), r2.alias("r2"), F.count(F.lit(1)).cast("bigint").alias("n"))


def confusion_matrix(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """2x2 matrix as rows (truth, predicted, n), every cell present."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    counts = pred.groupBy(y.alias("truth"), p.alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    cells = F.array(*[F.struct(F.lit(a).alias("truth"), F.lit(b).alias("predicted")) for a in (0, 1) for b in (0, 1)])
    spine = pred.sparkSession.range(1).select(F.explode(cells).alias("c")).select("c.*")
    return (spine.join(counts, ["truth", "predicted"], "left")
                 .select("truth", "predicted", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b.cast("double"))


def classification_metrics(pred: DataFrame, label: str, prediction: str = "prediction",
                           model: str | None = None) -> DataFrame:
    """Confusion cells, accuracy, and precision / recall / F1 of class 1
    with zero division -> 0, in one pass."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    base = pred.where(y.isNotNull() & p.isNotNull())
    c = base.agg(F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                 F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp"))
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    prec = _safe_div(tp, tp + fp)
    rec = _safe_div(tp, tp + fn)
    out = c.select(*(F.col(x).cast("bigint").alias(x) for x in ("tn", "fp", "fn", "tp")),
                   _safe_div(tp + tn, tn + fp + fn + tp).alias("accuracy"), prec.alias("precision"),
                   rec.alias("recall"),
                   F.when(prec + rec == 0, F.lit(0.0)).otherwise(F.lit(2.0) * prec * rec / (prec + rec)).alias("f1"))
    return out.select(F.lit(model).alias("model"), "*") if model else out


def timed(fn, *args, **kwargs):
    """(result, seconds) around a call."""
    t0 = time.perf_counter()
    res = fn(*args, **kwargs)
    return res, round(time.perf_counter() - t0, 4)


def compare(frames: list[DataFrame]) -> DataFrame:
    """Side-by-side table of metric rows (SET1, EV8): union by name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def compare_wide(frames: list[DataFrame], metrics: list[str], model_col: str = "model",
                 names: list[str] | None = None) -> DataFrame:
    """Side-by-side table (EV8): one row per metric, one column per model.
    Metric rows are unpivoted to (model, metric, value) and pivoted on the
    model ``names``; unless given, they are read from the frames."""
    both = compare(frames)
    names = names or [r[0] for r in both.select(model_col).collect()]      # one row per frame
    return (both.unpivot(model_col, metrics, "metric", "value").groupBy("metric").pivot(model_col, names)
                .agg(F.first("value")).select("metric", *names))
