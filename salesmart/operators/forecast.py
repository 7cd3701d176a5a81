"""Daily demand series and forecast."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions import columns as c
from salesmart.operators.enrich import completed, daily_calendar
from salesmart.storage import materialize

DOW = [f"dow_{i}" for i in range(7)]


def daily_series(orders: DataFrame, start: str, end: str) -> DataFrame:
    """Completed sales per day of the period, zero on days without orders.

    Stored: it has one row per day, and the forecast reads it several times.
    """
    daily = completed(orders).groupBy(F.col("order_date").alias("date")).agg(c.exact_sum("total_amount").alias("actual_sales"), F.count("*").alias("actual_orders"))
    return materialize(daily_calendar(daily, "date", ["actual_sales", "actual_orders"], start, end), "daily-series")


def trailing_mean(column: str, days: int):
    """Mean of the previous ``days`` rows, without the current one.

    The series has one row per calendar day, so its unpartitioned window is small.
    """
    w = Window.orderBy("date").rowsBetween(-days, -1)
    return c.exact_sum_over(column, w) / F.count(column).over(w)


def trailing_means(series: DataFrame) -> DataFrame:
    has_past = F.count("actual_sales").over(Window.orderBy("date").rowsBetween(-28, -1)) > 0
    return series.withColumn("rev_7d_ma", F.when(has_past, trailing_mean("actual_sales", 7))).withColumn(
        "rev_28d_ma", F.when(has_past, trailing_mean("actual_sales", 28)))


def forecast_features(series: DataFrame, start: str, test_days: int = 90) -> DataFrame:
    """Trend, trailing means and weekday flags; gaps take the mean of the training days."""
    last = series.agg(F.max("date")).scalar()
    f = trailing_means(series).withColumn("in_test", F.datediff(last, "date") < test_days)
    f = f.withColumn("week_index", F.floor(F.datediff("date", F.lit(start).cast("date")) / 7).cast("double"))
    train = series.where(F.datediff(last, "date") >= test_days).agg(c.exact_avg("actual_sales")).scalar()
    f = f.withColumns({n: F.coalesce(F.col(n), train) for n in ("rev_7d_ma", "rev_28d_ma")})
    return f.withColumns({n: (F.weekday("date") == i).cast("double") for i, n in enumerate(DOW)})


def naive_forecast(series: DataFrame, test_days: int = 90) -> DataFrame:
    """Previous day's sales over the held-out days; the first day repeats its actual."""
    last = series.agg(F.max("date")).scalar()
    test = series.where(F.datediff(last, "date") < test_days)
    lagged = F.lag("actual_sales").over(Window.orderBy("date"))
    return test.select("date", "actual_sales", F.coalesce(lagged, "actual_sales").alias("naive_prediction"))


def demand_forecast(features: DataFrame, naive: DataFrame) -> DataFrame:
    """Linear regression fitted on the past, applied to the held-out days."""
    columns = ["week_index", "rev_7d_ma", "rev_28d_ma", *DOW[:-1]]
    model = Pipeline(stages=[
        VectorAssembler(inputCols=columns, outputCol="features"),
        LinearRegression(labelCol="actual_sales", solver="normal"),
    ]).fit(features.where("not in_test"))
    scored = model.transform(features.where("in_test")).select("date", "prediction")
    return scored.join(naive, "date").withColumn("in_sample", F.lit(False))


def forecast_metrics(forecast: DataFrame, prediction: str, model: str) -> DataFrame:
    """MAE, RMSE and MAPE (denominator at least 1)."""
    err = F.col("actual_sales") - F.col(prediction)
    return forecast.agg(
        F.round(F.avg(F.abs(err)), 4).alias("mae"), F.round(F.sqrt(F.avg(err * err)), 4).alias("rmse"),
        F.round(F.avg(F.abs(err) / F.greatest("actual_sales", F.lit(1.0))) * 100, 6).alias("mape"),
    ).select(F.lit(model).alias("model"), "mae", "rmse", "mape")
