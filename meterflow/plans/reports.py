"""After the fact: accuracy, response times, operator activity, load profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.config import GridConfig
from meterflow.functions import labels
from meterflow.operators.history import next_known
from meterflow.operators.loads import since

WHOLE_GRID = "ALL"


def forecast_against_actual(predictions: DataFrame, minute: DataFrame, cfg: GridConfig) -> DataFrame:
    """Each forecast with the load that came to pass one horizon later in the same zone."""
    horizon = F.make_dt_interval(secs=F.lit(cfg.horizon_rows * cfg.minute_window_s))
    due = predictions.select(
        "zip_code", (F.col("window_start") + horizon).alias("window_start"), F.col("predicted_15min").alias("predicted_kw")
    )
    actual = minute.select("zip_code", "window_start", F.col("minute_load_kw").alias("actual_kw"))
    error = F.abs(F.col("predicted_kw") - F.col("actual_kw")) / F.nullif(F.col("actual_kw"), F.lit(0.0))
    return due.join(actual, ["zip_code", "window_start"]).withColumn("relative_error", error)


def prediction_accuracy(
    predictions: DataFrame, minute: DataFrame, cfg: GridConfig, as_of: Column | None = None, days: int = 30
) -> DataFrame:
    """Mean accuracy in percent per zone and, under `ALL`, for the whole grid."""
    compared = since(forecast_against_actual(predictions, minute, cfg), as_of, days * 86_400)
    return _accuracy(
        compared.groupBy("zip_code").agg(
            F.count("relative_error").alias("forecasts"), F.sum("relative_error").alias("error")
        )
    )


def _accuracy(by_zone: DataFrame) -> DataFrame:
    overall = by_zone.agg(
        F.lit(WHOLE_GRID).alias("zip_code"),
        F.coalesce(F.sum("forecasts"), F.lit(0)).alias("forecasts"),
        F.sum("error").alias("error"),
    )
    return by_zone.unionByName(overall).select(
        "zip_code", "forecasts", (100.0 * (1 - F.try_divide("error", "forecasts"))).alias("accuracy_pct")
    )


def response_times(
    predictions: DataFrame, actions: DataFrame, cfg: GridConfig, as_of: Column | None = None, days: int = 7
) -> DataFrame:
    """Each published alert with the first action taken in its zone from then on; with `as_of`, alerts of the last days.

    An alert is known at the end of its minute. That is a bucket edge, so of all actions
    in a minute only the first can answer an alert: actions are reduced to one per zone
    and minute before anything is ordered.
    """
    edge = F.window("ts", f"{cfg.minute_window_s} seconds").getField("start")
    taken = since(actions, as_of, days * 86_400, "ts").select(
        "zip_code", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "ts", "operator_id", edge.alias("at")
    )
    # Numbers can be hashed. The operator, a text, is looked up at the end, for the actions that answered.
    answers = taken.groupBy("zip_code", "at").agg(F.min("us").alias("answer"))
    published = since(predictions, as_of, days * 86_400, "window_end")
    alerts = published.filter(F.col("alert_level").isin(*labels.PUBLISHED_LEVELS)).select(
        "zip_code", F.col("window_end").alias("at"), "alert_level"
    )
    # One timeline with at most one alert and one answer per zone and edge.
    timeline = answers.unionByName(alerts, allowMissingColumns=True)
    answered = next_known(timeline, ["zip_code"], "at", "answer", "us", cfg.history_chunk_s)
    one_of = Window.partitionBy("zip_code", "alert_time").orderBy("operator_id")
    return (
        answered.filter(F.col("alert_level").isNotNull())
        .select("zip_code", "alert_level", F.col("at").alias("alert_time"), "us")
        .join(taken.drop("at"), ["zip_code", "us"], "left")
        .withColumn("nth", F.row_number().over(one_of))
        .filter(F.col("nth") == 1)
        .select(
            "zip_code",
            "alert_level",
            "alert_time",
            F.col("ts").alias("action_time"),
            "operator_id",
            (F.timestamp_diff("MICROSECOND", F.col("alert_time"), F.col("ts")) / 1e6).alias("response_seconds"),
        )
    )


def response_time_stats(responses: DataFrame) -> DataFrame:
    return responses.groupBy("alert_level").agg(
        F.count(F.lit(1)).alias("alerts"),
        F.count("response_seconds").alias("answered"),
        F.avg("response_seconds").alias("avg_seconds"),
        F.max("response_seconds").alias("max_seconds"),
        F.percentile_approx("response_seconds", 0.5).alias("median_seconds"),
    )


def action_rate(actions: DataFrame, cfg: GridConfig) -> DataFrame:
    """Moments at which an operator had taken more actions within the rate window than allowed.

    Actions are first counted per operator and second. The seconds are then cut into
    spans; each span also gets the seconds before it that its windows reach back to.
    """
    per_second = (
        actions.withColumn("second", F.unix_seconds(F.col("ts").cast("timestamp")))
        .groupBy("operator_id", "second")
        .agg(F.count(F.lit(1)).alias("actions"))
    )
    width = cfg.rate_window_s
    span = max(16 * width, 3_600)
    own = F.expr(f"second div {span}")
    reaches_on = F.col("second") % span > span - width
    placed = per_second.withColumn("home", own).withColumn(
        "span", F.explode(F.array_compact(F.array(own, F.when(reaches_on, own + 1))))
    )
    last = Window.partitionBy("operator_id", "span").orderBy("second").rangeBetween(1 - width, 0)
    return (
        placed.withColumn("actions_in_window", F.sum("actions").over(last))
        .filter((F.col("span") == F.col("home")) & (F.col("actions_in_window") > cfg.rate_limit))
        .select("operator_id", F.timestamp_seconds("second").alias("at"), "actions_in_window")
    )


def period_profile(readings: DataFrame) -> DataFrame:
    """Load of single readings by period of the day, with the share outside the expected band."""
    period = labels.day_period(F.hour("event_time"))
    return (
        readings.select(period.alias("period"), "power_kw")
        .groupBy("period")
        .agg(
            F.count(F.lit(1)).alias("readings"),
            F.min("power_kw").alias("min_kw"),
            F.avg("power_kw").alias("avg_kw"),
            F.max("power_kw").alias("max_kw"),
            F.avg(labels.outside_expected(F.col("period"), F.col("power_kw")).cast("double")).alias("outside_share"),
        )
    )


def temp_correlation(loads: DataFrame) -> DataFrame:
    return loads.groupBy("zip_code").agg(
        F.count(F.lit(1)).alias("points"), F.corr("load_mw", "avg_temp_f").alias("temp_correlation")
    )


def daily_moments(loads: DataFrame) -> DataFrame:
    """Per day and zone what a correlation of load and temperature needs: counts, means and sums of squared differences.

    Stored once per day, they answer for any range of days without its rows.
    """
    x, y = F.col("load_mw"), F.col("avg_temp_f")
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    return loads.groupBy(F.to_date("window_start").alias("day"), "zip_code").agg(
        F.count(F.lit(1)).alias("points"),
        F.count(a).alias("n"),
        F.avg(a).alias("mean_x"),
        F.avg(b).alias("mean_y"),
        (F.var_pop(a) * F.count(a)).alias("square_x"),
        (F.var_pop(b) * F.count(a)).alias("square_y"),
        (F.covar_pop(a, b) * F.count(a)).alias("cross"),
    )


_MOMENTS = ("mean_x", "mean_y", "square_x", "square_y", "cross")


def _merged(a: Column, d: Column) -> Column:
    """Moments of two sets of points, from those of each: what differs between the sets is added, nothing cancels."""
    n = a["n"] + d["n"]
    dx, dy, weight = d["mean_x"] - a["mean_x"], d["mean_y"] - a["mean_y"], a["n"] * d["n"] / n
    return F.struct(
        n.alias("n"),
        (a["mean_x"] + dx * d["n"] / n).alias("mean_x"),
        (a["mean_y"] + dy * d["n"] / n).alias("mean_y"),
        (a["square_x"] + d["square_x"] + dx * dx * weight).alias("square_x"),
        (a["square_y"] + d["square_y"] + dy * dy * weight).alias("square_y"),
        (a["cross"] + d["cross"] + dx * dy * weight).alias("cross"),
    )


def _days_between(daily: DataFrame, start: Column | None, end: Column | None) -> DataFrame:
    if start is not None:
        daily = daily.filter(F.col("day") >= start)
    return daily if end is None else daily.filter(F.col("day") < end)


def temp_correlation_range(daily: DataFrame, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """`temp_correlation` of the days from `start` up to `end`, from their moments, merged in the order of days.

    A zone has one small row per day. Zones whose load or temperature never changes have none.
    """
    days = F.sort_array(F.collect_list(F.when(F.col("n") > 0, F.struct("day", "n", *_MOMENTS))))
    zero = F.struct(F.lit(0).cast("long").alias("n"), *[F.lit(0.0).alias(name) for name in _MOMENTS])
    zones = _days_between(daily, start, end).groupBy("zip_code").agg(F.sum("points").alias("points"), days.alias("days"))
    whole = zones.withColumn("m", F.aggregate("days", zero, _merged))
    spread = F.nullif(F.sqrt(F.col("m.square_x") * F.col("m.square_y")), F.lit(0.0))
    return whole.select("zip_code", "points", (F.col("m.cross") / spread).alias("temp_correlation"))


def daily_errors(predictions: DataFrame, minute: DataFrame, cfg: GridConfig) -> DataFrame:
    """Per day and zone the number of forecasts that came due and their summed relative error."""
    compared = forecast_against_actual(predictions, minute, cfg)
    return compared.groupBy(F.to_date("window_start").alias("day"), "zip_code").agg(
        F.count("relative_error").alias("forecasts"), F.sum("relative_error").alias("error")
    )


def prediction_accuracy_range(daily: DataFrame, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """`prediction_accuracy` of the forecasts due from `start` up to `end`, from daily sums."""
    return _accuracy(
        _days_between(daily, start, end)
        .groupBy("zip_code")
        .agg(F.sum("forecasts").alias("forecasts"), F.sum("error").alias("error"))
    )


#: A merged sketch misses a quantile's rank by this share of all values at most, with 99 % confidence.
SKETCH_SIZE, SKETCH_ERROR = 400, 0.0085


def daily_sketches(responses: DataFrame) -> DataFrame:
    """Per day and alert level the number of alerts and a sketch of the response times, in microseconds."""
    micros = F.round(F.col("response_seconds") * 1e6).cast("long")
    return responses.groupBy(F.to_date("alert_time").alias("day"), "alert_level").agg(
        F.count(F.lit(1)).alias("alerts"),
        F.count(micros).alias("answered"),
        F.kll_sketch_agg_bigint(micros, F.lit(SKETCH_SIZE)).alias("sketch"),
    )


def response_time_quantiles(daily: DataFrame, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """Median and 95th percentile of the response times of a range of days, from their sketches alone."""
    levels = _days_between(daily, start, end).groupBy("alert_level").agg(
        F.sum("alerts").alias("alerts"),
        F.sum("answered").alias("answered"),
        F.kll_merge_agg_bigint(F.when(F.col("answered") > 0, F.col("sketch"))).alias("sketch"),
    )
    quantile = lambda q: F.when(
        F.col("answered") > 0, F.kll_sketch_get_quantile_bigint("sketch", F.lit(q)) / F.lit(1e6)
    )
    return levels.select(
        "alert_level", "alerts", "answered", quantile(0.5).alias("median_seconds"), quantile(0.95).alias("p95_seconds")
    )


def write_csv(report: DataFrame, path: str) -> None:
    """Export a report as CSV with a header, one file per task of its plan."""
    report.write.mode("overwrite").option("header", True).csv(path)
