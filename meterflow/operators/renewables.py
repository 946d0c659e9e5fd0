"""Renewable surplus against forecast deficit: state, plan, transfers and their effect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.config import GridConfig
from meterflow.functions import labels
from meterflow.functions.exact import exact_total, percent, shown, to_mw, unsigned_zero
from meterflow.operators.forecast import overload_minutes, risk_score
from meterflow.operators.loads import in_range, since


def load_prediction_join(loads: DataFrame, predictions: DataFrame, cfg: GridConfig) -> DataFrame:
    """Zone loads with the prediction of the same zone and window start."""
    forecast = predictions.select(
        "zip_code",
        "window_start",
        "overload_risk_score",
        to_mw(F.col("predicted_15min"), cfg).alias("predicted_load_mw"),
    )
    return loads.select("zip_code", "window_start", "load_mw", "avg_temp_f").join(
        forecast, ["zip_code", "window_start"]
    )


def aligned_loads(loads: DataFrame, cfg: GridConfig) -> DataFrame:
    """Zone loads summed up to the bucket of the predictions, so that the two compare like with like."""
    start = F.window("window_start", f"{cfg.minute_window_s} seconds").getField("start")
    return (
        loads.withColumn("window_start", start)
        .groupBy("window_start", "zip_code")
        .agg(
            exact_total("load_mw", cfg.mw_decimals).alias("load_mw"),
            (F.sum(F.col("avg_temp_f") * F.col("meter_count")) / F.sum("meter_count")).alias("avg_temp_f"),
        )
    )


def renewable_state(
    loads: DataFrame, predictions: DataFrame, assets: DataFrame, cfg: GridConfig, as_of: Column | None = None
) -> DataFrame:
    """Load, forecast and renewable surplus per zone. A zone without a known generation has no surplus."""
    recent = since(loads, as_of, cfg.renewable_recent_s)
    spare = F.col("solar_generation_mw") + F.col("wind_generation_mw") - F.col("load_mw")
    return (
        load_prediction_join(recent, predictions, cfg)
        .join(assets, "zip_code", "left")
        .withColumn("renewable_surplus_mw", F.greatest(F.lit(0.0), spare))
    )


def plan_metrics(state: DataFrame, cfg: GridConfig) -> DataFrame:
    """The plan before rounding: deficit, priority and role of each zone."""
    load, forecast, risk = F.col("load_mw"), F.col("predicted_load_mw"), F.col("overload_risk_score")
    deficit = F.when(forecast > load * cfg.deficit_ratio, forecast - load).otherwise(F.lit(0.0))
    priority = unsigned_zero(risk * (forecast / F.nullif(load, F.lit(0.0))))
    return state.withColumns({"projected_deficit_mw": deficit, "reallocation_priority": priority}).withColumn(
        "grid_role", labels.grid_role(F.col("renewable_surplus_mw"), F.col("projected_deficit_mw"), risk, cfg)
    )


def reallocation_plan(state: DataFrame, cfg: GridConfig, ordered: bool = True) -> DataFrame:
    rows = plan_metrics(state, cfg)
    if ordered:
        rows = rows.orderBy(F.col("reallocation_priority").desc_nulls_last())
    return rows.select(
        "window_start",
        "zip_code",
        shown(F.col("load_mw"), 2).alias("current_load"),
        shown(F.col("predicted_load_mw"), 2).alias("predicted_load"),
        shown(F.col("overload_risk_score"), 1).alias("risk_score"),
        shown(F.col("renewable_surplus_mw"), 2).alias("surplus_mw"),
        shown(F.col("projected_deficit_mw"), 2).alias("deficit_mw"),
        shown(F.col("reallocation_priority"), 2).alias("priority_score"),
        "grid_role",
        labels.grid_command(F.col("renewable_surplus_mw"), F.col("projected_deficit_mw"), cfg).alias("grid_command"),
    )


def renewable_balance(state: DataFrame, cfg: GridConfig) -> DataFrame:
    """Per window: surplus of the whole grid and the number of zones in deficit."""
    return (
        plan_metrics(state, cfg)
        .groupBy("window_start")
        .agg(
            F.sum("renewable_surplus_mw").alias("renewable_surplus_mw"),
            F.count_if(F.col("projected_deficit_mw") > 0).alias("renewable_deficit_zones"),
        )
    )


def renewable_utilization(loads: DataFrame, assets: DataFrame, start=None, end=None) -> DataFrame:
    """Share of each zone's known generation that its own load took up, in windows with a known load."""
    generation = F.col("solar_generation_mw") + F.col("wind_generation_mw")
    return (
        in_range(loads, None, start, end)
        .join(assets, "zip_code")
        .withColumn("generation_mw", generation)
        .filter(F.col("generation_mw").isNotNull() & F.col("load_mw").isNotNull())
        .groupBy("zip_code")
        .agg(
            F.sum("generation_mw").alias("generation_mw"),
            F.sum(F.least("generation_mw", "load_mw")).alias("used_mw"),
        )
        .withColumn("utilization_pct", percent(F.col("used_mw"), F.col("generation_mw")))
    )


def transfer_pairs(plan: DataFrame, cfg: GridConfig) -> DataFrame:
    """Route the power offered by export zones to import zones, window by window.

    Exporters (largest surplus first) and importers (highest priority first) are laid end
    to end on one MW axis each. Sweeping both axes together, every start of an offer or
    of a request opens a stretch that belongs to the exporter and the importer last
    opened; so the work grows with the number of zones, not with the number of pairs.
    """
    exporting = F.col("grid_role") == labels.EXPORT_ZONE
    amount = F.round(
        F.when(exporting, F.col("renewable_surplus_mw") * cfg.transfer_share).otherwise(F.col("projected_deficit_mw")),
        4,
    ).cast("decimal(18,4)")
    weight = F.when(exporting, F.col("renewable_surplus_mw")).otherwise(F.col("reallocation_priority"))
    sides = (
        plan.filter(F.col("grid_role").isin(labels.EXPORT_ZONE, labels.IMPORT_ZONE))
        .select("window_start", "zip_code", exporting.alias("exports"), amount.alias("mw"), weight.alias("weight"))
        .filter(F.col("mw") > 0)
        # One shuffle serves the running sums, the grouping and the sweep below.
        .repartition("window_start")
    )
    queue = (
        Window.partitionBy("window_start", "exports")
        .orderBy(F.col("weight").desc_nulls_last(), "zip_code")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    laid = sides.withColumn("hi", F.sum("mw").over(queue)).withColumn("lo", F.col("hi") - F.col("mw"))
    stretch = F.struct("zip_code", "hi")
    starts = laid.groupBy("window_start", "lo").agg(
        F.max(F.when(F.col("exports"), stretch)).alias("source"),
        F.max(F.when(~F.col("exports"), stretch)).alias("target"),
    )
    sweep = Window.partitionBy("window_start").orderBy("lo")
    so_far = sweep.rowsBetween(Window.unboundedPreceding, 0)
    swept = starts.select(
        "window_start",
        "lo",
        F.last("source", ignorenulls=True).over(so_far).alias("source"),
        F.last("target", ignorenulls=True).over(so_far).alias("target"),
        F.lead("lo").over(sweep).alias("next_lo"),
    ).filter(F.col("source").isNotNull() & F.col("target").isNotNull())
    routed = F.least("next_lo", "source.hi", "target.hi") - F.col("lo")
    return swept.select(
        "window_start",
        F.col("source.zip_code").alias("source_zip"),
        F.col("target.zip_code").alias("target_zip"),
        routed.cast("double").alias("transfer_mw"),
    ).filter(F.col("transfer_mw") > 0)


def transfer_impact(pairs: DataFrame, predictions: DataFrame, cfg: GridConfig) -> DataFrame:
    """What one transfer does to its target: load, minutes left and risk once it is served from elsewhere."""
    targets = predictions.select(
        "window_start",
        F.col("zip_code").alias("target_zip"),
        "current_load_kw",
        "load_acceleration",
        "load_trend_slope",
        "predicted_15min",
    )
    moved = F.col("transfer_mw") * cfg.kw_per_mw
    load = F.col("current_load_kw") - moved
    return pairs.join(targets, ["window_start", "target_zip"]).select(
        "window_start",
        "source_zip",
        "target_zip",
        "transfer_mw",
        to_mw(load, cfg).alias("target_new_load_mw"),
        overload_minutes(load, F.col("load_acceleration"), F.lit(cfg.overload_capacity_kw), cfg).alias(
            "target_new_minutes_to_overload"
        ),
        risk_score(
            F.col("predicted_15min") - moved, F.col("load_trend_slope"), F.lit(cfg.risk_capacity_kw), cfg
        ).alias("target_new_risk_score"),
    )
