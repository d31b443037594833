"""One dashboard refresh: every panel over the current result tables.

The dashboard re-reads its three tables on each refresh and derives all
panels from them. Here each table's current view (a latest-per-key over its
batch log) is computed once per refresh and kept (memory, spilling to disk)
while the panels are read; every panel is a lazy DataFrame over those views.
Leaving the ``with`` block releases them.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from contrail.plans import panels

PANELS = (
    "live_airborne", "kpi_summary", "map_points", "altitude_bands", "velocity_histogram",
    "latest_country_window", "top_countries", "heatmap_countries", "trend_top_countries",
    "enriched_flights", "top_operators", "top_models", "top_manufacturers", "top_typecodes",
    "manufacturer_share", "scatter_top_operators",
    "alert_log", "worst_descent", "descent_histogram", "alerts_by_country",
)


def panel_frames(live: DataFrame, agg: DataFrame, alerts: DataFrame,
                 countries: list[str] | None = None) -> dict[str, DataFrame]:
    """Every panel from the three current views; ``countries`` picks the trend lines."""
    air = panels.live_airborne(live)
    fleet = panels.enriched_flights(air)
    return {
        "live_airborne": air,
        "kpi_summary": panels.kpi_summary(air, alerts),
        "map_points": panels.map_points(air),
        "altitude_bands": panels.altitude_bands(air),
        "velocity_histogram": panels.velocity_histogram(air),
        "latest_country_window": panels.latest_country_window(agg),
        "top_countries": panels.top_countries(agg),
        "heatmap_countries": panels.heatmap_countries(agg),
        "trend_top_countries": panels.trend_top_countries(agg, countries),
        "enriched_flights": fleet,
        "top_operators": panels.top_operators(fleet),
        "top_models": panels.top_models(fleet),
        "top_manufacturers": panels.top_manufacturers(fleet),
        "top_typecodes": panels.top_typecodes(fleet),
        "manufacturer_share": panels.manufacturer_share(fleet),
        "scatter_top_operators": panels.scatter_top_operators(fleet),
        "alert_log": panels.alert_log(alerts),
        "worst_descent": panels.worst_descent(alerts),
        "descent_histogram": panels.descent_histogram(alerts),
        "alerts_by_country": panels.alerts_by_country(alerts),
    }


@contextmanager
def refresh(spark: SparkSession, tables, countries: list[str] | None = None) -> Iterator[dict[str, DataFrame]]:
    """``with refresh(spark, ResultTables.at(root)) as p: p["kpi_summary"].show()``."""
    views = [t.current(spark).persist(StorageLevel.MEMORY_AND_DISK)
             for t in (tables.live, tables.agg, tables.alerts)]
    try:
        yield panel_frames(*views, countries=countries)
    finally:
        for v in views:
            v.unpersist()
