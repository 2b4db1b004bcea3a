"""The whole run: raw log in, the four reports out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegrid import sinks
from tidegrid.constants import MONTH_DAYS, WEEK_DAYS
from tidegrid.operators.aggregates import daily_rollup, slot_totals_from_rollup
from tidegrid.operators.ranking import top_sectors
from tidegrid.plans import q1, q2
from tidegrid.session import configure, materialize
from tidegrid.sources import normalized

PERIODS = {"week": WEEK_DAYS, "month": MONTH_DAYS}


def reports(positions: DataFrame, slot_tz: str = "UTC") -> dict[str, DataFrame]:
    """All literal result rows, by report name. The positions are read once, for the daily
    rollup; what follows works on the stored rollup, a few hundred rows a day."""
    rollup = materialize(daily_rollup(positions, slot_tz), "daily-rollup")
    out = {}
    for name, days in PERIODS.items():
        out[f"q1_{name}"] = q1.rendered(q1.q1_from_rollup(rollup, days))
        by_sea = slot_totals_from_rollup(rollup, days, by_sea=True)
        out[f"q2_{name}"] = q2.q2_rendered(top_sectors(by_sea))
        per_sector = materialize(slot_totals_from_rollup(rollup, days, by_sea=False),
                                 f"slot-totals-{name}")
        out[f"q2_{name}_cumulative"] = q2.q2_cumulative_rendered(per_sector, days)
    return out


def run_batch(spark: SparkSession, log: str, out_dir: str, source_tz: str = "UTC",
              slot_tz: str = "UTC", draught_compat: bool = False,
              text_log: bool = False) -> list[str]:
    """Ingest a raw or an already normalised log and write every report; returns the report
    names."""
    configure(spark)
    if text_log:
        positions = normalized.import_text_log(spark, log, f"{out_dir}/ingest")
    else:
        positions, _ = normalized.ingest(spark, log, f"{out_dir}/ingest", source_tz,
                                         draught_compat)
    written = reports(positions, slot_tz)
    for name, rows in written.items():
        sinks.write_lines(rows, f"{out_dir}/{name}")
    return list(written)
