"""Busiest-sector rankings over windowed slot counts.

The input is already aggregated: at most 401 sectors (the grid and the off-grid one) per
window and sea. Ties go to the smaller sector id. Sectors without a message in a slot
still count there with zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegrid.constants import SLOT_AM, SLOT_PM, TOP_N
from tidegrid.functions import cell_name, rank_list, sea_name


def _slots(am: Column, pm: Column) -> Column:
    return F.array(F.struct(F.lit(SLOT_AM).alias("slot"), am.alias("n")),
                   F.struct(F.lit(SLOT_PM).alias("slot"), pm.alias("n")))


def by_slot(slot_totals: DataFrame) -> DataFrame:
    """One row per (window, sector[, sea], slot), with sectors and seas named."""
    sea = [sea_name(F.col("west")).alias("sea")] if "west" in slot_totals.columns else []
    return (slot_totals
            .select("window_start",
                    cell_name(F.col("cell")).alias("sector"), *sea,
                    F.explode(_slots(F.col("am"), F.col("pm"))).alias("s"))
            .select("window_start", "sector", *(["sea"] if sea else []), "s.slot", "s.n"))


def _top(rows: DataFrame, keys: list[str], score: str, top_n: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), "sector")
    return (rows.withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= top_n)
            .select(*keys, "rank", "sector", score))


def top_sectors(slot_totals: DataFrame, top_n: int = TOP_N) -> DataFrame:
    """The busiest sectors per window, sea and slot."""
    return _top(by_slot(slot_totals), ["window_start", "sea", "slot"], "n", top_n)


def top_sectors_by_list(slot_totals: DataFrame, top_n: int = TOP_N) -> DataFrame:
    """Same rows as ``top_sectors`` for a stream, by a second aggregation, because streams
    do not support window functions. A list holds one entry per sector of the grid."""
    sector = cell_name(F.col("cell"))

    def best(n: str, slot: str) -> Column:
        entries = F.collect_list(F.struct((-F.col(n)).alias("neg"), sector.alias("sector")))
        ranked = F.slice(F.array_sort(entries), 1, top_n)
        return F.transform(ranked, lambda e, i: F.struct(
            F.lit(slot).alias("slot"), (i + 1).alias("rank"),
            e["sector"].alias("sector"), (-e["neg"]).alias("n")))

    return (slot_totals.groupBy("window", "west")
            .agg(F.concat(best("am", SLOT_AM), best("pm", SLOT_PM)).alias("best"))
            .select(F.col("window.start").alias("window_start"),
                    sea_name(F.col("west")).alias("sea"), F.inline("best")))


def _sectors_in_rank_order(entry: Column) -> Column:
    return rank_list(F.array_sort(F.collect_list(entry))["sector"])


def rank_lists(ranked: DataFrame, keys: list[str]) -> DataFrame:
    """Both slots of a window side by side, each as a rendered list such as ``{I34, D20}``."""
    def in_slot(slot: str) -> Column:
        # collect_list skips the nulls that stand for the other slot
        return _sectors_in_rank_order(
            F.when(F.col("slot") == slot, F.struct("rank", "sector")))

    return (ranked.groupBy(*keys)
            .agg(in_slot(SLOT_AM).alias("rank_a"), in_slot(SLOT_PM).alias("rank_p")))


def changed_lists(ranked: DataFrame) -> DataFrame:
    """The rank lists of those windows in which either differs from the window before."""
    per_slot = ranked.groupBy("window_start", "slot").agg(
        _sectors_in_rank_order(F.struct("rank", "sector")).alias("list"))
    before = F.lag("list").over(Window.partitionBy("slot").orderBy("window_start"))
    compared = per_slot.withColumn("changed", ~F.col("list").eqNullSafe(before))

    def in_slot(slot: str) -> Column:
        return F.max(F.when(F.col("slot") == slot, F.col("list")))

    return (compared.groupBy("window_start")
            .agg(in_slot(SLOT_AM).alias("rank_a"), in_slot(SLOT_PM).alias("rank_p"),
                 F.bool_or("changed").alias("changed"))
            .where("changed").drop("changed"))


def cumulative_scores(slot_totals: DataFrame, days: int) -> DataFrame:
    """Score of every sector seen so far, in every window that has data.

    A score adds up the *distinct* counts a sector had in its windows so far, per slot:
    equal counts in two windows count once. Sectors that fall silent keep their score.

    ``slot_totals`` is read more than once, so pass a stored table.
    """
    rows = by_slot(slot_totals).repartition("sector", "slot")
    same_count = Window.partitionBy("sector", "slot", "n").orderBy("window_start")
    so_far = Window.partitionBy("sector", "slot").orderBy("window_start")
    step = F.expr(f"INTERVAL '{days}' DAY")
    last_window = slot_totals.agg(F.max("window_start")).scalar()
    scored = (rows
              .withColumn("gain", F.when(F.row_number().over(same_count) == 1, F.col("n"))
                                   .otherwise(F.lit(0)))
              .withColumn("score", F.sum("gain").over(so_far))
              .withColumn("until", F.coalesce(F.lead("window_start").over(so_far) - step,
                                              last_window)))
    carried = scored.select(
        F.explode(F.sequence("window_start", "until", step)).alias("window_start"),
        "sector", "slot", "score")
    with_data = slot_totals.select("window_start").distinct()
    return carried.join(with_data, "window_start", "left_semi")


def cumulative_top(slot_totals: DataFrame, days: int, suppress_first: bool = True,
                   top_n: int = TOP_N) -> DataFrame:
    """The sectors with the highest score so far, per window and slot; the first window of
    the data gives no output unless ``suppress_first`` is off."""
    scores = cumulative_scores(slot_totals, days)
    if suppress_first:
        first_window = slot_totals.agg(F.min("window_start")).scalar()
        scores = scores.where(F.col("window_start") > first_window)
    return _top(scores, ["window_start", "slot"], "score", top_n)


def emissions(slot_totals: DataFrame, days: int, suppress_first: bool = True,
              top_n: int = TOP_N) -> DataFrame:
    """The cumulative ranking as it changes while the sectors of a window report in turn.

    Sectors report in the order of their ids. After each report the ranking uses the new
    scores of those that have reported in this window and the old scores of all others. A
    row comes out when its sea (that of the reporting sector's last record) or its lists
    differ from the row before; a new window always differs, for its label is in the row.

    A window is one row that holds its sectors as a list, 401 entries at most.
    """
    scores = cumulative_scores(slot_totals, days)
    before = Window.partitionBy("sector", "slot").orderBy("window_start")
    scores = scores.withColumn("old", F.lag("score").over(before))

    def in_slot(column: str, slot: str) -> Column:
        return F.max(F.when(F.col("slot") == slot, F.col(column))).alias(f"{column}_{slot[:2]}")

    slots = (SLOT_AM, SLOT_PM)
    sectors = scores.groupBy("window_start", "sector").agg(
        *[in_slot(c, s) for c in ("old", "score") for s in slots])
    reports = slot_totals.select("window_start", cell_name(F.col("cell")).alias("sector"),
                                 sea_name(F.col("last_west")).alias("sea"))
    windows = (sectors.join(reports, ["window_start", "sector"], "left")
               .groupBy("window_start")
               .agg(F.array_sort(F.collect_list(F.struct(
                   "sector", "sea", *[f"{c}_{s[:2]}" for c in ("old", "score") for s in slots]
               ))).alias("cells")))

    def ranking(step: Column, slot: str) -> Column:
        def entry(cell: Column) -> Column:
            reported = cell["sea"].isNotNull() & (cell["sector"] <= step["sector"])
            score = F.when(reported, cell[f"score_{slot[:2]}"]).otherwise(cell[f"old_{slot[:2]}"])
            return F.struct((-score).alias("neg"), cell["sector"].alias("sector"))

        entries = F.filter(F.transform("cells", entry), lambda e: e["neg"].isNotNull())
        return rank_list(F.slice(F.array_sort(entries), 1, top_n)["sector"])

    steps = F.transform(
        F.filter("cells", lambda c: c["sea"].isNotNull()),
        lambda c: F.struct(c["sector"].alias("sector"), c["sea"].alias("sea"),
                           ranking(c, SLOT_AM).alias("rank_a"),
                           ranking(c, SLOT_PM).alias("rank_p")))
    if suppress_first:
        first_window = slot_totals.agg(F.min("window_start")).scalar()
        windows = windows.where(F.col("window_start") > first_window)
    row = F.struct("sea", "rank_a", "rank_p")
    reported = Window.partitionBy("window_start").orderBy("sector")
    return (windows.select("window_start", F.inline(steps))
            .withColumn("before", F.lag(row).over(reported))
            .where(~row.eqNullSafe(F.col("before")))
            .drop("before"))
