import random

from pyspark.sql import functions as F

from conftest import at, in_order, rows
from tidegrid.constants import SLOT_AM, SLOT_PM, WEEK_DAYS
from tidegrid.functions import cell_name
from tidegrid.operators import ranking
from tidegrid.plans import q2
from tidegrid.session import materialize

WEEKS = [at(f"2015-{d} 00:00") for d in ("03-05", "03-12", "03-19", "03-26", "04-02")]


def totals(spark, *rows_):
    """Slot totals from (week number, cell, am, pm[, last_west])."""
    full = [(WEEKS[w], cell, am, pm, bool(rest and rest[0])) for w, cell, am, pm, *rest in rows_]
    df = spark.createDataFrame(
        full, "window_start timestamp, cell int, am bigint, pm bigint, last_west boolean")
    return materialize(df, "test-totals")


def name(cell):
    return "Error!" if cell < 0 else "ABCDEFGHIJ"[cell // 40] + str(cell % 40 + 1)


def by_sea(df):
    return df.withColumnRenamed("last_west", "west")


def test_top_three_with_ties_by_sector_id(spark):
    t = by_sea(totals(spark, (0, 1, 5, 0), (0, 9, 5, 1), (0, 2, 5, 2), (0, 3, 9, 3)))
    am = ranking.top_sectors(t).where(F.col("slot") == SLOT_AM)
    assert rows(am, "rank", "sector", "n") == [(1, "A4", 9), (2, "A10", 5), (3, "A2", 5)]


def test_zero_counts_rank_when_few_sectors(spark):
    t = by_sea(totals(spark, (0, 1, 0, 4), (0, 2, 3, 0)))
    top = ranking.top_sectors(t)
    assert rows(top.where(F.col("slot") == SLOT_AM), "rank", "sector", "n") == [
        (1, "A3", 3), (2, "A2", 0)]
    assert rows(top.where(F.col("slot") == SLOT_PM), "rank", "sector", "n") == [
        (1, "A2", 4), (2, "A3", 0)]


def test_seas_rank_apart(spark):
    t = by_sea(totals(spark, (0, 1, 1, 1, True), (0, 2, 2, 2, False)))
    rendered = q2.q2_rendered(ranking.top_sectors(t))
    assert rows(rendered) == [
        ("Thu Mar 05", "Occidentale", SLOT_AM, "{A2}", SLOT_PM, "{A2}"),
        ("Thu Mar 05", "Orientale", SLOT_AM, "{A3}", SLOT_PM, "{A3}")]


def test_equal_counts_score_once(spark):
    t = totals(spark, (0, 1, 5, 0), (1, 1, 5, 0), (2, 1, 8, 0))
    scores = ranking.cumulative_scores(t, WEEK_DAYS).where(F.col("slot") == SLOT_AM)
    assert rows(scores, "window_start", "score") == [
        (WEEKS[0], 5), (WEEKS[1], 5), (WEEKS[2], 13)]


def test_silent_sectors_keep_their_score_and_gaps_stay_out(spark):
    t = totals(spark, (0, 1, 9, 0), (1, 2, 4, 0), (3, 2, 1, 0))
    top = ranking.cumulative_top(t, WEEK_DAYS).where(F.col("slot") == SLOT_AM)
    assert rows(top, "window_start", "rank", "sector", "score") == [
        (WEEKS[1], 1, "A2", 9), (WEEKS[1], 2, "A3", 4),
        (WEEKS[3], 1, "A2", 9), (WEEKS[3], 2, "A3", 5)]


def test_first_window_can_be_kept(spark):
    t = totals(spark, (0, 1, 9, 0), (1, 2, 4, 0))
    kept = ranking.cumulative_top(t, WEEK_DAYS, suppress_first=False)
    assert kept.agg(F.min("window_start")).first()[0] == WEEKS[0]


def test_changelog_reports_changes_only(spark):
    t = totals(spark, (0, 1, 9, 9), (1, 2, 4, 4), (2, 2, 1, 1), (3, 2, 8, 8))
    assert rows(q2.q2_changelog(t, WEEK_DAYS)) == [
        (WEEKS[1], "{A2, A3}", "{A2, A3}"), (WEEKS[3], "{A3, A2}", "{A3, A2}")]


def brute_force_emissions(table):
    """Sector by sector, with sets of counts, as the definition says it."""
    am, pm, out, last = {}, {}, [], None
    for w in sorted({r[0] for r in table}):
        for _, cell, a, p, west in sorted((r for r in table if r[0] == w),
                                          key=lambda r: name(r[1])):
            am.setdefault(cell, set()).add(a)
            pm.setdefault(cell, set()).add(p)
            if w == min(r[0] for r in table):
                continue
            lists = []
            for counts in (am, pm):
                best = sorted(counts, key=lambda c: (-sum(counts[c]), name(c)))[:3]
                lists.append("{" + ", ".join(map(name, best)) + "}")
            row = (WEEKS[w], "Occidentale" if west else "Orientale", *lists)
            if row != last:
                out.append((WEEKS[w], name(cell), *row[1:]))
            last = row
    return in_order(out)


def test_emissions_and_cumulative_match_brute_force(spark):
    rng = random.Random(7)
    table = [(w, cell, rng.randint(0, 4), rng.randint(0, 4), rng.random() < 0.5)
             for w in (0, 1, 2, 4) for cell in (-1, 3, 4, 50, 90, 120) if rng.random() < 0.7]
    t = totals(spark, *table)
    assert rows(q2.q2_emissions(t, WEEK_DAYS)) == brute_force_emissions(table)

    expected = []
    for w in sorted({r[0] for r in table})[1:]:
        for slot, i in ((SLOT_AM, 2), (SLOT_PM, 3)):
            scores = {}
            for r in table:
                if r[0] <= w:
                    scores.setdefault(name(r[1]), set()).add(r[i])
            best = sorted(scores, key=lambda s: (-sum(scores[s]), s))[:3]
            expected += [(WEEKS[w], slot, k + 1, s, sum(scores[s])) for k, s in enumerate(best)]
    assert rows(q2.q2_cumulative(t, WEEK_DAYS)) == in_order(expected)


def test_names_of_all_cells(spark):
    df = spark.range(-1, 400).select(F.col("id").cast("int").alias("cell"))
    assert ([r[0] for r in df.orderBy("cell").select(cell_name(F.col("cell"))).collect()]
            == [name(c) for c in range(-1, 400)])
