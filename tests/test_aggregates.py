from pyspark.sql import functions as F

from conftest import at, plan_of, rows, shuffled_records
from tidegrid.constants import MONTH_DAYS, WEEK_DAYS
from tidegrid.operators import aggregates
from tidegrid.plans import q1
from tidegrid.sources import events, normalized

WEST = (40.0, 5.0)          # H11
SF = "/root/testdata/sf0.001"


def many(n, ts="2015-03-05 10:00", place=WEST, shiptype=70, first_id=0):
    return [(ts, *place, shiptype, first_id + i) for i in range(n)]


def test_weeks_start_on_thursday_utc(positions):
    p = positions(("2015-03-04 23:59", *WEST), ("2015-03-05 00:00", *WEST))
    starts = [r.window_start for r in q1.q1(p, WEEK_DAYS).orderBy("window_start").collect()]
    assert starts == [at("2015-02-26 00:00"), at("2015-03-05 00:00")]


def test_months_are_31_days_from_the_epoch(positions):
    p = positions(("2015-03-28 23:59", *WEST), ("2015-03-29 00:00", *WEST))
    starts = [r.window_start for r in q1.q1(p, MONTH_DAYS).orderBy("window_start").collect()]
    assert starts == [at("2015-02-26 00:00"), at("2015-03-29 00:00")]


def test_averages_drop_the_remainder(positions):
    def average(n, days):
        return q1.q1(positions(*many(n)), days).first().avg_70_79

    assert [average(n, WEEK_DAYS) for n in (6, 7, 13, 14)] == [0.0, 1.0, 1.0, 2.0]
    assert [average(n, MONTH_DAYS) for n in (30, 31)] == [0.0, 1.0]


def test_messages_count_not_ships(positions):
    p = positions(*[("2015-03-05 10:00", *WEST, 35, i, "same ship") for i in range(7)])
    assert q1.q1(p, WEEK_DAYS).first().avg_35 == 1.0


def test_classes_are_apart_and_complete(positions):
    rows_ = [r for i, t in enumerate((0, 34, 35, 36, 60, 65, 70, 79, 80, 99))
             for r in many(7, shiptype=t, first_id=10 * i)]
    r = q1.q1(positions(*rows_), WEEK_DAYS).first()
    assert (r.avg_35, r.avg_60_69, r.avg_70_79, r.avg_others) == (1.0, 2.0, 2.0, 5.0)


def test_only_the_western_area_counts(positions):
    p = positions(("2015-03-05 10:00", 36.0, 5.0), ("2015-03-05 10:00", 40.0, 15.0),
                  ("2015-03-05 10:00", 46.0, 5.0), ("2015-03-05 10:00", *WEST))
    assert rows(q1.q1(p, WEEK_DAYS), "sector") == [("H11",)]


def test_last_type_follows_time_then_id(positions):
    p = positions(("2015-03-05 10:00", *WEST, 1, 9), ("2015-03-06 10:00", *WEST, 2, 3),
                  ("2015-03-06 10:00", *WEST, 3, 4), ("2015-03-05 11:00", *WEST, 4, 99))
    assert q1.q1(p, WEEK_DAYS).first().last_shiptype == 3
    numbered = normalized.in_event_time_order(p, "event_id")
    assert q1.q1(numbered, WEEK_DAYS).first().last_shiptype == 3


def test_rendered_row(positions):
    r = q1.rendered(q1.q1(positions(*many(8, shiptype=99)), WEEK_DAYS)).first()
    assert tuple(r) == ("Thu Mar 05", 99, "H11", "35", 0.0, "60-69", 0.0, "70-79", 0.0,
                        "Others", 1.0)


def test_slot_counts_carry_the_last_record(positions):
    p = positions(("2015-03-05 11:59", *WEST, 70, 1, "a"), ("2015-03-05 12:00", *WEST, 70, 2, "b"),
                  ("2015-03-05 12:00", 40.1, 4.9, 70, 3, "c"))
    r = aggregates.slot_totals_with_last(p, WEEK_DAYS).first()
    assert (r.am, r.pm, r.last_ship_id, r.last_lat, r.last_lon, r.last_ts) == (
        1, 2, "c", 40.1, 4.9, at("2015-03-05 12:00"))


def test_rollup_gives_the_direct_results(spark):
    p = events.positions(spark, SF)
    rollup = aggregates.daily_rollup(p)
    for days in (WEEK_DAYS, MONTH_DAYS):
        assert rows(q1.q1_from_rollup(rollup, days)) == rows(q1.q1(p, days))
        for by_sea in (True, False):
            columns = ["window_start", "cell", *(["west"] if by_sea else []), "am", "pm"]
            assert (rows(aggregates.slot_totals_from_rollup(rollup, days, by_sea), *columns)
                    == rows(aggregates.slot_totals(p, days, by_sea), *columns))
        assert (rows(aggregates.slot_totals_from_rollup(rollup, days, False),
                     "window_start", "cell", "last_west")
                == rows(aggregates.slot_totals_with_sea(p, days),
                        "window_start", "cell", "last_west"))


def test_classes_sum_to_the_records(spark):
    p = events.positions(spark, SF)
    total = aggregates.class_totals(p, WEEK_DAYS).agg(
        sum(F.sum(c) for c in aggregates.CLASS_COLUMNS)).first()[0]
    western = p.transform(aggregates.within_area).transform(aggregates.western)
    assert total == western.count()


def test_plans_hash_aggregate_in_one_shuffle(spark, positions):
    plain = events.positions(spark, SF)
    numbered = normalized.in_event_time_order(positions(*many(3)), "event_id")
    for p in (plain, numbered.select("*")):
        own_shuffles = plan_of(p).count("Exchange ")
        for df in (q1.q1(p, WEEK_DAYS), aggregates.slot_totals(p, WEEK_DAYS, True),
                   aggregates.daily_rollup(p), aggregates.slot_totals_with_sea(p, WEEK_DAYS)):
            plan = plan_of(df)
            assert "SortAggregate" not in plan
            assert plan.count("Exchange ") == own_shuffles + 1


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    p = events.positions(spark, SF).withColumn("ts", F.col("ts").cast("timestamp"))
    ordered = normalized.in_event_time_order(p, "event_id")
    table = normalized.write_positions(ordered, str(tmp_path / "positions"))
    plan = plan_of(q1.q1(table, WEEK_DAYS))
    for pushed in ("GreaterThanOrEqual(lon,-6.0)", "LessThanOrEqual(lat,45.0)",
                   "GreaterThan(lat,37.2)", "LessThan(lon,11.2)"):
        assert pushed in plan
    schema = plan[plan.index("ReadSchema"):]
    assert "ship_id" not in schema and "event_id" not in schema
    day = plan_of(table.where(F.col("event_date") == "2024-01-05"))
    assert "PartitionFilters: [isnotnull(event_date" in day


def test_hot_sector_sends_few_rows_to_the_shuffle(positions):
    """However many rows a sector has, each task sends one partial row for it."""
    p = positions(*many(300), *[("2015-03-05 10:00", 38.1 + i % 6, 5.0) for i in range(600)])
    for df in (aggregates.slot_totals(p.coalesce(2), WEEK_DAYS, by_sea=False),
               q1.q1(p.coalesce(2), WEEK_DAYS), aggregates.daily_rollup(p.coalesce(2))):
        cells = df.count()
        assert shuffled_records(df) and max(shuffled_records(df)) <= 2 * cells
