"""The same queries as SQL for a second engine, written independently of the Spark plans:
sectors by counting decimal edges, rankings by joining each window with all before it."""

from __future__ import annotations

from tidegrid.constants import MONTH_DAYS, WEEK_DAYS

POSITIONS = """
SELECT event_id, CAST(user_id AS VARCHAR) AS ship_id, ts, value, event_type,
  CAST(json_extract_string(props, '$.k') AS INT) AS shiptype,
  CAST(([3614,3957,4330,4390,3680,3590,4085,3795,3125,3465,4490,3700])[user_id % 12 + 1]
       + (event_id % 7) * 3 - 9 AS DOUBLE) / 100 AS lat,
  CAST(([-535,265,530,890,1510,1450,2930,2360,3230,3300,1230,3695])[user_id % 12 + 1]
       + (event_id % 11) * 5 - 25 AS DOUBLE) / 100 AS lon
FROM events"""

SECTORS = """
SELECT *,
  CASE WHEN latd > 44.0 OR lond > 36.9 THEN 'Error!' ELSE
    substr('ABCDEFGHIJ', least(len(list_filter(range(0, 11),
      lambda k: CAST(32.0 + 1.2 * k AS DECIMAL(20,12)) < latd)), 9) + 1, 1)
    || CAST(len(list_filter(range(0, 40),
      lambda k: CAST(-6.0 + 1.1 * k AS DECIMAL(20,12)) < lond)) + 1 AS VARCHAR) END AS sector,
  CASE WHEN lat > 37.2 AND lon < 11.2 THEN 'Occidentale' ELSE 'Orientale' END AS sea
FROM (SELECT *, CAST(lat AS DECIMAL(20,12)) AS latd, CAST(lon AS DECIMAL(20,12)) AS lond
      FROM p)"""

AREA = "lon BETWEEN -6.0 AND 37.0 AND lat BETWEEN 32.0 AND 45.0"

BASE = f"WITH p AS ({POSITIONS}), s AS ({SECTORS}), b AS (SELECT * FROM s WHERE {AREA})"


def bucket(days: int, ts: str = "ts") -> str:
    return f"time_bucket(INTERVAL {days} DAY, {ts}, TIMESTAMP '1970-01-01')"


def label(ts: str) -> str:
    return f"strftime({ts}, '%a %b %d')"


def window_counts(days: int, where: str = "TRUE") -> str:
    return f"""{BASE}
SELECT {bucket(days)} AS window_start, sector, count(*) AS n
FROM b WHERE {where} GROUP BY ALL"""


CLASS_COUNTS = """
  count(*) FILTER (shiptype = 35) AS n_35,
  count(*) FILTER (shiptype BETWEEN 60 AND 69) AS n_60_69,
  count(*) FILTER (shiptype BETWEEN 70 AND 79) AS n_70_79,
  count(*) FILTER (NOT (shiptype = 35 OR shiptype BETWEEN 60 AND 79)) AS n_others"""

SLOT_COUNTS = """
  count(*) FILTER (hour(ts) < 12) AS am, count(*) FILTER (hour(ts) >= 12) AS pm"""

DAILY_ROLLUP = f"""{BASE}
SELECT date_trunc('day', ts)::TIMESTAMP AS day, sector, sea, {CLASS_COUNTS}, {SLOT_COUNTS},
  arg_max(shiptype, (ts, event_id)) AS last_shiptype
FROM b GROUP BY ALL"""


def q1_with(days: int) -> str:
    return f"""{BASE}, c AS (
  SELECT {bucket(days)} AS window_start, sector, {CLASS_COUNTS},
    arg_max(shiptype, (ts, event_id)) AS last_shiptype
  FROM b WHERE sea = 'Occidentale' GROUP BY ALL),
q AS (SELECT window_start, sector,
  CAST(n_35 // {days} AS DOUBLE) AS avg_35, CAST(n_60_69 // {days} AS DOUBLE) AS avg_60_69,
  CAST(n_70_79 // {days} AS DOUBLE) AS avg_70_79,
  CAST(n_others // {days} AS DOUBLE) AS avg_others, last_shiptype FROM c)"""


def q1(days: int) -> str:
    return f"{q1_with(days)} SELECT * FROM q"


def q1_rendered(days: int) -> str:
    return f"""{q1_with(days)}
SELECT {label('window_start')} AS date, last_shiptype AS stype, sector AS id_cella,
  '35' AS stype_35, avg_35, '60-69' AS stype_6069, avg_60_69 AS avg_6069,
  '70-79' AS stype_7079, avg_70_79 AS avg_7079, 'Others' AS stype_others, avg_others
FROM q"""


def slot_counts(days: int) -> str:
    return f"""{BASE}
SELECT {bucket(days)} AS window_start, sector,
  count(*) FILTER (hour(ts) < 12) AS am_num, count(*) FILTER (hour(ts) >= 12) AS pm_num,
  arg_max(ship_id, (ts, event_id)) AS last_ship_id, arg_max(lat, (ts, event_id)) AS last_lat,
  arg_max(lon, (ts, event_id)) AS last_lon, max(ts) AS last_ts
FROM b GROUP BY ALL"""


def top3_with(days: int) -> str:
    return f"""{BASE}, c AS (
  SELECT {bucket(days)} AS window_start, sea, sector, {SLOT_COUNTS} FROM b GROUP BY ALL),
l AS (SELECT window_start, sea, sector, '00:00-11:59' AS slot, am AS n FROM c
      UNION ALL SELECT window_start, sea, sector, '12:00-23:59', pm FROM c),
t AS (SELECT window_start, sea, slot, CAST(row_number() OVER (
        PARTITION BY window_start, sea, slot ORDER BY n DESC, sector) AS INT) AS rank,
      sector, n FROM l QUALIFY rank <= 3)"""


def top3(days: int) -> str:
    return f"{top3_with(days)} SELECT * FROM t"


def lists(key: str) -> str:
    return f"""
  '{{' || string_agg(sector, ', ' ORDER BY rank) FILTER ({key} = '00:00-11:59') || '}}' AS rank_a,
  '{{' || string_agg(sector, ', ' ORDER BY rank) FILTER ({key} = '12:00-23:59') || '}}' AS rank_p"""


def q2_rendered(days: int) -> str:
    return f"""{top3_with(days)}
SELECT {label('window_start')} AS ts, sea, '00:00-11:59' AS slot_a,
  '12:00-23:59' AS slot_p, {lists('slot')}
FROM t GROUP BY window_start, sea"""


def cumulative_with(days: int) -> str:
    return f"""{BASE}, c AS (
  SELECT {bucket(days)} AS w, sector, {SLOT_COUNTS} FROM b GROUP BY ALL),
l AS (SELECT w, sector, '00:00-11:59' AS slot, am AS n FROM c
      UNION ALL SELECT w, sector, '12:00-23:59', pm FROM c),
x AS (SELECT v.w AS window_start, slot, sector, sum(DISTINCT n)::BIGINT AS score
      FROM (SELECT DISTINCT w FROM c) v JOIN l ON l.w <= v.w GROUP BY ALL),
t AS (SELECT window_start, slot, CAST(row_number() OVER (
        PARTITION BY window_start, slot ORDER BY score DESC, sector) AS INT) AS rank,
      sector, score FROM x WHERE window_start > (SELECT min(w) FROM c) QUALIFY rank <= 3)"""


def cumulative(days: int) -> str:
    return f"{cumulative_with(days)} SELECT * FROM t"


def changelog(days: int) -> str:
    return f"""{cumulative_with(days)},
r AS (SELECT window_start, {lists('slot')} FROM t GROUP BY window_start),
d AS (SELECT *, lag((rank_a, rank_p)) OVER (ORDER BY window_start) AS before FROM r)
SELECT window_start, rank_a, rank_p FROM d WHERE (rank_a, rank_p) IS DISTINCT FROM before"""


def cumulative_rendered(days: int) -> str:
    return f"""{cumulative_with(days)},
r AS (SELECT window_start, {lists('slot')} FROM t GROUP BY window_start),
e AS (SELECT {bucket(days)} AS window_start, arg_max(sea, (ts, event_id)) AS sea FROM b GROUP BY ALL)
SELECT {label('window_start')} AS ts, sea, '00:00-11:59' AS slot_a, rank_a,
  '12:00-23:59' AS slot_p, rank_p FROM r JOIN e USING (window_start)"""


# A window closes when the watermark, 60 s behind the latest record of any place, reaches its end.
WATERMARK_ALL = f"""{BASE}
SELECT {bucket(WEEK_DAYS)} AS window_start, sector, count(*) AS n FROM b
WHERE {bucket(WEEK_DAYS)} + INTERVAL {WEEK_DAYS} DAY <= (SELECT max(ts) - INTERVAL 60 SECOND FROM p)
GROUP BY ALL"""

LATE_MIXED = f"""{BASE}
SELECT {bucket(WEEK_DAYS)} AS window_start, sector, count(*) AS n FROM b
WHERE {bucket(WEEK_DAYS)} + INTERVAL {WEEK_DAYS} DAY
  > (SELECT max(ts) - INTERVAL 60 SECOND FROM p WHERE NOT ({AREA}))
GROUP BY ALL"""


LATE_ROWS = f"""{BASE}, w AS (
  SELECT max(ts) - INTERVAL 60 SECOND AS watermark FROM p
  WHERE CAST(ts AS DATE) > (SELECT min(CAST(ts AS DATE)) FROM p))
SELECT ship_id, ts, shiptype, lat, lon, watermark FROM p, w
WHERE CAST(ts AS DATE) = (SELECT min(CAST(ts AS DATE)) FROM p)
  AND {bucket(WEEK_DAYS)} + INTERVAL {WEEK_DAYS} DAY <= watermark"""


def emissions(days: int) -> str:
    return f"""{BASE}, c AS (
  SELECT {bucket(days)} AS w, sector, {SLOT_COUNTS}, arg_max(sea, (ts, event_id)) AS sea
  FROM b GROUP BY ALL),
l AS (SELECT w, sector, '00:00-11:59' AS slot, am AS n FROM c
      UNION ALL SELECT w, sector, '12:00-23:59', pm FROM c),
x AS (SELECT c.w, c.sector AS reporter, c.sea, l.slot, l.sector, sum(DISTINCT l.n) AS score
      FROM c JOIN l ON l.w < c.w OR (l.w = c.w AND l.sector <= c.sector)
      WHERE c.w > (SELECT min(w) FROM c) GROUP BY ALL),
t AS (SELECT *, row_number() OVER (
        PARTITION BY w, reporter, slot ORDER BY score DESC, sector) AS rank
      FROM x QUALIFY rank <= 3),
r AS (SELECT w AS window_start, reporter, sea, {lists('slot')} FROM t GROUP BY ALL),
d AS (SELECT *, lag((sea, rank_a, rank_p)) OVER (
        PARTITION BY window_start ORDER BY reporter) AS before FROM r)
SELECT window_start, reporter AS sector, sea, rank_a, rank_p FROM d
WHERE (sea, rank_a, rank_p) IS DISTINCT FROM before"""


INGESTED = f"""WITH p AS ({POSITIONS})
SELECT ship_id, shiptype, value AS speed, lon, lat, CAST(event_id % 360 AS INT) AS course,
  CAST(CASE WHEN event_id % 5 = 0 THEN 0 ELSE event_id % 359 END AS INT) AS heading,
  date_trunc('minute', ts) AS ts, upper(event_type) || ' X' AS departure_port_name,
  CAST(CASE WHEN event_id % 4 > 1 THEN event_id % 120 ELSE 0 END AS INT) AS reported_draught,
  CAST(event_id AS VARCHAR) AS trip_id
FROM p WHERE event_id % 97 <> 0"""

EVENT_ORDER = """SELECT CAST(event_id AS VARCHAR) AS trip_id,
  date_trunc('minute', ts) AS ts,
  row_number() OVER (ORDER BY date_trunc('minute', ts), event_id) - 1 AS replay_seq
FROM events WHERE event_id % 97 <> 0"""

ORACLES: dict[str, str] = {
    "ingest_csv": INGESTED,
    "ingest_timestamps": """SELECT CAST(event_id AS VARCHAR) AS trip_id,
  date_trunc('minute', ts) AS ts FROM events""",
    "ingest_defaults": """SELECT CAST(event_id AS VARCHAR) AS trip_id,
  CAST(CASE WHEN event_id % 5 = 0 THEN 0 ELSE event_id % 359 END AS INT) AS heading,
  CAST(CASE WHEN event_id % 4 > 1 THEN event_id % 120 ELSE 0 END AS INT) AS draught,
  0 AS draught_compat FROM events""",
    "ingest_rejects": """SELECT CAST(event_id AS VARCHAR) AS trip_id,
  'shiptype' AS reject_reason FROM events WHERE event_id % 97 = 0""",
    "event_time_topn": f"""{BASE} SELECT event_id, ts, ship_id FROM p
ORDER BY ts, event_id LIMIT 100""",
    "event_time_order": EVENT_ORDER,
    "ingest_incremental": EVENT_ORDER,
    "text_log_roundtrip": INGESTED,
    "bbox_filter": f"{BASE} SELECT event_id, lat, lon FROM p WHERE {AREA}",
    "clustered_bbox_filter": f"{BASE} SELECT event_id, lat, lon FROM p WHERE {AREA}",
    "clustered_sector_filter": f"{BASE} SELECT event_id, lat, lon FROM s WHERE sector = 'E2'",
    "sea_west_filter": f"{BASE} SELECT event_id, lat, lon FROM p WHERE lat > 37.2 AND lon < 11.2",
    "sea_east_filter": f"{BASE} SELECT event_id, lat, lon FROM p WHERE lat < 37.2 AND lon > 11.2",
    "sea_label": f"{BASE} SELECT event_id, sea FROM s",
    "sector_assign": f"{BASE} SELECT event_id, lat, lon, sector FROM s",
    "shiptype_class": f"""{BASE} SELECT event_id, shiptype, CASE WHEN shiptype = 35 THEN '35'
  WHEN shiptype BETWEEN 60 AND 69 THEN '60-69' WHEN shiptype BETWEEN 70 AND 79 THEN '70-79'
  ELSE 'Others' END AS ship_class FROM p""",
    "day_slot": """SELECT event_id, ts,
  CASE WHEN hour(ts) < 12 THEN '00:00-11:59' ELSE '12:00-23:59' END AS slot FROM events""",
    "window_label": f"""SELECT event_id, {label(bucket(7))} AS week_label,
  {label(bucket(31))} AS month_label FROM events""",
    "window_week_counts": window_counts(WEEK_DAYS),
    "window_month_counts": window_counts(MONTH_DAYS),
    "last_arrival_type": f"""{q1_with(WEEK_DAYS)}
SELECT window_start, sector, last_shiptype FROM q""",
    "daily_rollup": DAILY_ROLLUP,
    "q1_week": q1(WEEK_DAYS),
    "q1_month": q1(MONTH_DAYS),
    "q1_week_rendered": q1_rendered(WEEK_DAYS),
    "q1_month_rendered": q1_rendered(MONTH_DAYS),
    "q1_week_by_rollup": q1(WEEK_DAYS),
    "q1_month_by_rollup": q1(MONTH_DAYS),
    "slot_counts_week": slot_counts(WEEK_DAYS),
    "slot_counts_month": slot_counts(MONTH_DAYS),
    "q2_week_top3": top3(WEEK_DAYS),
    "q2_month_top3": top3(MONTH_DAYS),
    "q2_week_by_rollup": top3(WEEK_DAYS),
    "q2_month_by_rollup": top3(MONTH_DAYS),
    "q2_week_rendered": q2_rendered(WEEK_DAYS),
    "q2_month_rendered": q2_rendered(MONTH_DAYS),
    "q2_cumulative_week": cumulative(WEEK_DAYS),
    "q2_cumulative_month": cumulative(MONTH_DAYS),
    "q2_cumulative_week_rendered": cumulative_rendered(WEEK_DAYS),
    "q2_cumulative_month_rendered": cumulative_rendered(MONTH_DAYS),
    "stream_watermark_all_rows": WATERMARK_ALL,
    "stream_late_drop_mixed": LATE_MIXED,
    "q2_changelog_week": changelog(WEEK_DAYS),
    "q2_changelog_month": changelog(MONTH_DAYS),
    "q2_emissions_week": emissions(WEEK_DAYS),
    "q2_emissions_month": emissions(MONTH_DAYS),
    "stream_q1_week": q1(WEEK_DAYS),
    "stream_q1_month": q1(MONTH_DAYS),
    "stream_q1_week_open_end": q1(WEEK_DAYS),
    "stream_q1_month_open_end": q1(MONTH_DAYS),
    "stream_q2_week_top3": top3(WEEK_DAYS),
    "stream_q2_month_top3": top3(MONTH_DAYS),
    "stream_q2_changelog": changelog(WEEK_DAYS),
    "stream_q2_changelog_month": changelog(MONTH_DAYS),
    "stream_q2_emissions": emissions(WEEK_DAYS),
    "stream_q2_emissions_month": emissions(MONTH_DAYS),
    "stream_fanout_q1_week": q1_rendered(WEEK_DAYS),
    "stream_fanout_q1_month": q1_rendered(MONTH_DAYS),
    "stream_fanout_q2_week": q2_rendered(WEEK_DAYS),
    "stream_fanout_q2_month": q2_rendered(MONTH_DAYS),
    "stream_fanout_q2_cumulative_week": cumulative_rendered(WEEK_DAYS),
    "stream_fanout_q2_cumulative_month": cumulative_rendered(MONTH_DAYS),
    "stream_q2_cumulative_rendered_week": cumulative_rendered(WEEK_DAYS),
    "stream_q2_cumulative_rendered_month": cumulative_rendered(MONTH_DAYS),
    "stream_late_drop": window_counts(
        WEEK_DAYS, "CAST(ts AS DATE) > (SELECT min(CAST(ts AS DATE)) FROM p)"),
    "stream_late_rows": LATE_ROWS,
    "stream_counts": """SELECT 'feed_records' AS name, count(*) + 1 AS n FROM events
UNION ALL SELECT 'late', 0""",
    "stream_csv_sink": q1_rendered(WEEK_DAYS),
    "sink_csv_roundtrip": q1_rendered(WEEK_DAYS),
    "sink_csv_roundtrip_q2": q2_rendered(WEEK_DAYS),
    "observe_counts": f"""{BASE} SELECT 'all' AS stage, count(*) AS records FROM p
UNION ALL SELECT 'in_area', count(*) FROM b
UNION ALL SELECT 'western', count(*) FROM b WHERE sea = 'Occidentale'""",
}
