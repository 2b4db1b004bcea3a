"""Arrival order as one number.

"Last record to arrive" is the largest (ts, arrival id). As a struct that pair cannot be
updated in place in an aggregation buffer, and Spark then sorts all input rows of every
task before aggregating. As one wide decimal it can, and the aggregation stays a hash
aggregation. The factor exceeds the whole span of a 64-bit id, so ids never spill into
the time part, whatever their sign.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_ID_SPAN = "CAST('20000000000000000000' AS DECIMAL(20,0))"


def arrival_key(ts: Column, arrival_id: Column) -> Column:
    micros = F.unix_micros(ts.cast("timestamp")).cast("decimal(18,0)")
    return (micros * F.expr(_ID_SPAN) + arrival_id).cast("decimal(38,0)")
