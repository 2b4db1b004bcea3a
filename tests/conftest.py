import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidegrid.schema import POSITION_SCHEMA  # noqa: E402
from tidegrid.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", {
        "spark.checkpoint.dir": tmp_path_factory.mktemp("shared").as_uri(),
        "spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g", "spark.sql.maxMetadataStringLength": "2000"})
    session.sparkContext.setLogLevel("ERROR")
    return session


def at(text: str) -> dt.datetime:
    return dt.datetime.strptime(text, "%Y-%m-%d %H:%M")


@pytest.fixture
def positions(spark):
    """Positions from (ts, lat, lon[, shiptype[, event_id[, ship_id]]]) tuples."""
    def make(*rows):
        full = []
        for i, row in enumerate(rows):
            ts, lat, lon, *rest = row
            shiptype, event_id, ship_id = (*rest, *(70, i, f"ship{i}")[len(rest):])
            full.append((event_id, ship_id, at(ts), shiptype, float(lat), float(lon)))
        return spark.createDataFrame(full, POSITION_SCHEMA)
    return make


def in_order(tuples):
    return sorted(tuples, key=lambda r: tuple(map(str, r)))


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    found = df.select(*columns) if columns else df
    return in_order(tuple(r) for r in found.collect())


def plan_of(df) -> str:
    simple = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    return df._jdf.queryExecution().explainString(simple)


def shuffled_records(df) -> list[int]:
    """Records that each shuffle of an executed frame wrote."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            if name == "ShuffleExchangeExec":
                found.append(node.metrics().apply("shuffleRecordsWritten").value())
            children = node.children()
            todo.extend(children.apply(i) for i in range(children.size()))
    return found
