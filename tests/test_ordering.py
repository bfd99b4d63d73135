import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from corvane.operators.ordering import with_position
from corvane.sources.results import ResultStore


@pytest.mark.parametrize("n", [0, 1, 500])
def test_positions_are_those_of_one_sort(spark, tmp_path, n):
    rng = random.Random(n)
    # Half of the rows share a key, so the second column decides.
    rows = [(rng.choice([7, rng.randrange(100)]), i, None if i % 9 else "p") for i in range(n)]
    df = spark.createDataFrame(rows, "a int, position_of long, part string").repartition(7)
    got = with_position(df, [F.desc("a"), "position_of"], ResultStore(spark, str(tmp_path)), "ordered").collect()
    want = sorted(rows, key=lambda r: (-r[0], r[1]))
    assert [tuple(r)[:3] for r in sorted(got, key=lambda r: r["position"])] == want
    assert sorted(r["position"] for r in got) == list(range(1, n + 1))


def test_no_task_sorts_all(spark, tmp_path):
    df = spark.range(1000).select("id", (F.col("id") % 10).alias("k"))
    plan = plan_of(with_position(df, ["k", "id"], ResultStore(spark, str(tmp_path)), "ordered"))
    assert "Window" not in plan and "SinglePartition" not in plan
