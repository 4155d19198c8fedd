"""Steps that operators write on the way."""

from pathlib import Path

import pytest

from feedworks.llm import common
from feedworks.llm.buckets import bucketed


def test_steps_go_with_their_scope(spark):
    kept = common.written(spark.range(5), "kept")
    before = len(common._steps[spark.sparkContext.applicationId])
    with common.steps_removed(spark):
        step = common.written(kept.selectExpr("id * 2 AS id"), "step")
        inside = [Path(common._steps[spark.sparkContext.applicationId][-1].removeprefix("file:"))]
        with common.steps_removed(spark):
            table = bucketed(step, "inner", "id")
            assert table.count() == 5
            inside.append(Path(common._steps[spark.sparkContext.applicationId][-1].removeprefix("file:")))
        assert not inside[1].exists() and inside[0].exists() and step.count() == 5
    assert not inside[0].exists()
    assert kept.count() == 5 and len(common._steps[spark.sparkContext.applicationId]) == before


def test_steps_go_when_what_needs_them_fails(spark):
    with pytest.raises(RuntimeError, match="stop"), common.steps_removed(spark):
        common.written(spark.range(5), "step")
        place = Path(common._steps[spark.sparkContext.applicationId][-1].removeprefix("file:"))
        raise RuntimeError("stop")
    assert not place.exists()


def test_buckets_are_joined_without_a_shuffle(spark):
    with common.steps_removed(spark):
        one, two = (bucketed(spark.range(1000).withColumn(c, common.F.col("id") % 7), c, "id") for c in "ab")
        both = one.join(two.hint("merge"), "id")
        assert both.count() == 1000
        assert "Exchange hashpartitioning" not in both._jdf.queryExecution().executedPlan().toString()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("feedworks_")]
