"""The code that Spark generates for the registered queries stays small enough to be compiled."""

from __future__ import annotations

import re

import pytest

from aerolake.plans.register import QUERIES
from aerolake.session import HUGE_METHOD


@pytest.fixture(scope="module")
def plans(spark):
    """Physical plans as they are before adaptive execution, which hides their stages."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield {name: build(spark, "/root/testdata/sf0.001")._jdf.queryExecution() for name, build in QUERIES.items()}
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def methods(execution) -> list[int]:
    stages = execution.debug().codegenToSeq()
    return [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_generated_method_is_too_large_to_compile(spark, plans, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    assert max(methods(plans[name]), default=0) < HUGE_METHOD


@pytest.mark.parametrize("name", ["silver_legs", "obt_legs", "obt_enriched", "fact_legs", "recovery_profile", "status_profile"])
def test_each_time_is_read_once(plans, name):
    """One cast for each column of text, none of them repeated below by a filter or a join."""
    plan = plans[name].executedPlan().toString()
    reads = re.findall(r"try_cast\((\w+)#\d+ as timestamp\)", plan)
    assert reads and len(reads) == len(set(reads))
    assert "RLIKE" not in plan
