from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cardex.operators import costs
from cardex.schemas import JOB_RUNS

START = datetime(2024, 1, 1)
NOW = datetime(2024, 1, 1, 5)


def run(name, start, end, *sizes):
    return (name, "app", "SUCCESS", start, end, *sizes)


@pytest.fixture
def ledger(spark):
    rows = [
        run("default", START, datetime(2024, 1, 1, 10), *[None] * 5),
        run("given", START, datetime(2024, 1, 1, 1), "8 vCPU", "32 GB", "2", " 4 GB", 3),
        run("odd", START, None, "many", "", "x 4", "4.5 GB", 1),
        run("unstarted", None, None, *[None] * 5),
    ]
    return spark.createDataFrame(rows, JOB_RUNS)


def test_job_run_costs(ledger):
    found = {
        r.job_run_id: r for r in costs.job_run_costs(ledger, F.lit(NOW)).collect()
    }
    default = found["default"]
    assert default.duration_seconds == 36000
    assert default.duration_hours == 10
    assert default.driver_cpu_cost == pytest.approx(2.08)
    assert default.driver_memory_cost == pytest.approx(1.20)
    assert default.executor_cpu_cost == pytest.approx(20.80)
    assert default.executor_memory_cost == pytest.approx(12.00)
    assert default.total_cost == pytest.approx(36.08)
    given = found["given"]
    assert (given.driver_cpu, given.driver_memory) == (8, 32)
    assert (given.executor_cpu, given.executor_memory) == (2, 4)
    assert given.total_cost == pytest.approx(0.052 * (8 + 6) + 0.0075 * (32 + 12))
    odd = found["odd"]
    assert (odd.driver_cpu, odd.driver_memory) == (4, 16)
    assert (odd.executor_cpu, odd.executor_memory) == (4, 16)
    assert odd.duration_hours == 5
    assert found["unstarted"].total_cost == 0


def test_totals(ledger):
    total = costs.job_run_cost_totals(costs.job_run_costs(ledger, F.lit(NOW))).first()
    assert (total.application_id, total.state, total.runs) == ("app", "SUCCESS", 4)
    assert float(total.total_cost) == pytest.approx(36.08 + 1.058 + 3.28)


def test_numbers_pass_through_size(spark):
    rows = spark.createDataFrame([(8,), (None,)], "cpu int")
    assert [r[0] for r in rows.select(costs.size("cpu", 4)).collect()] == [8, 4]


def workload(spark, gb):
    return spark.createDataFrame([(float(gb),)], "data_size_gb double")


def test_estimated_costs(spark):
    found = costs.estimated_costs(workload(spark, 100)).first()
    assert found.estimated_hours == 10
    assert found.total_cost == pytest.approx(36.08)


@pytest.mark.parametrize(
    "gb, executors, cpu, memory",
    [(2, 2, 4, 16), (9, 5, 4, 16), (38, 20, 4, 16), (40, 11, 8, 32), (1000, 50, 8, 32)],
)
def test_sized_for_duration(spark, gb, executors, cpu, memory):
    found = costs.sized_for_duration(workload(spark, gb), 2).first()
    assert found.executor_instances == executors
    assert (found.executor_cpu, found.executor_memory) == (cpu, memory)


def test_sizing_scenario(spark):
    found = costs.sized_for_duration(workload(spark, 100), 2).first()
    assert found.executor_instances == 26
    assert found.total_cost == pytest.approx(34.768)
