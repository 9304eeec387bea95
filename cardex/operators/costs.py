"""M2: what job runs cost, computed over a ledger of runs."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values (example prices and default sizes) ---
VCPU_HOUR = 0.052
GB_HOUR = 0.0075
DEFAULT_VCPU = 4
DEFAULT_GB = 16
DEFAULT_EXECUTORS = 10
CLUSTER_GB_PER_HOUR = 10.0
EXECUTOR_GB_PER_HOUR = 1.0
LARGE_FROM_EXECUTORS = 21
LARGE_VCPU = 8
LARGE_GB = 32
MAX_LARGE_EXECUTORS = 50


def size(column: str, default: int) -> Column:
    """The leading integer of e.g. ``8 vCPU``, else ``default``."""
    first = f"get(split(trim(cast({column} as string)), '\\\\s+'), 0)"
    return F.coalesce(F.expr(f"try_cast({first} as int)"), F.lit(default))


def with_costs(sized: DataFrame, hours: str) -> DataFrame:
    """The four cost parts and their total for sizes held for ``hours``."""
    held = F.col(hours)
    executors = F.col("executor_instances")
    parts = {
        "driver_cpu_cost": VCPU_HOUR * F.col("driver_cpu") * held,
        "driver_memory_cost": GB_HOUR * F.col("driver_memory") * held,
        "executor_cpu_cost": VCPU_HOUR * F.col("executor_cpu") * executors * held,
        "executor_memory_cost": GB_HOUR * F.col("executor_memory") * executors * held,
    }
    total = (
        F.col("driver_cpu_cost")
        + F.col("driver_memory_cost")
        + F.col("executor_cpu_cost")
        + F.col("executor_memory_cost")
    )
    return sized.withColumns(parts).withColumn("total_cost", total)


def job_run_costs(runs: DataFrame, now: Column) -> DataFrame:
    """Duration, sizes and costs of every run in a ledger.

    ``now`` stands in for a missing start or end.
    """

    def micros(column: str) -> Column:
        return F.unix_micros(F.coalesce(column, now).cast("timestamp"))

    instances = F.coalesce("executor_instances", F.lit(DEFAULT_EXECUTORS))
    sized = runs.select(
        "job_run_id",
        "application_id",
        "state",
        ((micros("end_time") - micros("start_time")) / 1e6).alias("duration_seconds"),
        size("driver_cpu", DEFAULT_VCPU).alias("driver_cpu"),
        size("driver_memory", DEFAULT_GB).alias("driver_memory"),
        size("executor_cpu", DEFAULT_VCPU).alias("executor_cpu"),
        size("executor_memory", DEFAULT_GB).alias("executor_memory"),
        instances.alias("executor_instances"),
    ).withColumn("duration_hours", F.col("duration_seconds") / 3600)
    return with_costs(sized, "duration_hours")


def job_run_cost_totals(costs: DataFrame) -> DataFrame:
    """Runs and total cost per application and state.

    Costs are summed as decimals: the total does not depend on the order in which
    partitions arrive.
    """
    cost = F.col("total_cost").cast("decimal(28,6)")
    return costs.groupBy("application_id", "state").agg(
        F.count(F.lit(1)).alias("runs"), F.sum(cost).alias("total_cost")
    )


def estimated_costs(
    workloads: DataFrame, gb_per_hour: float = CLUSTER_GB_PER_HOUR
) -> DataFrame:
    """Costs of workloads of ``data_size_gb`` on the default cluster."""
    sized = workloads.withColumns(
        {
            "estimated_hours": F.col("data_size_gb") / gb_per_hour,
            "driver_cpu": F.lit(DEFAULT_VCPU),
            "driver_memory": F.lit(DEFAULT_GB),
            "executor_cpu": F.lit(DEFAULT_VCPU),
            "executor_memory": F.lit(DEFAULT_GB),
            "executor_instances": F.lit(DEFAULT_EXECUTORS),
        }
    )
    return with_costs(sized, "estimated_hours")


def sized_for_duration(workloads: DataFrame, target_hours: float) -> DataFrame:
    """Executors, their size and costs to finish each workload in ``target_hours``.

    Small executors up to 20 of them, beyond that half as many large ones, at most 50.
    """
    rate = F.col("data_size_gb") / target_hours / EXECUTOR_GB_PER_HOUR
    needed = F.floor(rate) + 1
    large = needed >= LARGE_FROM_EXECUTORS
    halved = F.least(F.floor(needed / 2) + 1, F.lit(MAX_LARGE_EXECUTORS))
    sized = workloads.withColumns(
        {
            "estimated_hours": F.lit(float(target_hours)),
            "driver_cpu": F.lit(DEFAULT_VCPU),
            "driver_memory": F.lit(DEFAULT_GB),
            "executor_cpu": F.when(large, LARGE_VCPU).otherwise(DEFAULT_VCPU),
            "executor_memory": F.when(large, LARGE_GB).otherwise(DEFAULT_GB),
            "executor_instances": F.when(large, halved).otherwise(needed).cast("int"),
        }
    )
    return with_costs(sized, "estimated_hours")
