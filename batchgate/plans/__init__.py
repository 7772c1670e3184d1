from batchgate.plans.pipeline import RunResult, process_incoming
from batchgate.plans.workload import bench_workload

__all__ = ["RunResult", "bench_workload", "process_incoming"]
