from batchgate.sinks.batches import processed_batches, write_summaries, write_transactions
from batchgate.sinks.logs import write_alerts, write_dead_letters
from batchgate.sinks.retention import expired_batches, remove_batches
from batchgate.sinks.samples import write_csv, write_manifest

__all__ = [
    "expired_batches",
    "processed_batches",
    "remove_batches",
    "write_alerts",
    "write_csv",
    "write_dead_letters",
    "write_manifest",
    "write_summaries",
    "write_transactions",
]
