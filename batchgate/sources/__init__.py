from batchgate.sources.csv_files import profile_files, read_all_strings, read_batch_csv
from batchgate.sources.incoming import explode_events, list_incoming
from batchgate.sources.manifest import read_manifest

__all__ = [
    "explode_events",
    "list_incoming",
    "profile_files",
    "read_all_strings",
    "read_batch_csv",
    "read_manifest",
]
