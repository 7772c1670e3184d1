from batchgate.synth.clean import clean_rows, row_numbers
from batchgate.synth.datasets import generate_benchmark, generate_seeded, shuffle_rows
from batchgate.synth.defects import DEFECTS, Defect, inject_defects

__all__ = [
    "DEFECTS",
    "Defect",
    "clean_rows",
    "generate_benchmark",
    "generate_seeded",
    "inject_defects",
    "row_numbers",
    "shuffle_rows",
]
