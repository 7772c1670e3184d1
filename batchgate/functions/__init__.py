from batchgate.functions.draws import draw, draw_below, pick, uniform
from batchgate.functions.parsing import (
    ascii_digits,
    is_blank,
    parse_iso_date,
    parse_number,
    shown,
)

__all__ = [
    "ascii_digits",
    "draw",
    "draw_below",
    "is_blank",
    "parse_iso_date",
    "parse_number",
    "pick",
    "shown",
    "uniform",
]
