"""Column-expression helpers (all JVM-side, codegen friendly; no Python UDFs)."""

from strata.functions.rounding import round_half_even, round_half_up
from strata.functions.temporal import (
    iso_utc_text,
    parse_event_time,
    temporal_parts,
    wall_clock,
)

__all__ = [
    "iso_utc_text",
    "parse_event_time",
    "round_half_even",
    "round_half_up",
    "temporal_parts",
    "wall_clock",
]
