"""Column expressions (all built-in Catalyst functions, no Python UDFs)."""

from tidemark.functions.scalar import (
    classify_status,
    clip_to_range,
    compose_id,
    compose_tag,
    micros_between,
    micros_to_ntz,
    micros_to_ts,
    ms_between,
    utc_wall_clock,
)

__all__ = [
    "classify_status", "clip_to_range", "compose_id", "compose_tag", "micros_between", "micros_to_ntz", "micros_to_ts",
    "ms_between", "utc_wall_clock",
]
