"""Match rules as Column expressions."""

from matchlive.functions.clock import (
    clock_or_zero,
    match_second,
    minute_label,
    minutes_remaining,
)
from matchlive.functions.rules import (
    ATTACKING_TYPES,
    in_box,
    is_attacking,
    is_completed,
    is_goal,
    is_shot,
    is_touch,
    safe_xg,
    win_probability,
)

__all__ = [
    "ATTACKING_TYPES",
    "clock_or_zero",
    "in_box",
    "is_attacking",
    "is_completed",
    "is_goal",
    "is_shot",
    "is_touch",
    "match_second",
    "minute_label",
    "minutes_remaining",
    "safe_xg",
    "win_probability",
]
