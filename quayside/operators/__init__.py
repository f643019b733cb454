"""Row operators: alignment, constants, conversion, rejects, profiling."""

from .align import align, with_constants
from .convert import coerce_to_target, convert
from .profile import as_text, suggest_rules
from .rejects import split_rejects

__all__ = [
    "align",
    "as_text",
    "coerce_to_target",
    "convert",
    "split_rejects",
    "suggest_rules",
    "with_constants",
]
