"""SQL expressions shared by every operator: scores, bounds and geometry."""

from edgelens.functions.bounds import Bounds
from edgelens.functions.geometry import Resolution, box_end, scale_to_float, scale_to_integer
from edgelens.functions.scores import ScoreFn, nan_to_null, strict_greatest, strict_least

__all__ = [
    "Bounds",
    "Resolution",
    "ScoreFn",
    "box_end",
    "nan_to_null",
    "scale_to_float",
    "scale_to_integer",
    "strict_greatest",
    "strict_least",
]
