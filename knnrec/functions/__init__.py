"""Column expressions shared by the operators (all JVM-side built-ins)."""

from knnrec.functions.columns import (
    normalized_deviation,
    out,
    predicted_rating,
    scale,
    snap,
)

__all__ = ["normalized_deviation", "out", "predicted_rating", "scale", "snap"]
