"""Column expressions used by the operators (all built-in, codegen-friendly)."""

from cadenza.functions.columns import (
    compressed,
    decay,
    discount,
    fallback,
    threshold,
)

__all__ = ["compressed", "decay", "discount", "fallback", "threshold"]
