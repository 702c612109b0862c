"""chronodim: versioned (SCD type 2) dimension loads as Spark DataFrame plans."""

from .plans.scd2 import apply_scd2
from .spec import OPEN_END, DimSpec

__all__ = ["DimSpec", "OPEN_END", "apply_scd2"]
