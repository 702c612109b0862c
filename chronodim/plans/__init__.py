from .pipelines import PIPELINES, run_pipeline
from .scd2 import apply_scd2

__all__ = ["PIPELINES", "apply_scd2", "run_pipeline"]
