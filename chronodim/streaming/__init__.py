from .loader import load_batch, start_loads

__all__ = ["load_batch", "start_loads"]
