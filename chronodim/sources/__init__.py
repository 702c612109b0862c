from .buckets import create_table, load_table, read_table
from .io import publish, read_dim, read_latest, read_staging, snapshots

__all__ = ["create_table", "load_table", "publish", "read_dim", "read_latest", "read_staging", "read_table", "snapshots"]
