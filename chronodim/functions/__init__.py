from .columns import batch_date, changed, differs, due, key_ok, open_end, ts_literal

__all__ = ["batch_date", "changed", "differs", "due", "key_ok", "open_end", "ts_literal"]
