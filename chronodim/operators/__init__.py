from .flags import (batch_rows, close_previous, flag_off_touched, flag_on_latest, next_start, redate,
                    retire_older, second_latest, staged_keys, touched_rows)
from .ordered import lead_within, rank_within
from .partitioning import checked_broadcast, measured_bytes
from .reports import late_rows, long_histories, null_key_rows
from .update import update_from
from .versions import (append_versions, changed_rows, current, dedupe_batch, map_columns, max_version, new_rows,
                       next_version_plus_one, number_versions, open_row, with_max_version)

__all__ = [
    "append_versions", "batch_rows", "checked_broadcast", "measured_bytes", "lead_within", "rank_within",
    "late_rows", "long_histories", "null_key_rows", "changed_rows", "close_previous", "current",
    "flag_off_touched", "flag_on_latest", "map_columns", "max_version", "new_rows", "next_start",
    "next_version_plus_one", "number_versions", "open_row", "redate", "retire_older", "second_latest",
    "staged_keys", "touched_rows", "update_from", "with_max_version", "dedupe_batch",
]
