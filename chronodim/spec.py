"""Declarative description of one versioned (SCD type 2) dimension load.

A ``DimSpec`` names the business key, the attributes whose change makes a new
version, the attributes copied along without comparison, the staging change
timestamp and the behaviour options of the load.  Every pipeline is a spec;
no pipeline has code of its own.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace

# Fixed values of the data model.
OPEN_END = "2200-01-01 00:00:00"          # date_to of a version that is still open
VERSION, CURRENT, DATE_FROM, DATE_TO = "version", "lastversion", "date_from", "date_to"
BOOKKEEPING = (VERSION, CURRENT, DATE_FROM, DATE_TO)

#: Names that steps of a load use beside the dimension's columns; also every name with these beginnings.
_OWN = {"v", "kind", "cur", "max_version", "next_date_from"}
_OWN_BEGINNINGS = ("_", "cur_")
_PLAIN = re.compile(r"[A-Za-z][A-Za-z0-9_]*")
#: Beginning of the names of staged NULLs for columns that a spec doesn't name.
FILL = "_none_"

MODES = ("append_all", "upsert", "close_previous")


@dataclass(frozen=True)
class DimSpec:
    """One dimension load.

    Pairs are ``(dimension column, staging column)``.

    mode
        ``append_all``: every staged row becomes a version (no change test).
        ``upsert``: new keys and changed rows become versions, older versions retire.
        ``close_previous``: new keys at version 1, a change at ``version + 1``,
        then the second-latest version of each touched key is closed.
    start
        ``staging``: ``date_from`` of a new version is the staged timestamp;
        ``batch``: it is the load's batch clock (``batch_ts``).
    retire / redate
        scope of the flag update and of the ``date_to`` chaining: ``batch``
        = versions whose ``date_from`` equals a staged timestamp of the key,
        ``touched`` = all versions of keys present in the batch.
    null_safe
        compare with ``IS DISTINCT FROM`` instead of ``<>`` (NULL is a change).
    version_partition
        dimension key columns that number new versions (default: the key).
    tiebreak
        staged key / attribute columns (dimension names) ordering staged rows
        with equal timestamps.
    new_keys
        ``one``: every staged row of a new key becomes version 1 (one row per
        new key is the contract); ``number``: versions 1..n by timestamp.
    due
        close-previous filter on ``date_from``: ``date`` (its date is on or
        before the batch date) or ``midnight`` (before the batch date's midnight).
    close_at
        value written into ``date_to`` by close-previous: ``staging`` (the
        staged timestamp) or ``batch_ts``.
    reclose
        close-previous: ``always`` closes the second-latest version of every
        touched key again (the source's behaviour), ``current`` only while its
        flag is still true.
    close_numbering
        close-previous: ``plus_one`` (every changed row gets ``version + 1``)
        or ``row_number`` (numbered by timestamp like an upsert).
    dedupe
        drop a staged row whose tracked values equal (NULL-safe) those of the
        staged row before it of the same key, before the load ("dedupe the
        batch first": the same change twice then makes one version).
    null_keys
        ``insert`` (a staged row with a NULL key is inserted as new, every
        load, as the anti join does) or ``drop``.
    carry
        ``(dimension column, staging column)``: taken from the current version
        on a change; a new key takes the staging column.
    """

    name: str
    keys: tuple[tuple[str, str], ...]
    tracked: tuple[tuple[str, str], ...]
    ts: str
    payload: tuple[tuple[str, str], ...] = ()
    carry: tuple[tuple[str, str], ...] = ()
    mode: str = "upsert"
    start: str = "staging"
    retire: str = "batch"
    redate: str = "batch"
    null_safe: bool = False
    version_partition: tuple[str, ...] | None = None
    tiebreak: tuple[str, ...] = ()
    new_keys: str = "one"
    due: str = "date"
    close_at: str = "staging"
    reclose: str = "always"
    close_numbering: str = "plus_one"
    null_keys: str = "insert"
    dedupe: bool = False
    columns: tuple[str, ...] | None = field(default=None)

    def __post_init__(self):
        if self.mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}: {self.mode}")
        if not self.keys:
            raise ValueError("a dimension needs at least one key column")
        for name, allowed, value in (
            ("start", ("staging", "batch"), self.start),
            ("retire", ("batch", "touched"), self.retire),
            ("redate", ("batch", "touched"), self.redate),
            ("new_keys", ("one", "number"), self.new_keys),
            ("due", ("date", "midnight"), self.due),
            ("close_at", ("staging", "batch_ts"), self.close_at),
            ("reclose", ("always", "current"), self.reclose),
            ("close_numbering", ("plus_one", "row_number"), self.close_numbering),
            ("null_keys", ("insert", "drop"), self.null_keys),
        ):
            if value not in allowed:
                raise ValueError(f"{name} must be one of {allowed}: {value}")
        if self.mode == "upsert" and self.start == "batch" and "batch" in (self.retire, self.redate):
            # a version started at the batch clock can never match a staged timestamp
            raise ValueError("start='batch' needs retire='touched' and redate='touched'")
        if self.version_partition and not set(self.version_partition) <= set(self.key_cols):
            raise ValueError("version_partition must be a subset of the key columns")
        extra = set(self.tiebreak) - set(self.key_cols) - set(self.attr_cols)
        if extra:
            raise ValueError(f"tiebreak columns must be staged key or attribute columns: {sorted(extra)}")

    # ---- column groups, in dimension names ------------------------------------
    @property
    def key_cols(self) -> tuple[str, ...]:
        return tuple(d for d, _ in self.keys)

    @property
    def tracked_cols(self) -> tuple[str, ...]:
        return tuple(d for d, _ in self.tracked)

    @property
    def payload_cols(self) -> tuple[str, ...]:
        return tuple(d for d, _ in self.payload)

    @property
    def carry_cols(self) -> tuple[str, ...]:
        return tuple(d for d, _ in self.carry)

    @property
    def attr_cols(self) -> tuple[str, ...]:
        """Attributes copied from the staged row (tracked + payload)."""
        return self.tracked_cols + self.payload_cols

    @property
    def partition_cols(self) -> tuple[str, ...]:
        """Columns numbering new versions; also the load's single shuffle key."""
        return tuple(self.version_partition) if self.version_partition else self.key_cols

    @property
    def dim_cols(self) -> tuple[str, ...]:
        if self.columns is not None:
            return self.columns
        return self.key_cols + self.attr_cols + self.carry_cols + BOOKKEEPING

    @property
    def order_cols(self) -> tuple[str, ...]:
        """Columns that order staged rows of one timestamp, after ``tiebreak``: every other staged
        value, so that the order is total up to rows that are equal in all of them."""
        staged = [d for d, s in self.keys + self.tracked + self.payload if not s.startswith(FILL)]
        return tuple(c for c in staged if c not in self.tiebreak)

    def plain_names(self, columns) -> dict[str, str]:
        """New names for those of the dimension's ``columns`` that a step of the load could take for
        one of its own, or that aren't plain identifiers."""
        taken = {c.lower() for c in columns}
        names: dict[str, str] = {}
        for c in columns:
            if c not in BOOKKEEPING and (c.lower() in _OWN or c.lower().startswith(_OWN_BEGINNINGS) or not _PLAIN.fullmatch(c)):
                n = len(names)
                while f"column{n}" in taken:
                    n += 1
                names[c] = f"column{n}"
                taken.add(names[c])
        return names

    def renamed(self, names: dict[str, str]) -> DimSpec:
        """The same load on a dimension whose columns have new names (the batch keeps its own)."""
        def one(c):
            return names.get(c, c)

        def pairs(p):
            return tuple((one(d), s) for d, s in p)
        return replace(self, keys=pairs(self.keys), tracked=pairs(self.tracked), payload=pairs(self.payload),
                       carry=pairs(self.carry), tiebreak=tuple(map(one, self.tiebreak)),
                       version_partition=self.version_partition and tuple(map(one, self.version_partition)),
                       columns=self.columns and tuple(map(one, self.columns)))

    @property
    def staging_cols(self) -> tuple[str, ...]:
        seen: list[str] = []
        for _, s in self.keys + self.tracked + self.payload + self.carry:
            if s not in seen:
                seen.append(s)
        if self.ts not in seen:
            seen.append(self.ts)
        return tuple(seen)
