"""Which batches of which streams a table state holds.

The record is part of the state's own commit: a file in a snapshot's folder that is there
before ``_SUCCESS``, or an entry of a bucketed table's manifest.  Each state takes over the
record of the state before it, so the newest one knows every batch loaded so far.  Epochs
of a stream are kept as ranges: ``[[0, 41]]`` after 42 batches.
"""

from __future__ import annotations

Origin = tuple[str, int]            # (stream, epoch)
Loaded = dict[str, list[list[int]]]


def holds(loaded: Loaded, origin: Origin) -> bool:
    stream, epoch = origin
    return any(a <= epoch <= b for a, b in loaded.get(stream, ()))


def with_origin(loaded: Loaded, origin: Origin | None) -> Loaded:
    """``loaded`` and one more batch."""
    if origin is None:
        return loaded
    stream, epoch = origin
    ranges: list[list[int]] = []
    for a, b in sorted([*loaded.get(stream, ()), [epoch, epoch]]):
        if ranges and a <= ranges[-1][1] + 1:
            ranges[-1] = [ranges[-1][0], max(b, ranges[-1][1])]
        else:
            ranges.append([a, b])
    return {**loaded, stream: ranges}
