"""Ranges of ids: of equal width, or of about equal numbers of rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from math import ceil

#: A range is put together from slots of at most its 8th part.
SLOTS_PER_RANGE = 8
#: A slot with more rows is cut into so many finer ones (a power of two).
CUTS = 16
FIRST_SLOTS = 4_096
#: Conditions in one statement.
INTERVALS_PER_QUERY = 500

#: (intervals of ids, origin, width) to rows per slot of so many ids, by its first id
Counts = Callable[[Sequence[tuple[int, int]], int, int], dict[int, int]]


@dataclass(frozen=True)
class IdRange:
    """An inclusive range of ids."""

    low: int
    high: int


def id_ranges(bounds: tuple[int, int] | None, size: int, max_id: int | None = None) -> list[IdRange]:
    """Cut ``bounds`` into consecutive ranges of ``size`` ids; ids above ``max_id`` are left out."""
    if bounds is None:
        return []
    low, high = bounds
    if max_id is not None:
        high = min(high, max_id)
    return [IdRange(start, min(start + size - 1, high)) for start in range(low, high + 1, size)]


def slots_of(counts: Counts, ids: IdRange, rows: int | None, ranges: int | None) -> tuple[list[tuple[int, int]], int]:
    """First ids and rows of slots in order, fine enough for the ranges wanted, and all rows.

    Only slots with many rows are counted again in finer ones, so the list has a bounded number of
    slots per range (besides the first ones), whatever the ids look like. A slot of one id is final.
    """
    # widths are powers of two, so that finer slots fill a wider one
    width = 1 << max(0, ((ids.high - ids.low) // FIRST_SLOTS).bit_length())
    found = counts([(ids.low, ids.high)], ids.low, width)
    total = sum(found.values())
    wanted = ranges or max(1, ceil(total / rows))
    limit = total / (wanted * SLOTS_PER_RANGE)
    final: dict[int, int] = {}
    while width > 1:
        heavy = sorted(slot for slot, n in found.items() if n > limit)
        final |= {slot: n for slot, n in found.items() if n <= limit}
        finer, found = max(1, width // CUTS), {}
        for start in range(0, len(heavy), INTERVALS_PER_QUERY):
            within = [(slot, min(slot + width - 1, ids.high)) for slot in heavy[start : start + INTERVALS_PER_QUERY]]
            found |= counts(within, ids.low, finer)
        width = finer
    return sorted((final | found).items()), total


def equal_ranges(counts: Counts, ids: IdRange, rows: int | None = None, ranges: int | None = None) -> list[IdRange]:
    """Cut a range of ids into consecutive ones of about ``rows`` rows, or into about ``ranges`` ones.

    A range differs from the mean by an eighth at most, unless one id has more rows than that: rows
    of one id stay together. Ids that do not occur belong to the range before them, so that ids
    added later in between have their range. The source counts; only counts per slot come here.
    """
    if (rows or ranges or 0) < 1:
        raise ValueError("name a positive number of rows or of ranges")
    slots, total = slots_of(counts, ids, rows, ranges)
    if not total:
        return [ids]
    mean = total / (ranges or max(1, ceil(total / rows)))
    out, start, before, number = [], ids.low, 0, 1
    held = 0
    for slot, n in slots:
        # the cut nearest to a multiple of the mean lies before this slot
        if held and before + n / 2 >= number * mean:
            out.append(IdRange(start, slot - 1))
            start, held = slot, 0
            number = int((before + n / 2) // mean) + 1
        before += n
        held += n
    return [*out, IdRange(start, ids.high)]
