"""Task-side helpers of the anchored time-to-live: numpy over sorted Arrow batches.

Spark places and sorts the rows; each helper keeps at most one batch and one carried value.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def mark_anchors(times: np.ndarray, starts: np.ndarray, limits: np.ndarray, ttl: int) -> np.ndarray:
    """Flag the rows that open a new time-to-live.

    ``times`` is ascending inside each group, groups begin at ``starts``, and the first anchor of a
    group is its first row later than its limit. All groups advance by one anchor per round.
    """
    n = len(times)
    marks = np.zeros(n, dtype=bool)
    if n == 0:
        return marks
    ends = np.append(starts[1:], n)
    group = np.repeat(np.arange(len(starts)), ends - starts)
    offsets = times - times[starts][group]
    width = int(offsets.max()) + ttl + 2
    if width * len(starts) >= 2**62:  # the combined key would overflow: one group at a time
        for s, e, limit in zip(starts, ends, limits, strict=True):
            marks[s:e] = mark_anchors(times[s:e], np.zeros(1, dtype=np.int64), limit[None], ttl)
        return marks
    combined = group * width + offsets
    live = np.arange(len(starts))
    reach = np.clip(limits - times[starts], -1, width - 1)
    while len(live):
        found = np.searchsorted(combined, live * width + reach, side="right")
        inside = found < ends[live]
        live, found = live[inside], found[inside]
        marks[found] = True
        reach = offsets[found] + ttl
    return marks


def fold_groups(batches, ttl: int):
    """Anchor and duplicate flag of rows sorted by group and time.

    Each batch is (time, true on the first row of a group, the anchor the group starts with or
    null). A group may span any number of batches.
    """
    carried = None
    for time, first, seed in batches:
        n = len(time)
        # A row without a time is a group of its own, whatever stands for its time.
        times = pc.fill_null(time, 0).to_numpy(zero_copy_only=False)
        begins = first.to_numpy(zero_copy_only=False).astype(bool)
        continued = n > 0 and not begins[0]
        starts = np.flatnonzero(begins)
        if continued:
            starts = np.insert(starts, 0, 0)
        seeds = seed.take(pa.array(starts))
        seeded = pc.is_valid(seeds).to_numpy(zero_copy_only=False).copy()
        anchors = pc.fill_null(seeds, 0).to_numpy(zero_copy_only=False).copy()
        if continued:
            seeded[0], anchors[0] = True, carried
        limits = np.where(seeded, anchors + ttl, times[starts] - 1)
        marks = mark_anchors(times, starts, limits, ttl)

        lengths = np.diff(np.append(starts, n))
        latest = np.maximum.accumulate(np.where(marks, np.arange(n), -1))
        values = np.where(
            latest >= np.repeat(starts, lengths), times[latest], np.repeat(anchors, lengths)
        )
        if n:
            carried = values[-1]
        yield pa.StructArray.from_arrays(
            [pa.array(values, pa.int64()), pa.array(~marks)], names=["anchor_ms", "is_duplicate"]
        )


def block_exits(times: np.ndarray, block_start: int, ttl: int) -> tuple[np.ndarray, np.ndarray]:
    """For every first anchor a block can have, the last anchor it leads to inside the block.

    An earlier anchor reaches at most ``ttl`` into the block, so the first anchor is one of the rows
    up to there, or the next one after. Neighbouring entries with the same exit are merged: an
    entry stands for all first anchors up to it.
    """
    heads = times[: np.searchsorted(times, block_start + ttl) + 1]
    exits = heads.copy()
    live = np.arange(len(heads))
    while len(live):
        found = np.searchsorted(times, exits[live] + ttl, side="right")
        inside = found < len(times)
        live, found = live[inside], found[inside]
        exits[live] = times[found]
    keep = np.append(exits[1:] != exits[:-1], True)
    return heads[keep], exits[keep]


def chain_blocks(batches, ttl: int):
    """The anchor each block of a key starts with, for block tables sorted by key and block.

    Each batch is (block start, true on the first block of a key, entries, exits).
    """
    anchor = None
    for block, first, heads, exits in batches:
        entering = []
        for i in range(len(block)):
            start = block[i].as_py()
            if first[i].as_py():
                anchor = None
            entering.append(anchor)
            limit = start - 1 if anchor is None else max(anchor + ttl, start - 1)
            entries = heads[i].values.to_numpy(zero_copy_only=False)
            found = int(np.searchsorted(entries, limit, side="right"))
            if found < len(entries):
                anchor = exits[i].values[found].as_py()
        yield pa.array(entering, pa.int64())


def pack_times(offsets: np.ndarray, width: int) -> bytes:
    """Sorted distinct offsets below ``width``: a bitmap, or the numbers themselves where these are fewer bytes.

    A bitmap is ``width / 8`` bytes long, so its length tells which of the two it is.
    """
    if len(offsets) * 4 < width // 8:
        return np.sort(offsets).astype("<u4").tobytes()
    bits = np.zeros(width, dtype=bool)
    bits[offsets] = True
    return np.packbits(bits).tobytes()


def unpack_times(data: bytes, width: int) -> np.ndarray:
    if len(data) == width // 8:
        return np.flatnonzero(np.unpackbits(np.frombuffer(data, dtype=np.uint8)))
    return np.frombuffer(data, dtype="<u4").astype(np.int64)


def column_exits(rows: np.ndarray, packed: list[bytes], width: int) -> np.ndarray:
    """For a chain that comes into a column at the start of each of its rows, the row in which it leaves.

    ``rows`` are the column's rows with times, ascending. A chain moves from a time to the first one at its place or later in
    the next row; it leaves where there is none. Chains at one place go on as one.
    """
    left = np.zeros(len(rows), dtype=np.int64)
    places = np.zeros(0, dtype=np.int64)  # of the chains, ascending
    chains: list[list[int]] = []  # the rows they came in, by number
    for i, row in enumerate(rows):
        if i and row != rows[i - 1] + 1:
            for chain in chains:
                left[chain] = rows[i - 1] + 1
            places, chains = places[:0], []
        times = unpack_times(packed[i], width)
        found = np.searchsorted(times, places)
        out = found == len(times)
        for k in np.flatnonzero(out):
            left[chains[k]] = row
        moved: dict[int, list[int]] = {int(times[0]): [i]}
        for k in np.flatnonzero(~out):
            place = int(times[found[k]])
            if place not in moved:
                moved[place] = chains[k]
            elif len(moved[place]) < len(chains[k]):
                chains[k].extend(moved[place])
                moved[place] = chains[k]
            else:
                moved[place].extend(chains[k])
        places = np.array(sorted(moved), dtype=np.int64)
        chains = [moved[p] for p in places.tolist()]
    for chain in chains:
        left[chain] = rows[-1] + 1
    return left


def chain_columns(batches, columns: int):
    """Whether the chain of a key's anchors comes into each (row, column), for tables sorted by key, row and column.

    Each batch is (row, column, row in which a chain leaves, true at the first of a key). A chain that leaves a column goes on
    at the next time after it, which is at the start of another column.
    """
    until = None
    for row, column, leaves, first in batches:
        places = row.to_numpy() * columns + column.to_numpy()
        exits = leaves.to_numpy() * columns + column.to_numpy()
        entered = np.zeros(len(places), dtype=bool)
        opens = first.to_numpy(zero_copy_only=False).astype(bool)
        for i in range(len(places)):
            if opens[i] or places[i] > until:
                entered[i], until = True, exits[i]
        yield pa.array(entered)


def column_anchors(rows: np.ndarray, packed: list[bytes], entered: list, width: int) -> list[tuple[int, int]]:
    """(number of the row, place) of the anchors of a column, given the rows in which the chain comes in at their start."""
    out: list[tuple[int, int]] = []
    place = None
    for i, row in enumerate(rows):
        if place is not None and row != rows[i - 1] + 1:
            place = None
        if entered[i]:
            place = 0
        if place is None:
            continue
        times = unpack_times(packed[i], width)
        at = int(np.searchsorted(times, place))
        place = int(times[at]) if at < len(times) else None
        if place is not None:
            out.append((i, place))
    return out
