import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from streamfuse.operators import anchors
from tests.folds import fold

times = st.lists(st.integers(0, 60), min_size=1, max_size=40).map(sorted)
groups = st.lists(times, min_size=1, max_size=6)


@settings(max_examples=300, deadline=None)
@given(groups, st.integers(0, 25), st.data())
def test_groups_fold_like_the_loop_whatever_the_batches(parts, ttl, data):
    seeds = [data.draw(st.one_of(st.none(), st.integers(-30, 30))) for _ in parts]
    want = [row for part, seed in zip(parts, seeds, strict=True) for row in fold(part, ttl, seed)]
    flat = [
        (t, i == 0, seed)
        for part, seed in zip(parts, seeds, strict=True)
        for i, t in enumerate(part)
    ]
    cuts = sorted(data.draw(st.lists(st.integers(0, len(flat)), max_size=4)))
    bounds = [0, *cuts, len(flat)]
    batches = (
        (
            pa.array([r[0] for r in flat[a:b]], pa.int64()),
            pa.array([r[1] for r in flat[a:b]], pa.bool_()),
            pa.array([r[2] for r in flat[a:b]], pa.int64()),
        )
        for a, b in zip(bounds, bounds[1:], strict=False)
    )
    got = []
    for out in anchors.fold_groups(batches, ttl):
        got += [(r["is_duplicate"], r["anchor_ms"]) for r in out.to_pylist()]
    assert got == [(d, a) for _, d, a in want]


@settings(max_examples=300, deadline=None)
@given(times, st.integers(0, 12), st.integers(1, 20))
def test_chained_blocks_enter_with_the_anchor_of_the_fold(rows, ttl, extra):
    size = ttl + extra
    rows = sorted(set(rows))
    want, blocks = {}, {}
    for t, _, anchor in fold(rows, ttl):
        blocks.setdefault(t - t % size, []).append(t)
        want[t - t % size] = anchor  # the anchor after the last row of the block
    starts = sorted(blocks)
    tables = [anchors.block_exits(np.array(blocks[s]), s, ttl) for s in starts]
    batch = (
        pa.array(starts, pa.int64()),
        pa.array([i == 0 for i in range(len(starts))]),
        pa.array([t[0] for t in tables], pa.list_(pa.int64())),
        pa.array([t[1] for t in tables], pa.list_(pa.int64())),
    )
    entering = next(anchors.chain_blocks([batch], ttl)).to_pylist()
    assert entering == [None, *[want[s] for s in starts[:-1]]]


def test_groups_too_wide_for_one_combined_key_are_taken_one_by_one():
    far = 2**60
    rows = np.array([0, 1, far, 0, far, far + 1], dtype=np.int64)
    marks = anchors.mark_anchors(rows, np.array([0, 3]), np.array([-1, -1]), 5)
    assert marks.tolist() == [True, False, True, True, True, False]


def test_a_hit_never_extends_the_time_to_live():
    rows = np.array([0, 50, 61, 100, 200], dtype=np.int64)
    marks = anchors.mark_anchors(rows, np.array([0]), np.array([-1]), 60)
    assert marks.tolist() == [True, False, True, False, True]


@pytest.mark.parametrize("n", [0, 1, 3, 40, 64])
def test_packed_times_come_back(n):
    offsets = np.sort(np.random.default_rng(n).choice(64, n, replace=False))
    data = anchors.pack_times(offsets, 64)
    assert len(data) <= 8 and anchors.unpack_times(data, 64).tolist() == offsets.tolist()
