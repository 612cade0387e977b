"""What line deduplication moves: arrays as compressed byte planes, tables of cells as bits."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from roadloom.llm import line_dedup as ld


def test_small_numbers_move_in_few_bytes_and_come_back():
    n = np.arange(1000)
    shard = n % 3
    columns = [ld.mixed(n.astype(np.uint64)), n.astype(np.int64) - 5, (n % 7).astype(np.int32), (n % 60_000).astype(np.uint16)]
    group = pa.Table.from_batches(list(ld._packed(shard, columns)))
    assert group.column("shard").to_pylist() == [0, 1, 2]
    order = np.argsort(shard, kind="stable")
    for want, got in zip(columns, ld._unpacked(group, [c.dtype for c in columns])):
        assert got.dtype == want.dtype and np.array_equal(got, want[order])
    sizes = [sum(map(len, group.column(f"c{i}").to_pylist())) for i in range(4)]
    assert sizes[1] < 3000 and sizes[2] < 1500  # 8000 and 4000 bytes as they are in memory


def test_marked_cells():
    table = np.zeros(1 << 10, np.uint16)
    table[[0, 9, 700]] = [1, 65_535, 3]
    marks = ld._marks(table)
    assert marks.nbytes == 128
    keys = np.array([0, 8, 9, 700, 701, (5 << 10) + 700], np.uint64)
    assert ld._marked(marks, keys).tolist() == [True, False, True, True, False, True]


def test_short_tokens():
    tokens = np.array([1, 255, 256, (1 << ld.TOKEN_BITS) - 1], np.uint64)
    short = tokens.view(np.uint8).reshape(-1, 8)[:, : ld.TOKEN_BYTES]
    again = np.frombuffer(short.tobytes(), ld._TOKEN)
    assert len(short.tobytes()) == 24 and np.array_equal(ld._whole(again), tokens)
