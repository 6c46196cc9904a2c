"""Rows of keys that different lines share, whatever the batches they come in."""

import numpy as np
import pyarrow as pa

from cartwheel.llm.lines import _several


def test_shared_keys_do_not_depend_on_batches():
    rng = np.random.default_rng(5)
    for _ in range(60):
        n = int(rng.integers(0, 80))
        rows = sorted((int(k), int(x), int(x) * 7, bool(o)) for k, x, o in zip(rng.integers(0, 12, n), rng.integers(0, 4, n), rng.integers(0, 2, n), strict=True))
        lines: dict[int, set[int]] = {}
        for k, x, _, _ in rows:
            lines.setdefault(k, set()).add(x)
        want = {r for r in rows if len(lines[r[0]]) > 1}
        cols = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.bool_()))]
        whole = pa.RecordBatch.from_arrays(cols, ["k", "line", "sign", "own"])
        for size in (1, 2, 3, 7, 100):
            batches = [whole.slice(a, size) for a in range(0, max(n, 1), size)]
            found = {tuple(r.values()) for b in _several(iter(batches)) for r in b.to_pylist()}
            assert found == want
