"""What a bucket of keys and a block's keys take in memory, and what they tell."""

from __future__ import annotations

import tracemalloc

import numpy as np

from tripmill.llm import suffix_dedup


def test_sorting_keys_takes_few_copies():
    keys = np.random.default_rng(1).integers(0, 1 << 20, 1 << 19).astype(np.uint64) << np.uint64(40)
    unique, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    for run, most in ((lambda: suffix_dedup._sorted_buckets([keys[:100].tobytes(), keys[100:].tobytes()]), 5), (lambda: suffix_dedup._once(keys), 5)):
        tracemalloc.start()
        found = run()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < most * keys.nbytes
        if len(found) == 2:
            assert b"".join(found) == (counts > 1)[inverse].astype(np.uint8).tobytes() and len(found[0]) == 100
        else:
            assert (found[0] == unique).all() and (found[1] == inverse).all() and (found[2] == (counts > 1)).all()


def test_no_keys():
    none = np.zeros(0, np.uint64)
    assert [len(x) for x in suffix_dedup._once(none)] == [0, 0, 0]
    assert suffix_dedup._by_bucket(none, 8)[1].tolist() == []
    assert suffix_dedup._sorted_buckets([b"", b""]) == [b"", b""]
