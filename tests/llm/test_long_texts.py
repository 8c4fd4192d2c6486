"""op10 on a text over 16 MiB: windows behind byte 2**24 meet theirs in other documents."""

import numpy as np

from muniscope.llm import repeats, suffixes
from muniscope.llm.common import ship


def letters(rng, n):
    return rng.choice(np.frombuffer(b"abcdefghijklmnopqrstuvwxyz0123456789", np.uint8), n).tobytes().decode()


def test_repeats_behind_16_mib(spark):
    rng, edge = np.random.default_rng(4), 1 << 24
    over, tail = letters(rng, 300), letters(rng, 500)
    long = letters(rng, edge - 150) + over + letters(rng, 1000) + tail
    rows = [(1, letters(rng, 77) + tail + letters(rng, 30)), (2, over + letters(rng, 11)), (3, long)]
    out = {r["doc_id"]: r for r in repeats.remove_repeats(ship(spark).createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (out[1]["n_removed"], out[2]["n_removed"]) == (0, 0)
    assert out[3]["spans"] == [edge - 150, edge + 150, edge + 1150, edge + 1650]


def test_pieces_change_no_anchor(monkeypatch):
    rng = np.random.default_rng(5)
    raw = rng.integers(97, 100, 5000).astype(np.uint8)
    borders, rolling = np.array([0, 1200, 1230, 5000]), suffixes.Rolling(raw)
    code, width = rolling.all_of(24), 77
    want = [a + int(np.flatnonzero(code[a : a + width] >> np.uint64(24) == (code[a : a + width] >> np.uint64(24)).min())[-1]) for a in range(4901)]
    for bits in (24, 10):
        monkeypatch.setattr(suffixes, "PLACE", bits)
        at, lo, hi, digit = suffixes.anchors(raw, borders, 100, 24, rolling)
        assert all(want[w] == x for x, a, b in zip(at.tolist(), lo.tolist(), hi.tolist(), strict=True) for w in range(a, b + 1))
        assert sum((hi - lo + 1).tolist()) == 1101 + 3671 and (digit == code[at]).all()
