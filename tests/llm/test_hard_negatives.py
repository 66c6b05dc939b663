import math
import random
from collections import Counter

import numpy as np
import pytest

from lakestar.llm import hard_negatives as hn

SCHEMA = "vec_id bigint, embedding array<float>, label int, row int, slot string, score int, id int, v int, q int"


def made(seed=5, n=700, dim=6):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(dim)] for _ in range(4)]
    out = []
    for i in range(n):
        c = r.choice(centres)
        out.append([i, [float(np.float32(x + r.gauss(0, 0.3))) for x in c], r.choice([0, 0, 0, 1, 2, 9])])
    for i in range(300, 420):
        out[i][1] = out[299][1]                     # ties of a third of a label
    out[10][1], out[11][1], out[12][1] = None, [1.0, None, 0.0, 0.0, 0.0, 0.0], [float("nan")] + [0.0] * 5
    out[13][1], out[14][2], out[15][1] = [float("inf")] * 6, None, []
    out[16][1], out[17][1] = [1.0, 2.0], [0.5] * 9   # other lengths
    out[100][1] = [0.0] * 6                          # an anchor whose scores are all 0
    out[200][1] = [-50.0] * 6
    out[18][1] = [1e30] * 6                          # does not fit a long
    out[19][1] = [3e5] * 6                           # leaves the exact range of doubles with its like
    out[21][1] = [3e5] * 6
    out += [out[0], out[0], out[5], out[600], [None, out[0][1], 1], [None, out[0][1], 0], [1000, out[19][1], 0]]
    r.shuffle(out)
    return [tuple(x) for x in out]


def brute(rows, top=5):
    keep = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v) or any(abs(x) > 1e20 for x in v):
            continue
        keep.append((i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    out = Counter()

    def order(x):
        return (-x[0], x[1] is None, x[1] or 0)

    for k, (i, label, q) in enumerate(keep):
        if i is None or i % 100:
            continue
        scored = [(sum(a * b for a, b in zip(q, p, strict=False)), j, m) for n, (j, m, p) in enumerate(keep) if n != k]
        for s, j, _ in sorted([x for x in scored if x[2] == label], key=order)[:top]:
            found = sorted([x for x in scored if x[2] != label and 80 * s <= 100 * x[0] <= 100 * s], key=order)[:top]
            for rank, (t, n, _) in enumerate(found, 1):
                out[i, j, rank, n, s, t] += 1
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*x, 1, "s", 2, 3, 4, 5) for x in rows], SCHEMA)


@pytest.mark.parametrize("blocks", [(1 << 16, 1 << 13, 1 << 22), (60, 3, 50)])
def test_against_brute_force(spark, monkeypatch, blocks):
    for name, x in zip(("PER_ROWS", "PER_ANCHORS", "CELLS"), blocks, strict=True):
        monkeypatch.setattr(hn, name, x)
    rows = made()
    got = hn.mined(frame(spark, rows).repartition(3)).collect()
    assert Counter(map(tuple, got)) == brute(rows) and len(got) > 50
    assert {r.rank for r in got} == {1, 2, 3, 4, 5}


def test_empty_and_single(spark):
    assert hn.mined(frame(spark, [])).count() == 0
    assert hn.mined(frame(spark, [(0, [1.0], 1)])).count() == 0
    got = hn.mined(frame(spark, [(100, [1.0], 1), (3, [1.0], 1), (4, [0.9], 2), (5, [0.5], 2)])).collect()
    assert list(map(tuple, got)) == [(100, 3, 1, 4, 65536, 58880)]


def test_slots_share_one_limit_and_merge_downwards(spark):
    # two positives with one score, one lower: the lower one's window is answered by slots the higher ones never keep in full
    rows = [(100, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [0.9, 0.0], 1)]
    rows += [(20 + k, [0.95, 0.0], 2) for k in range(6) if (20 + k) % 7] + [(40 + k, [0.85, 0.0], 2) for k in range(9) if (40 + k) % 7]
    got = Counter(map(tuple, hn.mined(frame(spark, rows)).collect()))
    assert got == brute(rows)
    assert {k[3] for k in got if k[1] == 3} == {40, 41, 43, 44, 45}
