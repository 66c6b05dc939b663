import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from lakestar.llm import alignment, tokens
from tests.llm.helpers import SCHEMA, empty, messy, rows

ODD = ["<|endoftext|> <s> </s> <0x41>", "a ▁b", "▁", "  two  spaces ", "日本語 テキスト 😀", "\x00 nul", "x　wide y", "tab\t\n\nend ",
       "é" * 300, " " * 500, "a" * 3000, " "]


@pytest.fixture(scope="module")
def coders():
    return tokens.coder(tokens.Bpe, tokens.vocabulary()), tokens.coder(tokens.Pieces, tokens.vocabulary(tokens.PIECES))


def plain(text, coders):
    """(A ids, B ids, groups as id lists) by whole-text encoding and a merge of the two rows of ends."""
    one, two = coders
    if not text:
        return [], [], []
    a, b = one.whole(" " + text), two.whole(" " + text)
    sides = [np.cumsum([len(one.bytes[i]) for i in a]).tolist(), np.cumsum([len(two.bytes[i]) for i in b]).tolist()]
    whole = (" " + text).encode()
    if b"".join(one.bytes[i] for i in a) != whole or b"".join(two.bytes[i] for i in b) != whole:
        return [], [], []
    shared = sorted(set(sides[0]) & set(sides[1]))
    groups, i, j = [], 0, 0
    for end in shared:
        n, m = sides[0].index(end, i) + 1, sides[1].index(end, j) + 1
        groups.append((a[i:n], b[j:m]))
        i, j = n, m
    return a, b, groups


def brute(texts, coders):
    told = [plain(x, coders) for x in texts]
    linked = [Counter((p, q) for a, b in g for p in a for q in b) for _, _, g in told]
    count = Counter(p for x in linked for p in x)
    top = defaultdict(int)
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    out = []
    for (a, b, g), x in zip(told, linked, strict=True):
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in g)
        out.append((len(a), len(b), len(g), sum(x.values()), sum(n for p, n in x.items() if count[p] == top[p[0]]),
                    sum(n * count[p] for p, n in x.items()), hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return out


def test_against_brute_force(spark, coders):
    more = [(1000 + i, x, *[None] * 14) for i, x in enumerate(ODD)]
    all_rows = rows() + more
    got = alignment.per_document(messy(spark).unionByName(spark.createDataFrame(more, SCHEMA)).repartition(3)).collect()
    expected = Counter((r[0], *x) for r, x in zip(all_rows, brute([r[1] for r in all_rows], coders), strict=True))
    assert Counter(tuple(r) for r in got) == expected
    assert alignment.per_document(empty(spark)).count() == 0


def test_text_ids_and_small_slices(spark, coders, monkeypatch):
    texts = ["one two three", "one two", None, "", "two three three", "x▁y"]
    df = spark.createDataFrame([(str(i), x, 1) for i, x in enumerate(texts)], "slice string, pair string, place int")
    got = alignment.per_document(df.repartition(4), "slice", "pair").collect()
    assert sorted(map(tuple, got)) == [(str(i), *x) for i, x in enumerate(brute(texts, coders))]


def test_align_at_random_ends():
    rng = np.random.default_rng(3)
    for _ in range(60):
        ends, first = [[], []], [[0], [0]]
        at, expected = 0, []
        for _ in range(rng.integers(1, 5)):
            n = int(rng.integers(1, 40))
            for side in (0, 1):
                inner = np.flatnonzero(rng.random(n - 1) < rng.choice([0.05, 0.4, 0.9])) + 1
                ends[side] += [at + int(x) for x in inner] + [at + n]
                first[side].append(len(ends[side]))
            at += n
        a, b = np.array(ends[0]), np.array(ends[1])
        got = alignment.align(a, b, np.array(first[0]), np.array(first[1]))
        shared = np.intersect1d(a, b)[:-1]
        expected = [np.r_[0, np.searchsorted(x, shared) + 1] for x in (a, b)]
        assert [x.tolist() for x in got] == [x.tolist() for x in expected]


def test_a_wide_group_is_counted_by_distinct_ids(monkeypatch):
    x = alignment.Aligned(np.array([1, 2, 1], np.uint32), np.array([5, 5, 6], np.uint32), np.array([0, 3]), np.array([0, 3]),
                          np.array([0, 3]), np.array([0, 3]), np.array([0, 1]))

    def told():
        out = Counter()
        for d, p, t in zip(*alignment.links(x), strict=True):
            out[int(d), int(p)] += int(t)
        return out

    narrow = told()
    monkeypatch.setattr(alignment, "WIDE", 2)
    assert told() == narrow and narrow[0, (1 << 32) | 5] == 4


def test_a_text_longer_than_a_slice(spark, coders):
    text = "some words of a long text, " * 120_000  # 3 MB
    got = alignment.per_document(spark.createDataFrame([(1, text), (2, "some words")], "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_a for r in got}[1] == len(coders[0].whole(" " + text))
    assert pa.array([r.n_links for r in got]).null_count == 0
