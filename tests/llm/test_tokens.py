import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from lakestar.llm import id_coder, mixing, packing, tokens
from tests.llm.helpers import empty, messy, rows, words


def plain_ids(texts):
    from tokenizers import Tokenizer
    one = Tokenizer.from_file(tokens.vocabulary())
    one.encode_special_tokens = True
    return [e.ids for e in one.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_ids_equal_the_librarys():
    texts = [x[1] for x in rows()] + ["a  b\n c\t\td \n\n  e", " lead", "trail ", "don't we'll 12 345", "<|endoftext|>",
                                       "　wide　 x", "日本語 テキスト", "a\x1c b", "x" * 5000, "\r\n \r\n"]
    got = []
    for _, n, ids, off in tokens.encoded(pa.array(texts, pa.string()), tokens.vocabulary()):
        got += [ids[off[i]:off[i + 1]].tolist() for i in range(n)]
    assert got == plain_ids(texts)


def test_packing_covers_every_id_once(spark):
    got = packing.packed(messy(spark), length=256).collect()
    own = defaultdict(list)
    for x, ids in zip(rows(), plain_ids([x[1] for x in rows()]), strict=True):
        own[x[0]].append(np.array([*ids, 0], "<u4"))
    pieces = Counter()
    for i, docs in own.items():
        for ids in docs:
            at, to, k = 0, len(ids) % 256 or min(256, len(ids)), 0
            while at < len(ids):
                pieces[(i, k, at, to - at, zlib.crc32(ids[at:to].tobytes()))] += 1
                at, to, k = to, to + 256, k + 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == pieces
    full = defaultdict(list)
    for r in got:
        full[r.sequence_id].append((r.offset, r.length))
    for spans in full.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:], strict=False))
        assert sum(n for _, n in spans) <= 256
    total = sum(n for s in full.values() for _, n in s)
    assert len(full) <= 1.1 * -(-total // 256) + 1
    assert packing.packed(empty(spark)).count() == 0


def test_best_two_fit_swaps_a_smallest_piece():
    # greedy: 60, then 30 fits, gap 10; two pieces of 20 fill the gap that 30 leaves exactly
    place, offset = packing.best_two_fit(np.array([60, 30, 20, 20]), 100)
    assert place.tolist() == [0, 1, 0, 0] and sorted(offset[[0, 2, 3]]) == [0, 60, 80]


def test_coder_round_trip():
    rng = np.random.default_rng(1)
    blocks = [rng.zipf(1.3, n).clip(0, 60000).astype("<u4") for n in (1, 5, 700, 3000)] + [
        np.tile(np.arange(50, dtype="<u4"), 60), np.zeros(2000, "<u4"), np.array([2**32 - 1, 0, 2**32 - 1], "<u4")]
    data = id_coder.encode_blocks(blocks)
    back = id_coder.decode_blocks(data, np.array([len(x) for x in blocks]))
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(blocks, back, strict=True))
    alone = [id_coder.decode_blocks([d], np.array([len(x)]))[0] for d, x in zip(data, blocks, strict=True)]
    assert all((a == b).all() for a, b in zip(blocks, alone, strict=True))  # each block can be read by itself
    assert len(data[4]) < 4 * len(blocks[4]) / 8


def test_long_blocks_are_coded_in_parts_side_by_side(monkeypatch):
    rng = np.random.default_rng(2)
    blocks = [rng.zipf(1.2, 5 * id_coder.BLOCK + 7).clip(0, 60000).astype("<u4"), np.arange(2 * id_coder.BLOCK, dtype="<u4"),
              np.full(id_coder.BLOCK + 1, 9, "<u4"), np.array([4], "<u4"), np.zeros(0, "<u4")]
    steps = []
    predict = id_coder._Lanes.predict
    monkeypatch.setattr(id_coder._Lanes, "predict", lambda *a: (steps.append(1), predict(*a))[1])
    data = id_coder.encode_blocks(blocks)
    assert len(steps) <= id_coder.BLOCK  # not one step for each id of the longest block
    back = id_coder.decode_blocks(data, np.array([len(x) for x in blocks]))
    assert len(steps) <= 2 * id_coder.BLOCK
    assert all(len(a) == len(b) and (a == b).all() for a, b in zip(blocks, back, strict=True))
    alone = id_coder.decode_blocks(data[:1], np.array([len(blocks[0])]))[0]
    assert (alone == blocks[0]).all()
    assert id_coder.encode_blocks([]) == [] and id_coder.decode_blocks([], np.zeros(0, int)) == []


def test_files_hold_all_ids_in_order(spark, tmp_path):
    id_coder.write(messy(spark), str(tmp_path / "ids"), block=512)
    got = sorted(id_coder.read(spark, str(tmp_path / "ids"), with_ids=True).collect(), key=lambda r: r.start)
    expected = Counter((x[0], *ids, 2) for x, ids in zip(rows(), plain_ids([x[1] for x in rows()]), strict=True))
    assert Counter((r.doc_id, *r.ids) for r in got) == expected
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    known = [r.doc_id for r in got if r.doc_id is not None]
    assert known == sorted(known) and got[-1].doc_id is None
    id_coder.write(empty(spark), str(tmp_path / "none"))
    assert id_coder.read(spark, str(tmp_path / "none")).count() == 0


def test_a_damaged_block_is_reported(spark, tmp_path):
    import pytest
    from pyspark.sql import functions as F
    id_coder.write(messy(spark).limit(5), str(tmp_path / "ids"))
    bad = spark.read.parquet(str(tmp_path / "ids")).withColumn("crc32", F.col("crc32") + 1)
    bad.write.parquet(str(tmp_path / "bad"))
    with pytest.raises(Exception, match="damaged"):
        id_coder.read(spark, str(tmp_path / "bad")).count()


def test_targets_stop_at_three_times():
    got = mixing.targets([("b", 10), ("a", 1000), (None, 5), ("c", 1000)])
    assert abs(sum(got.values()) - 2015) < 1e-6 or all(v <= 3 * s for v, s in zip(got.values(), (1000, 10, 1000, 5), strict=True))
    assert got["b"] == 30 and got[None] == 15 and abs(got["c"] / got["a"] - 3) < 1e-9
    assert mixing.targets([("x", 0)]) == {"x": 0.0}


def test_permutations_are_permutations():
    for n in (1, 2, 3, 10, 1000, 4097):
        assert sorted(mixing.permuted(np.arange(n), n, 5).tolist()) == list(range(n))


def test_mix_takes_its_targets(spark):
    got = mixing.taken(messy(spark), block=16, shard=8).collect()
    size = Counter(len(words(x[1])) for x in rows())
    assert Counter(r.size for r in got) == size
    per = defaultdict(lambda: [0, 0, 0.0])
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        per[r.source][0] += r.size
        per[r.source][1] += r.taken
        per[r.source][2] = r.target
        assert r.source_size == sum(len(words(x[1])) for x in rows() if x[3] == r.source)
    assert {s: v[2] for s, v in per.items()} == mixing.targets([(s, v[0]) for s, v in per.items()])
    for s, (_, taken, target) in per.items():
        assert abs(taken - target) <= 1, s
    again = mixing.taken(messy(spark).repartition(7), block=16, shard=8).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    assert mixing.taken(empty(spark)).count() == 0


def test_mix_does_not_follow_the_parts(spark, monkeypatch):
    plain = mixing.taken(messy(spark), block=16, shard=2).collect()
    monkeypatch.setattr(mixing, "PART", 2)
    monkeypatch.setattr(mixing, "CHUNK", 3)
    cut = mixing.taken(messy(spark).repartition(5), block=16, shard=2).collect()
    assert Counter(map(tuple, cut)) == Counter(map(tuple, plain))


def test_streams_are_in_order_of_ids(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PART", 4)
    docs = spark.createDataFrame([(i * 7919 % 101, "w " * (1 + i % 9), "s") for i in range(101)],
                                 "doc_id bigint, text string, source string")
    _, spans = mixing.mixed(docs, block=8, shard=4)
    size = {r.doc_id: len(words(r.text)) for r in docs.collect()}
    begin, at = {}, 0
    for i in sorted(size):
        begin[i], at = at, at + size[i]
    found = spans.collect()
    assert sum(r.words for r in found) == at
    for slot in {(r.slot,) for r in found}:  # the words of a slot are one block of the stream
        mine = sorted((begin[r.id] + r.start, r.words) for r in found if (r.slot,) == slot)
        assert mine[0][0] % 8 == 0 and all(a + n == b for (a, n), (b, _) in zip(mine, mine[1:], strict=False))


def test_spans_of_a_shard_are_words_of_documents(spark):
    docs, spans = mixing.mixed(messy(spark), block=16, shard=8)
    size = defaultdict(int)
    for x in rows():
        size[x[0]] = max(size[x[0]], len(words(x[1])))
    found = spans.collect()
    assert all(r.start >= 0 and r.words > 0 and r.start + r.words <= size[r.id] for r in found)
    assert sum(r.words for r in found) > 0 and docs.count() == len(rows())


def test_mix_as_documents(spark):
    out = mixing.mix(messy(spark))
    assert out.columns == messy(spark).columns
    assert out.groupBy("doc_id", "text").count().agg({"count": "max"}).first()[0] <= 9  # three repeated rows, three times
    assert mixing.mix(empty(spark)).count() == 0


def test_packed_sequences_hold_the_ids(spark):
    placed = packing.packed(messy(spark), length=256, with_ids=True)
    got, plain = placed.collect(), packing.packed(messy(spark), length=256).drop("sequence_id", "offset").collect()
    held = Counter((r.doc_id, r.piece, r.start, r.length, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in got)
    assert held == Counter(tuple(r) for r in plain)
    whole = defaultdict(list)
    for r in sorted(got, key=lambda r: r.offset):
        whole[r.sequence_id] += r.ids
    made = {r.sequence_id: r.ids for r in packing.sequences(placed).collect()}
    assert Counter(map(tuple, made.values())) == Counter(map(tuple, whole.values()))
    assert Counter(map(tuple, packing.digested(placed).drop("sequence_id", "offset").collect())) == held
    assert packing.digested(packing.packed(empty(spark), with_ids=True)).count() == 0
