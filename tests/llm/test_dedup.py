import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from lakestar.llm import exact_dedup, line_dedup, ngram_join, repeated_substrings
from tests.llm.helpers import empty, messy, rows, unique, words


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (t or ""))


def test_exact_groups(spark):
    got = exact_dedup.decide(messy(spark), counters=3).collect()
    groups = defaultdict(list)
    for x in rows():
        groups[lower(x[1])].append(x[0])
    assert len(got) == len(rows())
    for g in got:
        own = [k for k, ids in groups.items() if hashlib.sha256(k.encode()).hexdigest() == g.text_sha256]
        ids = groups[own[0]]
        assert g.group_size == len(ids) and g.keep_id == max((i for i in ids if i is not None), default=None)
    assert Counter(g.text_sha256 for g in got if g.kept) == Counter(hashlib.sha256(k.encode()).hexdigest() for k in groups)
    kept = exact_dedup.dedup(messy(spark))
    assert kept.columns == messy(spark).columns and kept.count() == len(groups)
    assert exact_dedup.decide(empty(spark)).count() == 0 and exact_dedup.dedup(empty(spark)).count() == 0


def test_misra_gries_finds_every_frequent_key(spark):
    keys = [1] * 400 + [2] * 300 + list(range(10, 310))
    df = spark.createDataFrame([(k,) for k in keys], "key bigint").repartition(3)
    found = {r.key for r in exact_dedup.frequent(df, counters=9).collect()}
    assert {1, 2} <= found and len(found) <= 10


def jaccard_components(data):
    sets = []
    for x in data:
        w = words(x[1])
        sets.append(frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else
                    frozenset([tuple(w)] if w else []))
    parent = list(range(len(data)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        for j in range(i):
            if s and sets[j] and 100 * len(s & sets[j]) >= 80 * len(s | sets[j]):
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(data)):
        groups[find(i)].append(data[i][0])
    name = {k: min((i for i in v if i is not None), default=None) for k, v in groups.items()}
    return Counter((x[0], len(sets[i]), name[find(i)] if sets[i] else x[0]) for i, x in enumerate(data))


def test_ngram_join_against_brute_force(spark):
    got = ngram_join.join(messy(spark)).collect()
    assert Counter(tuple(r) for r in got) == jaccard_components(rows())
    assert ngram_join.join(empty(spark)).count() == 0


def test_ngram_dedup_decides_by_row_not_by_id(spark):
    a, b = "a b c d e f g h i j", "other words that are not linked to it at all"
    docs = spark.createDataFrame([(1, a), (7, a), (7, b), (8, None), (8, a + " k"), (None, a)], "doc_id long, text string")
    kept = sorted(map(tuple, ngram_join.dedup(docs).collect()), key=repr)
    assert kept == sorted([(1, a), (7, b), (8, None), (None, a)], key=repr)


def test_ngram_dedup_keeps_one_of_each_group(spark):
    docs = unique(spark)
    kept = ngram_join.dedup(docs)
    ids = sorted(r.doc_id for r in kept.collect())
    data = {x[0]: x for x in reversed(rows()) if x[0] is not None}
    assert ids == sorted({c for _, _, c in jaccard_components(list(data.values()))})
    assert kept.columns == docs.columns


def test_divide_skip_counts_like_sets():
    rng = np.random.default_rng(3)
    query = np.unique(rng.integers(0, 60, 30))
    others = [np.unique(rng.integers(0, 60, rng.integers(1, 40))) for _ in range(50)]
    owner = np.concatenate([np.full(len(x), i) for i, x in enumerate(others)])
    for need in (1, 5, 12, 20):
        got = ngram_join.divide_skip(query, need, owner, np.concatenate(others), 50, np.full(50, need))
        assert sorted(got) == [i for i, x in enumerate(others) if len(np.intersect1d(x, query)) >= need]


def test_passages_against_brute_force(spark):
    got = repeated_substrings.marked(messy(spark), keep_first=False).collect()
    data = [(x[0], (x[1] or "").encode()) for x in rows()]
    size = repeated_substrings.LENGTH
    seen = Counter(b[i:i + size] for _, b in data for i in range(len(b) - size + 1))
    expected = Counter()
    for i, b in data:
        mark = np.zeros(len(b) + 1, int)
        for k in range(len(b) - size + 1):
            if seen[b[k:k + size]] > 1:
                mark[k] += 1
                mark[k + size] -= 1
        gone = np.cumsum(mark)[:-1] > 0
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        expected[(i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == expected
    assert sum(k[2] * n for k, n in expected.items()) > 1000
    assert repeated_substrings.marked(empty(spark)).count() == 0


def test_first_copy_of_a_passage_stays(spark):
    got = {r.doc_id: r for r in repeated_substrings.marked(unique(spark)).collect()}
    assert got[0].n_removed == 0                       # the first of the copies of base
    assert got[500].n_removed == got[500].n_bytes      # a later one
    assert got[12].n_removed == 0 and got[15].n_removed > 200 and got[18].n_removed > 200


def test_windows_of_heavy_anchors_meet_by_digest(spark):
    for keep_first in (False, True):
        plain, cut = (repeated_substrings.marked(messy(spark), keep_first=keep_first, per_anchor=n).collect()
                      for n in (repeated_substrings.PER_ANCHOR, 0))
        assert Counter(map(str, plain)) == Counter(map(str, cut))
    # a phrase shorter than a passage in every text, with other words around it, and one passage in a few
    r = random.Random(17)
    prose = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    phrase, passage = prose(90), prose(260)
    data = [(i, prose(300) + phrase + prose(300) + (passage if i % 50 == 7 else "")) for i in range(400)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    for n in (0, 100_000):
        got = {x.doc_id: x for x in repeated_substrings.marked(docs, per_anchor=n).collect()}
        assert {i for i, x in got.items() if x.n_removed} == {i for i in range(400) if i % 50 == 7 and i > 7}
        assert all(260 <= x.n_removed < 270 for i, x in got.items() if i % 50 == 7 and i > 7)
    assert repeated_substrings.marked(empty(spark), per_anchor=0).count() == 0


def test_suffix_ranks_are_byte_order():
    rng = np.random.default_rng(0)
    buf = rng.integers(97, 99, 900).astype(np.uint8)
    buf = np.concatenate([buf, buf[100:500]])
    windows = np.arange(len(buf) - 199)
    rank = repeated_substrings.ranks(buf, windows)
    raw = buf.tobytes()
    strings = [raw[i:i + 200] for i in windows]
    assert [strings[i] for i in np.argsort(rank, kind="stable")] == sorted(strings)
    earlier, later = repeated_substrings.previous_factors(rank, windows)
    count = Counter(strings)
    assert [bool(e or w) for e, w in zip(earlier, later, strict=True)] == [count[s] > 1 for s in strings]


def test_lines(spark):
    line = "the quick brown foxes jumped over seventeen sleeping badgers beside another river yesterday morning"
    data = [(1, line + "\nshort one\n" + line), (2, line.upper() + "!!"), (3, line.replace("river", "rivers") + "\nshort one"),
            (4, None), (5, ""), (6, "short one"), (None, line), (7, "word word word word word word\n" + "q " * 20000)]
    docs = spark.createDataFrame([(i, t, 9) for i, t in data], "doc_id bigint, text string, row int")
    got = {r.doc_id: r for r in line_dedup.per_document(docs).collect()}
    assert (got[1].n_lines, got[1].dropped_lines) == (3, [2])
    assert got[2].dropped_lines == [0] and got[None].dropped_lines == [0]
    assert got[5].n_lines == 1 and got[6].n_dropped == 0 and got[4].n_lines in (0, 1)
    assert got[7].n_dropped == 0
    kept = {r.doc_id: r.text for r in line_dedup.dedup(docs.where("doc_id is not null")).collect()}
    assert kept[1] == line + "\nshort one" and kept[2] == "" and kept[4] is None and kept[6] == "short one"
    assert line_dedup.per_document(docs.limit(0)).count() == 0


def test_lines_drop_exact_repeats_at_least(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    norm = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "raw")).select(
        "doc_id", "line", line_dedup.normalised(F.col("raw")).alias("norm")).where(F.size(F.split("norm", " ")) >= 5)
    repeats = norm.count() - norm.select("norm").distinct().count()
    got = line_dedup.per_document(docs).agg(F.sum("n_dropped")).first()[0]
    assert got >= repeats > 0


def test_simhash_is_the_majority_of_word_hashes(spark):
    texts = ["alpha beta gamma delta epsilon zeta theta", "iota kappa lambda"]
    lines = spark.createDataFrame([(t,) for t in texts], "norm string")
    got = {r.norm: (r.s0, r.s1) for r in line_dedup.simhash(lines).collect()}
    for t in texts:
        h = [spark.range(1).select(F.xxhash64(F.lit(w)).alias("a"), F.xxhash64(F.lit(w), F.lit(1)).alias("b")).first()
             for w in t.split(" ")]
        for k in (0, 1):
            bits = sum(1 << j for j in range(64) if 2 * sum((x[k] >> j) & 1 for x in h) > len(h))
            assert got[t][k] % 2**64 == bits


def test_votes_take_several_words_a_row_and_a_line_is_normalised_once(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(4, 7)))
    texts = [" ".join(word() for _ in range(n)) for n in (1, 3, 4, 5, 8, 11, line_dedup.RUN, line_dedup.RUN + 3)]
    found = line_dedup.simhash(spark.createDataFrame([(t,) for t in texts], "norm string"))
    got = {x.norm: (x.s0 % 2**64, x.s1 % 2**64) for x in found.collect()}
    vocab = sorted({w for t in texts for w in t.split(" ")})
    h = {x.w: (x.a % 2**64, x.b % 2**64) for x in spark.createDataFrame([(w,) for w in vocab], "w string").select(
        "w", F.xxhash64("w").alias("a"), F.xxhash64("w", F.lit(1)).alias("b")).collect()}
    major = lambda v: sum(1 << j for j in range(64) if 2 * sum((x >> j) & 1 for x in v) > len(v))
    for t in texts:
        ws = t.split(" ")
        parts = [ws[i:i + line_dedup.RUN] for i in range(0, len(ws), line_dedup.RUN)]
        assert got[t] == tuple(major([major([h[w][k] for w in p]) for p in parts]) for k in (0, 1))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "few#" in plan and "word#" not in plan                 # a row holds several words
    raw = spark.createDataFrame([(None,), ("",), ("--- ---",), ("\t",), ("A_b  c!",), ("\u4eca\u65e5\u3002",)], "raw string")
    norm = raw.select(line_dedup.normalised(F.col("raw")).alias("norm"))
    assert [x.norm for x in norm.collect()] == [None, "", "--- ---", "", "a b c", "\u4eca\u65e5"]
    assert norm._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(lower(raw") == 2


def test_lines_with_one_changed_word_are_found(spark):
    line = "the quick brown foxes jumped over seventeen sleeping badgers beside another river yesterday morning"
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(4, 8)))
    data = [(1, line), (2, line.replace("river", "rivers"))]
    for k in range(60):
        w = [word() for _ in range(r.randint(8, 40))]
        data.append((10 + 2 * k, " ".join(w)))
        w[r.randrange(len(w))] = word()
        data.append((11 + 2 * k, " ".join(w)))
    docs = spark.createDataFrame(data, "doc_id bigint, text string").repartition(3)
    x, y = docs.selectExpr("doc_id a", "text x"), docs.selectExpr("doc_id b", "text y")
    similar = x.crossJoin(y).where("a < b and 100 * levenshtein(x, y) <= 20 * greatest(length(x), length(y))")
    expected = {p.b for p in similar.collect()}
    got = {g.doc_id for g in line_dedup.per_document(docs).where("n_dropped > 0").collect()}
    assert 2 in got and len(expected) > 50
    assert got <= expected and len(got) >= 0.95 * len(expected)


def test_runs_of_long_lines_come_from_every_piece(spark):
    r = random.Random(13)
    text = "".join(r.choice("abcdefgh ") for _ in range(3 * line_dedup.PIECE + 17))
    got = {x.norm: x.runs for x in line_dedup.sampled_runs(
        spark.createDataFrame([(text,), ("x" + text,), ("tiny",)], "norm string")).collect()}
    assert got["tiny"] == [] and len(got[text]) == line_dedup.SAMPLED
    assert len(set(got[text]) & set(got["x" + text])) > line_dedup.SAMPLED // 2


def test_runs_are_sampled_beside_the_votes_without_a_join(spark):
    r = random.Random(17)
    texts = ["".join(r.choice("abcdefgh ") for _ in range(n)) for n in (9, 15, 63, 64, 80, 81, 300, line_dedup.PIECE + 5)] + ["ab" * 40]
    lines = spark.createDataFrame([(t, k) for k, t in enumerate(texts)], "norm string, k int")
    found = line_dedup.sampled_runs(lines)
    got = {x.k: x.runs for x in found.collect()}  # other columns stay, no row is shuffled
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    for k, t in enumerate(texts):
        parts = [t[i:i + line_dedup.PIECE] for i in range(0, len(t), line_dedup.PIECE)]
        expected = []
        for c, (q, low, high) in enumerate(line_dedup.RUNS):
            runs = {p[i:i + q] for p in parts for i in range(len(p) - q + 1)} if low <= len(t) <= high else set()
            hashes = spark.createDataFrame([(x,) for x in runs], "x string").select(F.xxhash64("x", F.lit(c)).alias("h"))
            expected += sorted({x.h for x in hashes.collect()})[:line_dedup.SAMPLED]
        assert got[k] == expected


def test_short_lines_go_by_their_exact_form(spark):
    cjk = "今日は天気がとても良いので公園まで散歩に行きましょう"
    data = [(1, "Share this article\n\n" + cjk + "\n***"), (2, "share  this article!\n\n" + cjk[:-1] + "う。\n***\n---"),
            (3, "spam spam spam spam spam spam"), (4, "spam " * 6 + "\nspam spam\n \n" + cjk.replace("公園", "学校"))]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    got = {r.doc_id: r.dropped_lines for r in line_dedup.per_document(docs, short=True).collect()}
    assert got == {1: [], 2: [0, 2, 3], 3: [], 4: [0, 3]}
    # the registered query takes short lines in; the default leaves them, but counts characters
    got = {r.doc_id: r.dropped_lines for r in line_dedup.per_document(docs).collect()}
    assert got == {1: [], 2: [2], 3: [], 4: [0, 3]}


def test_registered_line_query_drops_short_repeats(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    norm = docs.select(F.explode(F.split("text", "\n")).alias("raw")).select(
        line_dedup.normalised(F.col("raw")).alias("norm")).where("norm <> ''")
    repeats = norm.count() - norm.distinct().count()
    got = line_dedup.op8_fuzzy_line_dedup(spark, "/root/testdata/sf0.001").agg(F.sum("n_dropped")).first()[0]
    assert got >= repeats > 0
