import functools
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from lakestar.llm import perplexity, pitman_yor, quality_classifier
from lakestar.llm.scratch import Scratch
from tests.llm.helpers import empty, messy, rows, words

SF = "/root/testdata/sf0.01"


def test_base_scores_against_brute_force(spark):
    got = pitman_yor.model_scores(messy(spark)).collect()
    data = [(x[0], [*words(x[1]), "</s>"]) for x in rows()]
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    c = Counter(w for i, ws in data if not out(i) for w in ws)
    n, v = sum(c.values()), len(c)
    expected = Counter((i, out(i), len(ws), sum(c[w] > 0 for w in ws), n, round(
        sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 4)) for i, ws in data)
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == expected
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert pitman_yor.model_scores(empty(spark)).count() == 0


def test_held_out_texts_are_predicted_better_than_by_words(spark):
    got = pitman_yor.model_scores(spark.read.parquet(f"{SF}/documents.parquet")).toPandas()
    held = got[got.held_out]
    per_token = held.score.sum() / held.n_tokens.sum()
    assert per_token > held.base_score.sum() / held.n_tokens.sum() + 0.5
    assert (held.score > held.base_score).mean() > 0.9


def test_seating_keeps_its_books_and_its_mean():
    rng = np.random.default_rng(0)
    count = rng.integers(0, 9, 4000)
    room = rng.integers(0, 50, 4000)
    s = pitman_yor.Seating(count, room, 50, np.full(4000, 0.01), 0.5, 1.0, 1)
    for _ in range(30):
        s.sweep()
    for i, b in enumerate(s.busy):
        own = slice(s.first[i], s.first[i] + count[b])
        assert s.size[own].sum() == count[b] and (s.size[own] > 0).sum() == s.tables[b]
        assert (np.bincount(s.table[own], minlength=count[b]) == s.size[own]).all()
    assert (s.tables[count == 1] == 1).all() and (s.tables[count == 0] == 0).all()
    # two customers of one dish: alone in their restaurant, they share with chance (1 - d) / (1 - d + (s + d) p)
    n = 20000
    s = pitman_yor.Seating(np.full(n, 2), np.arange(n), n, np.full(n, 0.5), 0.5, 1.0, 2)
    for _ in range(20):
        s.sweep()
    apart = (1.0 + 0.5) * 0.5 / (1 - 0.5 + (1.0 + 0.5) * 0.5)
    assert abs((s.tables == 2).mean() - apart) < 0.02


def plain_tables(counts, parent, d, strength, sweeps, burn, seed):
    """Mean tables of each dish of one restaurant, customer by customer with a list of tables a dish."""
    rng = np.random.default_rng(seed)
    tables = [[1] * c for c in counts]  # everyone alone at first
    total, seen = sum(counts), np.zeros(len(counts))
    for sweep in range(sweeps):
        for w, own in enumerate(tables):
            for _ in range(counts[w]):
                i = rng.choice(len(own), p=np.array(own) / sum(own))
                own[i] -= 1
                if not own[i]:
                    own.pop(i)
                    total -= 1
                weights = np.array([x - d for x in own] + [(strength + d * total) * parent[w]])
                i = rng.choice(len(weights), p=weights / weights.sum())
                if i == len(own):
                    own.append(1)
                    total += 1
                else:
                    own[i] += 1
        if sweep >= burn:
            seen += [len(x) for x in tables]
    return seen / (sweeps - burn)


def test_tables_against_a_plain_sampler():
    counts, parent = [1, 2, 3, 5, 8, 13, 40], np.array([0.05, 0.1, 0.02, 0.2, 0.03, 0.3, 0.3])
    plain = plain_tables(counts, parent, 0.8, 1.0, 1500, 100, 3)
    k = 300  # as many restaurants side by side
    s = pitman_yor.Seating(np.tile(counts, k), np.repeat(np.arange(k), len(counts)), k, np.tile(parent, k), 0.8, 1.0, 4)
    got = np.zeros(len(counts))
    for sweep in range(30):
        s.sweep()
        if sweep >= 10:
            got += s.tables.reshape(k, -1).mean(0) / 20
    assert np.allclose(got, plain, rtol=0.06, atol=0.08), (got, plain)


@functools.cache
def ways_to_sit(c, d):
    """Logarithms of the numbers of ways in which c customers sit at 0 to c tables."""
    t = np.arange(c + 1.0)
    ways = np.full(c + 1, -np.inf)
    ways[1] = 0.0
    with np.errstate(divide="ignore"):
        for n in range(1, c):
            ways = np.logaddexp(np.r_[-np.inf, ways[:-1]], np.log(np.maximum(n - d * t, 0)) + ways)
    return t, ways


def exact_tables(c, rest, parent, d, strength):
    """Mean and variance of the tables of c customers given the rest."""
    t, ways = ways_to_sit(c, d)
    weight = ways + np.r_[0, np.cumsum(np.log((strength + d * (rest + t[:-1])) * parent))]
    p = np.exp(weight - weight.max())
    p /= p.sum()
    return (p * t).sum(), (p * t * t).sum() - (p * t).sum() ** 2


def test_large_counts_are_drawn_from_their_conditional():
    cases = [(c, rest, parent) for c in (129, 1000, 4000) for rest in (3, 300, 20000) for parent in (1e-5, 0.001, 0.02, 0.3)]
    counts, rest, parent = (np.array(x) for x in zip(*cases, strict=True))
    for d, strength in (pitman_yor.CONTEXT, pitman_yor.PARENT):
        mean, var = pitman_yor.large_tables(counts, rest, parent, np.ones(len(counts)), d, strength)
        for i, (c, r, p) in enumerate(cases):
            m, v = exact_tables(c, r, p, d, strength)
            assert abs(mean[i] - m) <= 0.03 * m + 1.5, (c, r, p)
            assert v < 1 or 0.5 < var[i] / v < 2, (c, r, p)  # under one table the normal is rounded away
    k = 400  # the draws themselves: as many restaurants, each with 3,000 customers of one word and 50 words once
    count = np.tile(np.r_[3000, np.ones(50, int)], k)
    s = pitman_yor.Seating(count, np.repeat(np.arange(k), 51), k, np.full(51 * k, 0.2), 0.8, 1.0, 6)
    s.sweep()
    m, v = exact_tables(3000, 50, 0.2, 0.8, 1.0)
    drawn = s.tables.reshape(k, -1)[:, 0]
    assert abs(drawn.mean() - m) < 0.1 * m and 0.6 < drawn.var() / v < 1.6


def test_kneser_ney_probabilities_add_up():
    text = "the cat sat on the mat and the dog sat on the log".encode() * 3
    texts = pa.array([text.decode()], pa.large_string())
    from lakestar.llm import words as W
    gram, n = np.unique(perplexity.trigrams(*W.raw(texts)), return_counts=True)
    model = perplexity.Model(gram, n)
    for a, b in ((ord("t"), ord("h")), (ord("q"), ord("x")), (0, 0), (ord("x"), ord("a"))):
        codes = (a << 16) | (b << 8) | np.arange(256)
        assert abs((10 ** model.log10(codes)).sum() - 1) < 1e-6


def test_rules_against_brute_force(spark):
    got = perplexity.judged(messy(spark)).collect()
    expected = Counter()
    import re
    for x in rows():
        t = x[1] or ""
        w = [y for y in re.split("[\x20\x09-\x0d]+", t) if y]
        c = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
        covered = {j for k in range(len(w) - 4) if c[tuple(w[k:k + 5])] > 1 for j in range(k, k + 5)}
        seen, dup = set(), 0
        for line in t.split("\n"):
            if re.search("[^\x20\x09-\x0d]", line):
                dup += line in seen
                seen.add(line)
        failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
        expected[(x[0], len(w), sum(map(len, w)), sum(y in "#*$%&|<>" for y in t), dup, len(covered), failed)] += 1
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                   for r in got) == expected
    for r in got:
        inside = r.lower is not None and r.log10_perplexity is not None and r.lower <= r.log10_perplexity <= r.upper
        assert r.kept == (not r.base_failed and inside)
    assert perplexity.judged(empty(spark)).count() == 0


def kneser_ney(texts, order):
    """log10 of each text's probability by modified Kneser-Ney over bytes, straight from the formulas."""
    grams = Counter((b"\0" * (order - 1) + t)[i:i + order] for t in texts for i in range(len(t)))
    levels = {order: grams}
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    cut = {}
    for k, c in levels.items():
        n1, n2, n3, n4 = (sum(v == x for v in c.values()) for x in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 else 0
        cut[k] = [0, 0.5, 0.75, 0.9] if min(n1, n2, n3) == 0 else [
            0, *(min(max(x - (x + 1) * y * b / a, 0), x - 0.01) for x, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4)))]
    rest = {k: defaultdict(list) for k in levels}
    for k, c in levels.items():
        for g, n in c.items():
            rest[k][g[:-1]].append(n)

    def p(g):
        if not g:
            return 1 / 256
        own, d = rest[len(g)][g[:-1]], cut[len(g)]
        n = levels[len(g)][g]
        return (n - d[min(n, 3)] + sum(d[min(x, 3)] for x in own) * p(g[1:])) / sum(own)

    return [sum(math.log10(p((b"\0" * (order - 1) + t)[i:i + order])) for i in range(len(t))) for t in texts]


def test_perplexity_is_that_of_six_byte_kneser_ney(spark):
    data = rows()
    docs = messy(spark).selectExpr("doc_id id", "coalesce('=' || lang, '') key", "coalesce(text, '') text")
    got = perplexity.measured(docs, perplexity.fit(Scratch(spark, "test"), docs, 5), 5).collect()
    assert len(got) == len(data) and sum(r.log10_p < -100 for r in got) > 30
    expected = Counter()
    for lang in {x[2] for x in data}:
        own = [x for x in data if x[2] == lang]
        for x, log in zip(own, kneser_ney([(x[1] or "").encode() for x in own], perplexity.ORDER), strict=True):
            expected[(x[0], len((x[1] or "").encode()), round(log, 0))] += 1
    for r in got:
        near = [k for k in expected if k[:2] == (r.id, r.n_bytes) and abs(k[2] - r.log10_p) <= 0.5 + 2e-4 * r.n_bytes]
        assert near, r


def test_perplexity_rejects_bad_documents_many_times_as_often(spark):
    got = perplexity.judged(spark.read.parquet(f"{SF}/documents.parquet"))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    told = got.join(labels, "doc_id").where("not base_failed").toPandas()
    bad, clean = ((~told.kept)[told.quality == q].mean() for q in (0, 1))
    assert bad > 0.3 and bad > 10 * clean


def test_perplexity_bands_keep_clean_documents(spark):
    got = perplexity.judged(spark.read.parquet(f"{SF}/documents.parquet"))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    clean = got.join(labels, "doc_id").where("quality = 1 and not base_failed").toPandas()
    assert clean.kept.mean() > 0.97


def test_classifier_on_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    x = quality_classifier.described(docs)
    model = quality_classifier.train(x, labels)
    got = quality_classifier.scored(x, model).toPandas().merge(labels.toPandas(), left_on="id", right_on="doc_id")
    held = got[[zlib.crc32(str(i).encode()) % 5 == 0 for i in got.id]]
    assert len(held) > 50 and ((held.score >= 0.3) == (held.quality == 1)).mean() > 0.97
    d = len(quality_classifier.NAMES)
    assert [np.allclose(a @ np.linalg.inv(a), np.eye(d)) for a in model.whiten] == [True, True]
    kept = quality_classifier.accepted(docs, model)
    assert kept.columns == docs.columns and kept.count() == int((
        quality_classifier.scored(x, model).toPandas().score >= 0.3).sum())


def test_classifier_on_messy_rows(spark):
    docs = messy(spark)
    labels = spark.createDataFrame([(0, 1), (3, 1), (54, 0), (57, 0), (None, 1), (6, None), (9, 5)],
                                   "doc_id bigint, quality int")
    x = quality_classifier.described(docs)
    for told in (labels, labels.where("quality = 1"), labels.limit(0)):
        got = quality_classifier.scored(x, quality_classifier.train(x, told)).collect()
        assert len(got) == len(rows()) and all(0 <= r.score <= 1 for r in got)
    assert quality_classifier.accepted(empty(spark), quality_classifier.train(x, labels)).count() == 0
    assert quality_classifier.described(empty(spark)).count() == 0
