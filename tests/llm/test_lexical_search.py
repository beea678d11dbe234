"""Ranked search against a score for every pair, in plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tripmill.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_force(docs, items, best):
    counted = [(key, Counter(terms(text))) for key, text in docs]
    sizes = [sum(c.values()) for _, c in counted]
    n_docs, n_terms = sum(s > 0 for s in sizes), sum(sizes)
    held = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for (key, c), n in zip(counted, sizes):
            score = 0
            for t in set(terms(text)) & c.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1)))
                score += w * (10**9 * c[t] // (1000 * c[t] + 20 * (50 + 50 * n * n_docs // n_terms)))
            if score > 0:
                scores.append((-score, key is None, key or 0))
        for rank, (score, no_key, key) in enumerate(sorted(scores)[:best], 1):
            out.append((item, rank, None if no_key else key, -score))
    return sorted(out, key=str)


def made(n, seed):
    r = random.Random(seed)
    words = [f"W{k}" for k in range(40)] + [f"rare{k}é" for k in range(400)] + ["Été", "日本", "a1b2"]
    weights = [1 / (k + 1) for k in range(len(words))]
    return [" ".join(r.choices(words, weights, k=r.choice([1, 3, 20, 80]))) for _ in range(n)]


ODD = [None, "", " \n", "!!! ...", "w0", "W0", "w0,w0;W0", "Ünï-cödé x_y", "a\x00b", "²½ Ⅷ"]


@pytest.mark.parametrize("together, full", [(300_000, 1024), (60, 7)])
def test_ranks(spark, monkeypatch, together, full):
    monkeypatch.setattr(ls, "SHARD_DOCS", full)
    docs = [(k * 7 % 1000, t) for k, t in enumerate(ODD + made(250, 1))]
    docs += [(None, "w1 rare3é"), (None, "w1 rare3é"), (5, "w1 rare3é"), (5, "w1 rare3é"), (900, "w1 rare3é"), (901, "w0 " * 400_000)]
    items = [(k, t) for k, t in enumerate(ODD + made(25, 2))] + [(3, "w1 again"), (3, "w1 again"), (None, "rare3é")]
    frame = spark.createDataFrame([(k, t, 1, "x") for k, t in docs], "doc_id long, text string, score int, `Item_id` string")
    asked = spark.createDataFrame([(k, t, 1) for k, t in items], "item_id long, text string, rank int")
    for best in (50, 3):
        got = ls.rank(frame.repartition(5), asked, best=best, together=together)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, got.collect()), key=str) == brute_force(docs, items, best)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert ls.rank(docs.limit(0), items).count() == 0
    assert ls.rank(docs, items.limit(0)).count() == 0
    assert ls.rank(docs.where("doc_id = 2"), items).count() == 0
    assert [tuple(r)[:3] for r in ls.rank(docs, items).collect()] == [(1, 1, 1)]


def test_long_texts_are_cut_between_terms(monkeypatch):
    text = "ab " * 300 + "x" * 5000 + " é" * 200
    whole = [t.encode() for t in terms(text)]
    for piece in (1, 7, 100, 1 << 20):
        monkeypatch.setattr(ls, "_PIECE", piece)
        assert [t for part in ls.terms_of(text.encode()) for t in part] == whole


def shard_of(docs, vocabulary):
    place = {t: k for k, t in enumerate(vocabulary)}
    counted = [Counter(place[t] for t in terms(text) if t in place) for text in docs]
    counted = [(k, c) for k, c in enumerate(counted) if c]
    return {
        "ids": np.array([k for k, _ in counted]),
        "sizes": np.array([len(terms(docs[k])) for k, _ in counted]),
        "ends": np.cumsum([len(c) for _, c in counted]).astype(np.int32),
        "terms": np.concatenate([np.array(sorted(c), np.int32) for _, c in counted]),
        "counts": np.concatenate([np.array([c[t] for t in sorted(c)], np.int32) for _, c in counted]),
    }


@pytest.mark.parametrize("block_docs", [1, 4, 32])
def test_blocks(monkeypatch, block_docs):
    monkeypatch.setattr(ls, "BLOCK_DOCS", block_docs)
    docs = made(600, 5)
    docs += [docs[0] + f" copy{k % 3}" for k in range(60)]
    vocabulary = sorted({t for d in docs for t in terms(d)})
    weights = np.array([1 + len(v) * 100 for v in vocabulary])
    shard = shard_of(docs, vocabulary)
    items = [np.array(sorted({random.Random(seed).randrange(len(vocabulary)) for _ in range(9)})) for seed in range(8)]
    partners = ls.Partners(items, len(vocabulary))
    built = ls._blocks(shard, weights, len(docs), 9000, partners)
    postings = {(int(t), int(d)) for t, d in zip(built["terms"], np.repeat(np.arange(len(shard["ids"])), np.diff(shard["ends"], prepend=0)))}
    blocks = np.split(built["block_docs"], built["block_ends"])[:-1]
    assert {(int(t), int(d)) for t, b in zip(built["block_terms"], blocks) for d in b} == postings
    assert sum(map(len, blocks)) == len(postings)
    values = {}
    for d, (low, high) in enumerate(zip(built["ends"] - np.diff(built["ends"], prepend=0), built["ends"])):
        values[d] = dict(zip(built["terms"][low:high].tolist(), built["values"][low:high].tolist()))
    for own, b, top_t, top_v in zip(built["block_terms"].tolist(), blocks, np.split(built["top_terms"], built["top_ends"]), np.split(built["top_values"], built["top_ends"])):
        if len(b) > 1:
            beside = {own}.union(*(i.tolist() for i in items if own in i))
            want = {t: max(values[d].get(t, 0) for d in b) for d in b for t in values[d].keys() & beside}
            assert dict(zip(top_t.tolist(), top_v.tolist())) == want
    passed = 0
    for item in items:
        exact = {d: sum(int(weights[t]) * v.get(t, 0) for t in item.tolist()) for d, v in values.items()}
        ranked = sorted((-s, int(shard["ids"][d])) for d, s in exact.items() if s > 0)[:10]
        for least in (0, -ranked[-1][0], -ranked[0][0]):
            top = ls._Best(least, 10)
            passed += ls.search_shard(built, weights, [item], [top])
            assert [(-s, i) for s, i in zip(top.scores.tolist(), top.ids.tolist())] == [x for x in ranked if -x[0] >= least]
    assert passed > 0 or block_docs == 1


def test_similar_documents_share_blocks():
    docs = [("apple pear plum " if k % 2 else "iron steel zinc ") * 3 + "common" for k in range(200)]
    vocabulary = sorted({t for d in docs for t in terms(d)})
    built = ls._blocks(shard_of(docs, vocabulary), np.full(len(vocabulary), 1000), 200, 2000, ls.Partners([], len(vocabulary)))
    blocks = [b for t, b in zip(built["block_terms"], np.split(built["block_docs"], built["block_ends"])) if vocabulary[t] == "common"]
    assert all(len({d % 2 for d in b.tolist()}) == 1 for b in blocks)
