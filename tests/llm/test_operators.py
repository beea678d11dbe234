"""The corpus operators against brute force, on odd rows and on the given tables."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tripmill.llm import (
    components,
    cover_tree,
    decontaminate,
    html_content,
    language_id,
    quality_fm,
    recurrent_lm,
    sentencepiece_codec,
    simhash,
    suffix_dedup,
    warc,
)
from tripmill.llm.queries import ORACLE_SQL, QUERIES
from tripmill.llm.shared import fold_is, tokenizer_file

SMALL = "/root/testdata/sf0.001"
ODD = [None, "", " \n\t", "a", "Ä é 日本", "one two three four five six", "one two three four five six", "x" * 3000, "ab " * 900, "1 2 3 !!"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(k, text, "en" if k % 2 else None, "s", None, 1.0) for k, text in enumerate(ODD)]
    rows += [(None, "null key here", "en", None, 3, 2.0), (3, "a", "en", "s", 1, 0.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, Score double")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def roots(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return [find(x) for x in range(n)]


def test_components(spark):
    r = random.Random(1)
    links = [(k, k + 1) for k in range(40)] + [(r.randrange(100, 300), r.randrange(100, 300)) for _ in range(90)]
    found = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    want = roots(300, links)
    assert len({row.node for row in found}) == len(found)
    assert all(want[row.node] == row.root for row in found)
    assert {row.node for row in found} == {x for a, b in links if a != b for x in (a, b)}


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_bit_sliced_distances(radius):
    r = np.random.default_rng(radius)
    base = r.integers(0, 2**63, 60, dtype=np.uint64)
    flips = [np.uint64(0), np.uint64(1), np.uint64(6), np.uint64(1 << 63), np.uint64(7)]
    values = np.unique(np.concatenate([base ^ f for f in flips]))
    got = {(i, j) for a, b in simhash.within(values, radius) for i, j in zip(a.tolist(), b.tolist())}
    assert got == {(i, j) for i in range(len(values)) for j in range(len(values)) if (int(values[i]) ^ int(values[j])).bit_count() <= radius}


def test_large_buckets_give_the_same_components(spark, monkeypatch):
    r = np.random.default_rng(5)
    base = r.integers(0, 2**63, 20, dtype=np.uint64)
    values = np.unique(np.concatenate([base ^ np.uint64(m) for m in (0, 1, 3, 7, 15, 1 << 40)]))
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    results = []
    for most in (2048, 1):
        monkeypatch.setattr(simhash, "MOST_IN_BUCKET", most)
        results.append(sorted(map(tuple, components.components(simhash.links_within(frame, 2)).collect())))
    assert results[0] == results[1] and len(results[0]) > 20


def simhash_of(text):
    words = (text or "").encode().lower().split()
    pieces = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in pieces]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark, odd, documents):
    for frame in (odd, documents.limit(0), documents):
        rows = frame.select("doc_id", "text").collect()
        marks = [simhash_of(row.text) for row in rows]
        links = [(i, j) for i in range(len(rows)) for j in range(i) if (marks[i] ^ marks[j]).bit_count() <= 2]
        group = roots(len(rows), links)
        least = {}
        for row, g in zip(rows, group):
            if row.doc_id is not None:
                least[g] = min(least.get(g, row.doc_id), row.doc_id)
        want = Counter((row.doc_id, f"{m:016x}", least.get(g)) for row, m, g in zip(rows, marks, group))
        got = simhash.near_duplicates(frame).withColumn("fingerprint", simhash.hex_digits("fingerprint"))
        assert Counter(map(tuple, got.select("doc_id", "fingerprint", "component_id").collect())) == want
    kept = simhash.keep_one_of_each(odd)
    assert kept.columns == odd.columns and kept.where("doc_id is null").count() == 1


def covered(texts, length):
    seen = Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        out.append(gone)
    return out


def test_suffix_dedup(spark, odd):
    r = random.Random(3)
    passage = "".join(r.choice("abcdé ") for _ in range(700))
    rows = [(k, t) for k, t in enumerate(ODD)]
    for k in range(30):
        low, n = r.randrange(300), r.choice([150, 199, 200, 201, 250, 400])
        edge = "".join(r.choice("xyz ") for _ in range(r.randrange(300)))
        rows.append((100 + k, edge + passage[low : low + n] + edge[::-1]))
    rows += [(200, passage), (201, passage)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {row.doc_id: row for row in suffix_dedup.remove_repeated(frame).collect()}
    texts = [(t or "").encode() for _, t in rows]
    for (key, _), text, gone in zip(rows, texts, covered(texts, 200)):
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        left = bytes(b for b, g in zip(text, gone) if not g)
        assert (got[key].n_bytes, got[key].n_removed, got[key].n_spans, bytes(got[key].kept)) == (len(text), sum(gone), spans, left)
    assert suffix_dedup.remove_repeated(frame.limit(0)).count() == 0
    kept = suffix_dedup.without_repeats(odd)
    assert kept.columns == odd.columns and kept.count() == odd.count() and kept.where("text is null").count() == 1


def test_the_cover_holds_every_difference():
    cover = suffix_dedup.COVER.tolist()
    assert {(a - b) % suffix_dedup.PERIOD for a in cover for b in cover} == set(range(suffix_dedup.PERIOD))


def test_codec_equals_the_library(spark, odd):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file())
    r = random.Random(0)
    texts = [t or "" for t in ODD] + ["  a  b ", "▁x ▁", "ababab" * 200]
    texts += ["".join(r.choice("abcde é日\n the ing") for _ in range(r.randint(1, 60))) for _ in range(800)]
    tool = sentencepiece_codec.codec(tokenizer_file())
    found = tool.encode(texts)
    assert [f.tolist() for f in found] == library.encode(texts)
    assert [tool.decode(f) for f in found] == [library.decode(f.tolist()) for f in found]
    coded = sentencepiece_codec.decode(sentencepiece_codec.encode(odd, tokenizer_file()), tokenizer_file())
    assert all(row.decoded == row.text for row in coded.collect())
    assert sentencepiece_codec.encode(odd.limit(0), tokenizer_file()).count() == 0


def test_unigram_search_finds_the_best_path():
    tool = sentencepiece_codec.Codec(tokenizer_file())
    tool.kind = 1

    def best(word):
        total = [0.0] + [-math.inf] * len(word)
        for end in range(1, len(word) + 1):
            for start in range(end):
                k = tool.ids.get(word[start:end])
                if k is not None:
                    total[end] = max(total[end], total[start] + tool.scores[k])
        return total[-1]

    words = ["▁thering", "▁nationale", "▁zzyx", "abcabcabcabc"]
    for word, ids in zip(words, (np.frombuffer(tool._search([w])[0], np.int32).tolist() for w in words)):
        assert "".join(tool.texts[k] for k in ids) == word
        assert sum(tool.scores[k] for k in ids) == pytest.approx(best(word))


def test_embedding_dedup(spark):
    r = np.random.default_rng(2)
    base = r.normal(size=(60, 8))
    vectors = [b + r.normal(size=8) * s for b in base for s in (0, 0, 0.1, 0.3)]
    rows = [(k, [float(x) for x in np.float32(v)]) for k, v in enumerate(vectors)]
    rows += [(900, None), (901, []), (902, [0.0] * 8), (903, [float("nan")] * 8), (904, [None] * 8), (None, rows[0][1])]
    got = cover_tree.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), tree_size=40)
    got = Counter(map(tuple, got.collect()))
    real = [v for k, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    at = [i for i, (k, v) in enumerate(rows) if v in real]
    unit = np.array([rows[i][1] for i in at])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    links = [(at[i], at[j]) for i, j in zip(*np.nonzero(near))]
    group, count = roots(len(rows), links), Counter(a for a, _ in links)
    least = {}
    for (key, _), g in zip(rows, group):
        if key is not None:
            least[g] = min(least.get(g, key), key)
    want = Counter((key, count[i], least[group[i]], key == least[group[i]]) for i, (key, _) in enumerate(rows))
    assert got == want


def test_language_and_quality(spark, odd, documents):
    learn = ~fold_is(F.col("doc_id"), 3, 1)
    model = language_id.train(documents, learn)
    found = language_id.predict(documents, model)
    assert found.where("lang = lang_pred").count() > 0.97 * documents.count()
    rows = {row.doc_id: row for row in language_id.predict(odd, model).collect()}
    assert all(rows[k].lang_pred == "und" and rows[k].score == 0 for k in (0, 1, 2)) and rows[5].lang_pred != "und"
    assert language_id.predict(odd, language_id.train(odd, F.lit(False))).where("lang_pred = 'und'").count() == odd.count()
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    quality = quality_fm.train(documents, labels, learn)
    scored = quality_fm.score(documents, quality).join(labels, "doc_id").where(~learn)
    assert scored.where("predicted = quality").count() >= 0.8 * scored.count()
    assert quality_fm.score(odd, quality).where("score between 0 and 1").count() == odd.count()
    nothing = quality_fm.train(documents, labels.limit(0), learn)
    assert {row.score for row in quality_fm.score(odd, nothing).collect()} == {0.5}


def test_pairwise_sum_in_linear_time():
    r = np.random.default_rng(0)
    model = quality_fm.FactorisationMachine(np.zeros((0, 15)), 0.5, r.normal(size=9), r.normal(size=(9, 3)))
    places, values = np.array([1, 4, 7, 8]), r.normal(size=4)
    pairs = sum(model.factors[places[i]] @ model.factors[places[j]] * values[i] * values[j] for i in range(4) for j in range(i))
    assert model.margin(places, values) == pytest.approx(0.5 + model.weights[places] @ values + pairs)


def test_marginals_equal_enumeration():
    from itertools import product

    model = html_content.train(html_content.labelled_pages())
    nodes = html_content.Nodes()
    html_content.parse("<div class=ad><p>One.</p><ul><li><a href=x>two</a></ul></div><p>Three", 0, nodes)
    n = len(nodes.parent)
    weight = np.zeros((n, 2))
    for y in product((0, 1), repeat=n):
        total = model.root[y[0]]
        for at in range(n):
            total += sum(model.unary[f][y[at]] for f in html_content.features(nodes, at, html_content.Shape.of(nodes)) if f in model.unary)
            if at:
                total += model.edge(nodes.tag[nodes.parent[at]], nodes.tag[at])[y[nodes.parent[at]], y[at]]
        for at in range(n):
            weight[at, y[at]] += math.exp(total)
    assert model.marginals(nodes) == pytest.approx(weight[:, 1] / weight.sum(axis=1))


def test_html_text(spark):
    page = """<html><head><title>t</title></head><body><nav><a href=/>Home</a></nav><div class="cookie-consent"><p>We use cookies here.</p></div>
    <article><h1>A &amp; B</h1><p>First\n  <b>bold</b> words of a long enough text, with a stop.<p>Second &eacute; text that goes on.<script>var x = "<p>no</p>";</script></article>
    <section id="comments"><p>Great article, thank you very much!</p></section><footer>&copy; me</footer></body></html>"""
    rows = [(1, "u", page, 5), (2, None, None, 6), (3, "u", "", 7), (3, "u", page, 8), (4, "u", "<<<p>a</b", 9)]
    got = html_content.extract(spark.createDataFrame(rows, "page_id long, url string, html string, N_Chars int"))
    texts = [(row.page_id, row.text, row.n_chars) for row in got.collect()]
    want = "A & B\n\nFirst bold words of a long enough text, with a stop.\n\nSecond é text that goes on."
    assert texts[:4] == [(1, want, len(want)), (2, "", 0), (3, "", 0), (3, want, len(want))]


def test_warc(spark):
    rows = [(1, "u", "é" * 60), (2, "u\nv", "é" * 60), (3, None, "short"), (4, "u", "short"), (5, "u", None), (None, "u", "é" * 60), (1, "w", "é" * 60)]
    rows += [(9, "u", "WARC/1.1\r\n\r\n\r\n\r\nx" * 9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = Counter(map(tuple, warc.round_trip(pages).collect()))
    want = Counter()
    for key, _, html in rows:
        data = (html or "").encode()
        again = key == 2
        want[(key, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", 1 if again else None)] += 1
    assert got == want
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_recurrent_lm(spark, odd):
    network = recurrent_lm.Network.start(np.arange(1.0, recurrent_lm.WORDS + 1))
    r = np.random.default_rng(0)
    documents = [r.integers(0, recurrent_lm.WORDS, n).astype(np.int32) for n in (70, 9, 3, 1, 0, 30)]
    together = recurrent_lm.score_documents(network, documents, width=2)
    assert together == pytest.approx([recurrent_lm.score_documents(network, [d])[0] for d in documents])
    again = [documents[0][:30]] * 40
    trained = network
    for _ in range(15):
        trained = recurrent_lm.train_on(trained, again, rate=0.02)
    assert recurrent_lm.score_documents(trained, again)[0] > recurrent_lm.score_documents(network, again)[0] + 5
    learn = ~fold_is(F.col("doc_id"), 5, 1)
    got = recurrent_lm.score(odd, learn).collect()
    rows = odd.select("doc_id", "text").collect()
    cut = [[*(row.text or "").encode().lower().split(), None] for row in rows]
    held = [row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 5 == 1 for row in rows]
    counts = Counter(w for words, h in zip(cut, held) if not h for w in words)
    n, mass = sum(counts.values()), sum(counts.values()) + 0.5 * (len(counts) + 1)
    want = sorted((str(row.doc_id), len(w), sum(counts[x] > 0 for x in w), n, round(sum(math.log10((counts[x] + 0.5) / mass) for x in w), 6)) for row, w in zip(rows, cut))
    assert sorted((str(g.doc_id), g.n_tokens, g.n_known, g.train_tokens, round(g.base_score, 6)) for g in got) == want
    assert all(g.score < 0 and math.isfinite(g.score) for g in got)


def test_decontamination(spark, odd):
    items = [(1, "one two three four five six"), (2, "one two three four five nine"), (3, None), (4, " "), (5, "A"), (1, "one two three four five six")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.n_found) for r in decontaminate.contaminated(odd, frame).collect()}
    assert got == {(5, 1, 2), (6, 1, 2), (3, 5, 1)}
    kept = decontaminate.drop_contaminated(odd, frame)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 4
    assert decontaminate.contaminated(odd, frame.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SMALL).toPandas()
    want = duck(SMALL).execute(ORACLE_SQL[name]).df()
    columns = sorted(got.columns)
    as_text = lambda f: sorted(tuple(str(x).removesuffix(".0").replace("<NA>", "nan") for x in row) for row in f[columns].values)
    assert as_text(got) == as_text(want)


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = None
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SMALL)
        assert before is None or name == "sentencepiece" or after.columns == before
        docs, before = spark.createDataFrame(after.toArrow()), after.columns
    assert docs.where("not round_trip").count() == 0 and docs.count() > 150
