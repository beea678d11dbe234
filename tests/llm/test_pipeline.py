"""Each stage of the pipeline, on all that its predecessor kept, against brute force."""

from __future__ import annotations

import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import covered, roots, simhash_of
from tripmill import storage
from tripmill.llm import decontaminate, language_id
from tripmill.llm.shared import settle, scratch, tokenizer_file
from tripmill.session import new_folder

SMALL = "/root/testdata/sf0.001"


def words(text):
    return (text or "").lower().split()


def shingles(text):
    own = words(text)
    return {tuple(own[k : k + 5]) for k in range(max(1, len(own) - 4))} if own else set()


def after_languages(spark, rows):
    model = language_id.train(spark.read.parquet(f"{SMALL}/documents.parquet"), F.lit(True))
    found = {r.doc_id: model.predict(r.text) for r in rows}
    return [r for r in rows if found[r.doc_id][0] != "und" and found[r.doc_id][1] >= corpus_pipeline.LEAST_SHARE]


def after_near_duplicates(spark, rows):
    marks = [simhash_of(r.text) for r in rows]
    group = roots(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (marks[i] ^ marks[j]).bit_count() <= 2])
    least = {}
    for row, g in zip(rows, group):
        least[g] = min(least.get(g, row.doc_id), row.doc_id)
    return [r for r, g in zip(rows, group) if r.doc_id == least[g]]


def after_passages(spark, rows):
    gone = covered([r.text.encode() for r in rows], 200)
    texts = [bytes(b for b, g in zip(r.text.encode(), own) if not g).decode("utf-8", "ignore") for r, own in zip(rows, gone)]
    assert any(any(own) for own in gone)
    return [{**r.asDict(), "text": t, "n_chars": len(t)} for r, t in zip(rows, texts)]


def after_test_items(spark, rows):
    items = [shingles(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    clean = [r for r in rows if not any(i and len(i & shingles(r.text)) >= 0.8 * len(i) - 1e-9 for i in items)]
    return clean


def after_tokens(spark, rows):
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file())
    out = []
    for r in rows:
        ids = library.encode(r.text)
        out.append({"doc_id": r.doc_id, "lang": r.lang, "source": r.source, "n_tokens": len(ids), "token_ids": ids, "round_trip": True})
    return out


def test_stages(spark):
    wanted = [after_languages, after_near_duplicates, after_passages, after_test_items, after_tokens]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    for (name, stage), want in zip(corpus_pipeline.STAGES, wanted, strict=True):
        rows = docs.collect()
        after = settle(stage(spark, docs, SMALL), name)
        expected = [r if isinstance(r, dict) else r.asDict() for r in want(spark, rows)]
        got = sorted((r.asDict() for r in after.collect()), key=lambda r: r["doc_id"])
        assert got == sorted(expected, key=lambda r: r["doc_id"]), name
        assert name == "sentencepiece" or after.columns == columns
        docs = after
    assert 100 < docs.count() < 200


def test_run_leaves_its_last_rows_only(spark):
    base = storage.entries(spark, new_folder(spark, "x").rsplit("/", 1)[0])
    found = corpus_pipeline.run(spark, SMALL)
    left = {e.name for e in storage.entries(spark, new_folder(spark, "x").rsplit("/", 1)[0])} - {e.name for e in base}
    assert len(left) == 1 and next(iter(left)).startswith("sentencepiece-")
    assert found.count() > 100


def test_odd_documents(spark, tmp_path):
    rows = [
        (1, None, "en", "s", None), (2, "", None, None, 0), (3, " \n", "en", "s", 2), (4, "²½", "fr", "s", 2),
        (5, "the cat and the dog sat on the wall " * 3, "en", None, None), (5, "the cat and the dog sat on the wall " * 3, "en", None, None),
        (6, "le chat et le chien " * 4, "fr", "s", 1), (None, "the end of the road and more of the same", "en", "s", 5),
        (7, "the " * 250_000, "en", "s", 1_000_000), (8, "x" * 100_000, "en", "s", 3),
    ]
    frame = spark.createDataFrame([(*r, "kept") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, answer string")
    spark.createDataFrame([(1, "of the road and more of the same"), (None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (frame, frame.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            after = settle(stage(spark, docs, str(tmp_path)), name)
            if name != "sentencepiece":
                assert after.columns == frame.columns
                docs = after
    assert after.count() == 0


@pytest.mark.parametrize("in_plan", [50_000, 0])
def test_decontamination_with_a_small_and_a_large_sketch(spark, monkeypatch, in_plan):
    monkeypatch.setattr(decontaminate, "IN_PLAN", in_plan)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    repeated = docs.union(docs.limit(3)).withColumn("Item_id", F.lit("kept")).withColumn("row", F.lit(1))
    got = {(r.doc_id, r.item_id, r.n_found, r.n_shingles) for r in decontaminate.contaminated(repeated, items).collect()}
    held = {r.doc_id: shingles(r.text) for r in docs.collect()}
    want = set()
    for item in items.collect():
        own = shingles(item.text)
        for doc_id, theirs in held.items():
            if own and len(own & theirs) >= 0.8 * len(own) - 1e-9:
                want.add((doc_id, item.item_id, len(own & theirs), len(own)))
    assert got == want and want


def test_scratch_ends_with_its_work(spark):
    with scratch(spark):
        inside = settle(spark.range(3), "inside")
        folder = inside.inputFiles()[0].rsplit("/", 1)[0]
        assert storage.exists(spark, folder)
    assert not storage.exists(spark, folder)
