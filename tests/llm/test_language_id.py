"""What counts as a letter, and which columns and rows pass through a prediction."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripmill.llm import language_id


@pytest.mark.parametrize(
    "text, words",
    [("²½ Ⅷ 12", []), ("x² Ⅷb", ["x", "b"]), ("Straße 日本1", ["straße", "日本"]), ("a_b-c", ["a", "b", "c"]), ("٣ ௧", [])],
)
def test_words_are_runs_of_letters(text, words):
    assert language_id.words_of(text) == words


def made(spark):
    rows = [(k, "the cat and the dog" if k % 2 else "le chat et le chien", "en" if k % 2 else "fr") for k in range(200)]
    rows += [(1000, None, None), (1001, "", "en"), (1002, "²½ Ⅷ", "fr"), (1003, "the " * 300_000, None), (None, "le chat", "fr"), (7, "the cat", "en"), (7, "the cat", "en")]
    return spark.createDataFrame([(*r, "kept", 1) for r in rows], "doc_id long, text string, lang string, answer string, Score int")


def test_rows_pass_through(spark):
    docs = made(spark)
    model = language_id.train(docs, F.lit(True))
    found = language_id.predict(docs, model)
    assert found.columns == ["doc_id", "text", "lang", "answer", "lang_pred", "score"]
    rows = found.collect()
    assert len(rows) == docs.count() and {r.answer for r in rows} == {"kept"}
    by_id = {r.doc_id: r for r in rows}
    assert [by_id[k].lang_pred for k in (1000, 1001, 1002, 1003, None, 7)] == ["und", "und", "und", "en", "fr", "en"]
    assert by_id[1000].score == 0 and 0.9 < by_id[1003].score <= 1
    assert len({(r.lang_pred, r.score) for r in rows if r.doc_id == 7 and r.text == "the cat"}) == 1


def test_empty_tables(spark):
    docs = made(spark)
    nothing = language_id.train(docs.limit(0), F.lit(True))
    assert {r.lang_pred for r in language_id.predict(docs, nothing).collect()} == {"und"}
    model = language_id.train(docs, F.lit(True))
    assert language_id.predict(docs.limit(0), model).count() == 0


def test_ties_go_to_the_first_language():
    table = np.log(np.array([[0.5, 0.5]], dtype=np.float32))
    model = language_id.LanguageModel(["aa", "bb"], {"x": 0}, {n: {} for n in range(1, 5)}, table)
    assert model.predict("x x") == ("aa", 0.5)
