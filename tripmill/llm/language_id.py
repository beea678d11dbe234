"""Language identification: known words first, shorter and shorter character n-grams for the others."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.shared import free_name, uniform

UNKNOWN = "und"
LONGEST_GRAM = 4
#: Documents of each language that the model learns from, in expectation.
SAMPLE_PER_LANGUAGE = 600
_RUN = re.compile(r"[^\W\d_]+")
_MOST_CACHED = 300_000


def words_of(text: str) -> list[str]:
    """Runs of letters (Unicode category L), in lower case.

    The pattern also takes numbers that are no decimal digits, such as a fraction or a Roman
    numeral's own character; only texts beyond ASCII can hold one.
    """
    words = _RUN.findall(text.lower())
    if text.isascii():
        return words
    letters: list[str] = []
    for word in words:
        letters.extend([word] if word.isalpha() else filter(None, "".join(c if c.isalpha() else " " for c in word).split()))
    return letters


@dataclass
class LanguageModel:
    """Log frequencies by language of words and of character n-grams.

    ``words`` and ``grams[n]`` give a row of ``table``, which holds a log frequency for
    each of ``languages``.
    """

    languages: list[str]
    words: dict[str, int]
    grams: dict[int, dict[str, int]]
    table: np.ndarray

    def __post_init__(self) -> None:
        self._rows = dict(self.words)  # and the unseen words met so far
        self._table = np.concatenate([self.table, np.zeros((_MOST_CACHED, len(self.languages)), np.float32)])
        self._end = len(self.table)

    def __getstate__(self) -> tuple:
        return self.languages, self.words, self.grams, self.table

    def __setstate__(self, state: tuple) -> None:
        self.languages, self.words, self.grams, self.table = state
        self.__post_init__()

    def backed_off(self, word: str) -> np.ndarray:
        """For a word that isn't known, the mean row of its longest known n-grams."""
        marked = f"^{word}$"
        for n in range(LONGEST_GRAM, 0, -1):
            known = self.grams[n]
            rows = [known[g] for k in range(len(marked) - n + 1) if (g := marked[k : k + n]) in known]
            if rows:
                return self.table[rows].sum(axis=0) / len(rows)
        return np.zeros(len(self.languages), dtype=np.float32)

    def _rows_of(self, words: list[str]) -> list[int]:
        rows = list(map(self._rows.get, words))
        if None in rows:
            new = {word for word, row in zip(words, rows) if row is None}
            if self._end + len(new) > len(self._table):
                self._rows, self._end = dict(self.words), len(self.table)
                new = set(words) - self._rows.keys()
                if len(new) > _MOST_CACHED:
                    self._table = np.concatenate([self._table, np.zeros((len(new), len(self.languages)), np.float32)])
            for word in new:
                self._table[self._end] = self.backed_off(word)
                self._rows[word] = self._end
                self._end += 1
            rows = list(map(self._rows.__getitem__, words))
        return rows

    def predict(self, text: str | None) -> tuple[str, float]:
        """The likeliest language and its share; ties go to the first by name.

        The share comes from the words' mean log frequency, weighted as up to 20 words,
        so that it tells mixed from clear texts at any length.
        """
        words = words_of(text) if text else []
        if not words or not self.languages:
            return UNKNOWN, 0.0
        mean = self._table[self._rows_of(words)].mean(axis=0, dtype=np.float64)
        share = np.exp((mean - mean.max()) * min(len(words), 20))
        best = int(share.argmax())
        return self.languages[best], float(share[best] / share.sum())


def _log_frequencies(counts: dict[str, np.ndarray], least: int) -> tuple[list[str], np.ndarray]:
    """Units seen ``least`` times or more, and their smoothed log frequency by language."""
    totals = sum(counts.values())
    units = sorted(unit for unit, by_language in counts.items() if by_language.sum() >= least)
    if not units:
        return [], np.zeros((0, len(totals) if np.ndim(totals) else 0), dtype=np.float32)
    table = np.array([counts[unit] for unit in units], dtype=np.float64)
    return units, np.log((table + 0.5) / (totals + 0.5 * (len(counts) + 1))).astype(np.float32)


def _counted_words(sample: DataFrame) -> DataFrame:
    """``lang``, ``word`` and its count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[tuple[str, str]] = Counter()
        for batch in batches:
            rows = batch.to_pydict()
            for language, text in zip(rows["lang"], rows["text"]):
                counts.update((language, word) for word in words_of(text))
        columns = [[k[0] for k in counts], [k[1] for k in counts], list(counts.values())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()))], names=["lang", "word", "n"]
        )

    counted = sample.select("lang", "text").mapInArrow(run, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def train(
    docs: DataFrame,
    learn: Column,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    per_language: int = SAMPLE_PER_LANGUAGE,
    least: int = 2,
) -> LanguageModel:
    """Learn from a sample of the rows for which ``learn`` holds, with a language and a text.

    The sample is drawn by the key's hash at a rate for each language, so that about
    ``per_language`` documents of each are read; this bounds the model's size. A word
    counts as known if the sample holds it ``least`` times.
    """
    usable = docs.where(learn & docs[lang].isNotNull() & docs[text].isNotNull()).select(
        docs[key].alias("key"), docs[text].alias("text"), docs[lang].cast("string").alias("lang")
    )
    sizes = {row["lang"]: row["n"] for row in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], {}, {n: {} for n in range(1, LONGEST_GRAM + 1)}, np.zeros((0, 0), np.float32))
    rate = F.create_map(*(F.lit(x) for name in languages for x in (name, min(1.0, per_language / sizes[name]))))
    sample = usable.where(uniform(F.col("key")) < F.element_at(rate, F.col("lang")))
    at = {name: k for k, name in enumerate(languages)}
    words: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(languages)))
    grams = {n: defaultdict(lambda: np.zeros(len(languages))) for n in range(1, LONGEST_GRAM + 1)}
    for row in _counted_words(sample).toLocalIterator():
        words[row["word"]][at[row["lang"]]] += row["n"]
    for word, counts in words.items():
        marked = f"^{word}$"
        for n, found in grams.items():
            for k in range(len(marked) - n + 1):
                found[marked[k : k + n]] += counts
    units, rows = _log_frequencies(words, least)
    tables, indexes = [rows], {}
    start = len(units)
    for n, found in grams.items():
        names, rows = _log_frequencies(found, least)
        indexes[n] = {name: start + k for k, name in enumerate(names)}
        tables.append(rows)
        start += len(names)
    known = {word: k for k, word in enumerate(units)}
    return LanguageModel(languages, known, indexes, np.concatenate([t for t in tables if t.size]))


def predict(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1), which replace columns of these names.

    A text that is null or has no letter is ``und`` with score 0, and so is every text
    if nothing was learned. All rows are kept; other columns pass through. Only the text goes
    to Python, once; the rows wait for its answers in the JVM.
    """
    rest = [docs[name] for name in docs.columns if name.lower() not in ("lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double")
    def identify(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for texts in batches:
            found = [model.predict(t.as_py()) for t in texts]
            yield pa.StructArray.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["lang_pred", "score"],
            )

    answer = free_name(docs, "answer")
    return docs.select(*rest, identify(docs[text]).alias(answer)).select(
        *[c for c in docs.columns if c.lower() not in ("lang_pred", "score")], f"{answer}.lang_pred", f"{answer}.score"
    )
