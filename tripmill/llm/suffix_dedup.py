"""Suffix-array dedup: bytes of long strings that start more than once, by difference-cover blockwise sorting.

Two suffixes share their first 200 bytes if they are tied that far. Within their first 133
offsets one is on the difference cover in both, whatever their places are modulo 133, and from there on at least
68 bytes are shared. So the cover sample's ranks come first: sampled suffixes are sorted
bucket by bucket by the fingerprint of these 68 bytes, and only the tied ones stay. Long ties
are resolved by the ranks alone: tied samples are sorted by the fingerprint of all that a
200-byte string through them can reach, and where that ties too, every string through the
sample is repeated and none is sorted. What is left, strings near the ends of repeated
passages, is sorted by its own fingerprint. Ranks are names: equal for equal strings, their order means nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm import exchange
from tripmill.llm.shared import free_name, settle

LENGTH = 200
PERIOD = 133
#: Perfect difference set: every residue modulo 133 is one difference of two members.
COVER = np.array([0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109])
REACH = LENGTH - PERIOD + 1
_BASE = 0x9E3779B97F4A7C15
_MULTIPLIER = np.uint64(0xBF58476D1CE4E5B9)


class Text:
    """The texts of a block end to end, with fingerprints of any of their strings."""

    def __init__(self, batch: pa.RecordBatch, length: int, period: int) -> None:
        texts = batch.column(batch.num_columns - 1)
        values = [t.as_buffer() for t in texts]
        self.sizes = np.array([len(v) for v in values], dtype=np.int64)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.data = np.frombuffer(b"".join(values), dtype=np.uint8)
        self.length, self.period = length, period
        n = len(self.data)
        base, inverse = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
        self._back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, inverse)]))
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n - 1, 0), base)]))[:n]
        values = self.data.astype(np.uint64) + np.uint64(1)
        values *= _MULTIPLIER
        values ^= values >> np.uint64(29)
        values *= powers
        self._sums = np.concatenate([[np.uint64(0)], np.cumsum(values)])

    def fingerprint(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of the strings from start to end (and their lengths)."""
        value = self._sums[end]
        value -= self._sums[start]
        value *= self._back[start]
        other = (end - start).view(np.uint64)
        other *= np.uint64(0xD6E8FEB86659FD93)
        value += other
        value ^= np.right_shift(value, np.uint64(32), out=other)
        value *= np.uint64(0xD6E8FEB86659FD93)
        value ^= np.right_shift(value, np.uint64(29), out=other)
        value *= _MULTIPLIER
        value ^= np.right_shift(value, np.uint64(32), out=other)
        return value

    def _document(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, at, side="right")

    def samples(self, cover: np.ndarray) -> np.ndarray:
        """Places on the cover, counted in each document, with ``REACH`` bytes from there on."""
        residue = np.zeros(self.period, dtype=bool)
        residue[cover] = True
        place = np.arange(len(self.data)) - np.repeat(self.starts, self.sizes)
        left = np.repeat(self.ends, self.sizes) - np.arange(len(self.data))
        return np.nonzero(residue[place % self.period] & (left >= self.length - self.period + 1))[0]

    def surroundings(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What strings of the length through a sample's bytes can reach, within its document."""
        own = self._document(at)
        low = np.maximum(at - self.period + 1, self.starts[own])
        return low, np.minimum(at + self.length, self.ends[own])


def _by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The keys' order by bucket, the buckets there are, and where each ends in that order."""
    bucket = ((keys >> np.uint64(40)) % np.uint64(buckets)).astype(np.int32)
    sizes = np.bincount(bucket, minlength=buckets)
    numbers = np.flatnonzero(sizes)
    return np.argsort(bucket, kind="stable"), numbers, np.cumsum(sizes[numbers])


def _packed(keys: np.ndarray, buckets: int, extra: np.ndarray | None = None) -> Iterator[tuple[int, bytes]]:
    """A question for each bucket: its keys, each once."""
    order, numbers, ends = _by_bucket(keys, buckets)
    columns = [keys[order]] if extra is None else [keys[order], extra[order]]
    begin = 0
    for number, end in zip(numbers.tolist(), ends.tolist()):
        yield number, b"".join(column[begin:end].tobytes() for column in columns)
        begin = end


def _spread(answers: list[dict] | None, keys: np.ndarray, buckets: int) -> np.ndarray:
    """Answers in the keys' order."""
    out = np.zeros(len(keys), dtype=np.uint8)
    order, numbers, ends = _by_bucket(keys, buckets)
    told = {pair["bucket"]: pair["answer"] for pair in answers or ()}
    if told:
        out[order] = np.frombuffer(b"".join(told[number] for number in numbers.tolist()), dtype=np.uint8)
    return out


def _once(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each key, the places of all keys among these, and whether a key is there twice."""
    order = np.argsort(keys)
    found = keys[order]
    new = _new(found)
    unique = found[new]
    del found
    number = np.cumsum(new, dtype=np.int32)
    number -= 1
    inverse = np.empty(len(keys), dtype=np.int32)
    inverse[order] = number
    del order, number
    return unique, inverse, ~np.append(new[1:], True)[new]


def _new(ordered: np.ndarray) -> np.ndarray:
    """Whether each key differs from the one before."""
    new = np.ones(len(ordered), dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    return new


def _sorted_buckets(questions: list[bytes]) -> list[bytes]:
    """Whether another block asks the same key: one sort of the bucket."""
    parts = [np.frombuffer(q, dtype=np.uint64) for q in questions]
    keys = np.concatenate(parts)
    order = np.argsort(keys)
    # As sorted: a key is there twice if it equals the one before or after.
    new = _new(keys[order])
    flags = np.empty(len(keys), dtype=np.uint8)
    flags[order] = ~(new & np.append(new[1:], True))
    return [part.tobytes() for part in np.split(flags, np.cumsum([len(k) for k in parts])[:-1])]


#: Answers on tied samples: all is repeated; that, and others tie in less; tied in less only.
_ALL, _ALL_SPEAKS, _PART = 1, 2, 3


def _sorted_ties(questions: list[bytes]) -> list[bytes]:
    """By rank and then by the surroundings: which samples tie in both, and one speaker of each tie if its rank has others.

    Of one block's question, a key that is there twice carries the lowest bit of its second half.
    """
    parts = [np.frombuffer(q, dtype=np.uint64).reshape(2, -1) for q in questions]
    both = np.concatenate(parts, axis=1)
    rank, around, doubled = both[0], both[1] & ~np.uint64(1), (both[1] & np.uint64(1)).astype(bool)
    order = np.lexsort((around, rank))
    new_rank = np.concatenate([[True], rank[order][1:] != rank[order][:-1]])
    new_tie = new_rank | np.concatenate([[True], around[order][1:] != around[order][:-1]])
    tie = np.cumsum(new_tie) - 1
    group = np.cumsum(new_rank) - 1
    size = np.bincount(tie) + np.bincount(tie, weights=doubled[order]).astype(np.int64)
    ties_of = np.bincount(group, weights=new_tie).astype(np.int64)
    answer = np.where(size[tie] > 1, _ALL, _PART).astype(np.uint8)
    answer[(answer == _ALL) & (ties_of[group] > 1) & new_tie] = _ALL_SPEAKS
    out = np.empty(len(answer), dtype=np.uint8)
    out[order] = answer
    return [part.tobytes() for part in np.split(out, np.cumsum([p.shape[1] for p in parts])[:-1])]


class _Search:
    """One block's side of the three rounds."""

    def __init__(self, batch: pa.RecordBatch, buckets: tuple[int, int, int], length: int, period: int, cover: np.ndarray) -> None:
        self.text, self.buckets, self.length, self.period = Text(batch, length, period), buckets, length, period
        self.at = self.text.samples(cover)
        reach = length - period + 1
        self.ranks = self.text.fingerprint(self.at, self.at + reach)

    def ask_ranks(self) -> Iterator[tuple[int, bytes]]:
        self.rank_keys, self.rank_of, self.rank_twice = _once(self.ranks)
        return _packed(self.rank_keys, self.buckets[0])

    def ask_ties(self, answers: list[dict] | None) -> Iterator[tuple[int, bytes]]:
        tuple(self.ask_ranks())
        tied = (self.rank_twice | (_spread(answers, self.rank_keys, self.buckets[0]) > 0))[self.rank_of]
        self.at, self.ranks = self.at[tied], self.ranks[tied]
        self.low, self.high = self.text.surroundings(self.at)
        around = self.text.fingerprint(self.low, self.high)
        around ^= (self.at - self.low).astype(np.uint64) * np.uint64(_BASE)
        around &= ~np.uint64(1)
        keys = np.stack([self.ranks, around])
        order = np.lexsort((keys[1], keys[0]))
        new = np.concatenate([[True], (keys[:, order][:, 1:] != keys[:, order][:, :-1]).any(axis=0)]) if len(order) else np.zeros(0, bool)
        self.tie_of = np.empty(len(order), dtype=np.int64)
        self.tie_of[order] = np.cumsum(new) - 1
        self.first = order[new]
        keys = keys[:, self.first]
        doubled = np.bincount(self.tie_of, minlength=len(self.first)) > 1
        self.tie_keys = keys
        return _packed(keys[0], self.buckets[1], keys[1] | doubled.astype(np.uint64))

    def ask_strings(self, answers: list[dict] | None) -> Iterator[tuple[int, bytes]]:
        told = _spread(answers, self.tie_keys[0], self.buckets[1])[self.tie_of] if len(self.at) else np.zeros(0, np.uint8)
        speaks = told == _PART
        speaks[self.first[told[self.first] == _ALL_SPEAKS]] = True
        n = len(self.text.data)
        settled = self._strings(told != _PART, n)
        wanted = self._strings(speaks, n)
        self.repeated = settled
        self.open = np.nonzero(wanted)[0]
        keys = self.text.fingerprint(self.open, self.open + self.length)
        self.string_keys, self.string_of, self.string_twice = _once(keys)
        return _packed(self.string_keys, self.buckets[2])

    def _strings(self, chosen: np.ndarray, n: int) -> np.ndarray:
        """Starts of the strings through the chosen samples."""
        low = self.low[chosen]
        last = np.minimum(self.at[chosen], self.high[chosen] - self.length)
        some = last >= low
        edge = np.bincount(low[some], minlength=n + 1) - np.bincount(last[some] + 1, minlength=n + 1)[: n + 1]
        return np.cumsum(edge)[:n] > 0

    def covered(self, answers: list[dict] | None) -> np.ndarray:
        """Whether each byte is in a repeated string."""
        again = self.string_twice | (_spread(answers, self.string_keys, self.buckets[2]) > 0)
        self.repeated[self.open[again[self.string_of]]] = True
        n = len(self.text.data)
        starts = np.nonzero(self.repeated)[0]
        edge = np.bincount(starts, minlength=n + 1) - np.bincount(starts + self.length, minlength=n + 1)[: n + 1]
        return np.cumsum(edge)[:n] > 0


def _kept(batch: pa.RecordBatch, covered: np.ndarray, text: Text) -> Iterator[tuple[int, int, int, bytes]]:
    for start, end in zip(text.starts.tolist(), text.ends.tolist()):
        gone = covered[start:end]
        spans = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
        yield end - start, int(gone.sum()), spans, text.data[start:end][~gone].tobytes()


def remove_repeated(
    docs: DataFrame, text: str = "text", length: int = LENGTH, period: int = PERIOD, cover: np.ndarray = COVER, as_text: bool = False
) -> DataFrame:
    """``docs`` without ``text``, with ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept``
    (binary, or text without the halves of characters).

    Each byte (UTF-8) covered by a string of ``length`` bytes that also starts anywhere else, in any row or
    the same one, is removed; strings overlap, never cross rows, and are judged on the
    input. A null text is empty; rows shorter than ``length`` stay whole; repeated rows
    remove each other. Columns of the result's names are replaced. An empty table gives an
    empty result. Strings are compared by 64-bit fingerprints.

    A block's memory is bounded by the block; a document longer than a block is one of its own.
    """
    names = ("n_bytes", "n_removed", "n_spans", "kept")
    rest = [name for name in docs.columns if name.lower() not in (text.lower(), *names)]
    schema = docs.select(rest).schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long")
    schema = schema.add("kept", "string" if as_text else "binary")
    stored = exchange.blocks(docs, rest, text)
    share = len(cover) / period
    buckets = tuple(exchange.n_buckets(stored, part) for part in (share * 8, share * 8, 2.0))

    def search(packed: bytes) -> tuple[pa.RecordBatch, _Search]:
        batch = exchange.unpacked(packed)
        return batch, _Search(batch, buckets, length, period, cover)

    def asking(number: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for row in (row for k in range(whole.num_rows) for row in whole.slice(k, 1).to_pylist()):
                    _, found = search(row["packed"])
                    asked = found.ask_ranks()
                    if number > 0:
                        asked = found.ask_ties(row["round_0"])
                    if number > 1:
                        asked = found.ask_strings(row["round_1"])
                    asked = list(asked)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([k for k, _ in asked], pa.int64()),
                            pa.array([row["block"]] * len(asked), pa.int64()),
                            pa.array([q for _, q in asked], pa.binary()),
                        ],
                        names=["bucket", "block", "question"],
                    )

        return run

    rounds: list[DataFrame] = []
    for number, answer in enumerate((_sorted_buckets, _sorted_ties, _sorted_buckets)):
        asked = exchange.with_answers(stored, *rounds).mapInArrow(asking(number), exchange.ASKED)
        rounds.append(settle(exchange.answered(asked, answer), f"round_{number}"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for row in (row for k in range(whole.num_rows) for row in whole.slice(k, 1).to_pylist()):
                batch, found = search(row["packed"])
                tuple(found.ask_ties(row["round_0"]))
                tuple(found.ask_strings(row["round_1"]))
                rows = list(_kept(batch, found.covered(row["round_2"]), found.text))
                numbers = [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]
                kept = pa.array([r[3].decode("utf-8", "ignore") if as_text else r[3] for r in rows])
                kept = kept.cast(pa.string() if as_text else pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *numbers, kept], names=[*rest, *names])

    return exchange.with_answers(stored, *rounds).mapInArrow(finish, schema)


def without_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs``, column by column, with the repeated strings taken out of ``text``.

    A character that is cut in two goes as well. A null text stays null, and ``n_chars``
    follows the text if it is there.
    """
    mark = free_name(docs, "was_null")
    found = remove_repeated(docs.withColumn(mark, F.col(text).isNull()), text, as_text=True)
    found = found.withColumn(text, F.when(~F.col(mark), F.col("kept")))
    if "n_chars" in docs.columns and text != "n_chars":
        found = found.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType))
    return found.select(docs.columns)
