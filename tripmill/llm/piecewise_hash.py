"""Context-triggered piecewise hashing: chunk signatures of whole texts, compared by edit distance.

A hash over the last ``WINDOW`` bytes decides where a chunk ends, so that an edit moves only the chunks
around it. A byte whose window hash has k trailing zero bits ends a chunk at block size ``2 ** k`` and
at all smaller ones; block size 1 cuts after every byte. The block size is the smallest that
gives ``USUAL`` chunks or fewer if the hashes are even; while it cuts the text into fewer than
``FEWEST``, it is halved. A fingerprint names it, the chunks' hashes at that size and those at
twice that size: ``k:signature:signature``. Two fingerprints are compared where they share a
block size, by the edit distance of their chunks.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.shared import free_name, small_batches

WINDOW = 7
USUAL, FEWEST = 64, 16
#: Chunks in a signature. In a text that repeats itself a block size can cut more; the last one then holds the rest.
MOST = 128
#: Levels of a window hash; a text's last byte has the next one, so it ends a chunk at every block size.
_LEVELS = 33
_SLICE = 1 << 18
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_TOKENS = np.array([a + b for a in _DIGITS for b in _DIGITS], dtype="S2")  # a chunk's 12 bits
_VALUES = {token: value for value, token in enumerate(_TOKENS.tolist())}


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


_UP = _powers(_BASE, 2 * _SLICE)
_DOWN = _powers(_INVERSE, 2 * _SLICE)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _MIX
    return values ^ (values >> np.uint64(29))


def _sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums from which the polynomial hash of any run of bytes follows."""
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _DOWN[: len(values)])])


def _window_marks(sums: np.ndarray) -> np.ndarray:
    """32 bits for each byte from WINDOW on, of the window that ends with it."""
    n = len(sums) - 1
    windows = (sums[WINDOW + 1 :] - sums[1 : n - WINDOW + 1]) * _UP[WINDOW:n]
    return (_mixed(windows) >> np.uint64(32)).astype(np.uint32)


def _levels(marks: np.ndarray) -> np.ndarray:
    """Trailing zero bits."""
    lowest = marks & (~marks + np.uint32(1))
    return np.where(marks == 0, _LEVELS - 1, (lowest.astype(np.float32).view(np.int32) >> 23) - 127)


def _usual(sizes: np.ndarray) -> np.ndarray:
    """The level at which texts of these sizes have USUAL chunks or some fewer."""
    return np.ceil(np.log2(np.maximum(sizes, USUAL) / USUAL)).astype(int)


def _chosen(counts: np.ndarray, usual: np.ndarray) -> np.ndarray:
    """By text, the largest level up to the usual one that ends FEWEST chunks or more; -1 if none does."""
    at_least = counts[:, ::-1].cumsum(axis=1)[:, ::-1]
    return np.minimum((at_least >= FEWEST).sum(axis=1) - 1, usual)  # counts don't grow with the level


def _batch(texts: Sequence[bytes], lowest: np.ndarray | None = None) -> list[str]:
    """Fingerprints of texts of ``_SLICE`` bytes together at most, or of one."""
    sizes = np.array([len(t) for t in texts])
    pad = b"\0" * WINDOW
    values = np.frombuffer(pad + pad.join(texts), dtype=np.uint8).astype(np.uint64)
    starts = np.cumsum(sizes + WINDOW) - sizes
    real = np.ones(len(values), dtype=bool)
    real[(starts[:, None] - WINDOW + np.arange(WINDOW)).ravel()] = False
    values = np.where(real, values + np.uint64(1), np.uint64(0))
    sums = _sums(values)
    marks = _window_marks(sums)
    # Only ends at the usual level are looked at, unless they are too few.
    usual = _usual(sizes)
    low = usual if lowest is None else lowest
    masks = np.repeat(((1 << low) - 1).astype(np.uint32), sizes + WINDOW)[WINDOW:]
    ends = np.nonzero(((marks & masks) == 0) & real[WINDOW:])[0] + WINDOW
    last = (starts + sizes - 1)[sizes > 0]
    ends = np.union1d(ends, last)
    levels = _levels(marks[ends - WINDOW])
    levels[np.searchsorted(ends, last)] = _LEVELS
    owner = np.searchsorted(starts, ends, side="right") - 1
    owner = np.where(sizes[owner] > 0, owner, 0) if len(owner) else owner
    counts = np.bincount(owner * (_LEVELS + 1) + levels, minlength=len(texts) * (_LEVELS + 1)).reshape(len(texts), -1)
    chosen = _chosen(counts, usual)
    again = np.nonzero((chosen < low) & (low > 0))[0]
    chosen = np.maximum(chosen, 0)
    parts = []
    for more in (0, 1):
        kept = levels >= chosen[owner] + more
        at, of = ends[kept], owner[kept]
        first = np.searchsorted(of, np.arange(len(texts)))
        total = np.searchsorted(of, np.arange(len(texts)), side="right") - first
        rank = np.arange(len(at)) - first[of]
        kept = (rank < MOST - 1) | (rank == total[of] - 1)
        at, of = at[kept], of[kept]
        begins = np.concatenate([[0], at[:-1] + 1])
        begins = np.maximum(begins, starts[of])
        hashes = _mixed((sums[at + 1] - sums[begins]) * _UP[at]) >> np.uint64(52)
        text = _TOKENS[hashes].tobytes().decode()
        cuts = 2 * np.searchsorted(of, np.arange(len(texts) + 1))
        parts.append([text[a:b] for a, b in zip(cuts[:-1], cuts[1:])])
    out = [f"{k}:{a}:{b}" for k, a, b in zip(chosen.tolist(), *parts)]
    if len(again):
        for k, found in zip(again, _batch([texts[k] for k in again], np.zeros(len(again), dtype=int))):
            out[k] = found
    return out


def _long(text: bytes) -> str:
    """The fingerprint of a text of any length, slice by slice: once for the block size, once for the chunks."""
    n = len(text)

    def slices() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Each slice's first byte, its sums from WINDOW bytes before that on, and its bytes' levels."""
        for start in range(0, n, _SLICE):
            part = np.frombuffer(text, np.uint8, min(_SLICE, n - start) + min(WINDOW, start), max(0, start - WINDOW))
            values = part.astype(np.uint64) + np.uint64(1)
            if not start:
                values = np.concatenate([np.zeros(WINDOW, np.uint64), values])
            sums = _sums(values)
            levels = _levels(_window_marks(sums))
            if start + _SLICE >= n:
                levels[-1] = _LEVELS
            yield start, sums, levels

    counts = np.zeros(_LEVELS + 1, dtype=np.int64)
    for _, _, levels in slices():
        counts += np.bincount(levels, minlength=_LEVELS + 1)
    chosen = max(0, int(_chosen(counts[None, :], _usual(np.array([n])))[0]))
    found: list[list[tuple[int, int]]] = [[], []]  # each chunk's last byte and the sum up to it
    below = 0
    for start, sums, levels in slices():
        # Exponents count from WINDOW bytes before the slice; what lies before the slice is in ``below``.
        scale = pow(_INVERSE, start, 1 << 64)
        for more in (0, 1):
            ends = np.nonzero(levels >= chosen + more)[0]
            last = ends[-1:][levels[ends[-1:]] == _LEVELS]
            ends = np.union1d(ends[: max(0, MOST - 1 - len(found[more]))], last).astype(int)
            found[more] += [(start + e, below + (int(sums[e + WINDOW + 1]) - int(sums[WINDOW])) * scale & _MASK) for e in ends.tolist()]
        below = below + (int(sums[-1]) - int(sums[WINDOW])) * scale & _MASK
    parts = []
    for chunks in found:
        befores = [0, *(total for _, total in chunks[:-1])]
        raw = [(total - before) * pow(_BASE, end + WINDOW, 1 << 64) & _MASK for (end, total), before in zip(chunks, befores)]
        parts.append(_TOKENS[_mixed(np.array(raw, dtype=np.uint64)) >> np.uint64(52)].tobytes().decode())
    return f"{chosen}:{parts[0]}:{parts[1]}"


def fingerprints(texts: Sequence[bytes]) -> list[str]:
    """The fingerprint of each text; equal texts have equal ones. The empty text's is ``0::``."""
    out: list[str] = []
    group: list[bytes] = []
    size = 0
    for text in (*texts, None):
        if group and (text is None or size + len(text) + WINDOW > _SLICE):
            out += _batch(group) if any(group) else ["0::"] * len(group)
            group, size = [], 0
        if text is None:
            break
        if len(text) + WINDOW > _SLICE:
            out.append(_long(text))
        else:
            group.append(text)
            size += len(text) + WINDOW
    return out


def _parsed(fingerprint: str) -> tuple[int, np.ndarray, np.ndarray]:
    k, *signatures = fingerprint.split(":")
    return int(k), *(
        np.array([_VALUES[raw[at : at + 2]] for at in range(0, len(raw), 2)], dtype=np.int16)
        for raw in (s.encode() for s in signatures)
    )


def edit_distances(first: Sequence[np.ndarray], second: Sequence[np.ndarray], together: int = 512) -> np.ndarray:
    """Edit distance (insert, delete, replace) of each pair, a row of many pairs' tables at once."""
    out = np.zeros(len(first), dtype=np.int64)
    sizes = np.array([len(a) for a in first], dtype=int)
    order = np.argsort(sizes, kind="stable")
    for begin in range(0, len(order), together):
        part = order[begin : begin + together]
        lengths, widths = sizes[part], np.array([len(second[k]) for k in part])
        a = np.full((len(part), lengths.max(initial=0)), -1, dtype=np.int16)
        b = np.full((len(part), widths.max(initial=0)), -2, dtype=np.int16)
        for row, k in enumerate(part):
            a[row, : sizes[k]], b[row, : widths[row]] = first[k], second[k]
        steps = np.arange(b.shape[1] + 1, dtype=np.int16)
        table = np.tile(steps, (len(part), 1))
        found = np.where(lengths == 0, widths, 0)
        for i in range(a.shape[1]):
            best = np.empty_like(table)
            best[:, 0] = i + 1
            np.minimum(table[:, 1:] + 1, table[:, :-1] + (b != a[:, i : i + 1]), out=best[:, 1:])
            table = np.minimum.accumulate(best - steps, axis=1) + steps
            done = np.nonzero(lengths == i + 1)[0]
            found[done] = table[done, widths[done]]
        out[part] = found
    return out


def likeness(first: Sequence[str], second: Sequence[str]) -> np.ndarray:
    """0 to 1 for each pair of fingerprints: 1 less the edit distance's share of the longer signature.

    The best of the block sizes they have in common counts; 0 if there is none, 1 for equal fingerprints.
    """
    out = np.zeros(len(first))
    left, right, of = [], [], []
    parsed = {fp: _parsed(fp) for fp in {*first, *second}}
    for k, (a, b) in enumerate(zip(first, second)):
        if a == b:
            out[k] = 1.0
            continue
        (size_a, *sigs_a), (size_b, *sigs_b) = parsed[a], parsed[b]
        for m, sig in enumerate(sigs_a):
            if 0 <= size_a + m - size_b <= 1:
                left.append(sig)
                right.append(sigs_b[size_a + m - size_b])
                of.append(k)
    longer = np.array([max(len(a), len(b), 1) for a, b in zip(left, right)])
    if of:
        np.maximum.at(out, of, 1 - edit_distances(left, right) / longer)
    return out


def fingerprint(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of a text column, a null text as an empty one; ``name`` is replaced."""

    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(fingerprints([(t or "").encode() for t in texts.to_pylist()]), pa.string())

    mark = free_name(docs, "made")
    rest = [docs[c] for c in docs.columns if c.lower() != name.lower()]
    return docs.select(*rest, run(docs[text]).alias(mark)).withColumnRenamed(mark, name)


#: Bytes of text that a task of the chain is planned for, and the most tasks; a larger task streams its rows.
PART_BYTES, MOST_PARTS = 32 << 20, 50_000
_PER_PART = 16
_ANSWER = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _rank(key: int | None, mark: int) -> tuple:
    return key is None, -(key or 0), -mark


def edited_by_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text beside itself with its second half taken from the next document, and beside that document.

    The next one is that with the next smaller key (an integer; null keys come last), after the last
    the first; texts with equal keys follow each other by their hash. The last ``n_chars // 2`` code
    points are replaced by as many of the next text's first, or all. Returns the key, ``n_chars``,
    ``edited_sha256``, ``fingerprint``, ``edited_fingerprint`` and the likeness of the first to the second
    (``near_edited``) and to the next text's (``near_next``). Null texts are empty; a single
    document is its own next; an empty table gives none. Further columns are ignored.

    Whole texts are moved once, to tasks cut at sampled rows. A task's first row goes to the task
    before it as well, so that each task has all its rows' next ones.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[key].cast("long").alias("key"), F.coalesce(docs[text], F.lit("")).alias("__text"))
    rows = rows.withColumn("mark", F.xxhash64("__text"))
    total = rows.agg(
        F.count("*").alias("n"), F.sum(F.octet_length("__text")).alias("size"), F.max(F.struct("key", "mark")).alias("first")
    ).first()
    n_parts = min(MOST_PARTS, max(total["n"], 1), max(1, (total["size"] or 0) // PART_BYTES))
    cuts = []
    if n_parts > 1:
        sample = rows.select("key", "mark").sample(min(1.0, _PER_PART * n_parts / total["n"]), 1).collect()
        ranked = sorted({_rank(*row) for row in sample})
        cuts = [ranked[k * len(ranked) // n_parts] for k in range(1, n_parts)] if ranked else []
    cuts = sorted({_rank(*total["first"]), *cuts}) if total["n"] else []
    shared = spark.sparkContext.broadcast(cuts)

    @F.arrow_udf("array<int>")
    def tasks_of(keys: pa.Array, marks: pa.Array) -> pa.Array:
        cuts = shared.value
        out = []
        for row in map(_rank, keys.to_pylist(), marks.to_pylist()):
            own = bisect_right(cuts, row) - 1
            out.append([own, (own - 1) % len(cuts)] if cuts[own] == row else [own])
        return pa.array(out, pa.list_(pa.int32()))

    dealt = (
        rows.select("key", "__text", "mark", F.posexplode_outer(tasks_of("key", "mark")).alias("guest", "task"))
        .repartitionById(max(1, len(cuts)), "task")
        .sortWithinPartitions("guest", F.desc_nulls_last("key"), F.desc("mark"))
        .select("key", "guest", "__text")
    )

    def answers(rows: list[tuple[int | None, str]], prints: list[str]) -> pa.RecordBatch:
        edited, sizes = [], []
        for (_, here), (_, following) in zip(rows, rows[1:]):
            n = len(here)
            sizes.append(n)
            edited.append((here[: n - n // 2] + following[: n // 2]).encode())
        changed = fingerprints(edited)
        columns = [
            pa.array([k for k, _ in rows[:-1]], pa.int64()),
            pa.array(sizes, pa.int64()),
            pa.array([hashlib.sha256(t).hexdigest() for t in edited], pa.string()),
            pa.array(prints[:-1], pa.string()),
            pa.array(changed, pa.string()),
            pa.array(likeness(prints[:-1], changed)),
            pa.array(likeness(prints[:-1], prints[1:])),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[key, *(c.split()[0] for c in _ANSWER.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[tuple[int | None, str]] = []
        known: list[str] = []
        for batch in small_batches(batches, "__text", 2 << 20):
            guests = batch.column(1).to_pylist()
            n_own = guests.index(1) + 1 if 1 in guests else len(guests)  # and the first guest, the last one's next
            rows = list(zip(batch.column(0).to_pylist()[:n_own], batch.column(2).slice(0, n_own).to_pylist()))
            prints = fingerprints([t.encode() for _, t in rows])
            pending, known = pending + rows, known + prints
            if len(pending) > 1:
                yield answers(pending, known)
            pending, known = pending[-1:], known[-1:]
            if 1 in guests:
                return

    return dealt.mapInArrow(run, f"`{key}` long, {_ANSWER}")
