"""LM scoring: a gated recurrent network over whole documents, in numpy, with a class-factored output."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm import exchange
from tripmill.llm.shared import settle, small_batches, uniform

CLASS_SIZE = 32
WORDS = 32 * CLASS_SIZE
EMBEDDING, HIDDEN = 16, 24
WINDOW = 24
#: Rounds of training; each training document is in one of them.
ROUNDS = 6
#: Text that one task learns from in a round, about, so that lanes hold many documents and end together.
_SHARD_BYTES = 16 << 20
#: Tokens that are laid out in lanes at once.
_SHARD_TOKENS = 3_000_000
#: Parameters are averaged in so many groups of shards before they come together.
_GROUPS = 16
_GROUP_BYTES = 8 << 20
_RARE, _END = 0, 1
#: Tokens whose likelihoods are found at once.
_AT_ONCE = 8192
_LN10 = np.log(10.0)


#: Scores below this neither overflow a float's exponential nor, negated, lose it.
_SMALL = 40.0


class _Room:
    """Arrays by name that the next window fills again: the pages of new ones would take as long as the sums in them."""

    def __init__(self) -> None:
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, shape: tuple[int, ...], dtype: np.dtype) -> np.ndarray:
        size = int(np.prod(shape))
        flat = self.held.get(name)
        if flat is None or flat.size < size or flat.dtype != dtype:
            flat = self.held[name] = np.empty(size, dtype)
        return flat[:size].reshape(shape)


def _below(scores: np.ndarray) -> None:
    """Take away each row's maximum, unless all scores are small."""
    if scores.size and not (scores.max() < _SMALL and scores.min() > -_SMALL):
        scores -= scores.max(axis=1, keepdims=True)


def _shapes(classes: int) -> dict[str, tuple[int, ...]]:
    n = classes * CLASS_SIZE
    return {
        "embedding": (n + 1, EMBEDDING),  # the last row starts a document
        "input": (EMBEDDING, 3 * HIDDEN),
        "input_bias": (3 * HIDDEN,),
        "recurrent": (HIDDEN, 3 * HIDDEN),
        "class_weight": (HIDDEN, classes),
        "class_bias": (classes,),
        "word_weight": (n, HIDDEN),
        "word_bias": (n,),
    }


def _views(flat: np.ndarray, classes: int) -> dict[str, np.ndarray]:
    """The parameters as parts of one array."""
    values, at = {}, 0
    for name, shape in _shapes(classes).items():
        size = int(np.prod(shape))
        values[name] = flat[at : at + size].reshape(shape)
        at += size
    return values


@dataclass
class Network:
    """Gated recurrent units; a word is predicted as its class, and then as itself within the class."""

    values: dict[str, np.ndarray]

    @classmethod
    def start(cls, counts: np.ndarray) -> Network:
        """Random weights, with biases that predict each word by its count."""
        classes = len(counts) // CLASS_SIZE
        random = np.random.default_rng(11)
        values = {name: random.normal(0, 0.1, shape).astype(np.float32) for name, shape in _shapes(classes).items()}
        values["recurrent"] *= 2
        values["input_bias"][:] = 0
        values["class_weight"] *= 0.3
        values["word_weight"] *= 0.3
        by_class = counts.reshape(classes, CLASS_SIZE)
        values["class_bias"] = np.log(by_class.sum(axis=1) / by_class.sum()).astype(np.float32)
        values["word_bias"] = np.log(by_class / by_class.sum(axis=1, keepdims=True)).ravel().astype(np.float32)
        return cls(values)

    @property
    def start_row(self) -> int:
        return len(self.values["embedding"]) - 1

    def flat(self) -> np.ndarray:
        return np.concatenate([self.values[name].ravel() for name in _shapes(1)])

    @classmethod
    def from_flat(cls, flat: np.ndarray, classes: int) -> Network:
        return cls(_views(flat.astype(np.float32), classes))

    def step(self, gates: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, ...]:
        """The next state of each row, from its gates (update, reset and new, before the state's part)."""
        made = _scaled(gates).T[None]
        return (_Steps(self, made, np.ones((1, len(state)), made.dtype), _Room()).run(state.T).T,)

    def log_likelihood(
        self, states: np.ndarray, targets: np.ndarray, slopes: dict | None = None, room: _Room | None = None
    ) -> np.ndarray:
        """Of each target given its state; with ``slopes``, also the gradient of the negated sum."""
        v, n, h = self.values, *states.shape
        room, kind, n_classes = room or _Room(), states.dtype, len(v["class_bias"])
        # Targets of one class are neighbours, so a class is a slice of one array.
        classes = (targets // CLASS_SIZE).astype(np.int16)
        order = np.argsort(classes, kind="stable")
        cuts = [0, *np.bincount(classes, minlength=n_classes).cumsum().tolist()]
        held = [(slice(a, b), slice(k * CLASS_SIZE, (k + 1) * CLASS_SIZE)) for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
        # A last column of ones takes the biases into the products.
        ordered = room("ordered", (n, h + 1), kind)
        ordered[:, :h] = states.take(order, axis=0, out=room("taken", (n, h), kind), mode="clip")
        ordered[:, h] = 1
        word_weight = room("word_weight", (n_classes * CLASS_SIZE, h + 1), kind)
        word_weight[:, :h], word_weight[:, h] = v["word_weight"], v["word_bias"]
        class_weight = np.concatenate([v["class_weight"], v["class_bias"][None]])
        scores = np.matmul(ordered, class_weight, out=room("scores", (n, n_classes), kind))
        inner = room("inner", (n, CLASS_SIZE), kind)
        for own, block in held:
            np.matmul(ordered[own], word_weight[block].T, out=inner[own])
        _below(scores)
        _below(inner)
        rows = np.arange(n)
        at_class, at_word = rows * n_classes + classes.take(order), rows * CLASS_SIZE + targets.take(order) % CLASS_SIZE
        found = scores.ravel().take(at_class) + inner.ravel().take(at_word)
        shares, share = np.exp(scores, out=scores), np.exp(inner, out=inner)
        totals, total = shares @ np.ones(n_classes, kind), share @ np.ones(CLASS_SIZE, kind)
        found -= np.log(totals)
        found -= np.log(total)
        out = np.empty_like(found)
        out[order] = found
        if slopes is not None:
            shares /= totals[:, None]
            shares.ravel()[at_class] -= 1
            share /= total[:, None]
            share.ravel()[at_word] -= 1
            by_class = ordered.T @ shares
            by_word = room("by_word", word_weight.shape, kind)
            by_word[:] = 0
            above, part = room("above", (n, h), kind), room("taken", (n, h), kind)
            np.matmul(shares, v["class_weight"].T, out=above)
            for own, block in held:
                np.matmul(share[own].T, ordered[own], out=by_word[block])
                np.matmul(share[own], v["word_weight"][block], out=part[own])
            above += part
            slopes["class_weight"], slopes["class_bias"] = by_class[:h], by_class[h]
            slopes["word_weight"], slopes["word_bias"] = by_word[:, :h], by_word[:, h]
            slopes["states"] = room("by_states", (n, h), kind)
            slopes["states"][order] = above
        return out


def _scaled(weights: np.ndarray) -> np.ndarray:
    """Columns of update, reset and new as new, update and reset, by factors that leave an exponential to be all of a gate."""
    return np.concatenate([weights[..., 2 * HIDDEN :] * -2, -weights[..., : 2 * HIDDEN]], axis=-1)


class _Steps:
    """A window of steps with a lane in each column, so that a gate of all lanes is one run of memory.

    ``gates`` are scaled: their sigmoid is 1 / (1 + exp), their tanh 2 / (1 + exp) - 1. Unless ``keep`` is
    set, all steps share the place of what only the gradient needs.
    """

    def __init__(self, network: Network, gates: np.ndarray, goes_on: np.ndarray, room: _Room, keep: bool = False) -> None:
        n, _, width = gates.shape
        h, kind = HIDDEN, gates.dtype
        self.gates, self.goes_on = gates, goes_on
        self.recurrent = np.ascontiguousarray(network.values["recurrent"].T * np.repeat(np.array([-1, -1, -2], kind), h)[:, None])
        self.at = list(range(n)) if keep else [0] * n
        kept = n if keep else 1
        self.states = room("states", (n, h, width), kind)
        self.olds, self.new, self.gap = (room(name, (kept, h, width), kind) for name in ("olds", "new", "gap"))
        self.both = room("both", (kept, 2 * h, width), kind)  # update and reset
        self.by_state = room("by_state", (kept, 3 * h, width), kind)

    def run(self, state: np.ndarray) -> np.ndarray:
        """From the state before the window to a copy of that after it."""
        h, recurrent = HIDDEN, self.recurrent
        with np.errstate(over="ignore"):  # 1 / (1 + inf) is the 0 that is meant
            for at, gates, goes_on, after in zip(self.at, self.gates, self.goes_on, self.states):
                old, new, gap, both, by_state = self.olds[at], self.new[at], self.gap[at], self.both[at], self.by_state[at]
                np.multiply(state, goes_on, out=old)
                np.matmul(recurrent, old, out=by_state)
                np.add(gates[h:], by_state[: 2 * h], out=both)
                np.exp(both, out=both)
                both += 1
                np.reciprocal(both, out=both)
                np.multiply(both[h:], by_state[2 * h :], out=new)
                new += gates[:h]
                np.exp(new, out=new)
                new += 1
                np.divide(2, new, out=new)
                new -= 1
                np.subtract(old, new, out=gap)
                np.multiply(gap, both[:h], out=after)
                after += new
                state = after
        return state.copy()


def _gates(network: Network, before: np.ndarray, room: _Room) -> tuple[np.ndarray, np.ndarray]:
    """The embedding of each token before, with a one at the end, and its scaled gates."""
    v = network.values
    table = np.concatenate([v["embedding"], np.ones((len(v["embedding"]), 1), v["embedding"].dtype)], axis=1)
    into = _scaled(np.concatenate([v["input"], v["input_bias"][None]]))
    embedded = table.take(before, axis=0, out=room("embedded", (*before.shape, table.shape[1]), table.dtype), mode="clip")
    gates = room("gates", (len(before), 3 * HIDDEN, before.shape[1]), table.dtype)
    return embedded, np.matmul(into.T, embedded.transpose(0, 2, 1), out=gates)


def _rows_of(lanes: np.ndarray, chosen: np.ndarray, room: _Room) -> np.ndarray:
    """The chosen ones of the rows for each step and lane, from steps with lanes in columns."""
    n, h, width = lanes.shape
    rows = room("rows", (n, width, h), lanes.dtype)
    np.copyto(rows, lanes.transpose(0, 2, 1))
    rows = rows.reshape(-1, h)
    return rows if len(chosen) == len(rows) else rows.take(chosen, axis=0)


def lanes_of(lengths: np.ndarray, width: int) -> list[list[int]]:
    """Documents dealt to at most ``width`` lanes, longest first to the shortest lane; longest lane first."""
    import heapq

    lanes: list[list[int]] = [[] for _ in range(max(1, min(width, len(lengths))))]
    heap = [(0, k) for k in range(len(lanes))]
    for at in np.argsort(-lengths, kind="stable").tolist():
        size, k = heapq.heappop(heap)
        lanes[k].append(at)
        heapq.heappush(heap, (size + int(lengths[at]), k))
    return sorted(lanes, key=lambda lane: -sum(int(lengths[at]) for at in lane))


def _laid_out(documents: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens by step and lane, the document of each (-1: none), and the length of each lane."""
    lengths = np.array([len(d) for d in documents])
    lanes = lanes_of(lengths, width)
    sizes = np.array([sum(int(lengths[at]) for at in lane) for lane in lanes])
    tokens = np.zeros((int(sizes.max(initial=0)), len(lanes)), dtype=np.int32)
    owner = np.full(tokens.shape, -1, dtype=np.int32)
    for k, lane in enumerate(lanes):
        if lane:
            tokens[: sizes[k], k] = np.concatenate([documents[at] for at in lane])
            owner[: sizes[k], k] = np.repeat(np.array(lane, np.int32), lengths[lane])
    return tokens, owner, sizes


def _inputs(tokens: np.ndarray, owner: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The token before each, or ``start``, and whether a document goes on there."""
    goes_on = np.zeros(owner.shape, dtype=bool)
    goes_on[1:] = owner[1:] == owner[:-1]
    before = np.full(tokens.shape, start, dtype=np.int32)
    before[1:] = np.where(goes_on[1:], tokens[:-1], start)
    return before, goes_on


def score_documents(
    network: Network, documents: list[np.ndarray], width: int = 256, mixed=lambda found, targets: found
) -> np.ndarray:
    """Natural log-likelihood of each whole document; lanes run side by side and carry their state from window to window.

    ``mixed`` may turn the network's log-likelihoods of some tokens into others.
    """
    out = np.zeros(len(documents))
    if not documents:
        return out
    tokens, owner, sizes = _laid_out(documents, width)
    before, goes_on = _inputs(tokens, owner, network.start_row)
    room = _Room()
    state = np.zeros((HIDDEN, tokens.shape[1]), dtype=np.float32)
    low = high = 0
    while high < len(tokens):
        low = high
        n = int((sizes > low).sum())  # lanes that still run are the first ones
        high = min(low + max(WINDOW, _AT_ONCE // n), len(tokens))
        part = slice(low, high), slice(0, n)
        _, gates = _gates(network, before[part], room)
        steps = _Steps(network, gates, goes_on[part].astype(gates.dtype), room)
        state = steps.run(state[:, :n])
        own = owner[part].ravel()
        real = np.flatnonzero(own >= 0)
        targets = tokens[part].ravel()[real]
        found = mixed(network.log_likelihood(_rows_of(steps.states, real, room), targets, room=room), targets)
        out += np.bincount(own[real], weights=found, minlength=len(out))
    return out


def train_on(network: Network, documents: list[np.ndarray], width: int = 128, rate: float = 0.01, note=None) -> Network:
    """One pass of truncated backpropagation: a step of Adam for each window, with the state carried into it.

    ``note`` is told the log-likelihoods of each window's tokens, by the network before it learns from them.
    """
    if not documents:
        return network
    flat = network.flat()
    network = Network(_views(flat, len(network.values["class_bias"])))
    first, second = np.zeros_like(flat), np.zeros_like(flat)
    tokens, owner, sizes = _laid_out(documents, width)
    before, goes_on = _inputs(tokens, owner, network.start_row)
    state = np.zeros((tokens.shape[1], HIDDEN), dtype=np.float32)
    slope, moved, room = np.empty_like(flat), np.empty_like(flat), _Room()
    for number, low in enumerate(range(0, len(tokens), WINDOW), 1):
        n = int((sizes > low).sum())  # lanes that still run are the first ones
        part = slice(low, min(low + WINDOW, len(tokens))), slice(0, n)
        real = owner[part] >= 0
        slopes, state = window_slopes(network, before[part], tokens[part], real, goes_on[part], state[:n], note, room)
        np.concatenate([slopes[name].ravel() for name in _shapes(1)], out=slope)
        slope *= 1.0 / max(1, int(real.sum()))
        np.clip(slope, -1.0, 1.0, out=slope)
        first *= 0.9
        first += np.multiply(slope, 0.1, out=moved)
        second *= 0.99
        np.square(slope, out=slope)
        slope *= 0.01
        second += slope
        spread = np.multiply(second, 1 / (1 - 0.99**number), out=slope)
        np.sqrt(spread, out=spread)
        spread += 1e-7
        np.multiply(first, rate / (1 - 0.9**number), out=moved)
        moved /= spread
        flat -= moved
    return network


def window_slopes(
    network: Network,
    before: np.ndarray,
    tokens: np.ndarray,
    real: np.ndarray,
    goes_on: np.ndarray,
    state: np.ndarray,
    note=None,
    room: _Room | None = None,
) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The gradient of a window's negated log-likelihood, by backpropagation to its first step, and the state after it.

    The gradient's arrays last until the next window in the same ``room``.
    """
    values, h, room = network.values, HIDDEN, room or _Room()
    embedded, gates = _gates(network, before, room)
    n, _, width = gates.shape
    kind, lanes = gates.dtype, (n, h, width)
    goes_on = goes_on.astype(kind)
    steps = _Steps(network, gates, goes_on, room, keep=True)
    state = steps.run(state.T)
    chosen = np.flatnonzero(real)
    slopes: dict[str, np.ndarray] = {}
    targets = tokens.ravel()[chosen]
    found = network.log_likelihood(_rows_of(steps.states, chosen, room), targets, slopes, room)
    if note is not None:
        note(found, targets)
    by_rows = slopes.pop("states")
    if len(chosen) < real.size:
        spread = np.zeros((real.size, h), kind)
        spread[chosen] = by_rows
        by_rows = spread
    above = room("above_lanes", lanes, kind)
    np.copyto(above, by_rows.reshape(n, width, h).transpose(0, 2, 1))
    update, reset = steps.both[:, :h], steps.both[:, h:]
    # What each gate's slope is to that of the state, for all steps at once.
    by_new, by_reset, rest = (room(name, lanes, kind) for name in ("by_new", "by_reset", "rest"))
    by_update = np.multiply(steps.gap, update, out=steps.gap)
    by_update *= np.subtract(1, update, out=rest)
    np.square(steps.new, out=by_new)
    np.subtract(1, by_new, out=by_new)
    by_new *= rest
    np.multiply(steps.by_state[:, 2 * h :], reset, out=by_reset)
    np.subtract(reset, 1, out=rest)
    rest *= 0.5  # the state's part in new was scaled by -2
    by_reset *= rest
    # Slopes of new, update and reset, as of the gates; then of new as of the state's part in it.
    each = room("each", (n, 4 * h, width), kind)
    later, back = np.zeros_like(state), np.empty_like(state)
    for t in range(n - 1, -1, -1):
        d, own = above[t], each[t]
        d += later
        d_new = np.multiply(d, by_new[t], out=own[:h])
        np.multiply(d, by_update[t], out=own[h : 2 * h])
        np.multiply(d_new, by_reset[t], out=own[2 * h : 3 * h])
        np.multiply(d_new, reset[t], out=own[3 * h :])
        np.matmul(values["recurrent"], own[h:], out=back)
        np.multiply(d, update[t], out=later)
        later += back
        later *= goes_on[t]
    of_gates, of_states = each[:, : 3 * h], each[:, h:]
    by_step = np.matmul(of_states, steps.olds.transpose(0, 2, 1), out=room("by_step", (n, 3 * h, h), kind))
    slopes["recurrent"] = by_step.sum(axis=0).T
    by_step = np.matmul(of_gates, embedded, out=room("by_step", (n, 3 * h, EMBEDDING + 1), kind))
    of_input = np.roll(by_step.sum(axis=0).T, -h, axis=1)
    slopes["input"], slopes["input_bias"] = of_input[:EMBEDDING], of_input[EMBEDDING]
    of_embedded = room("of_embedded", (n, width, EMBEDDING), kind)
    np.matmul(of_gates.transpose(0, 2, 1), np.roll(values["input"], h, axis=1).T, out=of_embedded)
    of_embedded, flat = of_embedded.reshape(-1, EMBEDDING), before.ravel()
    order = np.argsort(flat.astype(np.int16), kind="stable")
    rows, begin = np.unique(flat[order], return_index=True)
    ordered = of_embedded.take(order, axis=0, out=room("ordered_embedded", of_embedded.shape, kind), mode="clip")
    slopes["embedding"] = np.zeros_like(values["embedding"])
    slopes["embedding"][rows] = np.add.reduceat(ordered, begin, axis=0)
    return slopes, state.T


def words_of(text: bytes) -> list[bytes]:
    """What ASCII white space separates, A-Z in lower case."""
    return text.lower().split()


@dataclass
class _Words:
    """A block's different words in the order of their hashes, so that a bucket's are neighbours, whatever the buckets' number."""

    hashes: np.ndarray
    counts: np.ndarray  # in the block's training documents
    joined: bytes

    def packed(self) -> bytes:
        parts = np.int64(len(self.hashes)).tobytes(), self.hashes.tobytes(), self.counts.tobytes(), self.joined
        return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))

    @classmethod
    def unpacked(cls, packed: bytes) -> _Words:
        data = zstandard.ZstdDecompressor().decompress(packed)
        n = int(np.frombuffer(data, np.int64, 1)[0])
        return cls(np.frombuffer(data, np.uint32, n, 8), np.frombuffer(data, np.int64, n, 8 + 4 * n), data[8 + 12 * n :])

    def starts(self) -> np.ndarray:
        """Where words start among the joined bytes, and would after the last; no word holds a space."""
        return np.concatenate([[0], np.flatnonzero(np.frombuffer(self.joined, np.uint8) == 32) + 1, [len(self.joined) + 1]])

    def numbers(self, vocabulary: dict[bytes, int]) -> np.ndarray:
        """The network's number of each word; only words with the hash of one in the vocabulary are looked at."""
        out, starts = np.full(len(self.hashes), _RARE, np.int32), self.starts()
        wanted = np.fromiter(map(zlib.crc32, vocabulary), np.uint32, len(vocabulary))
        begins, ends = (np.searchsorted(self.hashes, wanted, side).tolist() for side in ("left", "right"))
        for (word, number), begin, end in zip(vocabulary.items(), begins, ends):
            for k in range(begin, end):
                if self.joined[starts[k] : starts[k + 1] - 1] == word:
                    out[k] = number
        return out

    def questions(self, buckets: int) -> Iterator[tuple[int, int, bytes]]:
        """Bucket, number of words, and the counts and words, for each bucket that has words."""
        bucket = self.hashes.astype(np.int64) * buckets >> 32
        numbers, begins = np.unique(bucket, return_index=True)
        ends = np.append(begins[1:], len(bucket))
        starts = self.starts()
        for number, begin, end in zip(numbers.tolist(), begins.tolist(), ends.tolist()):
            words = self.joined[starts[begin] : starts[end] - 1]
            yield number, end - begin, self.counts[begin:end].tobytes() + words


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents as places among the block's different words."""
    for batch in small_batches(batches, "__text", exchange.BLOCK_BYTES):
        texts = [t.as_buffer().to_pybytes() for t in batch.column(2)]
        met: defaultdict[bytes, int] = defaultdict(count().__next__)  # words by when they are first met
        tokens = [np.fromiter(map(met.__getitem__, words), np.int32, len(words)) for words in map(words_of, texts)]
        found = list(met)
        hashes = np.fromiter(map(zlib.crc32, found), np.uint32, len(found))
        order = np.argsort(hashes, kind="stable")
        each = [found[k] for k in order.tolist()]
        place = np.empty(len(found), np.int32)
        place[order] = np.arange(len(found), dtype=np.int32)
        tokens = [place[own] for own in tokens]
        learned = [own for own, number in zip(tokens, batch.column(1).to_pylist()) if number >= 0]
        counts = np.bincount(np.concatenate([*learned, np.zeros(0, np.int32)]), minlength=len(each)).astype(np.int64)
        words = _Words(hashes[order], counts, b" ".join(each))
        kept = pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([own.tobytes() for own in tokens], pa.binary())], names=_KEPT)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, kept.schema) as stream:
            stream.write_batch(kept)
        packed = zstandard.ZstdCompressor(level=3).compress(sink.getvalue())
        columns = [[sum(map(len, texts))], [len(learned)], [packed], [words.packed()]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["size", "learned", "packed", "words"])


_KEPT = ["__key", "__round", "__tokens"]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for whole in batches:
        for k in range(whole.num_rows):
            yield whole.slice(k, 1).to_pylist()[0]


def _places(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(t.as_buffer(), np.int32) for t in batch.column(2)]


def _ask_counts(buckets: int):
    """Each block's different words, with their counts in its training documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            asked = list(_Words.unpacked(row["words"]).questions(buckets))
            columns = [pa.array([a[0] for a in asked], pa.int64()), pa.array([row["block"]] * len(asked), pa.int64())]
            columns += [pa.array([a[1] for a in asked], pa.int64()), pa.array([a[2] for a in asked], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "block", "n", "question"])

    return run


def _sum_counts(group: pa.Table) -> pa.Table:
    """The counts over all blocks, for each block in its order; under block -1 the bucket's totals and most frequent words."""
    totals: defaultdict[bytes, int] = defaultdict(int)
    asked = []
    for n, question in zip(group.column("n").to_pylist(), group.column("question").to_pylist()):
        own = question[8 * n :].split(b" ")
        for word, count in zip(own, np.frombuffer(question[: 8 * n], dtype="<i8").tolist()):
            totals[word] += count
        asked.append(own)
    answers = [np.fromiter(map(totals.__getitem__, own), dtype="<i8", count=len(own)).tobytes() for own in asked]
    seen = [(-count, word) for word, count in totals.items() if count]
    top = sorted(seen)[:WORDS]
    bucket = group.column("bucket")[0].as_py()
    return pa.table(
        {
            "block": pa.array([*group.column("block").to_pylist(), -1], pa.int64()),
            "bucket": pa.array([bucket] * (len(answers) + 1), pa.int64()),
            "answer": pa.array([*answers, b""], pa.binary()),
            "tokens": pa.array([0] * len(answers) + [sum(totals.values())], pa.int64()),
            "different": pa.array([0] * len(answers) + [len(seen)], pa.int64()),
            "top": pa.array([None] * len(answers) + [[{"word": w, "n": -c} for c, w in top]], _TOP),
        }
    )


_TOP = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))
_REPLY = "block long, bucket long, answer binary, tokens long, different long, top array<struct<word: binary, n: long>>"


@dataclass
class Corpus:
    """Totals of the training tokens, and the words that the network tells apart."""

    tokens: int
    different: int
    documents: int
    vocabulary: dict[bytes, int]
    counts: np.ndarray

    @property
    def mass(self) -> float:
        """What the base divides by."""
        return self.tokens + 0.5 * (self.different + 1)


def _corpus(replies: DataFrame, documents: int) -> Corpus:
    totals = replies.where("block = -1")
    tokens, different = totals.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("different"), F.lit(0))).first()
    top = totals.select(F.inline("top")).orderBy(F.desc("n"), "word").limit(WORDS - 2).collect()
    counts = np.full(WORDS, 0.5)  # slots without a word keep the share of an unseen one
    counts[_END] = documents + 0.5
    vocabulary = {}
    for k, row in enumerate(top, 2):
        vocabulary[bytes(row["word"])] = k
        counts[k] = row["n"] + 0.5
    tokens, different = tokens + documents, different + (documents > 0)
    rest = tokens + 0.5 * (different + 1) - counts[_END] - counts[2 : 2 + len(top)].sum()
    counts[_RARE] = max(rest, 0.5)
    return Corpus(tokens, different, documents, vocabulary, counts)


@dataclass
class Mixture:
    """The network's share in each token's probability; the rest is the unigram base's."""

    share: float
    base: np.ndarray  # log probability of each token that the network tells apart

    def __call__(self, found: np.ndarray, targets: np.ndarray) -> np.ndarray:
        return np.logaddexp(found + np.log(self.share), self.base[targets] + np.log1p(-self.share))

    @classmethod
    def fit(cls, counts: np.ndarray, gains: np.ndarray, times: np.ndarray) -> Mixture:
        """The share that makes tokens likeliest whose log-likelihood by the network is that much (``gains``) above the base's."""
        share = 0.5
        for _ in range(200 if len(gains) else 0):
            own = share * np.exp(gains)
            share = float(np.average(own / (own + 1 - share), weights=times))
            share = min(max(share, 1e-3), 1 - 1e-3)
        return cls(share, np.log(counts / counts.sum()))


class _Gains:
    """How often the network is that much above the base, in steps of a twentieth."""

    MOST = 20 * 20

    def __init__(self, counts: np.ndarray) -> None:
        self.base = np.log(counts / counts.sum())
        self.times = np.zeros(2 * self.MOST + 1, np.int64)

    def note(self, found: np.ndarray, targets: np.ndarray) -> None:
        steps = np.rint(np.clip((found - self.base[targets]) * 20, -self.MOST, self.MOST)).astype(np.int64)
        self.times += np.bincount(steps + self.MOST, minlength=len(self.times))

    @classmethod
    def mixture(cls, counts: np.ndarray, times: np.ndarray) -> Mixture:
        some = np.flatnonzero(times)
        return Mixture.fit(counts, (some - cls.MOST) / 20, times[some])


def _mean(group: pa.Table) -> pa.Table:
    """Parameters averaged by the tokens that they have seen, and the sum of what was noted."""
    weights = group["weight"].to_numpy().astype(np.float64)
    total = sum(w * np.frombuffer(v.as_py(), np.float32) for w, v in zip(weights, group["value"]))
    value = (total / weights.sum()).astype(np.float32).tobytes()
    times = sum(np.frombuffer(v.as_py(), np.int64) for v in group["times"]).tobytes()
    columns = [pa.array([int(weights.sum())], pa.int64()), pa.array([value], pa.binary()), pa.array([times], pa.binary())]
    return pa.Table.from_arrays(columns, names=["weight", "value", "times"])


_LEARNED = "weight long, value binary, times binary"


def _train(stored: DataFrame, corpus: Corpus, total_bytes: int, rounds: int) -> tuple[Network, Mixture]:
    """Rounds of local training, each over documents of its own, all together over all that are learned from.

    The parameters are averaged by tokens after each round. The mixture's share makes the training documents
    likeliest, each by the network as it is before it learns from that document's window.
    """
    spark = stored.sparkSession
    network = Network.start(corpus.counts)
    classes = WORDS // CLASS_SIZE
    vocabulary = spark.sparkContext.broadcast(corpus.vocabulary)
    counts = corpus.counts
    shards = max(1, round(total_bytes / rounds / _SHARD_BYTES))
    dealt = stored.where("learned > 0").select("packed", "words").coalesce(shards)
    times = np.zeros_like(_Gains(counts).times)
    for number in range(rounds):
        flat = spark.sparkContext.broadcast(network.flat())

        def run(batches: Iterator[pa.RecordBatch], flat=flat, number=number) -> Iterator[pa.RecordBatch]:
            local, weight, gains = Network.from_flat(flat.value, classes), 0, _Gains(counts)
            documents: list[np.ndarray] = []
            held = 0
            for row in _rows(batches):
                batch, ids = exchange.unpacked(row["packed"]), _Words.unpacked(row["words"]).numbers(vocabulary.value)
                own = batch.filter(pa.array(batch.column(1).to_numpy() == number))
                found = [np.append(ids[at], np.int32(_END)) for at in _places(own)]
                documents += found
                held += sum(map(len, found))
                if held > _SHARD_TOKENS:
                    local, documents, weight, held = train_on(local, documents, note=gains.note), [], weight + held, 0
            local, weight = train_on(local, documents, note=gains.note), weight + held
            if weight:
                columns = [pa.array([weight], pa.int64()), pa.array([local.flat().tobytes()]), pa.array([gains.times.tobytes()])]
                yield pa.RecordBatch.from_arrays(columns, names=["weight", "value", "times"])

        grouped = dealt.mapInArrow(run, _LEARNED).groupBy(F.pmod(F.spark_partition_id(), F.lit(_GROUPS)).alias("part"))
        found = grouped.applyInArrow(_mean, _LEARNED).toArrow()
        if found.num_rows:
            found = _mean(found)
            network = Network.from_flat(np.frombuffer(found["value"][0].as_py(), np.float32), classes)
            times = times + np.frombuffer(found["times"][0].as_py(), np.int64)
    return network, _Gains.mixture(counts, times)


def score(docs: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Log10 probabilities of whole documents: of the model, and of the unigram base.

    Returns ``key``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.
    Tokens are a text's words and one end. Counts are over all rows for which ``learn``
    holds, and so are the network's gradients: each of these rows is in one of the ``rounds``, drawn by
    the key's hash. The network tells apart the most frequent words; any other word's probability is that of a rare word times its
    share of the rare words' smoothed counts, so a probability is left for every word. A
    token's probability mixes the network's with the base's, in the proportion that
    makes these rows likeliest, each before it is learned from. A null text is empty and has one
    token, the end; all rows, repeated ones too, are kept and scored. If nothing is learned from, all tokens count zero times. An empty table gives
    an empty result.
    """
    number = F.when(F.coalesce(learn, F.lit(False)), F.floor(uniform(docs[key]) * rounds).cast("int")).otherwise(-1)
    named = docs.select(
        docs[key].alias("__key"), number.alias("__round"), F.coalesce(docs[text], F.lit("")).cast("binary").alias("__text")
    )
    kind = docs.schema[key].dataType.simpleString()
    stored = exchange.numbered(named.mapInArrow(_cut, "size long, learned long, packed binary, words binary"))
    buckets = exchange.n_buckets(stored, 0.5)
    asked = stored.mapInArrow(_ask_counts(buckets), "bucket long, block long, n long, question binary")
    replies = settle(asked.groupBy("bucket").applyInArrow(_sum_counts, _REPLY), "counts")
    total, learned = stored.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("learned"), F.lit(0))).first()
    corpus = _corpus(replies, learned)
    network, mixture = _train(stored, corpus, total, rounds)
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((network.flat(), mixture, corpus))
    answers = replies.where("block >= 0").groupBy("block").agg(F.collect_list(F.struct("bucket", "answer")).alias("answers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, mixture, corpus = shared.value
        network = Network.from_flat(flat, WORDS // CLASS_SIZE)
        rows: list[tuple] = []
        documents: list[np.ndarray] = []
        size = 0
        for row in _rows(batches):
            found = exchange.unpacked(row["packed"])
            for item in _counted(found, _Words.unpacked(row["words"]), row["round_0"], corpus):
                rows.append(item[:-1])
                documents.append(item[-1])
            size += row["size"]
            kept_type = found.schema.field("__key").type
            if size > _GROUP_BYTES:
                yield _scored(network, mixture, rows, documents, corpus, kept_type)
                rows, documents, size = [], [], 0
        if rows:
            yield _scored(network, mixture, rows, documents, corpus, kept_type)

    schema = f"__key {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    scored = exchange.with_answers(stored, answers).mapInArrow(run, schema)
    return scored.withColumnRenamed("__key", key)


def _counted(batch: pa.RecordBatch, words: _Words, answers: list[dict] | None, corpus: Corpus) -> Iterator[tuple]:
    """Key, tokens, known tokens, base score, what rare words add, and the network's tokens, of each document."""
    told = sorted(answers or (), key=lambda pair: pair["bucket"])
    counts = np.concatenate([*(np.frombuffer(pair["answer"], dtype="<i8") for pair in told), np.zeros(0, np.int64)])
    ids = words.numbers(corpus.vocabulary)
    logs = np.log10(counts + 0.5)
    rare = np.where(ids == _RARE, logs - np.log10(corpus.counts[_RARE]), 0.0)
    known = counts > 0
    end = np.log10(corpus.documents + 0.5)
    mass = np.log10(corpus.mass)
    for key, at in zip(batch.column(0).to_pylist(), _places(batch)):
        n = len(at) + 1
        base = float(logs[at].sum() + end - n * mass)
        yield key, n, int(np.count_nonzero(known[at])) + (corpus.documents > 0), base, float(rare[at].sum()), np.append(ids[at], np.int32(_END))


def _scored(
    network: Network, mixture: Mixture, rows: list[tuple], documents: list[np.ndarray], corpus: Corpus, kind: pa.DataType
) -> pa.RecordBatch:
    found = score_documents(network, documents, mixed=mixture) / _LN10 + np.array([row[4] for row in rows])
    columns = [
        pa.array([row[0] for row in rows], kind),
        pa.array([row[1] for row in rows], pa.int64()),
        pa.array([row[2] for row in rows], pa.int64()),
        pa.array([corpus.tokens] * len(rows), pa.int64()),
        pa.array([row[3] for row in rows], pa.float64()),
        pa.array(found, pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["__key", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
