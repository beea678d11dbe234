"""SentencePiece encoding and decoding by a batched Viterbi search."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.shared import free_name

SPACE = "▁"
_NORMAL, _UNKNOWN, _USER_DEFINED, _BYTE = 1, 2, 4, 6
_UNIGRAM, _BPE = 1, 2
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
#: Bytes that a worker's known words may take: each word's own, its ids' and the dictionary's.
CACHE_BYTES, _ENTRY = 96 << 20, 170
_SIEVE, _SLOTS = 20, 1 << 21
_SHORT = 64
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Codec:
    """Encoder and decoder of one SentencePiece model file, with its library's ids.

    A lattice holds, for each end position, the pieces that end there. In a unigram model
    a piece adds its score to the best path to its start. In a BPE model the merges decide:
    a sequence of pieces is what the merges give exactly if each two neighbours alone merge
    to themselves, so a path is extended by a piece if that holds for it and the path's last
    piece, at no cost, and not otherwise. One path is left for each position.
    """

    def __init__(self, model_file: str) -> None:
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(model_file, "rb") as file:
            model.ParseFromString(file.read())
        rules = model.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("only models with the identity normalizer are supported")
        self.prefix = rules.add_dummy_prefix
        self.kind = model.trainer_spec.model_type
        if self.kind not in (_UNIGRAM, _BPE):
            raise ValueError("only unigram and BPE models are supported")
        self.texts = [piece.piece for piece in model.pieces]
        self.scores = np.array([piece.score for piece in model.pieces])
        self.kinds = np.array([piece.type for piece in model.pieces])
        if (self.kinds == _USER_DEFINED).any():
            raise ValueError("models with user-defined pieces are not supported")
        self.unknown = next(k for k, piece in enumerate(model.pieces) if piece.type == 2)
        self.bytes = {int(self.texts[k][1:-1], 16): k for k in np.nonzero(self.kinds == _BYTE)[0]}
        normal = np.nonzero(self.kinds == _NORMAL)[0]
        self.ids = {self.texts[k]: int(k) for k in normal}
        if any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in self.ids):
            raise ValueError("a piece goes over the start of a word")
        self.longest = max(map(len, self.ids))
        self.pairs = {pair for piece in self.ids for pair in zip(piece, piece[1:])}
        self.lowest = self.scores[normal].min() - 10.0
        keys = np.array([self._hash(self.texts[k]) for k in normal], dtype=np.uint64)
        order = np.argsort(keys)
        self.keys, self.key_ids = keys[order], normal[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces share a hash")
        self.maybe = np.zeros(1 << _SIEVE, dtype=bool)
        self.maybe[self.keys >> np.uint64(64 - _SIEVE)] = True
        self.asked = np.full(_SLOTS, -1)
        self.answers = np.zeros(_SLOTS, dtype=bool)
        self.recent: dict[str, bytes] = {}  # a word's ids as int32
        self.older: dict[str, bytes] = {}
        self.kept = 0
        self.spelt = [self._bytes_of(k) for k in range(len(self.texts))]

    @staticmethod
    def _hash(text: str) -> int:
        value = 0
        for character in text:
            value = (value * int(_BASE) + ord(character) + 1) & 0xFFFFFFFFFFFFFFFF
        return value

    def merged(self, text: str) -> list[int]:
        """Ids of the merges on a few characters; -1 for a character that is no piece."""
        parts = list(text)
        while len(parts) > 1:
            best, at = -np.inf, -1
            for k in range(len(parts) - 1):
                found = self.ids.get(parts[k] + parts[k + 1])
                if found is not None and self.scores[found] > best:
                    best, at = self.scores[found], k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ids.get(part, -1) for part in parts]

    def _may_follow(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Whether the merges keep each pair of pieces apart; -1 before a piece is the word's start.

        Answers are kept in a table of fixed size, one to a slot.
        """
        codes = (before + 1) * len(self.texts) + after
        slots = (codes * 0x9E3779B1 >> 7) & (_SLOTS - 1)
        new = np.nonzero(self.asked[slots] != codes)[0]
        if len(new):
            allowed = {}
            for code in np.unique(codes[new]).tolist():
                left, right = code // len(self.texts) - 1, code % len(self.texts)
                if left < 0:
                    allowed[code] = self.merged(self.texts[right]) == [right]
                else:
                    allowed[code] = self.merged(self.texts[left] + self.texts[right]) == [left, right]
            known = codes[new]
            answers = np.array([allowed[code] for code in known.tolist()])
            result = self.answers[slots]
            result[new] = answers
            self.asked[slots[new]] = known
            self.answers[slots[new]] = answers  # of several to a slot, the last of either list stays
            return result
        return self.answers[slots]

    def _search(self, words: Sequence[str]) -> list[bytes]:
        """Ids (int32) of words of one length: all of them advance together, end by end."""
        n, length = len(words), len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").reshape(n, length).astype(np.uint64)
        total = np.zeros((length + 1, n), dtype=np.uint64)
        powers = np.ones(self.longest + 1, dtype=np.uint64)
        powers[1:] = np.cumprod(np.full(self.longest, _BASE))
        for k in range(length):
            total[k + 1] = total[k] * _BASE + codes[:, k] + np.uint64(1)
        best = np.full((length + 1, n), -np.inf)
        best[0] = 0.0
        last = np.full((length + 1, n), -1, dtype=np.int64)  # the best path's last piece
        back = np.zeros((length + 1, n), dtype=np.int64)  # and that piece's start
        for end in range(1, length + 1):
            low = max(0, end - self.longest)
            starts = np.arange(low, end)
            hashes = total[end][None, :] - total[low:end] * powers[end - starts][:, None]
            known = self.maybe[hashes >> np.uint64(64 - _SIEVE)]
            rows, columns = np.nonzero(known)
            asked = hashes[rows, columns]
            at = np.searchsorted(self.keys, asked).clip(max=len(self.keys) - 1)
            real = self.keys[at] == asked
            known[rows, columns] = real
            piece = np.full(hashes.shape, self.unknown)
            piece[rows[real], columns[real]] = self.key_ids[at[real]]
            single = (starts == end - 1)[:, None] & ~known  # a character that is no piece
            rows, columns = np.nonzero((known | single) & np.isfinite(best[low:end]))
            found = piece[rows, columns]
            before = last[low + rows, columns]
            gain = np.where(known[rows, columns], self.scores[found], self.lowest)
            if self.kind == _BPE:
                check = known[rows, columns]
                allowed = np.ones(len(rows), dtype=bool)
                first = np.where(before == self.unknown, -1, before)
                allowed[check] = self._may_follow(first[check], found[check])
                gain = np.where(allowed, 0.0, -np.inf)
            scored = np.full((end - low, n), -np.inf)
            scored[rows, columns] = best[low + rows, columns] + gain
            choice = scored.argmax(axis=0)
            take = np.arange(n)
            best[end] = scored[choice, take]
            last[end] = piece[choice, take]
            back[end] = low + choice
        return self._back(words, last, back)

    def _back(self, words: Sequence[str], last: np.ndarray, back: np.ndarray) -> list[bytes]:
        """The ids of each word's path as int32 bytes, from its last piece to its first."""
        n = len(words)
        position = np.full(n, len(words[0]))
        active = np.arange(n)
        steps = []
        while len(active):
            at = position[active]
            ids, starts = last[at, active], back[at, active]
            steps.append((active, ids, starts))
            position[active] = starts
            active = active[starts > 0]
        owner, ids, starts = (np.concatenate(column[::-1]) for column in zip(*steps))
        order = np.argsort(owner, kind="stable")
        owner, ids = owner[order], ids[order]
        ends = np.searchsorted(owner, np.arange(n + 1)) * 4
        flat = ids.astype(np.int32).tobytes()
        out = [flat[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        unknown = np.nonzero(ids == self.unknown)[0]
        if len(unknown):
            starts = starts[order]
            for k in np.unique(owner[unknown]).tolist():
                pieces = zip(ids[ends[k] // 4 : ends[k + 1] // 4].tolist(), starts[ends[k] // 4 : ends[k + 1] // 4].tolist())
                spelt = [i for piece, start in pieces for i in (self._spelt(words[k][start]) if piece == self.unknown else [piece])]
                out[k] = np.array(spelt, dtype=np.int32).tobytes()
        return out

    def _spelt(self, character: str) -> list[int]:
        """The byte pieces of a character that is no piece; the unknown id in a model without them."""
        return [self.bytes[b] for b in character.encode()] if self.bytes else [self.unknown]

    def _words(self, text: str) -> list[str]:
        spaced = text.replace(" ", SPACE)
        words = _WORD.findall(SPACE + spaced if self.prefix and text else spaced)
        if len(words) * _SHORT < len(spaced) or any(len(word) > _SHORT for word in words):
            words = [part for word in words for part in (self._parts(word) if len(word) > _SHORT else [word])]
        return words

    def _parts(self, word: str) -> list[str]:
        """A long word, cut between any two characters that stand side by side in no piece: none goes over the cut."""
        cuts = [k for k, pair in enumerate(zip(word, word[1:]), 1) if pair not in self.pairs]
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)])]

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Ids of each text, as the library's ``encode`` gives them."""
        cut = [self._words(text) for text in texts]
        found: dict[str, bytes] = {}
        new: dict[int, list[str]] = {}
        for word in set().union(*cut):
            ids = self.recent.get(word)
            if ids is None:
                ids = self.older.get(word)
                if ids is None:
                    new.setdefault(len(word), []).append(word)
                    continue
                self._keep(word, ids)
            found[word] = ids
        for length, words in new.items():
            step = max(1, 200_000 // (length * self.longest))
            for start in range(0, len(words), step):
                part = words[start : start + step]
                for word, ids in zip(part, self._search(part)):
                    found[word] = ids
                    if length <= _SHORT:  # long words don't come again
                        self._keep(word, ids)
        return [np.frombuffer(b"".join(map(found.__getitem__, words)), dtype=np.int32) for words in cut]

    def _keep(self, word: str, ids: bytes) -> None:
        """Remember a word; when half the room is taken, the words not met since the last time go."""
        self.recent[word] = ids
        self.kept += len(ids) + 4 * len(word) + _ENTRY
        if self.kept > CACHE_BYTES // 2:
            self.older, self.recent, self.kept = self.recent, {}, 0

    def _bytes_of(self, k: int) -> bytes:
        """What a piece decodes to."""
        if self.kinds[k] == _BYTE:
            return bytes([int(self.texts[k][1:-1], 16)])
        if self.kinds[k] == _UNKNOWN:
            return " ⁇ ".encode()
        return self.texts[k].replace(SPACE, " ").encode() if self.kinds[k] == _NORMAL else b""

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids: spaces restored, byte pieces joined, the added first space taken off."""
        text = b"".join([self.spelt[k] for k in ids]).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


_codecs: dict[str, Codec] = {}


def codec(model_file: str) -> Codec:
    """One codec for each worker and file."""
    if model_file not in _codecs:
        _codecs[model_file] = Codec(model_file)
    return _codecs[model_file]


def encode(
    docs: DataFrame, model_file: str, text: str = "text", ids: str = "token_ids", exact: str | None = None
) -> DataFrame:
    """``docs`` with an array of ids, null for a null text and empty for an empty one.

    With ``exact``, a column of that name tells whether the ids decode to the very text (a null
    text: true); it is found beside the ids, so that one codec a worker does both. Repeated rows
    give the same ids; other columns pass through in the JVM, those named ``ids`` or ``exact`` are
    replaced. The file has to be at the same path on every machine.
    """
    given = {ids: "ids", **({exact: "exact"} if exact else {})}

    @F.arrow_udf("ids array<int>, exact boolean" if exact else "ids array<int>")
    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tool = codec(model_file)
        for texts in batches:
            parts = [_coded(tool, part, bool(exact)) for part in _slices(texts, 4 << 20)]
            yield pa.concat_arrays(parts) if parts else _coded(tool, texts, bool(exact))

    rest = [name for name in docs.columns if name.lower() not in {name.lower() for name in given}]
    answer = free_name(docs, "answer")
    return docs.select(*(docs[c] for c in rest), coded(docs[text]).alias(answer)).select(
        *rest, *(F.col(f"{answer}.{field}").alias(name) for name, field in given.items())
    )


def _slices(texts: pa.Array, limit: int) -> Iterator[pa.Array]:
    """The same texts in slices of about that many bytes, one text at least."""
    start, size = 0, 0
    lengths = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    for at, length in enumerate(lengths.tolist()):
        if size and size + length > limit:
            yield texts.slice(start, at - start)
            start, size = at, 0
        size += length
    if start < len(texts):
        yield texts.slice(start)


def _coded(tool: Codec, texts: pa.Array, exact: bool) -> pa.StructArray:
    values = texts.to_pylist()
    found = tool.encode([value or "" for value in values])
    ends = np.cumsum([0, *(len(f) for f in found)]).astype(np.int32)
    flat = pa.array(np.concatenate(found) if found else np.zeros(0, np.int32))
    columns = [pa.ListArray.from_arrays(pa.array(ends), flat, mask=texts.is_null())]
    if exact:
        same = [value is None or tool.decode(f.tolist()) == value for value, f in zip(values, found)]
        columns.append(pa.array(same, pa.bool_()))
    return pa.StructArray.from_arrays(columns, names=["ids", "exact"][: len(columns)])


def decode(docs: DataFrame, model_file: str, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the text of its ids, null for null; a column named ``text`` is replaced."""
    rest = [name for name in docs.columns if name.lower() != text.lower()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(model_file)
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                lists = batch.column(batch.num_columns - 1)
                found = [tool.decode(v) if v is not None else None for v in lists.to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.string())], names=[*rest, text])

    chosen = docs.select(*(docs[c] for c in rest), docs[ids].alias("__ids"))
    schema = chosen.drop("__ids").schema.add(text, "string")
    return chosen.mapInArrow(run, schema)
