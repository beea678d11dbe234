"""Fingerprints, edit distances and the chain of next documents against plain Python."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripmill.llm import piecewise_hash as ph
from tripmill.llm.queries import QUERIES

M = 1 << 64
REPEATED = "a line that comes again and again\n"


def mixed(value):
    value = (value ^ (value >> 32)) * 0xD6E8FEB86659FD93 % M
    return value ^ (value >> 29)


def polynomial(data):
    value = 0
    for byte in data:
        value = (value * 0x9E3779B97F4A7C15 + byte + 1) % M
    return value


def scalar_fingerprint(data):
    """The definition, byte by byte."""
    if not data:
        return "0::"
    ends = []
    for i in range(len(data)):
        mark = mixed(polynomial(data[max(0, i - ph.WINDOW + 1) : i + 1])) >> 32
        level = 32 if mark == 0 else (mark & -mark).bit_length() - 1
        ends.append(33 if i == len(data) - 1 else level)
    level = math.ceil(math.log2(max(len(data), ph.USUAL) / ph.USUAL))
    while level and sum(e >= level for e in ends) < ph.FEWEST:
        level -= 1
    signatures = []
    for k in (level, level + 1):
        at = [i for i, e in enumerate(ends) if e >= k]
        if len(at) > ph.MOST:
            at = at[: ph.MOST - 1] + at[-1:]
        begin, tokens = 0, []
        for end in at:
            value = mixed(polynomial(data[begin : end + 1])) >> 52
            tokens.append(ph._DIGITS[value >> 6] + ph._DIGITS[value & 63])
            begin = end + 1
        signatures.append("".join(tokens))
    return f"{level}:{signatures[0]}:{signatures[1]}"


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def scalar_likeness(a, b):
    if a == b:
        return 1.0

    def cut(fp):
        k, *signatures = fp.split(":")
        return {int(k) + m: [s[i : i + 2] for i in range(0, len(s), 2)] for m, s in enumerate(signatures)}

    a, b = cut(a), cut(b)
    shares = [1 - levenshtein(a[k], b[k]) / max(len(a[k]), len(b[k]), 1) for k in a.keys() & b.keys()]
    return max(shares, default=0.0)


def texts():
    r = random.Random(2)
    words = ["".join(r.choice("abcdefghijklmnopé") for _ in range(r.randrange(1, 9))) for _ in range(300)]
    out = ["", "a", "ab", "日本", "x" * 700, REPEATED * 60, "ab" * 40]
    out += [" ".join(r.choice(words) for _ in range(n)) for n in (1, 2, 5, 14, 60, 200, 600)]
    return out + [out[-1], out[-1] + " more", REPEATED * 20 + out[-2]]


def test_fingerprints_equal_the_definition():
    data = [t.encode() for t in texts()]
    want = [scalar_fingerprint(t) for t in data]
    assert ph.fingerprints(data) == want
    assert [ph._long(t) if t else "0::" for t in data] == want


def test_long_texts_take_the_same_way():
    r = np.random.default_rng(3)
    for n in (ph._SLICE - 7, ph._SLICE - 6, ph._SLICE + 1, 3 * ph._SLICE, 1_000_000):
        data = r.integers(32, 127, n, dtype=np.uint8).tobytes()
        whole = ph.fingerprints([data])[0]
        if n + ph.WINDOW <= 2 * ph._SLICE:
            assert whole == ph._batch([data])[0] == ph._long(data)
        assert 16 <= len(whole.split(":")[1]) // 2 <= ph.MOST
        half = ph.fingerprints([data[: n // 2] + r.integers(32, 127, n - n // 2, dtype=np.uint8).tobytes()])[0]
        assert 0.3 < ph.likeness([whole], [half])[0] < 0.7
    assert ph.fingerprints([b"x" * 1_000_000])[0].startswith("0:")


def test_likeness():
    prints = ph.fingerprints([t.encode() for t in texts()])
    pairs = [(a, b) for a in prints for b in prints]
    got = ph.likeness([a for a, _ in pairs], [b for _, b in pairs])
    assert got.tolist() == pytest.approx([scalar_likeness(a, b) for a, b in pairs])


def chained(rows):
    """Per row: what the chain gives, by a sorted list."""
    from xxhash import xxh64_intdigest

    def mark(text):
        value = xxh64_intdigest(text.encode(), 42)
        return value - M if value >= M // 2 else value

    rows = sorted(((k, t or "") for k, t in rows), key=lambda x: (x[0] is None, -(x[0] or 0), -mark(x[1])))
    out = []
    for (k, here), (_, following) in zip(rows, rows[1:] + rows[:1]):
        n = len(here)
        edited = here[: n - n // 2] + following[: n // 2]
        a, b, c = (scalar_fingerprint(t.encode()) for t in (here, edited, following))
        out.append((k, n, hashlib.sha256(edited.encode()).hexdigest(), a, b, scalar_likeness(a, b), scalar_likeness(a, c)))
    return out


@pytest.mark.parametrize("part", [32 << 20, 2000, 1])
def test_chain(spark, monkeypatch, part):
    monkeypatch.setattr(ph, "PART_BYTES", part)
    rows = [(k * 3, t) for k, t in enumerate(texts())] + [(9, "same id"), (9, "same id"), (9, None), (None, "no id"), (None, None)]
    frame = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id long, text string, mark int, `key` string")
    got = [tuple(row) for row in ph.edited_by_next(frame.repartition(6)).collect()]

    def ordered(found):
        return sorted(((*x[:5], round(x[5], 9), round(x[6], 9)) for x in found), key=str)

    assert ordered(got) == ordered(chained(rows))
    alone = ph.edited_by_next(frame.where("doc_id = 3")).collect()
    assert [tuple(r) for r in alone] == chained([(3, "a")])
    assert ph.edited_by_next(frame.limit(0)).count() == 0


def test_column(spark):
    frame = spark.createDataFrame([(1, None), (2, "ab ab")], "made int, text string")
    got = ph.fingerprint(frame, name="Text").collect()
    assert [tuple(r) for r in got] == [(1, "0::"), (2, scalar_fingerprint(b"ab ab"))]


def test_edited_texts_are_told_from_next_ones(spark):
    found = QUERIES["op11_fingerprints"](spark, "/root/testdata/sf0.01").where("n_chars >= 50")
    row = found.select(F.avg((F.col("near_edited") > F.col("near_next")).cast("int")), F.avg("near_edited"), F.avg("near_next")).first()
    assert row[0] > 0.97 and row[1] > 0.4 and row[2] < 0.1
