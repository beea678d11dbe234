"""SimHash near-dedup by bit-sliced comparison."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.components import components
from tripmill.llm.shared import free_name, settle, small_batches

BITS = 64
#: Largest bucket that is compared in one task; larger ones go by flipped bits.
MOST_IN_BUCKET = 2048
_MIX = 1 << 16


def fingerprint(text: bytes, shingle: int) -> int:
    """Majority of the shingles' hashes, bit by bit; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        pieces = [b" ".join(words)]
    else:
        pieces = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
    hashes = np.fromiter((xxhash.xxh64_intdigest(piece, 42) for piece in pieces), dtype="<u8")
    counts = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), _MIX):
        part = hashes[start : start + _MIX].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    majority = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(majority.view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3, name: str = "fingerprint") -> DataFrame:
    """The other columns and a long with the fingerprint's bits; a null text counts as empty."""
    rest = [column for column in docs.columns if column not in (text, name)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "__text", 8 << 20):
            texts = batch.column(batch.schema.get_field_index("__text"))
            found = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle) for t in texts]
            values = pa.array(np.array(found, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], values], names=[*rest, name])

    chosen = docs.select(*(docs[c] for c in rest), docs[text].alias("__text"))
    schema = chosen.drop("__text").schema.add(name, "long")
    return chosen.mapInArrow(run, schema)


def planes_of(values: np.ndarray) -> np.ndarray:
    """Bit planes: row b holds bit b of every value, 64 values to a word."""
    width = -(-len(values) // 64) * 64
    bits = np.zeros((width, BITS), dtype=np.uint8)
    bits[: len(values)] = np.unpackbits(
        values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
    )
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def within(values: np.ndarray, radius: int, block: int = 64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of positions (i <= j among them) whose values differ in at most ``radius`` bits.

    The planes of all values meet a block of queries at once. Carry-save counters add the
    mismatches of each plane bitwise; a lane that passes the radius stays out, and a query
    whose lanes are all out is abandoned.
    """
    planes = planes_of(values)
    words = planes.shape[1]
    n_counters = max(1, int(radius + 1).bit_length())
    lanes = np.zeros(words * 64, dtype=np.uint8)
    lanes[: len(values)] = 1
    real = np.packbits(lanes, bitorder="little").view("<u8")
    for start in range(0, len(values), block):
        alive = np.arange(start, min(start + block, len(values)))
        counters = [np.zeros((len(alive), words), dtype=np.uint64) for _ in range(n_counters)]
        out = np.broadcast_to(~real, (len(alive), words)).copy()
        for bit in range(BITS):
            asked = (values[alive] >> np.uint64(bit)) & np.uint64(1)
            carry = planes[bit] ^ (np.uint64(0) - asked)[:, None]
            for k, counter in enumerate(counters):
                counters[k], carry = counter ^ carry, counter & carry
            out |= carry
            if bit % 8 == 7:
                out |= _above(counters, radius)
                keep = ~(out == np.uint64(0xFFFFFFFFFFFFFFFF)).all(axis=1)
                if not keep.all():
                    alive, out = alive[keep], out[keep]
                    counters = [counter[keep] for counter in counters]
                    if not len(alive):
                        break
        if len(alive):
            near = np.unpackbits((~out).view(np.uint8), axis=1, bitorder="little")
            rows, columns = np.nonzero(near)
            yield alive[rows], columns


def _above(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter is over the radius."""
    more = np.zeros_like(counters[0])
    equal = np.full_like(counters[0], np.uint64(0xFFFFFFFFFFFFFFFF))
    for k in range(len(counters) - 1, -1, -1):
        if radius >> k & 1:
            equal &= counters[k]
        else:
            more |= equal & counters[k]
            equal &= ~counters[k]
    return more


def spanning_links(values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest with the same components as all links among the values: (value, its root)."""
    parent = np.arange(len(values))
    for left, right in within(values, radius):
        while True:  # all links of the block at once; smaller positions win
            a, b = parent[left], parent[right]
            low, high = np.minimum(a, b), np.maximum(a, b)
            open_ = low != high
            if not open_.any():
                break
            np.minimum.at(parent, high[open_], low[open_])
            while (parent != parent[parent]).any():
                parent = parent[parent]
    moved = parent != np.arange(len(values))
    return values[moved], values[parent[moved]]


def _band_keys(fp: str, radius: int) -> list:
    """Keys of which two fingerprints within the radius share one: all but ``radius`` bands."""
    n_bands = radius + 2
    edges = [BITS * k // n_bands for k in range(n_bands + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(n_bands), n_bands - radius)):
        mask = sum(((1 << edges[b + 1]) - (1 << edges[b])) for b in chosen)
        mask -= (1 << 64) if mask >> 63 else 0
        keys.append(F.struct(F.lit(number).alias("part"), F.col(fp).bitwiseAND(F.lit(mask)).alias("bits")))
    return keys


def links_within(values: DataFrame, radius: int) -> DataFrame:
    """Links (``a``, ``b``) that connect the distinct longs of ``fp`` as all pairs within ``radius`` bits do.

    Two values within the radius agree on one choice of bands. Buckets of up to
    ``MOST_IN_BUCKET`` values are compared bit-sliced, and return a forest, not pairs.
    The values of larger buckets get one key per way of flipping up to half the radius
    of their bits: two values within the radius share such a key, and a key has a bounded
    number of owners, so no bucket size matters. Nothing is dropped.
    """
    keyed = values.select("fp", F.explode(F.array(*_band_keys("fp", radius))).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    sizes = settle(sizes.select(F.col("key.part").alias("part"), F.col("key.bits").alias("bits"), "n"), "buckets")
    shared = keyed.select("fp", "key.part", "key.bits").join(sizes, ["part", "bits"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[np.ndarray, np.ndarray]] = []
            for owners in batch.column(0):
                found.append(spanning_links(np.sort(owners.values.to_numpy().view(np.uint64)), radius))
            a = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.uint64)
            b = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    usual = (
        shared.where(F.col("n") <= MOST_IN_BUCKET)
        .groupBy("part", "bits")
        .agg(F.collect_list("fp").alias("owners"))
        .select("owners")
        .mapInArrow(compare, "a long, b long")
    )
    hot = shared.where(F.col("n") > MOST_IN_BUCKET).select("fp").distinct()
    return usual.union(_links_by_flips(hot, radius))


def _links_by_flips(values: DataFrame, radius: int) -> DataFrame:
    """The same for values of large buckets, in rows that grow with their number only."""
    reach = (radius + 1) // 2
    masks = [0]
    for k in range(1, reach + 1):
        for bits in combinations(range(BITS), k):
            mask = sum(1 << b for b in bits)
            masks.append(mask - (1 << 64) if mask >> 63 else mask)
    flipped = values.select(
        "fp", F.explode(F.transform(F.array(*map(F.lit, masks)), lambda m: F.col("fp").bitwiseXOR(m))).alias("key")
    )
    owners = flipped.groupBy("key").agg(F.collect_set("fp").alias("owners")).where(F.size("owners") > 1)
    if radius == 2 * reach:  # any two owners are within the radius
        star = F.array_min("owners")
        return owners.select(F.explode("owners").alias("a"), star.alias("b")).where("a != b").distinct()
    pairs = owners.select(F.explode("owners").alias("a"), "owners").select("a", F.explode("owners").alias("b"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius  # some are one bit too far
    return pairs.where("a > b").where(close).distinct()


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2
) -> DataFrame:
    """``key``, ``fingerprint`` (long) and ``component_id``, one row per row of ``docs``.

    Words are what ASCII white space separates, A-Z in lower case; fingerprints link at
    ``radius`` or fewer differing bits, and a component is named by its smallest key.
    Texts that are null, empty or without words have fingerprint 0 and link like any
    other. Repeated rows and keys are kept; null keys count for no name, and a component
    of only null keys is named null. An empty table gives an empty result. Further
    columns are ignored, whatever they are called.
    """
    marked = settle(fingerprints(docs.select(docs[key].alias("key"), docs[text].alias("text")), shingle=shingle), "fingerprints")
    classes = settle(
        marked.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("key").alias("least")), "classes"
    )
    stars = settle(components(links_within(classes.select("fp"), radius)), "stars")
    named = classes.join(stars, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    lookup = settle(named.select("fp", "root").join(least, "root").select("fp", "component_id"), "names")
    return marked.join(lookup, F.col("fingerprint") == F.col("fp")).select(
        F.col("key").alias(key), "fingerprint", "component_id"
    )


def hex_digits(column: str):
    """16 lower-case hexadecimal digits of a long."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def keep_one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` without the rows whose key isn't the smallest of its component.

    Rows with a null key stay: they can't be told apart. Of rows that repeat a kept key
    all stay, as they are one document.
    """
    found = near_duplicates(docs, key, text, shingle, radius)
    mark = free_name(docs, "dropped")
    gone = found.where(F.col(key) != F.col("component_id")).select(F.col(key).alias(mark)).distinct()
    return docs.join(gone, docs[key] == gone[mark], "left_anti")
