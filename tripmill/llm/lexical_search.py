"""Ranked lexical search over posting lists that are cut into geometric blocks.

Documents go to shards of some thousand postings. In a shard each term's posting list is clustered by the
similarity of its documents, and each cluster is a block with a summary: for each term the largest
value that any of its documents has. An item's score of a summary bounds the scores of the block's
documents, so a block is passed over exactly if that bound is below the score of the last
document that can still be among the best. Bounds are exact integers, so the result is.

The index holds the terms of the stated items, as no other term adds to a score, and in a
summary the terms that share an item with the block's own, as no other item reads that block.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.exchange import unpacked
from tripmill.llm.shared import settle

BEST = 50
#: A shard is full with so many documents or postings.
SHARD_DOCS, SHARD_POSTINGS = 1024, 1 << 16
#: Documents that a block is planned to have, and the dimensions in which documents are compared.
BLOCK_DOCS, DIMENSIONS = 32, 32
#: Items are answered together as long as they have this many terms, repeats included.
TERMS_TOGETHER = 300_000
#: One shard of so many is searched first; the scores found there are what the others have to reach.
FIRST_OF = 16
#: Shards that one task turns into blocks, and the partners that it remembers.
_SHARDS_TOGETHER, _KEPT_PARTNERS = 8, 1 << 21
_PIECE = 1 << 20
_NO_ID = np.iinfo(np.int64).max
_TERM_BYTES = bytes(
    b if b >= 0x80 or chr(b).isalnum() and not chr(b).isupper() else b + 32 if chr(b).isupper() else 0x20 for b in range(256)
)


def terms_of(data: bytes) -> Iterator[list[bytes]]:
    """Runs of ASCII letters, digits and all characters beyond ASCII, A-Z lowered; a long text's piece by piece."""
    data = data.translate(_TERM_BYTES)
    start = 0
    while start < len(data):
        end = start + _PIECE
        if end < len(data):
            at = data.rfind(b" ", start, end)
            end = at if at > start else data.find(b" ", end)
            end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


def _packed(**arrays: np.ndarray) -> bytes:
    columns = [pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), pa.array(a)) for a in arrays.values()]
    batch = pa.RecordBatch.from_arrays(columns, names=list(arrays))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as stream:
        stream.write_batch(batch)
    return zstandard.ZstdCompressor(level=3).compress(sink.getvalue())


def _arrays(packed: bytes) -> dict[str, np.ndarray]:
    batch = unpacked(packed)
    return {name: batch.column(k).values.to_numpy() for k, name in enumerate(batch.schema.names)}


def _spans(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All positions of the ranges one after another, and where each range starts among them."""
    sizes = ends - begins
    firsts = np.cumsum(sizes) - sizes
    return np.repeat(begins - firsts, sizes) + np.arange(sizes.sum()), firsts


def _sums(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Sum of each range, none of which is empty."""
    return np.add.reduceat(values, firsts) if len(firsts) else np.zeros(0, dtype=values.dtype)


def _shards(docs: DataFrame, vocabulary: Sequence[bytes], key: str, text: str) -> DataFrame:
    """``n_docs`` and ``n_terms`` of all documents of a shard, and its postings of known terms, packed.

    ``ids``, ``sizes`` (all terms of a document) and ``ends`` by document; ``terms`` and ``counts`` by posting.
    """
    shared = docs.sparkSession.sparkContext.broadcast(list(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {term: k for k, term in enumerate(shared.value)}
        ids, sizes, terms, counts = [], [], [], []
        n_docs = n_terms = n_postings = 0

        def shard() -> pa.RecordBatch:
            none = [np.zeros(0, np.int32)]
            ends = np.cumsum([len(t) for t in terms], dtype=np.int32)
            packed = _packed(
                ids=np.array(ids, np.int64), sizes=np.array(sizes, np.int64), ends=ends,
                terms=np.concatenate(none + terms), counts=np.concatenate(none + counts),
            )
            return pa.RecordBatch.from_arrays(
                [pa.array([n_docs], pa.int64()), pa.array([n_terms], pa.int64()), pa.array([packed], pa.binary())],
                names=["n_docs", "n_terms", "packed"],
            )

        for batch in batches:
            for doc_id, value in zip(batch.column(0), batch.column(1)):
                size, found = 0, []
                for piece in terms_of(value.as_py()):
                    size += len(piece)
                    found += [k for k in map(known.get, piece) if k is not None]
                n_docs += size > 0
                n_terms += size
                if found:
                    term, count = np.unique(np.array(found, np.int32), return_counts=True)
                    ids.append(doc_id.as_py() if doc_id.is_valid else _NO_ID)
                    sizes.append(size)
                    terms.append(term)
                    counts.append(count.astype(np.int32))
                    n_postings += len(term)
                if len(ids) >= SHARD_DOCS or n_postings >= SHARD_POSTINGS:
                    yield shard()
                    ids, sizes, terms, counts = [], [], [], []
                    n_docs = n_terms = n_postings = 0
        if n_docs:
            yield shard()

    chosen = docs.select(docs[key].cast("long"), F.coalesce(docs[text], F.lit("")).cast("binary"))
    return chosen.mapInArrow(run, "n_docs long, n_terms long, packed binary").withColumn("shard", F.monotonically_increasing_id())


@dataclass
class Index:
    """Shards with their blocks, the terms that they know, and the terms' weights."""

    shards: DataFrame
    vocabulary: list[bytes]
    weights: np.ndarray


def build_index(
    docs: DataFrame, vocabulary: Sequence[bytes], items: Sequence[np.ndarray], key: str = "doc_id", text: str = "text"
) -> Index:
    """Index the documents' postings of the given terms for items given as distinct places among them.

    Counts and statistics are of all documents. A null text has no terms; a null key is kept
    and ranks last among equal scores; rows with equal keys are documents of their own.
    """
    spark = docs.sparkSession
    vocabulary = list(vocabulary)
    shards = settle(_shards(docs, vocabulary, key, text), "shards")
    totals = shards.agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms"), F.count("*").alias("n")).first()
    n_docs, n_terms = totals["docs"] or 0, totals["terms"] or 0

    n_known = len(vocabulary)

    def holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(n_known, dtype=np.int64)
        for batch in batches:
            for packed in batch.column(0):
                found += np.bincount(_arrays(packed.as_py())["terms"], minlength=len(found))
        held = np.nonzero(found)[0]
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(found[held])], names=["term", "n"])

    held = shards.select("packed").mapInArrow(holders, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    rarity = F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("n") + 1))
    weights = np.zeros(len(vocabulary), dtype=np.int64)
    for row in held.select("term", F.floor(1000 * rarity).cast("long").alias("weight")).collect():
        weights[row["term"]] = row["weight"]
    shared = spark.sparkContext.broadcast((weights, list(items)))

    def blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, items = shared.value
        partners = Partners(items, len(weights))
        for batch in batches:
            for shard, packed in zip(batch.column(0), batch.column(1)):
                built = _blocks(_arrays(packed.as_py()), weights, n_docs, n_terms, partners)
                yield pa.RecordBatch.from_arrays([pa.array([shard]), pa.array([_packed(**built)], pa.binary())], names=["shard", "packed"])

    # A shard is small and takes long: tasks are counted by shards, not by the bytes they read.
    dealt = shards.select("shard", "packed").repartition(max(1, totals["n"] // _SHARDS_TOGETHER), "shard")
    return Index(settle(dealt.mapInArrow(blocked, "shard long, packed binary"), "index"), vocabulary, weights)


class Partners:
    """By term, the terms of the items that hold it, itself included."""

    def __init__(self, items: Sequence[np.ndarray], n_terms: int) -> None:
        self.items = items
        holders = np.repeat(np.arange(len(items)), [len(item) for item in items])
        terms = np.concatenate([np.zeros(0, np.int64), *items])
        self.holders = holders[np.argsort(terms, kind="stable")]
        self.ends = np.cumsum(np.bincount(terms, minlength=n_terms))
        self.known: dict[int, np.ndarray] = {}
        self.kept = 0

    def __getitem__(self, term: int) -> np.ndarray:
        found = self.known.get(term)
        if found is None:
            own = self.holders[self.ends[term - 1] if term else 0 : self.ends[term]]
            found = np.unique(np.concatenate([[term], *(self.items[k] for k in own.tolist())]))
            if self.kept > _KEPT_PARTNERS:
                self.known, self.kept = {}, 0
            self.known[term] = found
            self.kept += len(found)
        return found


def _blocks(
    shard: dict[str, np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int, partners: Partners
) -> dict[str, np.ndarray]:
    """A shard's postings with values, and its blocks.

    ``ids``, ``ends``, ``terms``, ``values`` by document; ``block_terms``, ``block_ends`` and ``block_docs``
    (documents by their place in the shard); ``top_ends``, ``top_terms``, ``top_values``: the summaries.
    """
    ends, terms, counts = shard["ends"].astype(np.int64), shard["terms"], shard["counts"].astype(np.int64)
    owners = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    spread = 50 + 50 * shard["sizes"] * n_docs // max(n_terms, 1)
    values = (1_000_000_000 * counts // (1000 * counts + 20 * spread[owners])).astype(np.int32)
    local, columns = np.unique(terms, return_inverse=True)
    dense = np.zeros((len(ends), len(local)), dtype=np.int32)
    dense[owners, columns] = values
    points = _points(dense, local, weights)
    order = np.argsort(columns, kind="stable")
    lists = np.split(owners[order], np.cumsum(np.bincount(columns, minlength=len(local)))[:-1]) if len(local) else []
    none = np.zeros(0, np.int32)
    block_terms, block_sizes, block_docs, top_terms, top_values = [], [], [], [], []
    for term, docs in zip(local.tolist(), lists):
        beside = np.searchsorted(local, partners[term])
        beside = beside[beside < len(local)]
        beside = beside[np.isin(local[beside], partners[term])]
        for members in _clusters(docs, points):
            block_terms.append(term)
            block_sizes.append(len(members))
            block_docs.append(members)
            # A block of one needs no summary: its document is the bound.
            top = dense[members[:, None], beside].max(axis=0) if len(members) > 1 else none
            kept = np.nonzero(top)[0]
            top_terms.append(local[beside[kept]].astype(np.int32))
            top_values.append(top[kept])
    return {
        "ids": shard["ids"], "ends": ends, "terms": terms, "values": values,
        "block_terms": np.array(block_terms, np.int32), "block_ends": np.cumsum(block_sizes, dtype=np.int64),
        "block_docs": np.concatenate([none, *block_docs]).astype(np.int32),
        "top_ends": np.cumsum([len(t) for t in top_terms], dtype=np.int64),
        "top_terms": np.concatenate([none, *top_terms]), "top_values": np.concatenate([none, *top_values]),
    }


def _points(dense: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Documents as directions in few dimensions: each term has random signs, always the same ones."""
    seeds = (terms.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    seeds ^= seeds >> np.uint64(29)
    seeds *= np.uint64(0xBF58476D1CE4E5B9)
    bits = (seeds[:, None] >> np.arange(32, 32 + DIMENSIONS, dtype=np.uint64)) & np.uint64(1)
    signs = (bits.astype(np.float32) * 2 - 1) * weights[terms].astype(np.float32)[:, None]
    points = np.concatenate([dense[k : k + 64].astype(np.float32) @ signs for k in range(0, len(dense), 64)] or [signs[:0]])
    return points / np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-9)


def _clusters(docs: np.ndarray, points: np.ndarray) -> list[np.ndarray]:
    """A posting list by the nearest of its own evenly taken documents; none is empty."""
    n = -(-len(docs) // BLOCK_DOCS)
    if n == 1:
        return [docs]
    centers = points[docs[np.arange(n) * len(docs) // n]]
    nearest = (points[docs] @ centers.T).argmax(axis=1)
    order = np.argsort(nearest, kind="stable")
    sizes = np.bincount(nearest, minlength=n)
    return [part for part in np.split(docs[order], np.cumsum(sizes)[:-1]) if len(part)]


class _Best:
    """An item's best documents so far, and the least score that another one needs."""

    def __init__(self, least: int, best: int) -> None:
        self.least, self.best = max(least, 1), best
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        kept = scores >= self.least
        scores, ids = np.concatenate([self.scores, scores[kept]]), np.concatenate([self.ids, ids[kept]])
        order = np.lexsort((ids, -scores))[: self.best]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.best:
            self.least = max(self.least, int(self.scores[-1]))


def search_shard(shard: dict[str, np.ndarray], weights: np.ndarray, items: Sequence[np.ndarray], best: Sequence[_Best]) -> int:
    """Add a shard's documents to the items' best; returns how many blocks were passed over by their bound.

    First the terms of an item that by their largest values in the shard can't together reach the least
    score are set aside: a document that holds only such terms can't either. Of the others' blocks
    those are read whose summary reaches it, and each of their documents gets its exact score.
    """
    ends, terms = shard["ends"], shard["terms"]
    if not len(terms):
        return 0
    weighted = weights[terms] * shard["values"]
    largest = np.zeros(len(weights), dtype=np.int64)
    np.maximum.at(largest, terms, weighted)
    begins = ends - np.diff(ends, prepend=0)
    block_ends, top_ends = shard["block_ends"], shard["top_ends"]
    block_begins, top_begins = block_ends - np.diff(block_ends, prepend=0), top_ends - np.diff(top_ends, prepend=0)
    top_weighted = weights[shard["top_terms"]] * shard["top_values"]
    asked = np.zeros(len(weights), dtype=bool)
    passed = 0
    for whole, found in zip(items, best):
        item = whole[largest[whole] > 0]
        item = item[np.argsort(largest[item], kind="stable")]
        item = item[np.cumsum(largest[item]) >= found.least]
        if not len(item):
            continue
        first = np.searchsorted(shard["block_terms"], item)
        blocks, _ = _spans(first, np.searchsorted(shard["block_terms"], item, side="right"))
        asked[whole] = True
        summed = np.nonzero(top_ends[blocks] > top_begins[blocks])[0]
        at, firsts = _spans(top_begins[blocks[summed]], top_ends[blocks[summed]])
        bounds = _sums(np.where(asked[shard["top_terms"][at]], top_weighted[at], 0), firsts)
        reached = np.ones(len(blocks), dtype=bool)
        reached[summed] = bounds >= found.least
        passed += int((~reached).sum())
        at, _ = _spans(block_begins[blocks[reached]], block_ends[blocks[reached]])
        docs = np.unique(shard["block_docs"][at])
        at, firsts = _spans(begins[docs], ends[docs])
        found.add(_sums(np.where(asked[terms[at]], weighted[at], 0), firsts), shard["ids"][docs])
        asked[whole] = False
    return passed


def _found(shards: DataFrame, index: Index, items: Sequence[np.ndarray], least: np.ndarray, best: int) -> DataFrame:
    """``item`` (its place), ``doc`` and ``score`` of each task's best documents."""
    shared = shards.sparkSession.sparkContext.broadcast((index.weights, list(items), least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, items, least = shared.value
        tops = [_Best(int(x), best) for x in least]
        for batch in batches:
            for packed in batch.column(0):
                search_shard(_arrays(packed.as_py()), weights, items, tops)
        places = np.repeat(np.arange(len(tops)), [len(top.ids) for top in tops])
        columns = [places, *(np.concatenate([np.zeros(0, np.int64), *(getattr(top, name) for top in tops)]) for name in ("ids", "scores"))]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item", "doc", "score"])

    return shards.select("packed").mapInArrow(run, "item long, doc long, score long")


def search(index: Index, items: Sequence[np.ndarray], best: int = BEST) -> DataFrame:
    """The best documents of each item, given as distinct places in the vocabulary.

    ``item`` (its place in ``items``), ``rank``, ``doc`` and ``score``. A part of the shards is searched
    first; the last of its best scores is one that all others have to reach.
    """
    first = F.pmod(F.xxhash64("shard"), F.lit(FIRST_OF)) == 0
    least = np.zeros(len(items), dtype=np.int64)
    ranked = Window.partitionBy("item").orderBy(F.desc("score"), "doc")
    tried = _found(index.shards.where(first), index, items, least, best).withColumn("rank", F.row_number().over(ranked))
    for row in tried.where(F.col("rank") == best).select("item", "score").collect():
        least[row["item"]] = row["score"]
    found = _found(index.shards, index, items, least, best).withColumn("rank", F.row_number().over(ranked))
    return found.where(F.col("rank") <= best).select(
        "item", "rank", F.when(F.col("doc") != _NO_ID, F.col("doc")).alias("doc"), "score"
    )


def _item_terms(items: DataFrame, item_key: str, item_text: str) -> DataFrame:
    """``item`` (a number of its own), its key and its distinct terms."""
    kind = items.schema[item_key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted({t for piece in terms_of(text.as_py()) for t in piece}) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.binary()))], names=["key", "terms"])

    chosen = items.select(items[item_key], F.coalesce(items[item_text], F.lit("")).cast("binary"))
    made = chosen.mapInArrow(run, f"key {kind.simpleString()}, terms array<binary>")
    return settle(made.withColumn("item", F.monotonically_increasing_id()), "items")


def rank(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    best: int = BEST,
    together: int = TERMS_TOGETHER,
) -> DataFrame:
    """The ``best`` highest-scoring documents of each item, or all with a score above 0 if they are fewer.

    The item's key, ``rank`` (from 1), the document's key and ``score``; equal scores rank by ascending
    key, null last. Each row of ``items`` is an item, of ``docs`` a document; null and empty texts find
    nothing and are not found. A weight of 0 (a term that nearly all documents hold) adds nothing. Empty
    tables give an empty result; further columns are ignored.

    Items are answered in groups of about ``together`` terms, which bounds what is broadcast; each group
    reads the documents once.
    """
    spark = docs.sparkSession
    stated = _item_terms(items, item_key, item_text)
    total = stated.agg(F.sum(F.size("terms"))).first()[0] or 0
    n_groups = max(1, -(-total // together))
    out = None
    for group in range(n_groups):
        rows = stated.where((F.size("terms") > 0) & (F.pmod(F.xxhash64("item"), F.lit(n_groups)) == group)).select("item", "terms").collect()
        vocabulary = sorted({bytes(term) for row in rows for term in row["terms"]})
        place = {term: k for k, term in enumerate(vocabulary)}
        asked = [np.array([place[bytes(t)] for t in row["terms"]], dtype=np.int64) for row in rows]
        found = search(build_index(docs, vocabulary, asked, key, text), asked, best)
        numbers = spark.createDataFrame([(k, row["item"]) for k, row in enumerate(rows)], "item long, number long")
        answer = found.join(numbers, "item").select("number", "rank", "doc", "score")
        out = answer if out is None else out.union(answer)
    named = stated.select(F.col("item").alias("number"), F.col("key").alias("asked"))
    return out.join(named, "number").select(F.col("asked").alias(item_key), "rank", F.col("doc").alias(key), "score")
