"""Benchmark decontamination: size-partitioned MinHash containment search, in DataFrame functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.shared import free_name, settle

SHINGLE = 5
CONTAINMENT = 0.8
#: Sketch values that the filter of the first scan may hold; 8 bytes each.
IN_PLAN = 50_000


_BLANKS = " \t\n\x0b\x0c\r"


def _words(text: Column) -> Column:
    """Lower case, cut at ASCII white space; a text without words is one empty word."""
    return F.split(F.lower(F.btrim(F.coalesce(text, F.lit("")), F.lit(_BLANKS))), "[\\x20\\x09-\\x0D]+")


def _shingled(words: str, make: Callable[[list[Column]], Column]) -> Column:
    """``make(parts)`` for each shingle, with nulls behind a sequence that is shorter.

    The parts are picked one by one: a slice would copy the whole array each time.
    """
    last = F.greatest(F.size(words) - SHINGLE, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda at: make([F.get(words, at + k) for k in range(SHINGLE)]))


def _shingle_hashes(frame: DataFrame, text: str) -> DataFrame:
    """Adds ``hashes``: a MinHash value for each shingle, repeats included.

    Each word is hashed once, and a shingle chains its words' values; no string is built.
    """
    frame = frame.withColumn("marks", F.transform(_words(F.col(text)), lambda word: F.xxhash64(word)))
    return frame.withColumn("hashes", _shingled("marks", lambda parts: F.xxhash64(*parts)))


def _shingle_texts(words: str) -> Column:
    return F.array_distinct(_shingled(words, lambda parts: F.concat_ws(" ", *parts)))


def _sketches(items: DataFrame, containment: float) -> DataFrame:
    """``item``, ``n`` (distinct shingles), ``size_class`` and its bottom sketch, a row per value.

    Items fall into size classes [2^c, 2^(c+1)). Of n shingles a document that holds at
    least ``containment`` lacks at most floor((1 - containment) n), so one of any more
    than that is in it. A class takes the bottom-k MinHash values with the k its largest
    size needs, and so the search has a recall of 1, however long the document.
    """
    hashed = _shingle_hashes(items.select("item", "item_text"), "item_text")
    sized = hashed.select("item", F.array_sort(F.array_distinct("hashes")).alias("hashes"))
    sized = sized.withColumn("n", F.size("hashes")).withColumn("size_class", F.floor(F.log2("n")).cast("int"))
    largest = F.pow(F.lit(2.0), F.col("size_class") + 1) - 1
    k = (F.floor(largest * (1 - containment) + 1e-9) + 1).cast("int")
    return sized.select("item", "n", "size_class", F.explode_outer(F.slice("hashes", F.lit(1), k)).alias("hash"))


def _once(frame: DataFrame, value: Column, name: str, *others: str) -> DataFrame:
    """``others`` and a value that is worked out once, whatever filter or lambda function reads it later."""
    return frame.select(*others, F.explode_outer(F.array(value)).alias(name))


def _with_hits(named: DataFrame, sketch: DataFrame) -> DataFrame:
    """Documents that share a MinHash value with an item: ``doc``, ``doc_text`` and ``hits``, those values."""
    hashed = _shingle_hashes(named, "doc_text")
    values = [row["hash"] for row in sketch.select("hash").distinct().limit(IN_PLAN + 1).collect() if row["hash"] is not None]
    if len(values) <= IN_PLAN:
        shared = F.filter("hashes", lambda value: value.isin(values)) if values else F.array().cast("array<bigint>")
        return _once(hashed, F.array_distinct(shared), "hits", "doc", "doc_text").where(F.size("hits") > 0)
    top = sketch.agg(F.max("hash")).first()[0]
    low = hashed.select("doc", "doc_text", F.filter("hashes", lambda value: value <= F.lit(top).cast("long")).alias("hashes"))
    marked = low.withColumn("at", F.xxhash64("doc", "doc_text"))
    shared = marked.select("at", F.explode_outer("hashes").alias("hash")).join(sketch.select("hash").distinct(), "hash", "left_semi")
    hits = shared.groupBy("at").agg(F.collect_set("hash").alias("hits"))
    return marked.join(hits, "at").select("doc", "doc_text", "hits")


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    containment: float = CONTAINMENT,
) -> DataFrame:
    """A row for each document and test item of whose distinct 5-word shingles it holds ``containment`` or more.

    ``key``, ``item_key``, ``size_class``, ``n_shingles`` (the item's distinct shingles),
    ``n_found`` (those in the document) and ``containment``. Candidates share a value of
    the item's sketch; they are verified on the shingles' own text. Upper and lower case
    are alike, words are cut at ASCII white space. A text of one to four words is
    one shingle, equal only to a text of those words. Null and empty texts hold and are
    nothing; rows with a null key are left out, as nothing could name them. Of repeated keys, each
    text is compared by itself and the best containment of a key and item counts.
    Empty tables give an empty result; further columns are ignored.

    Sketch values up to ``IN_PLAN`` are part of the first scan's own filter, which leaves the texts
    that share one with an item; these alone are written to the shared folder and compared. A larger
    sketch is joined with the shingles, and adaptive execution splits a hot shingle.
    """
    items = settle(
        items.select(items[item_key].alias("item"), items[item_text].alias("item_text"))
        .where(F.col("item").isNotNull() & (F.btrim("item_text", F.lit(_BLANKS)) != ""))
        .distinct(),
        "items",
    )
    sketch = settle(_sketches(items, containment), "sketches")
    named = docs.select(docs[key].alias("doc"), docs[text].alias("doc_text")).where("doc is not null")
    hit = settle(_with_hits(named, sketch).withColumn("row", F.monotonically_increasing_id()), "hit")
    candidates = (
        # Not the inner form: its filter would be pushed below and work out every array anew for each value.
        hit.select("row", F.explode_outer("hits").alias("hash"))
        .join(sketch.select("item", "hash", "size_class"), "hash")
        .select("row", "item", "size_class")
        .distinct()
    )
    wanted = items.select("item", _words(F.col("item_text")).alias("item_words")).select(
        "item", _shingle_texts("item_words").alias("wanted")
    )
    # A document's shingles are made once, beside all the items that are asked of it.
    asked = candidates.join(wanted, "item").groupBy("row").agg(F.collect_list(F.struct("item", "size_class", "wanted")).alias("asked"))
    worded = hit.select("row", "doc", _words(F.col("doc_text")).alias("words")).join(asked, "row")
    held = _once(worded, _shingle_texts("words"), "held", "doc", "asked")
    compared = held.select(
        "doc",
        F.explode_outer(
            F.transform(
                "asked",
                lambda a: F.struct(
                    a["item"].alias("item"),
                    a["size_class"].alias("size_class"),
                    F.size(a["wanted"]).alias("n_shingles"),
                    F.size(F.array_intersect(a["wanted"], F.col("held"))).alias("n_found"),
                ),
            )
        ).alias("found"),
    )
    found = compared.select(
        F.col("doc").alias(key), F.col("found.item").alias(item_key), "found.size_class", "found.n_shingles", "found.n_found"
    )
    best = found.groupBy(key, item_key).agg(
        F.max_by(F.struct("size_class", "n_shingles", "n_found"), F.col("n_found") / F.col("n_shingles")).alias("best")
    )
    share = (F.col("n_found") / F.col("n_shingles")).alias("containment")
    return best.select(key, item_key, "best.*").select("*", share).where(
        F.col("n_found") >= F.col("n_shingles") * containment - 1e-9
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that hold a test item; rows with a null key stay."""
    mark = free_name(docs, "leaked")
    leaked = contaminated(docs, items, key, text, **options).select(F.col(key).alias(mark)).distinct()
    return docs.join(leaked, docs[key] == leaked[mark], "left_anti")
