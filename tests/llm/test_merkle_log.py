"""The manifest against a plain recomputation, and its positions against a log written node by node."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tripmill.llm import merkle_log
from tripmill.llm.merkle_log import FAN_OUT, append_log, height, position


def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels_over(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest(last[k : k + FAN_OUT]) for k in range(0, len(last), FAN_OUT)])
    return levels


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 72, 73, 511, 512, 513, 700])
def test_positions_are_places_in_the_log(n):
    leaves = [hashlib.sha256(str(k).encode()).digest() for k in range(n)]
    log = append_log(leaves, height(n))
    levels = levels_over([leaf.hex() for leaf in leaves])
    seen = set()
    for level, nodes in enumerate(levels):
        for index, node in enumerate(nodes):
            at = position(level, index, n)
            assert log[32 * at : 32 * at + 32].hex() == node
            seen.add(at)
    assert seen == set(range(len(log) // 32))


def proofs_of(rows):
    """By row: leaf, subroot, root, proof, folded root."""
    groups = defaultdict(list)
    for row in rows:
        groups[row["g"]].append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r["k"] is not None, r["k"] or 0, r["leaf"]))
        trees[g] = levels_over([r["leaf"].hex() for r in groups[g]])
    top = levels_over([trees[g][-1][0] for g in order])
    out = []
    for t, g in enumerate(order):
        for i, row in enumerate(groups[g]):
            folded, proof = (row["claimed"] or row["leaf"]).hex(), ""
            for levels, at in ((trees[g], i), (top, t)):
                for nodes in levels[:-1]:
                    low = at // FAN_OUT * FAN_OUT
                    left, right = "".join(nodes[low:at]), "".join(nodes[at + 1 : low + FAN_OUT])
                    proof += left + right
                    folded = digest([left, folded, right])
                    at //= FAN_OUT
            out.append((row["k"], row["leaf"].hex(), trees[g][-1][0], top[-1][0], digest([proof]), folded, folded == top[-1][0]))
    return out


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_proofs(spark, levels):
    r = random.Random(levels)
    rows = []
    for g, n in ((None, 3), ("", 1), ("a", 150), ("Z", 65), ("é", 8), ("hot", 530), ("z", 64), ("b", 9), ("c", 2), ("d", 1)):
        for k in range(n):
            leaf = hashlib.sha256(f"{g} {k}".encode()).digest()
            claimed = leaf if r.random() < 0.2 else hashlib.sha256(b"other").digest() if r.random() < 0.2 else None
            rows.append({"k": r.randrange(10**6), "g": g, "leaf": leaf, "claimed": claimed})
    rows += [{**rows[10], "claimed": None}] * 2 + [{**rows[10], "k": None}]
    frame = spark.createDataFrame([(x["k"], x["g"], x["leaf"], x["claimed"], 1, "x") for x in rows], "k long, g string, leaf binary, claimed binary, tree int, `Index` string")
    manifest = merkle_log.build(frame.repartition(5), "k", "g", "leaf", "claimed", levels=levels)
    got = [tuple(row) for row in merkle_log.proofs(manifest, "k").collect()]

    def ordered(found):
        return sorted(found, key=lambda x: (x[0] is not None, *map(str, x)))

    assert ordered(got) == ordered(proofs_of(rows))
    assert len(manifest.rounds) == {1: 4, 2: 2, 4: 1}[levels]


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, lang string, leaf binary")
    found = merkle_log.proofs(merkle_log.build(empty, "doc_id", "lang", "leaf"), "doc_id")
    assert found.count() == 0 and found.columns[0] == "doc_id"
    one = spark.createDataFrame([(7, None)], "doc_id long, lang string").withColumn("leaf", merkle_log.leaf_digest([F.col("doc_id"), F.col("lang")]))
    row = merkle_log.proofs(merkle_log.build(one, "doc_id", "lang", "leaf"), "doc_id").first()
    assert row.leaf == row.subroot == row.root == row.folded_root == digest(["1:7-"])
    assert row.proof_sha256 == digest([]) and row.verified


def test_leaf_digest(spark):
    long = "é" * 600_000
    rows = [(1, None, "é", ""), (-20, "a", None, long)]
    frame = spark.createDataFrame(rows, "a long, b string, c string, d string")
    got = [bytes(x[0]).hex() for x in frame.select(merkle_log.leaf_digest([F.col(c) for c in "abcd"])).collect()]
    assert got == [digest(["1:1-2:é0:"]), digest(["3:-20", "1:a-", f"1200000:{long}"])]
