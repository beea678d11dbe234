"""Merkle manifest of a dataset: postorder logs written by aligned builders, proofs read from them by position.

The leaves of a tree are numbered in order and cut into aligned blocks of ``FAN_OUT ** LEVELS``. A
builder takes one block, reads its leaves in order and appends each node to its log when the node is
complete, so that a log is in postorder. Where a node of any level lies follows from the sizes of
the subtrees before it (:func:`position`), and a proof picks its siblings from the log by that
number. The blocks' top nodes are the leaves of the next round, whose logs are written alike, until a
tree has one node; a last tree joins the roots of all groups. Each round divides the number of
nodes by 4,096, so no task holds more than one block, however large a group is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.shared import settle
from tripmill.operators.numbering import number_rows

FAN_OUT = 8
#: Levels that a builder closes over its block of 4,096 leaves.
LEVELS = 4
_DIGEST = 32


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 (bytes) of the values, each ``-`` if null, else its UTF-8 byte count, ``:`` and itself."""
    texts = [value.cast("string") for value in values]
    marked = [
        F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")) for text in texts
    ]
    return F.unhex(F.sha2(F.concat(*marked), 256))


def height(n: int) -> int:
    """Levels above ``n`` leaves."""
    levels = 0
    while n > 1:
        n = -(-n // FAN_OUT)
        levels += 1
    return levels


def position(level: int, index: int, n: int) -> int:
    """Where node ``index`` of a level stands in the postorder log of a tree with ``n`` leaves.

    Before a leaf stand the leaves before it and every inner node that ended with one of
    them, ``leaf // FAN_OUT ** m`` of level m; the nodes that end with a leaf follow it, level by level.
    """
    last = min((index + 1) * FAN_OUT**level, n) - 1
    before, size = 0, 1
    while size <= last:
        before += last // size
        size *= FAN_OUT
    return before + level


def join_digests(digests: Sequence[bytes]) -> bytes:
    """The digest of a run: SHA-256 over its digests as lower-case hex text."""
    return hashlib.sha256(b"".join(digests).hex().encode()).digest()


def append_log(leaves: Sequence[bytes], levels: int) -> bytes:
    """The nodes over a block in the order of their completion, up to one node of that level."""
    log: list[bytes] = []
    open_runs: list[list[bytes]] = [[] for _ in range(levels + 1)]

    def complete(digest: bytes, level: int) -> None:
        log.append(digest)
        if level < levels:
            open_runs[level].append(digest)
            if len(open_runs[level]) == FAN_OUT:
                close(level)

    def close(level: int) -> None:
        run, open_runs[level] = open_runs[level], []
        complete(join_digests(run), level + 1)

    for leaf in leaves:
        complete(leaf, 0)
    for level in range(levels):
        if open_runs[level]:
            close(level)
    return b"".join(log)


def _levels_of(n: int, levels: int) -> int:
    """Levels that a builder closes in a round of a tree that has ``n`` nodes in it."""
    return height(n) if n <= FAN_OUT**levels else levels


def siblings(log: bytes, leaves: int, index: int, levels: int) -> list[tuple[bytes, bytes]]:
    """The digests left and right of a leaf's path in its block's log, level by level."""
    path = []
    for level in range(levels):
        count = -(-leaves // FAN_OUT**level)
        first = index // FAN_OUT * FAN_OUT
        ats = [position(level, k, leaves) * _DIGEST for k in range(first, min(first + FAN_OUT, count))]
        run = [log[at : at + _DIGEST] for at in ats]
        path.append((b"".join(run[: index - first]), b"".join(run[index - first + 1 :])))
        index //= FAN_OUT
    return path


@dataclass
class Manifest:
    """The logs of all groups' trees by round, the logs of the tree over the groups, and its root.

    A round holds ``tree``, ``block``, ``n`` (nodes of the tree in the round), ``log`` and, in the
    groups' first round, the rows' own ``keys`` and ``claimed`` digests.
    """

    rounds: list[DataFrame]
    top: list[DataFrame]
    root: bytes | None
    key_type: str
    spark: SparkSession
    levels: int = LEVELS


#: A block's top node, the last to be complete.
_LAST = f"substring(log, length(log) - {_DIGEST - 1}, {_DIGEST}) AS digest"
_NODES = "tree long, block long, n long, log binary"


def _write_rounds(nodes: DataFrame, largest: int, levels: int, label: str, row_fields: str = "") -> list[DataFrame]:
    """Logs of trees given as ``tree``, ``index``, ``n``, ``digest``, round after round."""
    size = FAN_OUT**levels

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("index")
        n = group["n"][0].as_py()
        log = append_log(group["digest"].to_pylist(), _levels_of(n, levels))
        columns = {"tree": group["tree"][:1], "block": group["block"][:1], "n": group["n"][:1], "log": pa.array([log], pa.binary())}
        for name in ("key", "claimed"):
            if name in group.column_names:
                columns[name] = pa.array([group[name].to_pylist()], pa.list_(group.schema.field(name).type))
        return pa.table(columns)

    rounds = []
    while True:
        blocked = nodes.withColumn("block", F.expr(f"index div {size}"))
        rounds.append(settle(blocked.groupBy("tree", "block").applyInArrow(build, _NODES + row_fields), label))
        if largest <= size:
            return rounds
        row_fields, largest = "", -(-largest // size)
        over = F.expr(f"(n + {size - 1}) div {size}").alias("n")
        nodes = rounds[-1].where(f"n > {size}").select("tree", F.col("block").alias("index"), over, F.expr(_LAST))


def _roots(rounds: list[DataFrame], levels: int) -> DataFrame:
    """``tree`` and the ``digest`` of its one last node."""
    ended = [r.where(f"n <= {FAN_OUT**levels}").select("tree", F.expr(_LAST)) for r in rounds]
    found = ended[0]
    for more in ended[1:]:
        found = found.union(more)
    return found


def build(rows: DataFrame, key: str, group: str, leaf: str, claimed: str | None = None, levels: int = LEVELS) -> Manifest:
    """Write the logs over all rows: a tree for each group, and one over the groups' roots.

    A group's leaves ascend by ``key`` (null first, equal keys by digest); the groups ascend by
    their value, null first, in the order of their UTF-8 bytes. ``leaf`` and ``claimed`` are digests
    (bytes); a null ``claimed`` stands for the leaf itself. Repeated rows are leaves of their own.
    A lone leaf is its group's root, and a lone group's root is the root. No rows: no root.
    Builders close ``levels`` levels. Further columns are ignored. Everything is written to the shared folder, the texts never are.
    """
    spark = rows.sparkSession
    chosen = rows.select(
        rows[group].cast("string").alias("grp"),
        rows[key].alias("key"),
        rows[leaf].alias("digest"),
        (rows[claimed] if claimed else F.lit(None).cast("binary")).alias("claimed"),
    )
    key_type = chosen.schema["key"].dataType.simpleString()
    leaves = settle(chosen, "leaves")
    numbered = number_rows(leaves, ["grp", "key", "digest"], "at")
    trees = settle(numbered.groupBy("grp").agg(F.min("at").alias("tree"), F.count("*").alias("n")), "trees")
    largest = trees.agg(F.max("n")).first()[0]
    if largest is None:
        return Manifest([], [], None, key_type, spark, levels)
    own = trees.withColumnRenamed("grp", "of")
    nodes = numbered.join(own, F.col("grp").eqNullSafe(F.col("of"))).select(
        "tree", (F.col("at") - F.col("tree")).alias("index"), "n", "digest", "key", "claimed"
    )
    rounds = _write_rounds(nodes, largest, levels, "log", f", key array<{key_type}>, claimed array<binary>")
    roots = number_rows(_roots(rounds, levels), ["tree"], "at")
    n_trees = trees.count()
    groups = roots.select(
        F.lit(0).cast("long").alias("tree"), (F.col("at") - 1).alias("index"), F.lit(n_trees).cast("long").alias("n"), "digest", F.col("tree").alias("key")
    )
    top = _write_rounds(groups, n_trees, levels, "top", ", key array<bigint>")
    return Manifest(rounds, top, bytes(_roots(top, levels).first()["digest"]), key_type, spark, levels)


_PATH = "array<struct<left:binary,right:binary>>"


def _paths_down(round_: DataFrame, upper: DataFrame, levels: int, with_keys: bool) -> DataFrame:
    """``tree``, ``index``, ``path`` and ``subroot`` of each node of a round, from those of its blocks' top nodes.

    With keys, the nodes are groups: ``tree`` is the group's own, ``index`` 0, ``subroot`` its root.
    """

    size = FAN_OUT**levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                log, n = row["log"], row["n"]
                first = row["block"] * size
                n_here, closed = min(size, n - first), _levels_of(n, levels)
                for k in range(n_here):
                    at = position(0, k, n_here) * _DIGEST
                    path = [{"left": left, "right": right} for left, right in siblings(log, n_here, k, closed)] + row["path"]
                    values = [row["key"][k], 0, path, log[at : at + _DIGEST]] if with_keys else [row["tree"], first + k, path, row["subroot"]]
                    yield pa.RecordBatch.from_pylist([dict(zip(("tree", "index", "path", "subroot"), values))], schema)

    schema = pa.schema(
        [("tree", pa.int64()), ("index", pa.int64()), ("path", pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())]))), ("subroot", pa.binary())]
    )
    columns = ["n", "block", "log", "path", *(["key"] if with_keys else ["tree", "subroot"])]
    return _with_paths(round_, upper).select(*columns).mapInArrow(run, f"tree long, index long, path {_PATH}, subroot binary")


def _with_paths(round_: DataFrame, upper: DataFrame) -> DataFrame:
    return round_.join(upper.withColumnRenamed("index", "block"), ["tree", "block"])


def proofs(manifest: Manifest, key: str = "key") -> DataFrame:
    """A row for each leaf: its key, digests and proof, and the root that its claimed digest leads to.

    ``key``, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (SHA-256 over the siblings' hex, level by
    level from the leaf to the root, left to right in each), ``folded_root`` and ``verified``. No rows for
    an empty manifest.
    Paths go down the rounds: a block's path to the root is found once and sent to its builder's log.
    """
    spark = manifest.spark
    schema = f"`{key}` {manifest.key_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    if manifest.root is None:
        return spark.createDataFrame([], schema)
    root, levels = manifest.root.hex(), manifest.levels
    upper = spark.createDataFrame([(0, 0, [], None)], f"tree long, index long, path {_PATH}, subroot binary")
    for k, round_ in reversed(list(enumerate(manifest.top))):
        upper = settle(_paths_down(round_, upper, manifest.levels, with_keys=k == 0), "paths")
    groups = upper
    for k, round_ in reversed(list(enumerate(manifest.rounds))):
        # A group's path starts in the round in which its tree ends; in the rounds above it has no nodes.
        ended = round_.where(f"n <= {FAN_OUT**manifest.levels}").select("tree").join(groups, "tree")
        upper = ended if k == len(manifest.rounds) - 1 else ended.unionByName(upper)
        if k:
            upper = settle(_paths_down(round_, upper, manifest.levels, with_keys=False), "paths")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                values = row.to_pylist()[0]
                found = list(_folded(values, root, levels))
                yield pa.RecordBatch.from_arrays(
                    [row.column("key")[0].values, *(pa.array(list(c)) for c in zip(*found))],
                    names=[key, "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
                )

    return _with_paths(manifest.rounds[0], upper).select("n", "block", "log", "key", "claimed", "path", "subroot").mapInArrow(run, schema)


def _folded(block: dict, root: str, levels: int) -> Iterator[tuple[str, str, str, str, str, bool]]:
    """The answers for all leaves of a block, in order."""
    log = block["log"].hex()
    n = min(FAN_OUT**levels, block["n"] - block["block"] * FAN_OUT**levels)
    levels = _levels_of(block["n"], levels)
    runs = []  # by level, the digests of each run in one text
    width = 2 * _DIGEST
    for level in range(levels):
        ats = [position(level, k, n) * width for k in range(-(-n // FAN_OUT**level))]
        digests = [log[at : at + width] for at in ats]
        runs.append(["".join(digests[k : k + FAN_OUT]) for k in range(0, len(digests), FAN_OUT)])
    above = [(step["left"].hex(), step["right"].hex()) for step in block["path"]]
    rest = "".join(left + right for left, right in above)
    subroot = block["subroot"].hex()
    for k, claimed in enumerate(block["claimed"]):
        at = position(0, k, n) * width
        leaf = log[at : at + width]
        path, index = [], k
        for level in range(levels):
            index, child = divmod(index, FAN_OUT)
            run = runs[level][index]
            path.append((run[: child * width], run[(child + 1) * width :]))
        proof = "".join([left + right for left, right in path]) + rest
        folded = leaf if claimed is None else claimed.hex()
        for left, right in (*path, *above):
            folded = hashlib.sha256(f"{left}{folded}{right}".encode()).hexdigest()
        yield leaf, subroot, root, hashlib.sha256(proof.encode()).hexdigest(), folded, folded == root
