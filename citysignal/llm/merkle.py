"""Merkle manifest of a dataset, with a proof for every row from one multiproof a leaf partition.

A row's leaf is the SHA-256 of its columns. The rows of a source, in the order of their ids, make a
tree of ``ARITY`` children a node; the sources' roots, in the order of their names, make the
tree above. A proof of a row is the list of siblings up to the root.

Rows are put in order by a range shuffle of digests alone (texts are hashed where they are read)
and numbered from the sizes of the sorted runs, so that a source with a third of all rows is
spread like any other. Leaf partitions are runs of ``ARITY ** BLOCK_LEVELS`` positions of a tree. Each reduces its
own leaves and names the coordinates that its proofs lack: going up, the children of every known
node's parent that it neither holds nor asked for (``missing``), so each coordinate is asked for once however many
proofs use it. Roots of partitions are reduced the same way, partition by partition, until one is left. The
asked nodes are fetched by one join for all partitions; each partition then derives its interiors once
and expands the proofs of its rows from them (``Known``).

Nulls in any column have a leaf of their own kind. Rows are ordered with null ids first, equal ids
by their leaf; fully equal rows are leaves of their own. A null source comes before the empty one. Checksums of null ids are those
of empty texts. Empty texts and very long ones are hashed whole. An empty table has no root and gives no rows.
Columns other than those of the leaf are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citysignal.llm.common import ID_ROWS, fold, only, small_side, written

ARITY = 3
# 2,187 leaves: some 200 KB a partition.
BLOCK_LEVELS = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: bytes) -> bytes:
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def sizes(n: int) -> list[int]:
    """How many nodes a tree of n leaves has, level by level, to its root."""
    out = [n]
    while out[-1] > 1:
        out.append(-(-out[-1] // ARITY))
    return out


def missing(positions: np.ndarray, n: int) -> list[tuple[int, int]]:
    """The fewest (level, index) that, with the leaves at ``positions``, prove them all."""
    out, known = [], np.unique(positions)
    for level, size in enumerate(sizes(n)[:-1]):
        parents = np.unique(known // ARITY)
        children = (parents[:, None] * ARITY + np.arange(ARITY)).ravel()
        lacking = np.setdiff1d(children[children < size], known)
        out += [(level, i) for i in lacking.tolist()]
        known = parents
    return out


def reduced(nodes: dict[int, bytes], size: int) -> dict[int, bytes]:
    """The parents of complete runs among the nodes of a level of ``size`` nodes."""
    out = {}
    for parent in sorted({i // ARITY for i in nodes}):
        run = range(parent * ARITY, min((parent + 1) * ARITY, size))
        if all(i in nodes for i in run):
            out[parent] = digest(*(nodes[i] for i in run))
    return out


class Known:
    """What a partition knows of its tree: its leaves, fetched nodes and all that follows from them."""

    def __init__(self, leaves: dict[int, bytes], n: int, fetched: dict[tuple[int, int], bytes]):
        self.sizes, self.levels = sizes(n), [dict(leaves)]
        for level, size in enumerate(self.sizes[:-1]):
            nodes = self.levels[-1]
            nodes.update({i: d for (at, i), d in fetched.items() if at == level})
            self.levels.append(reduced(nodes, size))

    @property
    def root(self) -> bytes:
        return self.levels[-1][0]

    def siblings(self, level: int, index: int) -> tuple[bytes, bytes]:
        """The node's run without it: what is left of it, what is right of it."""
        first, nodes = index - index % ARITY, self.levels[level]
        last = min(first + ARITY, self.sizes[level])
        left = b"".join(nodes[i] for i in range(first, index))
        return left, b"".join(nodes[i] for i in range(index + 1, last))

    def paths(self, positions: list[int], above: tuple) -> dict[int, tuple]:
        """The siblings of each position level by level, then those ``above`` the tree."""
        steps, own = [], sorted(set(positions))
        for level in range(len(self.sizes) - 1):
            steps.append({i: self.siblings(level, i) for i in own})
            own = sorted({i // ARITY for i in own})
        shared = {0: above}
        for level in reversed(range(len(steps))):
            shared = {i: (step, *shared[i // ARITY]) for i, step in steps[level].items()}
        return shared


def folded(leaf: bytes, path: tuple) -> bytes:
    """The root that follows from a leaf and its siblings."""
    for left, right in path:
        leaf = digest(left, leaf, right)
    return leaf


# --- leaves


def leaf_of(text: Column) -> Column:
    """The digest of a row: each column's length in bytes and value, ``-`` for a null."""
    values = [*(F.col(name).cast("string") for name in FIELDS[:-1]), text]
    encoded = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    return F.unhex(F.sha2(F.concat(*encoded), 256))


def tree_name(source: Column) -> Column:
    """Names sort like sources, a null one first."""
    return F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("/"), source.cast("string")))


def leaves_of(docs: DataFrame) -> DataFrame:
    """tree, id, digest and ``other``: the digest of the row with the line feeds of its text deleted, for
    rows whose id has an even checksum."""
    text = F.col("text").cast("string")
    cut = (fold("doc_id", 2) == 0) & F.contains(text, F.lit("\n"))
    return only(docs, *FIELDS).select(
        tree_name(F.col("source")).alias("tree"),
        F.col("doc_id").alias("id"),
        leaf_of(text).alias("digest"),
        F.when(cut, leaf_of(F.translate(text, "\n", ""))).alias("other"),
    )


def placed(leaves: DataFrame) -> DataFrame:
    """``leaves`` with their position in their tree and the number ``n`` of its leaves."""
    # Equal rows may stand in any order, so a number of their own lets the shuffle part them.
    by = ["tree", "id", "digest", "salt"]
    ordered = leaves.withColumn("salt", F.monotonically_increasing_id())
    ordered = ordered.repartitionByRange(*by).sortWithinPartitions(*by)
    # The number holds the partition in its high bits, the row in it in the lower 33.
    ordered = ordered.drop("salt").withColumn("seq", F.monotonically_increasing_id())
    ordered = written(ordered, "merkle-order").withColumn("run", F.shiftright("seq", 33))
    runs = ordered.groupBy("tree", "run").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("rows"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = written(
        runs.select(
            "tree",
            "run",
            (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"),
            F.sum("rows").over(tree).alias("n"),
        ),
        "merkle-runs",
    )
    joined = ordered.join(small_side(runs, ID_ROWS), ["tree", "run"])
    return joined.select("tree", "n", "id", "digest", "other", (F.col("seq") + F.col("shift")).alias("position"))


# --- partitions

NODES = "array<struct<level:int,index:bigint,digest:binary>>"


def _hex(raw: bytes) -> bytes:
    return raw.hex().encode()


def _raw(digits: bytes) -> bytes:
    return bytes.fromhex(digits.decode())


def blocks_of(leaves: DataFrame, levels: int = BLOCK_LEVELS) -> DataFrame:
    """One row a leaf partition: its leaves in order, its topmost node, the coordinates it lacks."""
    kind = leaves.schema["id"].dataType.simpleString()

    def pack(table):
        import pyarrow as pa

        table = table.sort_by("position")
        tree, n = table.column("tree")[0].as_py(), table.column("n")[0].as_py()
        positions = table.column("position").to_numpy()
        raw = table.column("digest").to_pylist()
        nodes, level = dict(zip(positions.tolist(), map(_hex, raw), strict=True)), 0
        for size in sizes(n)[:-1][:levels]:
            nodes, level = reduced(nodes, size), level + 1
        ((index, root),) = nodes.items()
        lacking = missing(positions, n)
        return pa.table(
            {
                "tree": [tree],
                "block": pa.array([int(positions[0]) // ARITY**levels], pa.int64()),
                "n": pa.array([n], pa.int64()),
                "ids": pa.array([table.column("id").to_pylist()], pa.list_(table.schema.field("id").type)),
                "positions": pa.array([positions], pa.list_(pa.int64())),
                "leaves": pa.array([raw], pa.list_(pa.binary())),
                "others": pa.array([table.column("other").to_pylist()], pa.list_(pa.binary())),
                "level": pa.array([level], pa.int32()),
                "index": pa.array([index], pa.int64()),
                "digest": pa.array([_raw(root)], pa.binary()),
                "is_root": [level == len(sizes(n)) - 1],
                "lacking": pa.array([[{"level": a, "index": b} for a, b in lacking]], pa.list_(pa.struct([("level", pa.int32()), ("index", pa.int64())]))),
            }
        )

    return leaves.groupBy("tree", F.floor(F.col("position") / ARITY**levels)).applyInArrow(
        pack,
        f"tree string, block bigint, n bigint, ids array<{kind}>, positions array<bigint>, leaves array<binary>, "
        "others array<binary>, level int, index bigint, digest binary, is_root boolean, lacking array<struct<level:int,index:bigint>>",
    )


def interiors(roots: DataFrame, levels: int = BLOCK_LEVELS) -> DataFrame:
    """All nodes (tree, n, level, index, digest) from the partitions' topmost ones to the trees' roots."""

    def climb(table):
        tree, n, level = (table.column(c)[0].as_py() for c in ("tree", "n", "level"))
        nodes = dict(zip(table.column("index").to_pylist(), map(_hex, table.column("digest").to_pylist()), strict=True))
        out = []
        for size in sizes(n)[level:-1][:levels]:
            nodes, level = reduced(nodes, size), level + 1
            top = level == len(sizes(n)) - 1
            out += [(tree, n, level, i, _raw(d), top) for i, d in nodes.items()]
        return pa.Table.from_pylist([dict(zip(node.names, row, strict=True)) for row in out], node)

    import pyarrow as pa

    kinds = pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.bool_()
    node = pa.schema(list(zip(("tree", "n", "level", "index", "digest", "is_root"), kinds, strict=True)))
    schema = "tree string, n bigint, level int, index bigint, digest binary, is_root boolean"
    nodes = newest = roots.select(*node.names)
    largest = roots.agg(F.max("n")).first()[0] or 1
    for level in range(levels, len(sizes(largest)) - 1, levels):
        below = newest.where(f"level = {level} and not is_root")
        grouped = below.groupBy("tree", F.floor(F.col("index") / ARITY**levels))
        newest = written(grouped.applyInArrow(climb, schema), "merkle-nodes")
        nodes = nodes.unionByName(newest)
    return nodes


def fetched(blocks: DataFrame, nodes: DataFrame) -> DataFrame:
    """What each partition asked for: tree, block and the nodes. One join for all partitions."""
    asked = blocks.select("tree", "block", F.inline("lacking"))
    found = asked.join(nodes.select("tree", "level", "index", "digest"), ["tree", "level", "index"])
    return found.groupBy("tree", "block").agg(
        F.collect_list(F.struct("level", "index", "digest")).cast(NODES).alias("nodes")
    )


def _known(row: dict) -> Known:
    leaves = dict(zip(row["positions"], map(_hex, row["leaves"]), strict=True))
    nodes = {(x["level"], x["index"]): _hex(x["digest"]) for x in row["nodes"] or ()}
    return Known(leaves, row["n"], nodes)


def _rows(batches) -> Iterator[dict]:
    """Arrow batches as plain rows, a row at a time: a row is a whole partition."""
    for batch in batches:
        for i in range(len(batch)):
            yield batch.slice(i, 1).to_pylist()[0]


def tree_paths(blocks: DataFrame) -> DataFrame:
    """tree, subroot, root and ``above``: the siblings of each subroot, level by level, in the tree of subroots."""

    def expand(batches):
        import pyarrow as pa

        for row in _rows(batches):
            known = _known(row)
            paths = known.paths(row["positions"], ())
            above = [[{"before": a.decode(), "after": b.decode()} for a, b in paths[p]] for p in row["positions"]]
            yield pa.RecordBatch.from_pydict(
                {
                    "tree": pa.array(row["ids"], pa.string()),
                    "subroot": pa.array([d.hex() for d in row["leaves"]], pa.string()),
                    "root": pa.array([known.root.decode()] * len(above), pa.string()),
                    "above": pa.array(above, pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))),
                }
            )

    return blocks.mapInArrow(
        expand, "tree string, subroot string, root string, above array<struct<before:string,after:string>>"
    )


def proofs(blocks: DataFrame) -> DataFrame:
    """The rows of every partition with their proofs, folded again from the other leaf where there is one."""
    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    schema = (
        f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, "
        "folded_root string, verified boolean"
    )

    def expand(batches):
        import pyarrow as pa

        kind_of_id = None
        for batch in batches:
            kind_of_id = batch.schema.field("ids").type.value_type
            for row in _rows([batch]):
                above = tuple((x["before"].encode(), x["after"].encode()) for x in row["above"])
                paths = _known(row).paths(row["positions"], above)
                proof, again = [], []
                for position, leaf, other in zip(row["positions"], row["leaves"], row["others"], strict=True):
                    path = paths[position]
                    proof.append(digest(*(x for step in path for x in step)).decode())
                    again.append(folded(_hex(other or leaf), path).decode())
                m = len(proof)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(row["ids"], kind_of_id),
                        "leaf": pa.array([d.hex() for d in row["leaves"]]),
                        "subroot": pa.array([row["subroot"]] * m),
                        "root": pa.array([row["root"]] * m),
                        "proof_sha256": pa.array(proof),
                        "folded_root": pa.array(again),
                        "verified": pa.array([x == row["root"] for x in again]),
                    }
                )

    return blocks.mapInArrow(expand, schema)


def forest(leaves: DataFrame, levels: int = BLOCK_LEVELS) -> tuple[DataFrame, DataFrame]:
    """The leaf partitions with what they asked for, and the roots of the trees."""
    blocks = written(blocks_of(placed(leaves), levels), "merkle-blocks")
    nodes = interiors(blocks, levels)
    whole = blocks.join(fetched(blocks, nodes), ["tree", "block"], "left")
    return whole.select("tree", "n", "ids", "positions", "leaves", "others", "nodes"), nodes.where("is_root").select("tree", "digest")


def manifest(docs: DataFrame, levels: int = BLOCK_LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified for every row."""
    blocks, roots = forest(written(leaves_of(docs), "merkle-leaves"), levels)
    subroots = roots.select(
        F.lit("").alias("tree"), F.col("tree").alias("id"), "digest", F.lit(None).cast("binary").alias("other")
    )
    top, _ = forest(written(subroots, "merkle-subroots"), levels)
    paths = written(tree_paths(top), "merkle-paths")
    return proofs(blocks.join(small_side(paths, ID_ROWS // 20), "tree"))
