"""N-gram Jaccard join: tiles by size, hashed bitmaps, exact intersection.

A document is the set of its distinct 5-word shingles (64-bit hashes). Two documents link
when their sets' intersection is at least 75 % of their union.

1. Sets. Equal sets are one class from here on; copies never meet each other.
2. Groups. Shingles are put in one order for all documents, rare ones first; two linked
   sets share a shingle among their first ``n - ceil(0.75 n) + 1``. Rarity is read from
   counts in ``SKETCH`` hash buckets, a table of fixed size; any order is exact.
3. Tiles. A group is sorted by set size and cut into blocks of ``TILE`` sets; only blocks
   whose sizes can still reach the threshold form a tile. Equal tiles are made once, and small
   ones that share their least or their greatest set become one, for near copies share many shingles.
4. Bitmaps. Each set has a parity bitmap of two to four bits a shingle. The bits in
   which two differ are at most the shingles in which the sets differ, which bounds the
   overlap from above; pairs below the threshold stop here.
5. Exact check of what is left by intersecting sorted arrays. First each tile proposes a
   spanning tree of its candidates; components of the links found leave the pairs between
   different components, which are checked all, but in tiles whose tree was all they had. No link
   between components is lost, and copies of one text in thousands do not cost all pairs.
6. Components of all links give each class its smallest document id.

Texts without words have no set, link with nothing, and are their own component. Null
texts likewise. Null ids never name a component unless nothing else does. Repeated rows keep
their rows. Columns other than id and text are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citysignal.llm import blocks
from citysignal.llm.common import ID_ROWS, arrow_rows, only, restored, shielded, small_side, written
from citysignal.llm.components import components

WORDS = 5
PERCENT = 75
SKETCH = 1 << 16
TILE = 1024
STAR = 1024
MERGED = 128
# Rows of a tile compared at once, and bytes of texts hashed at once: both bound what a worker holds.
COMPARED = 128
SLICE_BYTES = 1 << 18
LEAST_BITS = 256


def bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(48)).astype(np.int64)


def distinct_sets(batch):
    """(first row, row of each shingle, shingle) by slice, distinct, sorted by row and hash."""
    for first, data, offsets in blocks.slices(batch.column("text"), SLICE_BYTES):
        h, counts = blocks.hashed_words(data, offsets)
        made, owner = blocks.shingle_sets(h, counts, WORDS)
        order = np.lexsort((made, owner))
        made, owner = made[order], owner[order]
        fresh = np.ones(len(made), bool)
        fresh[1:] = (made[1:] != made[:-1]) | (owner[1:] != owner[:-1])
        yield first, len(counts), owner[fresh], made[fresh]


def set_ids(made: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One number a set: a mixed sum over its shingles."""
    total = np.add.reduceat(blocks.mixed(made ^ np.uint64(blocks.MIX[1])), starts)
    return blocks.mixed(total + sizes.astype(np.uint64) * np.uint64(blocks.BASE)).view(np.int64)


def _narrow(docs: DataFrame) -> DataFrame:
    return only(docs, "doc_id", "text").select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def sketch(docs: DataFrame) -> np.ndarray:
    """How many sets have a shingle of each bucket; a driver array of fixed size."""

    def count(batches):
        import pyarrow as pa

        total = np.zeros(SKETCH, np.int64)
        for batch in batches:
            for _, _, _, made in distinct_sets(batch):
                total += np.bincount(bucket(made), minlength=SKETCH)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": used, "n": total[used]})

    counted = _narrow(docs).mapInArrow(count, "bucket bigint, n bigint")
    out = np.zeros(SKETCH, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def bitmap_bits(size: int) -> int:
    """Two to four bits a shingle, a power of two."""
    return max(LEAST_BITS, 1 << int(2 * size - 1).bit_length())


def parity(made: np.ndarray, bits: int) -> bytes:
    odd = np.bincount((made & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _digest():
    """Finds the rows of a text again; texts that share it by chance are only read in vain."""
    return F.xxhash64("text").alias("digest")


def profiles(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """doc_id, digest, n_shingles, set_id for each row; prefix and bits once for each set in a task."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def profile(batches):
        import pyarrow as pa

        rarity, seen = shared.value, set()
        for batch in batches:
            for first, rows, owner, made in distinct_sets(batch):
                sizes = np.bincount(owner, minlength=rows)
                have = np.flatnonzero(sizes)
                starts = (np.cumsum(sizes) - sizes)[have]
                ids = set_ids(made, starts, sizes[have]) if len(have) else np.zeros(0, np.int64)
                ordered = made[np.lexsort((made, rarity[bucket(made)], owner))]
                set_id, prefix, bits = [None] * rows, [None] * rows, [None] * rows
                for r, at, name in zip(have.tolist(), starts.tolist(), ids.tolist(), strict=True):
                    n = int(sizes[r])
                    set_id[r] = name
                    if name in seen:
                        continue
                    seen.add(name)
                    keep = n - (PERCENT * n + 99) // 100 + 1
                    prefix[r] = ordered[at : at + keep].view(np.int64)
                    bits[r] = parity(made[at : at + n], bitmap_bits(n))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, rows),
                        batch.column("digest").slice(first, rows),
                        pa.array(sizes, pa.int64()),
                        pa.array(set_id, pa.int64()),
                        pa.array(prefix, pa.list_(pa.int64())),
                        pa.array(bits, pa.binary()),
                    ],
                    ["doc_id", "digest", "n_shingles", "set_id", "prefix", "bits"],
                )

    narrow = _narrow(docs).select("*", _digest())
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(
        profile,
        f"doc_id {kind}, digest bigint, n_shingles bigint, set_id bigint, prefix array<bigint>, bits binary",
    )


def may_reach(small: int, large: int) -> bool:
    return 100 * small >= PERCENT * large


def tiles_of(ids: np.ndarray, sizes: np.ndarray):
    """(left, right) blocks of a group whose sizes are compatible; right is None for a block itself."""
    order = np.lexsort((ids, sizes))
    ids, sizes = ids[order], sizes[order]
    # A set that no neighbour's size can reach has no partner here.
    near = np.zeros(len(ids), bool)
    reach = 100 * sizes[:-1] >= PERCENT * sizes[1:]
    near[1:] |= reach
    near[:-1] |= reach
    ids, sizes = ids[near], sizes[near]
    for i in range(0, len(ids), TILE):
        if len(ids[i : i + TILE]) > 1:
            yield ids[i : i + TILE], None
        largest = sizes[min(i + TILE, len(ids)) - 1]
        for j in range(i + TILE, len(ids), TILE):
            if not may_reach(largest, sizes[j]):
                break
            yield ids[i : i + TILE], ids[j : j + TILE]


def tiles(table: DataFrame) -> DataFrame:
    """tile, left, right: sets that share an early shingle, in compatible blocks, once each."""
    postings = table.where("prefix is not null").select(
        "set_id", F.col("n_shingles").alias("n"), F.explode("prefix").alias("key")
    )
    sorted_keys = postings.repartition("key").sortWithinPartitions("key")

    def groups(batches):
        import pyarrow as pa

        held = None
        out: list[tuple] = []

        def cut(key, ids, sizes, last: bool):
            """Tiles of all groups that are complete; the rest is held."""
            nonlocal held
            bounds = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            ends = np.append(bounds[1:], len(key))
            if not last:
                at = bounds[-1]
                held = (key[at:], ids[at:], sizes[at:])
                bounds, ends = bounds[:-1], ends[:-1]
            several = np.flatnonzero(ends - bounds > 1)
            for i, j in zip(bounds[several].tolist(), ends[several].tolist(), strict=True):
                own, first = np.unique(ids[i:j], return_index=True)
                if len(own) > 1:
                    for left, right in tiles_of(own, sizes[i:j][first]):
                        out.append((left, right))

        def flush():
            names = [
                int(
                    blocks.mixed(
                        np.array(
                            [
                                (np.sum(blocks.mixed(a.view(np.uint64))) + np.uint64(len(a)))
                                if a is not None
                                else np.uint64(7)
                                for a in tile
                            ],
                            np.uint64,
                        )
                        * np.array([1, blocks.BASE], np.uint64)
                    )
                    .sum()
                    .view(np.int64)
                )
                for tile in out
            ]
            made = pa.RecordBatch.from_arrays(
                [
                    pa.array(names, pa.int64()),
                    pa.array([t[0] for t in out], pa.list_(pa.int64())),
                    pa.array([t[1] for t in out], pa.list_(pa.int64())),
                ],
                ["tile", "left", "right"],
            )
            out.clear()
            return made

        for batch in batches:
            arrays = [batch.column(c).to_numpy() for c in ("key", "set_id", "n")]
            if not len(arrays[0]):
                continue
            if held is not None:
                arrays = [np.concatenate(pair) for pair in zip(held, arrays, strict=True)]
            held = None
            cut(*arrays, last=False)
            if len(out) > 2000:
                yield flush()
        if held is not None:
            cut(*held, last=True)
        if out:
            yield flush()

    made = sorted_keys.select("key", "set_id", "n").mapInArrow(
        groups, "tile bigint, left array<bigint>, right array<bigint>"
    )
    made = made.groupBy("tile").agg(F.first("left").alias("left"), F.first("right").alias("right"))
    return merged(merged(made, F.array_min), F.array_max)


def merged(table: DataFrame, end) -> DataFrame:
    """The tiles, with blocks of the same ``end`` as one where that has at most ``MERGED`` sets.

    Every pair of sets in a tile is still in one; more pairs may meet, which the exact check sorts out.
    """
    small = F.col("right").isNull() & (F.size("left") <= MERGED)
    own = table.withColumn("anchor", F.when(small, end("left")).otherwise(F.col("tile")))
    own = own.groupBy("anchor", small.alias("small")).agg(
        F.collect_list(F.struct("tile", "left", "right")).alias("own")
    )
    union = F.array_distinct(F.flatten("own.left"))
    one = F.array(F.struct(F.array_min("own.tile").alias("tile"), union.alias("left"), F.lit(None).cast("array<bigint>").alias("right")))
    fits = F.col("small") & (F.size(union) <= MERGED)
    return own.select(F.inline(F.when(fits, one).otherwise(F.col("own"))))


def folded(bits: list[bytes], width: int) -> np.ndarray:
    """Bitmaps row by row, wider ones folded to ``width`` bytes."""
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(b, np.uint64).reshape(-1, width // 8), 0) for b in bits])


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits that differ, for all pairs of bitmaps of one width."""
    out = np.empty((len(a), len(b)), np.int32)
    for i in range(len(a)):
        out[i] = np.bitwise_count(a[i] ^ b).sum(1, dtype=np.int32)
    return out


def bounded_pairs(ids, sizes, bits, split: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) whose sizes and bitmaps allow the threshold; ``split`` parts left and right.

    Members are sorted by size, so each row looks only at the following rows it can reach,
    in runs of equal bitmap width, of which ``COMPARED`` rows are compared at once.
    """
    found_i, found_j = [], []
    n = len(ids)
    order = np.argsort(sizes, kind="stable")
    widths = np.array([len(b) for b in bits])[order]
    size, where = sizes[order], order
    at = 0
    while at < n:
        # Rows of one width against all later rows within reach.
        stop = at + int(np.argmax(np.append(widths[at:] != widths[at], True)))
        reach = max(int(np.searchsorted(PERCENT * size, 100 * size[stop - 1], "right")), stop)
        narrow = folded([bits[k] for k in where[at:reach]], int(widths[at:reach].min()))
        for first in range(at, stop, COMPARED):
            last = min(first + COMPARED, stop)
            end = max(int(np.searchsorted(PERCENT * size, 100 * size[last - 1], "right")), last)
            mine, theirs = where[first:last], where[first:end]
            differ = differing(narrow[first - at : last - at], narrow[first - at : end - at])
            a, b = size[first:last, None].astype(np.int64), size[None, first:end].astype(np.int64)
            overlap = np.minimum((a + b - differ) // 2, a)
            fits = 100 * overlap >= PERCENT * (a + b - overlap)
            fits &= np.arange(len(theirs))[None, :] > np.arange(len(mine))[:, None]
            if split:
                fits &= (mine < split)[:, None] != (theirs < split)[None, :]
            i, j = np.nonzero(fits)
            found_i.append(mine[i])
            found_j.append(theirs[j])
        at = stop
    if not found_i:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_i), np.concatenate(found_j)


def spanning(n: int, i: np.ndarray, j: np.ndarray, ids: np.ndarray):
    """A breadth-first forest of the pairs, each tree from its smallest id, as two arrays."""
    source, target = np.concatenate([i, j]), np.concatenate([j, i])
    target = target[np.argsort(source, kind="stable")]
    degree = np.bincount(source, minlength=n)
    ends = np.cumsum(degree)
    seen = degree == 0
    parents, children = [], []
    for root in np.argsort(ids, kind="stable").tolist():
        if seen[root]:
            continue
        seen[root] = True
        layer = [root]
        for node in layer:
            near = target[ends[node] - degree[node] : ends[node]]
            fresh = near[~seen[near]]
            seen[fresh] = True
            parents += [node] * len(fresh)
            children += fresh.tolist()
            layer += fresh.tolist()
    return np.array(parents, np.int64), np.array(children, np.int64)


def proposed(tiles_table: DataFrame, marks: DataFrame, labelled: DataFrame | None) -> DataFrame:
    """Pairs (a, b) that pass the bitmaps: spanning trees, or with ``labelled`` (node, component)
    all pairs of different components. Where trees leave pairs out, a row names the ``tile`` and no pair."""
    members = tiles_table.select(
        "tile", F.explode("left").alias("set_id"), F.lit(0).alias("side")
    ).unionByName(
        tiles_table.select("tile", F.explode("right").alias("set_id"), F.lit(1).alias("side"))
    )
    if labelled is not None:
        named = labelled.select(F.col("node").alias("set_id"), "component")
        members = members.join(named, "set_id", "left").withColumn(
            "component", F.coalesce("component", "set_id")
        )
        several = members.groupBy("tile").agg(
            F.min("component").alias("least"), F.max("component").alias("most")
        )
        members = members.join(several.where("least <> most").select("tile"), "tile")
    else:
        members = members.withColumn("component", F.col("set_id"))
    # Bitmaps travel for sets in tiles only.
    members = written(members, "jaccard-members")
    wanted = small_side(members.select("set_id").distinct(), ID_ROWS)
    wanted_marks = marks.join(wanted, "set_id", "left_semi").dropDuplicates(["set_id"])
    rows = members.join(wanted_marks, "set_id").select("tile", "side", "set_id", "component", "n", "bits")
    all_pairs = labelled is not None

    def compare(table):
        import pyarrow as pa

        table = table.sort_by([("side", "ascending"), ("set_id", "ascending")])
        ids = table.column("set_id").to_numpy()
        split = int((table.column("side").to_numpy() == 0).sum())
        i, j = bounded_pairs(
            ids,
            table.column("n").to_numpy(),
            table.column("bits").to_pylist(),
            0 if split == len(ids) else split,
        )
        left_out = []
        if all_pairs:
            label = table.column("component").to_numpy()
            apart = label[i] != label[j]
            i, j = i[apart], j[apart]
        else:
            whole = len(i)
            i, j = spanning(len(ids), i, j, ids)
            left_out = [table.column("tile")[0].as_py()] * (len(i) < whole)
        pairs = [np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])]
        none = [None] * len(left_out)
        return pa.table(
            {
                "a": pa.array([*pairs[0].tolist(), *none], pa.int64()),
                "b": pa.array([*pairs[1].tolist(), *none], pa.int64()),
                "tile": pa.array([*[None] * len(i), *left_out], pa.int64()),
            }
        )

    return rows.groupBy("tile").applyInArrow(compare, "a bigint, b bigint, tile bigint").distinct()


def arrays(docs: DataFrame, digests: DataFrame) -> DataFrame:
    """set_id and the sorted shingles of each distinct set of a task, of texts with these digests."""

    def make(batches):
        import pyarrow as pa

        seen = set()
        for batch in batches:
            for _, rows, owner, made in distinct_sets(batch):
                sizes = np.bincount(owner, minlength=rows)
                have = np.flatnonzero(sizes)
                if not len(have):
                    continue
                starts = (np.cumsum(sizes) - sizes)[have]
                ids = set_ids(made, starts, sizes[have])
                out = []
                for at, n, name in zip(starts, sizes[have], ids.tolist(), strict=True):
                    if name not in seen:
                        seen.add(name)
                        out.append((name, made[at : at + n].tobytes()))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary())],
                        ["set_id", "shingles"],
                    )

    wanted = _narrow(docs).select("*", _digest()).join(digests, "digest", "left_semi")
    return wanted.select("text").mapInArrow(make, "set_id bigint, shingles binary")


def verified(docs: DataFrame, pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """The stored pairs (a, b) of sets that do link, by exact intersection.

    Only texts whose set is in a pair are made into arrays. Pairs are grouped by their first set, in stars of
    about ``STAR`` partners, so that an array travels once a star.
    """
    degree = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / STAR).alias("stars"))
    split = pairs.join(degree, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.col("stars")).alias("star")
    )
    split = written(split, "jaccard-pairs")
    wanted = split.select("a", "star", F.col("b").alias("set_id")).unionByName(
        split.select("a", "star", F.col("a").alias("set_id")).distinct()
    )
    wanted = small_side(wanted, ID_ROWS)
    digests = marks.select("set_id", "digest").dropDuplicates(["set_id"]).join(wanted.select("set_id"), "set_id", "left_semi")
    digests = written(digests.select("digest").distinct(), "jaccard-texts")
    rows = arrays(docs, small_side(digests, ID_ROWS)).join(wanted, "set_id")

    def intersect(table):
        import pyarrow as pa

        centre = table.column("a")[0].as_py()
        sets = dict(zip(table.column("set_id").to_pylist(), table.column("shingles").to_pylist(), strict=True))
        mine = np.frombuffer(sets.pop(centre), np.uint64)
        linked = []
        for name, raw in sets.items():
            other = np.frombuffer(raw, np.uint64)
            at = np.minimum(np.searchsorted(mine, other), len(mine) - 1)
            common = int((mine[at] == other).sum())
            if 100 * common >= PERCENT * (len(mine) + len(other) - common):
                linked.append(name)
        return pa.table({"a": pa.array([centre] * len(linked), pa.int64()), "b": pa.array(linked, pa.int64())})

    return rows.groupBy("a", "star").applyInArrow(intersect, "a bigint, b bigint")


def linked(docs: DataFrame, pairs: DataFrame, marks: DataFrame) -> DataFrame:
    pairs = written(pairs, "jaccard-candidates")
    with arrow_rows(docs.sparkSession):
        return written(verified(docs, pairs, marks), "jaccard-links")


def grouped(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for each row."""
    # What reads whole texts gets them in small batches; the narrow rows of tiles go by Spark's own.
    with arrow_rows(docs.sparkSession):
        table = written(profiles(docs, sketch(docs)), "jaccard-sets")
    made = written(tiles(table), "jaccard-tiles")
    marks = table.where("bits is not null").select(
        "set_id", F.col("n_shingles").alias("n"), "bits", "digest"
    )
    first = written(proposed(made, marks, None), "jaccard-trees")
    trees, several = first.where("a is not null").select("a", "b"), first.where("a is null").select("tile")
    links = linked(docs, trees, marks)
    rest = proposed(made.join(several, "tile", "left_semi"), marks, components(links))
    more = linked(docs, rest.select("a", "b"), marks)
    joined = components(links.unionByName(more))
    classes = (
        table.where("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("least"))
    )
    named = classes.join(joined.withColumnRenamed("node", "set_id"), "set_id", "left").select(
        "set_id", "least", F.coalesce("component", "set_id").alias("component")
    )
    roots = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(roots, "component").select("set_id", "component_id")
    return table.select("doc_id", "n_shingles", "set_id").join(named, "set_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def representatives(docs: DataFrame) -> DataFrame:
    """One row of each group of linked documents, that with the smallest id; all columns.

    Rows are told apart by a number, so of rows that share an id one stays as well. Only
    the numbers of rows that go are joined back to the documents.
    """
    inner = shielded(docs, "doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    classes = grouped(inner.select(F.col("row").alias("doc_id"), "text"))
    named = inner.select("row", F.col("doc_id").alias("id")).join(
        classes.withColumnRenamed("doc_id", "row"), "row"
    )
    order = F.struct(F.col("id").isNull(), "id", "row")
    kept = named.groupBy("component_id").agg(F.min(order).getField("row").alias("kept"))
    gone = written(
        named.join(kept, "component_id").where("row <> kept").select("row"), "jaccard-gone"
    )
    return restored(inner.join(small_side(gone, ID_ROWS), "row", "left_anti"), docs.columns)
