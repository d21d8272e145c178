"""The Merkle manifest against a plain tree in memory."""

import collections
import hashlib
import itertools
import zlib

import numpy as np
import pytest

from citysignal.llm import merkle

NAMES = "doc_id long, source string, SOURCE string, lang string, n_chars long, text string, tree string, n int, id long, other string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = (row[0], row[1], row[3], row[4], text)
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climbed(nodes):
    """All levels of a tree over ``nodes``."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def sides(levels, i):
    for nodes in levels[:-1]:
        first = i // 3 * 3
        yield "".join(nodes[first:i]), "".join(nodes[i + 1 : first + 3])
        i //= 3


def brute(rows):
    trees = collections.defaultdict(list)
    for row in rows:
        trees[row[1]].append((row[0] is not None, row[0] or 0, leaf(row, row[5]), row))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    levels = {s: climbed([x[2] for x in sorted(trees[s], key=lambda x: x[:3])]) for s in order}
    crown = climbed([levels[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, (_, _, own, row) in enumerate(sorted(trees[s], key=lambda x: x[:3])):
            path = [*sides(levels[s], i), *sides(crown, k)]
            text = row[5]
            if text is not None and zlib.crc32(b"" if row[0] is None else str(row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            again = leaf(row, text)
            for left, right in path:
                again = sha(left, again, right)
            proof = sha(*itertools.chain(*path))
            out.append((row[0], own, levels[s][-1][0], crown[-1][0], proof, again, again == crown[-1][0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_manifest_matches_a_plain_tree(spark, levels):
    sources = [None, "", "a", "ä", "B", "\U0001f600", "one"] + [f"s{i}" for i in range(5)]
    rows = [(i, "hot", "X", "en", 3 * i, f"line {i}\nline", "t", 1, 2, "o") for i in range(200)]
    rows += [(1000 + i, sources[i % len(sources) - (i % 3 == 0)], None, None, None, "x\n" * (i % 4), None, None, None, None) for i in range(80)]
    rows += [(None, "hot", None, None, None, None, None, None, None, None)] * 3 + [(7, "hot", "", "", 0, "", "", 0, 0, "")] * 2
    rows += [(5000, "long", "", "de", 9, "very long\n" * 50_000, "", 0, 0, "")]
    spark.conf.set("spark.sql.caseSensitive", "true")
    docs = spark.createDataFrame(rows, NAMES).repartition(5)
    got = merkle.manifest(docs, levels).collect()
    spark.conf.unset("spark.sql.caseSensitive")
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_one_row_and_no_row(spark):
    rows = [(3, "a", None, None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id int, source string, x string, lang string, n_chars int, text string, a int, b int, c int, d int")
    assert [tuple(r) for r in merkle.manifest(docs).collect()] == brute(rows)
    assert merkle.manifest(docs.limit(0)).count() == 0


def test_multiproof_is_enough_and_the_fewest():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 7, 27, 28, 100):
        leaves = [sha(str(i)).encode() for i in range(n)]
        levels = [[x.encode() for x in level] for level in climbed([x.decode() for x in leaves])]
        for size in {1, (n + 1) // 2, n}:
            held = np.sort(rng.choice(n, size, replace=False))
            asked = merkle.missing(held, n)
            fetched = {(level, i): levels[level][i] for level, i in asked}
            known = merkle.Known({i: leaves[i] for i in held.tolist()}, n, fetched)
            assert known.root == levels[-1][0]
            for i, path in known.paths(held.tolist(), ()).items():
                assert merkle.folded(leaves[i], path) == known.root
            for lost in asked:
                fewer = {k: v for k, v in fetched.items() if k != lost}
                with pytest.raises(KeyError):
                    merkle.Known({i: leaves[i] for i in held.tolist()}, n, fewer).paths(held.tolist(), ())
