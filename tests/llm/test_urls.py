"""URL verdicts and the mapped arrays behind them."""

import numpy as np
import pytest
import xxhash

from citysignal.llm import mapped, urls

RULES = [urls.Rule("allow", "net", "/"), urls.Rule("block", "a.net", "/x"), urls.Rule("allow", "a.net", "/xy"), urls.Rule("block", "b.a.net")]


def test_spark_and_python_hash_alike(spark):
    names = ["", "host.example", "ü/ß", "x" * 5000]
    got = spark.createDataFrame([(n,) for n in names], "n string").selectExpr("xxhash64(n) as h").collect()
    assert [r.h % (1 << 64) for r in got] == [xxhash.xxh64_intdigest(n.encode(), urls.SEED) for n in names]


def test_equal_keys_are_told_apart_by_their_names(tmp_path):
    keys = np.array([7, 7, 7, 1 << 63, 3], np.uint64)
    names = [b"one", b"two", b"", b"high", b"low"]
    path = tmp_path / "a.keys"
    path.write_bytes(mapped.packed(keys, np.arange(5) * 10, names))
    listed = mapped.SortedKeys(0, {0: str(path)})
    asked = [(7, b"two"), (7, b"tw"), (7, b""), (1 << 63, b"high"), (3, b"high"), (5, b"x"), ((1 << 64) - 1, b"x")]
    got = listed.confirm(np.array([k for k, _ in asked], np.uint64), [n for _, n in asked])
    assert got == [10, None, 20, 30, None, None, None]


@pytest.mark.parametrize("ship", [False, True])
def test_lists_of_several_shards(spark, ship):
    entries = spark.range(1000).selectExpr("concat('Host', id, '.example/P', id) as entry")
    entries = entries.union(entries).union(spark.createDataFrame([(None,), ("",)], "entry string"))
    listed = urls.stored_list(entries, shard_keys=100, ship=ship)
    assert listed.bits == 4 and len(listed.files) == 16
    pages = spark.range(2000).selectExpr("id as page_id", "concat('http://hOST', id, '.example/P', id, '?q') as url")
    got = urls.judged(pages, [], listed).groupBy("verdict").count().collect()
    assert {r.verdict: r["count"] for r in got} == {"block": 1000, "allow": 1000}


def test_rules_and_awkward_urls(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    long_host = ".".join(["x"] * 200_000) + ".bad.example"
    cases = {
        "http://A.net/xyz": ("a.net", "/xyz", "a.net/xy", "allow", None),
        "http://a.net/x#/xy": ("a.net", "/x", "a.net/x", "block", None),
        "s://q.b.a.net": ("q.b.a.net", "", "b.a.net", "block", None),
        "s://q.b.a.net/xy": ("q.b.a.net", "/xy", "a.net/xy", "allow", None),
        "//ba.net/x": ("", "", None, "allow", None),
        "x://ba.net?/x": ("ba.net", "", None, "allow", None),
        "x://ba.net/x": ("ba.net", "/x", "net/", "allow", None),
        "x://SUB.Bad.example/y?z": ("sub.bad.example", "/y", None, "block", "bad.example"),
        "x://notbad.example/y": ("notbad.example", "/y", None, "allow", None),
        "x://one.example/Page?z": ("one.example", "/Page", None, "block", "one.example/Page"),
        "x://one.example/page": ("one.example", "/page", None, "allow", None),
        "a://b://c/d": ("b:", "//c/d", None, "allow", None),
        f"x://{long_host}/{'y' * 100_000}": (long_host, "/" + "y" * 100_000, None, "block", "bad.example"),
        "": ("", "", None, "allow", None),
        None: ("", "", None, "allow", None),
        "x://": ("", "", None, "allow", None),
    }
    rows = [(i, u, "X", "h", "f", None) for i, u in enumerate(cases)] + [(None, None, None, None, None, None), (0, next(iter(cases)), "", "", "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, URL string, host string, found string, names string")
    listed = urls.stored_list(spark.createDataFrame([("BAD.example",), ("one.example/Page",), ("bad.example",)], "entry string"))
    got = urls.judged(pages, RULES, listed).collect()
    spark.conf.unset("spark.sql.caseSensitive")
    by_id = {r.page_id: tuple(r)[1:] for r in got}
    assert len(got) == len(rows) and sum(r.page_id == 0 for r in got) == 2
    for i, wanted in enumerate(cases.values()):
        assert by_id[i] == wanted
    assert by_id[None] == ("", "", None, "allow", None)


def test_empty_list_and_empty_table(spark):
    none = urls.stored_list(spark.createDataFrame([], "entry string"))
    pages = spark.createDataFrame([(1, "x://a/b")], "page_id long, url string")
    assert [r.verdict for r in urls.judged(pages, RULES, none).collect()] == ["allow"]
    assert urls.judged(pages.limit(0), RULES, none).count() == 0
    assert urls.suspects(pages.limit(0), ("bad",), 2).count() == 0
