"""URL filters: rules on hosts and paths, and a list of blocked names as sorted digests.

A list's entries are host names (``host``, which cover the host and its subdomains) or
addresses (``host/path``, which cover exactly that host and path, whatever the query or
fragment). Each entry's xxHash64 is a key in a sorted array that workers map into memory (see
``mapped``). A batch's distinct names are searched side by side by binary search; where a
key is found, the stored string decides, so that colliding digests never block a name.

Rules are few and become one column expression: a rule fits its host and all subdomains if the
path starts with the rule's, the longest fitting one wins (of equal length: the longer host, then
the smaller text). A URL with a rule gets the rule's verdict, another ``block`` if it
is listed, else ``allow``.

Null URLs and those without ``://`` have an empty host and path: no rule fits, nothing is listed, they
are allowed. Very long URLs are looked up whole; as a subdomain a name has at most
``NAME_CHARS`` characters, as in the domain name system. Repeated rows and null ids keep their rows.
Null and empty entries are left out, repeated ones count once. An empty list blocks nothing, an
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citysignal.llm import mapped
from citysignal.llm.common import lower_ascii, only

NAME_CHARS = 253
SEED = 42  # of Spark's xxhash64
FOUND = "struct<entry:string,value:bigint>"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = ""

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What follows the first ``://``: the host, ASCII letters in lower case, and the path."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0))
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def first_rule(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; nulls where none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    ordered = sorted(rules, key=lambda r: (-len(r.text), -len(r.host), r.text, r.verdict))
    for rule in reversed(ordered):
        fits = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
        fits &= F.startswith(path, F.lit(rule.path))
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def names_of(host: Column, path: Column) -> Column:
    """What may stand in the list for a URL: host with path, the host, the domains it is in."""
    tail = F.split(F.right(host, F.lit(NAME_CHARS + 1)), r"\.")
    last = F.size(tail)
    domains = F.transform(
        F.filter(F.sequence(F.lit(1), last), lambda i: (i > 1) | (F.char_length(host) <= NAME_CHARS)),
        lambda i: F.array_join(F.slice(tail, i, last - i + 1), "."),
    )
    none = F.array().cast("array<string>")
    return F.when(host == "", none).otherwise(F.concat(F.array(F.concat(host, path)), domains))


def stored_list(entries: DataFrame, **options) -> mapped.SortedKeys:
    """The list's file: ``entries`` (entry string), distinct, hosts in lower case."""
    entry = F.col("entry").cast("string")
    host = F.regexp_extract(entry, r"^[^/]*", 0)
    entry = F.concat(lower_ascii(host), F.substr(entry, F.char_length(host) + 1))
    rows = (
        only(entries, "entry")
        .select(entry.alias("name"))
        .where("name <> ''")
        .distinct()
        .select(F.xxhash64("name").alias("key"), F.lit(1).cast("long").alias("value"), "name")
    )
    return mapped.store(rows, "url-list", **options)


def looked_up(listed: mapped.SortedKeys, names: pa.Array) -> pa.Array:
    """The first listed one of each row's names, with its value."""
    counts = np.asarray(names.value_lengths().fill_null(0))
    coded = names.flatten().dictionary_encode()
    distinct = coded.dictionary.cast(pa.binary()).to_pylist()
    keys = np.array([xxhash.xxh64_intdigest(name, SEED) for name in distinct], np.uint64)
    values = listed.confirm(keys, distinct)
    known = np.array([v is not None for v in values], bool)
    which = np.asarray(coded.indices)
    hits = np.flatnonzero(known[which]) if len(which) else np.zeros(0, np.int64)
    rows, first = np.unique(np.repeat(np.arange(len(counts)), counts)[hits], return_index=True)
    found: list = [None] * len(counts)
    for row, i in zip(rows.tolist(), which[hits[first]].tolist(), strict=True):
        found[row] = {"entry": distinct[i].decode(), "value": values[i]}
    return pa.array(found, pa.struct([("entry", pa.string()), ("value", pa.int64())]))


def judged(pages: DataFrame, rules: list[Rule], listed: mapped.SortedKeys) -> DataFrame:
    """page_id, host, path, rule, verdict and ``listed``, the entry that covers the URL if one does."""

    @F.arrow_udf(FOUND)
    def look_up(names: pa.Array) -> pa.Array:
        return looked_up(listed, names)

    host, path = host_and_path(F.col("url"))
    split = only(pages, "page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    host, path = F.col("host"), F.col("path")
    found = split.withColumn("found", look_up(names_of(host, path)))
    text, verdict = first_rule(rules, host, path)
    otherwise = F.when(F.col("found").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return found.select(
        "page_id",
        "host",
        "path",
        text.alias("rule"),
        F.coalesce(verdict, otherwise).alias("verdict"),
        F.col("found.entry").alias("listed"),
    )


def suspects(pages: DataFrame, words: tuple[str, ...], whole_from: int) -> DataFrame:
    """A list drawn from a crawl: hosts that have one of ``words`` between dots or hyphens; those with
    ``whole_from`` or more pages as hosts, the pages of others as addresses."""
    host, path = host_and_path(F.col("url"))
    named = f"(^|[.-])({'|'.join(words)})([.-]|$)"
    bad = only(pages, "url").select(host.alias("host"), path.alias("path"))
    bad = bad.where(F.rlike("host", F.lit(named)))
    # One row an address before hosts meet.
    addresses = bad.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"))
    whole = addresses.groupBy("host").agg(F.sum("n").alias("n")).where(F.col("n") >= whole_from)
    whole = whole.select("host")
    rest = addresses.join(whole, "host", "left_anti").select(F.concat("host", "path").alias("entry"))
    return whole.select(F.col("host").alias("entry")).unionByName(rest)
