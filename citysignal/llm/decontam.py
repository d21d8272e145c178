"""Benchmark decontamination with a generalised suffix automaton over words.

The normalised words of all test items go into one automaton. A document's words are
streamed through it, keeping the state and the length of the longest match that ends at
each word; matches never run across two items. A match as long as the window marks its
last window's words; an item shorter than the window counts when all of it matches.
Spans of marked words are removed from the text; a document of which more than
``max_coverage`` of the words are marked is dropped.

Items are taken in blocks of at most ``BLOCK_WORDS`` words, one automaton each, which is
what bounds the broadcast; every block runs over all documents in the same pass unless
there are more than one, in which case results are combined by row. Words outside a
block's vocabulary end any match, so only runs of known words are walked.

Null or empty texts have no words: nothing hit, text kept as it is. Null items and items
without words are skipped. Repeated items give one entry per id. An empty benchmark hits
nothing. Rows keep all their columns; nothing is keyed by id, so ids may repeat or be null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citysignal.llm.common import byte_table, only, restored, shielded

WINDOW = 10
BLOCK_WORDS = 2_000_000
MAX_COVERAGE = 0.5


class Automaton:
    """Suffix automaton of word sequences; ``owners`` maps states to the items they prove."""

    def __init__(self, window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.whole: dict[int, set] = {}
        self.owners: dict[int, set] = {}
        self.shortest = window
        # The longest short item that a state's strings end with, as its state.
        self.short_above: dict[int, int] = {}

    def _extend(self, last: int, word: int) -> int:
        following = self.next[last].get(word)
        if following is not None:
            if self.length[following] == self.length[last] + 1:
                return following
            return self._split(last, word, following)
        state = self._new(self.length[last] + 1, {})
        at = last
        while at != -1 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at == -1:
            self.link[state] = 0
        else:
            following = self.next[at][word]
            if self.length[following] == self.length[at] + 1:
                self.link[state] = following
            else:
                self.link[state] = self._split(at, word, following)
        return state

    def _new(self, length: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(0)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, at: int, word: int, following: int) -> int:
        """A state of its own for the shorter strings of ``following``."""
        clone = self._new(self.length[at] + 1, dict(self.next[following]))
        self.link[clone] = self.link[following]
        self.link[following] = clone
        while at != -1 and self.next[at].get(word) == following:
            self.next[at][word] = clone
            at = self.link[at]
        return clone

    def fit(self, items: list[tuple[object, list[int]]]) -> Automaton:
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        for item, words in items:
            if len(words) < self.window:
                state = self._walk(words)
                self.whole.setdefault(state, set()).add(item)
                self.shortest = min(self.shortest, len(words))
            else:
                for state in self._windows(words):
                    self.owners.setdefault(state, set()).add(item)
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            above = state if state in self.whole else self.short_above.get(self.link[state])
            if above is not None:
                self.short_above[state] = above
        return self

    def _walk(self, words: list[int]) -> int:
        state = 0
        for word in words:
            state = self.next[state][word]
        return state

    def _windows(self, words: list[int]) -> Iterator[int]:
        for _, state, length in self.matches(words):
            if length >= self.window:
                yield self.of_window(state)

    def of_window(self, state: int) -> int:
        """The state of the last ``window`` words of a match that ends in ``state``."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def matches(self, words: list[int]) -> Iterator[tuple[int, int, int]]:
        """(position, state, length of the longest match that ends there); 0 is no word."""
        state = length = 0
        for position, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            following = self.next[state].get(word)
            if following is None:
                state = length = 0
            else:
                state, length = following, length + 1
            yield position, state, length


class Matcher:
    """One block's automaton with its vocabulary; what tasks get."""

    def __init__(self, items: list[tuple[object, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        number = lambda w: self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
        split = [(item, [number(w) for w in words.split()]) for item, words in items]
        split = [(item, words) for item, words in split if words]
        self.automaton = Automaton(window).fit(split)
        self.window = window

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set, int]:
        """Merged spans of hit words (end exclusive), items proven, longest match."""
        automaton, window = self.automaton, self.window
        ids = list(map(self.vocabulary.get, words))
        spans: list[tuple[int, int]] = []
        items: set = set()
        longest, total, start = 0, len(ids), 0
        while start < total:
            if ids[start] is None:
                start += 1
                continue
            # A match of the shortest kind has known words only: look at its last word first.
            end = start + automaton.shortest - 1
            if end >= total:
                break
            if ids[end] is None:
                start = end + 1
                continue
            end = start
            while end < total and ids[end] is not None:
                end += 1
            if end - start >= automaton.shortest:
                for position, state, length in automaton.matches(ids[start:end]):
                    longest = max(longest, length)
                    at = start + position + 1
                    if length >= window:
                        spans.append((at - window, at))
                        items |= automaton.owners[automaton.of_window(state)]
                    # Short items end here as well: the state's own, if all of it matched, and
                    # all that are suffixes of it.
                    short = automaton.short_above.get(state) if length else None
                    while short is not None:
                        if automaton.length[short] <= length:
                            spans.append((at - automaton.length[short], at))
                            items |= automaton.whole[short]
                        short = automaton.short_above.get(automaton.link[short])
            start = end
        return merged(spans), items, longest


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def normalised(text: str | None) -> bytes:
    """Lower-case ASCII letters, everything that is not of a word as a space; same offsets."""
    return (text or "").encode().translate(byte_table("letters and digits"))


def matchers(benchmark: DataFrame, window: int = WINDOW) -> list:
    """Broadcast automatons, one a block of items. Items stream to the driver, block by block."""
    spark, block, size, out = benchmark.sparkSession, [], 0, []

    def close():
        if block:
            out.append(spark.sparkContext.broadcast(Matcher(list(block), window)))
            block.clear()

    for row in only(benchmark, "item_id", "text").toLocalIterator():
        words = normalised(row.text)
        block.append((row.item_id, words))
        size += words.count(b" ") + 1
        if size > BLOCK_WORDS:
            close()
            size = 0
    close()
    return out


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of ``spans`` and what stands between them."""
    raw = text.encode()
    flat = raw.translate(byte_table("letters and digits"))
    at, bounds = 0, []
    for word in flat.split():
        at = flat.index(word, at)
        bounds.append((at, at + len(word)))
        at += len(word)
    out, last = [], 0
    for start, end in spans:
        out.append(raw[last : bounds[start][0]])
        last = bounds[end - 1][1]
    return b"".join([*out, raw[last:]]).decode()


FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("n_items", T.LongType()),
        T.StructField("items_sha256", T.StringType()),
        T.StructField("longest", T.LongType()),
        T.StructField("cleaned", T.StringType()),
    ]
)


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, clean: bool = False) -> DataFrame:
    """All columns of ``docs`` and a struct ``found``; ``clean`` fills in the cleaned text."""
    blocks = matchers(benchmark, window)

    @F.pandas_udf(FOUND)
    def find(texts):
        import pandas as pd

        rows = []
        for text in texts:
            words = normalised(text).split()
            spans, items, longest = [], set(), 0
            for block in blocks:
                more, proven, length = block.value.hits(words)
                spans += more
                items |= proven
                longest = max(longest, length)
            spans = merged(spans)
            listed = ",".join(sorted(str(item) for item in items))
            cut = without(text, spans) if clean and spans else None
            rows.append(
                (
                    len(words),
                    sum(end - start for start, end in spans),
                    len(items),
                    hashlib.sha256(listed.encode()).hexdigest(),
                    longest,
                    cut,
                )
            )
        return pd.DataFrame(rows, columns=FOUND.fieldNames())

    return docs.withColumn("found", find(F.col("text").cast("string")))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE
) -> DataFrame:
    """``docs`` with hit spans cut out of the texts; mostly hit documents are dropped."""
    found = scan(shielded(docs, "text"), benchmark, window, clean=True)
    found = found.where(F.col("found.n_hit") <= max_coverage * F.col("found.n_words"))
    return restored(found, docs.columns, F.coalesce("found.cleaned", "text"))
