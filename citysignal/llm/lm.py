"""LM scoring with a hierarchical Pitman-Yor model of word pairs.

Every word that occurs is the context of a restaurant whose customers are the words that
follow it. All context restaurants share one parent, the restaurant of single words: each
table in a context sends one customer there. The parent's own tables are served by an even
law over the V words seen in training and one unknown. Seating is sampled by Gibbs
(``restaurants``), in blocks of one dish of one restaurant; predictive probabilities are
averaged over ``SAMPLES`` states after ``BURN_IN``. Pairs are the longest context:
with three words, most restaurants of this kind of corpus have a single customer, and the
model would hold more rows than the corpus has words.

How the work is dealt out:

1. A first pass counts tokens and finds contexts with a large share of them, and common words,
   which are sent by number from then on.
2. Each task counts its pairs and sends them, packed, to the part that owns the context.
   Heavy contexts are spread over several parts by the following word. Parts seat their
   customers; the tables per word go to the owners of the words.
3. Word owners sum counts and customers, seat them in the parent, and answer the parts that
   asked. Driver and tasks exchange only totals and sums of heavy contexts.
4. Pairs with their documents go to the same parts, which find their seating again by the pairs' order,
   sample on with the parent's probabilities, score every pair and send one sum a document, packed by
   blocks of documents.

Packed rows hold numpy arrays; a part holds about ``PART_TOKENS`` tokens at any size of
the input, and sampling is seeded by part, so a lost task draws the same again. The parent is
fixed while parts sample, an approximation that parallel samplers make.

Null texts are empty ones: one token, the end. Repeated rows and null ids keep their rows
(a row has a number of its own). Without training rows the model is the even law. Columns
other than id and text are not read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citysignal.llm import blocks, restaurants
from citysignal.llm.common import fold, only, written

STRENGTH, DISCOUNT = 1.0, 0.8
ROOT_STRENGTH, ROOT_DISCOUNT = 1.0, 0.7
BURN_IN, SAMPLES = 1, 3
FIRST_SWEEPS = 2
PART_TOKENS = 2_000_000
FLUSH_TOKENS = 1_000_000
HEAVY = 0.25  # of a part
COMMON = 65_536
BLOCK = 12  # rows whose numbers differ in so many low bits are summed up together
SEED = 29
START, END = np.uint64(0x5354415254), np.uint64(0x454E44)
PACKED = "part int, kind int, body binary"


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes, each array's bytes put in planes, which compresses sorted numbers."""
    import pyarrow as pa

    out = []
    for a in arrays:
        planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T)
        body = pa.compress(planes.tobytes(), codec="zstd", asbytes=True) if len(a) else b""
        head = np.array([len(body), len(a)], np.int64).tobytes()
        out.append(head + a.dtype.str.encode().ljust(8) + body)
    return b"".join(out)


def unpack(body: bytes, first: int = 0, last: int | None = None) -> list[np.ndarray]:
    """The arrays of a packed body, or those from ``first`` up to ``last`` alone."""
    import pyarrow as pa

    out, at, number, view = [], 0, 0, memoryview(body)
    while at < len(body) and (last is None or number < last):
        size, count = np.frombuffer(body, np.int64, 2, at).tolist()
        if number >= first:
            kind = np.dtype(body[at + 16 : at + 24].decode().strip())
            raw = np.zeros(0, np.uint8)
            if count:
                packed = pa.py_buffer(view[at + 24 : at + 24 + size])
                raw = np.frombuffer(pa.decompress(packed, count * kind.itemsize, codec="zstd"), np.uint8)
            out.append(np.ascontiguousarray(raw.reshape(kind.itemsize, count).T).view(kind).reshape(count))
        at, number = at + 24 + size, number + 1
    return out


def ordered(keys: np.ndarray, width: int = 64) -> np.ndarray:
    """Where unsigned keys below ``2**width`` go when they are sorted, equal ones as they stand.

    Values with their places in the low bits are sorted, which is faster than to sort places; where
    keys differ in those bits alone, places are sorted after all.
    """
    places = len(keys).bit_length()
    low = np.uint64((1 << places) - 1)
    packed = keys << np.uint64(64 - width) & ~low | np.arange(len(keys), dtype=np.uint64)
    packed.sort()
    order = (packed & low).astype(np.int64)
    if width + places > 64:
        found = keys[order]
        if (found[1:] < found[:-1]).any():
            return np.argsort(keys, kind="stable")
    return order


def ranked(keys: np.ndarray, width: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, rising, and the number of each key among them."""
    order = ordered(keys, width)
    found = keys[order]
    fresh = np.append(True, found[1:] != found[:-1])[: len(keys)]
    where = np.empty(len(keys), np.int64)
    where[order] = np.cumsum(fresh) - 1
    return found[fresh], where


def rising(a: np.ndarray) -> np.ndarray:
    """Differences of a sorted array, the first value in front."""
    return np.diff(a, prepend=np.zeros(1, a.dtype))


def tokens(batch):
    """(first row, tokens a row, contexts, tokens, row of each) by slice."""
    for first, data, offsets in blocks.slices(batch.column("text")):
        h, counts = blocks.hashed_words(data, offsets)
        rows = len(counts)
        ends = np.cumsum(counts + 1)
        token = np.empty(ends[-1], np.uint64)
        is_end = np.zeros(ends[-1], bool)
        is_end[ends - 1] = True
        token[is_end] = END
        token[~is_end] = h
        context = np.empty_like(token)
        context[1:] = token[:-1]
        context[0] = START
        context[ends[:-1]] = START
        yield first, counts + 1, context, token, np.repeat(np.arange(rows), counts + 1)


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    own, where = ranked(keys)
    return own, np.bincount(where, values, len(own)).astype(np.int64)


class Shares:
    """Which part owns a pair: by context; contexts with a large share by their followers too.

    ``common`` are words, rising, that are sent by their number in it; which ones changes no result.
    """

    def __init__(self, parts: int, heavy: dict[int, int], common: np.ndarray):
        self.parts, self.common = parts, common
        self.heavy = np.array(sorted(heavy), np.uint64)
        self.spread = np.array([heavy[int(h)] for h in self.heavy], np.uint64)

    def spread_of(self, context: np.ndarray) -> np.ndarray:
        if not len(self.heavy):
            return np.ones(len(context), np.uint64)
        at = np.minimum(np.searchsorted(self.heavy, context), len(self.heavy) - 1)
        return np.where(self.heavy[at] == context, self.spread[at], np.uint64(1))

    def of(self, context: np.ndarray, token: np.ndarray) -> np.ndarray:
        salt = (blocks.mixed(token) >> np.uint64(20)) % self.spread_of(context)
        return ((blocks.mixed(context) + salt) % np.uint64(self.parts)).astype(np.int64)

    def numbers(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each name's number among the common words, and whether it is one."""
        if not len(self.common):
            return np.zeros(len(names), np.int32), np.zeros(len(names), bool)
        at = np.minimum(np.searchsorted(self.common, names), len(self.common) - 1)
        return at.astype(np.int32), self.common[at] == names

    def pairs(self, body: bytes) -> tuple:
        """Names, and the numbers in them of the contexts and of the tokens."""
        known, names, a, b = unpack(body, 0, 4)
        names = np.concatenate([self.common[np.cumsum(known)], np.cumsum(names)])
        return names, np.cumsum(a), b

    def of_word(self, word: np.ndarray) -> np.ndarray:
        return (blocks.mixed(word ^ np.uint64(blocks.BASE)) % np.uint64(self.parts)).astype(np.int64)


def first_pass(rows: DataFrame) -> Shares:
    """Parts, heavy contexts and common words. Tasks send contexts with a thousandth of their tokens,
    and the words they meet most among the first ones."""

    def count(batches):
        total, held, heavy, met = 0, {}, {}, [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        for batch in batches:
            for _, _, context, _, _ in tokens(batch):
                own, n = np.unique(context, return_counts=True)
                if total < FLUSH_TOKENS:
                    met.append((own, n))
                total += len(context)
                large = n * 1000 >= len(context)
                for h, x in zip(own[large].tolist(), n[large].tolist(), strict=True):
                    held[h] = held.get(h, 0) + x
        heavy = {h: n for h, n in held.items() if n * 1000 >= total}
        names = np.array(list(heavy), np.uint64).view(np.int64)
        yield batch_of(0, [None, *names.tolist()], [total, *heavy.values()])
        words, n = summed(*map(np.concatenate, zip(*met, strict=True)))
        most = np.argsort(-n, kind="stable")[: COMMON // 4]
        most = most[n[most] > 1]
        yield batch_of(1, words[most].view(np.int64), n[most])

    def batch_of(kind, h, n):
        import pyarrow as pa

        whole = {"kind": pa.array([kind] * len(h), pa.int32()), "h": pa.array(h, pa.int64()), "n": pa.array(n, pa.int64())}
        return pa.RecordBatch.from_pydict(whole)

    counted = rows.select("text").mapInArrow(count, "kind int, h bigint, n bigint")
    counted = written(counted.groupBy("kind", "h").agg(F.sum("n").alias("n")), "lm-counts")
    total = counted.where("kind = 0 and h is null").first()
    parts = max(2, math.ceil((total.n if total else 0) / PART_TOKENS))
    least = HEAVY * (total.n if total else 0) / parts
    large = counted.where("kind = 0 and h is not null").where(F.col("n") > least).collect()
    spread = {r.h % (1 << 64): min(parts, math.ceil(r.n / least)) for r in large}
    common = counted.where("kind = 1").orderBy(F.desc("n"), "h").limit(COMMON).select("h").collect()
    words = np.sort(np.array([r.h for r in common], np.int64).view(np.uint64))
    return Shares(parts, {h: s for h, s in spread.items() if s > 1}, words)


def pairs_by_part(rows: DataFrame, shares: Shares, with_rows: bool) -> DataFrame:
    """Packed pairs by part. Without rows: (contexts, tokens, training count) of distinct pairs;
    with rows: (contexts, tokens, row, count) of distinct pairs of a row."""
    shared = rows.sparkSession.sparkContext.broadcast(shares)

    def send(batches):
        import pyarrow as pa

        held: list[tuple] = []

        def flush():
            token, row, n = (np.concatenate(c) for c in zip(*held, strict=True))
            held.clear()
            names, where = ranked(np.append(token, START))
            # Common words get the first numbers, so that they need no name.
            number, is_common = shared.value.numbers(names)
            order = np.argsort(~is_common, kind="stable")
            names, number, common = names[order], number[order], int(is_common.sum())
            place = np.empty(len(order), np.uint64)
            place[order] = np.arange(len(order), dtype=np.uint64)
            where = place[where]
            # A context is the token before, the start in front of a row.
            word, context = where[:-1], np.append(where[-1], where[:-2])
            context[1:][row[1:] != row[:-1]] = where[-1]
            if len(shared.value.heavy):
                part = shared.value.of(names[context], token)
            else:
                part = shared.value.of(names, names)[context]
            bits = len(names).bit_length()
            shift, low = np.uint64(bits), np.uint64((1 << bits) - 1)
            key = context << shift | word
            del token, where, word, context
            by_part = ordered(part.astype(np.uint64), shared.value.parts.bit_length())
            part = part[by_part]
            bounds = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            out, rank = [], np.empty(len(names), np.int32)
            for i, j in zip(bounds.tolist(), [*bounds[1:].tolist(), len(part)], strict=True):
                # A row's tokens lie together, and the sort keeps their order.
                own = by_part[i:j]
                own = own[ordered(key[own], 2 * bits)]
                pair, owner = key[own], row[own]
                fresh = np.append(True, (pair[1:] != pair[:-1]) | (with_rows & (owner[1:] != owner[:-1])))
                at = np.flatnonzero(fresh)
                times = np.add.reduceat(n[own], at).astype(np.int32)
                a, b = (pair[at] >> shift).astype(np.int64), (pair[at] & low).astype(np.int64)
                if len(names) < 16 * len(at):
                    used = np.zeros(len(names), bool)
                    used[a] = used[b] = True
                    met = np.flatnonzero(used)
                else:
                    met = np.unique(np.concatenate([a, b]))
                rank[met] = np.arange(len(met), dtype=np.int32)
                split = int(np.searchsorted(met, common))
                body = [rising(number[met[:split]]), rising(names[met[split:]]), rising(rank[a]), rank[b]]
                body += [owner[at], times] if with_rows else [times]
                out.append((int(part[i]), 2 if with_rows else 0, pack(*body)))
            columns = list(zip(*out, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.binary())],
                ["part", "kind", "body"],
            )

        size = 0
        for batch in batches:
            number = batch.column("row").to_numpy()
            train = ~np.asarray(batch.column("held_out").to_numpy(zero_copy_only=False), bool)
            for first, _, _, token, row in tokens(batch):
                n = train[first + row].astype(np.int64) if not with_rows else np.ones(len(row), np.int64)
                # Packed by whole slices: pairs of a slice are summed when it is flushed.
                held.append((token, number[first + row], n))
                size += len(token)
                if size >= FLUSH_TOKENS:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return rows.select("row", "held_out", "text").mapInArrow(send, PACKED)


class Part:
    """The distinct pairs of a part, sorted by context and token, and their seating.

    The pairs are those of the packed bodies, of either kind: both passes make the same list of them,
    so that counts and tables of the first go to the second without the pairs. Of bodies with rows,
    ``spots`` has which pair each entry is.
    """

    def __init__(self, bodies: list[bytes], shares: Shares, counted: bool):
        found = [shares.pairs(body) for body in bodies]
        sizes = [len(names) for names, _, _ in found]
        every, to = ranked(np.concatenate([names for names, _, _ in found]))
        contexts, words, fresh = [], [], []
        for (_, a, b), begin, size in zip(found, np.cumsum([0, *sizes]).tolist(), sizes, strict=False):
            if not counted:
                fresh.append(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
                a, b = a[fresh[-1]], b[fresh[-1]]
            contexts.append(to[begin : begin + size][a])
            words.append(to[begin : begin + size][b])
        del found
        c, w = np.concatenate(contexts), np.concatenate(words)
        is_context, is_word = np.zeros(len(every), bool), np.zeros(len(every), bool)
        is_context[c] = is_word[w] = True
        self.contexts, self.words = every[is_context], every[is_word]
        bits = len(every).bit_length()
        shift, low = np.uint64(bits), np.uint64((1 << bits) - 1)
        c, w = (np.cumsum(is_context) - 1)[c].astype(np.uint64), (np.cumsum(is_word) - 1)[w].astype(np.uint64)
        pair = c << shift | w
        del c, w, contexts, to
        order = ordered(pair, 2 * bits)
        pair = pair[order]
        new = np.append(True, pair[1:] != pair[:-1])
        at = np.flatnonzero(new)
        pair = pair[at]
        self.c, self.w = (pair >> shift).astype(np.int64), (pair & low).astype(np.int64)
        if counted:
            n = np.concatenate([unpack(body, 4, 5)[0] for body in bodies])[order]
            n = np.add.reduceat(n, at).astype(np.int64)
            self.seat(n, n > 0)
        else:
            place = np.empty(len(order), np.int32)
            place[order] = (np.cumsum(new) - 1).astype(np.int32)
            ends = np.cumsum([len(x) for x in words]).tolist()
            self.spots = [
                place[end - len(x) : end][np.cumsum(f) - 1] for end, x, f in zip(ends, words, fresh, strict=True)
            ]

    def seat(self, n: np.ndarray, tables: np.ndarray) -> None:
        self.n, self.tables = n.astype(np.int64), tables.astype(np.int64)
        self.customers = np.bincount(self.c, n, len(self.contexts))
        self.movable = np.flatnonzero(n > 1)

    def key(self) -> np.ndarray:
        return blocks.mixed(self.contexts[self.c] * np.uint64(blocks.BASE) + self.words[self.w])

    def sweep(self, p: np.ndarray, factor: np.ndarray, rng) -> np.ndarray:
        """Draws the tables of all pairs; returns tables by context. ``p``: the parent's
        probability by word; ``factor``: how many times its own tables a context has in all."""
        total = np.bincount(self.c, self.tables, len(self.contexts)) * factor
        m = self.movable
        others = np.maximum(total[self.c[m]] - self.tables[m], 0.0)
        self.tables[m] = restaurants.draw_tables(
            self.n[m], p[self.w[m]], others, STRENGTH, DISCOUNT, rng
        )
        return np.bincount(self.c, self.tables, len(self.contexts))

    def by_word(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.w, values, len(self.words)).astype(np.int64)


def by_owner(owner: np.ndarray):
    """Each owner of words, rising, and where its words are, in order."""
    order = np.argsort(owner, kind="stable")
    bounds = np.flatnonzero(np.append(True, owner[order][1:] != owner[order][:-1]))
    for i, j in zip(bounds.tolist(), [*bounds[1:].tolist(), len(owner)], strict=True):
        yield int(owner[order[i]]), order[i:j]


def seat_parts(packed: DataFrame, shares: Shares) -> DataFrame:
    """The parts' counts and tables (kind 1), their words for the word owners (kind 3) and the sums of
    heavy contexts (kind 4), packed."""
    shared = packed.sparkSession.sparkContext.broadcast(shares)

    def seat(table):
        import pyarrow as pa

        own = table.column("part")[0].as_py()
        part, rng = Part(table.column("body").to_pylist(), shared.value, True), np.random.default_rng([SEED, own])
        spread = shared.value.spread_of(part.contexts)
        for _ in range(FIRST_SWEEPS):
            served = part.by_word(part.tables) + 1.0 / len(part.words)
            totals = part.sweep(served / served.sum(), spread.astype(float), rng)
        out = [(own, 1, pack(part.n.astype(np.int32), part.tables.astype(np.int32)))]
        count, tables = part.by_word(part.n), part.by_word(part.tables)
        for o, at in by_owner(shared.value.of_word(part.words)):
            body = pack(np.array([own], np.int64), rising(part.words[at]), count[at].astype(np.int32), tables[at].astype(np.int32))
            out.append((o, 3, body))
        large = spread > 1
        if large.any():
            out.append((own, 4, pack(part.contexts[large], part.customers[large].astype(np.int64), totals[large].astype(np.int64))))
        return pa.table({"part": pa.array([o[0] for o in out], pa.int32()), "kind": pa.array([o[1] for o in out], pa.int32()), "body": pa.array([o[2] for o in out], pa.binary())})

    return packed.groupBy("part").applyInArrow(seat, PACKED)


def sums(seated: DataFrame) -> dict[int, tuple[int, int]]:
    """Customers and tables of heavy contexts: their number is bounded by that of parts."""
    found: dict[int, tuple[int, int]] = {}
    for row in seated.where("kind = 4").select("body").toLocalIterator():
        for h, n, t in zip(*(a.tolist() for a in unpack(bytes(row.body))), strict=True):
            a, b = found.get(h, (0, 0))
            found[h] = (a + n, b + t)
    return found


def word_owners(seated: DataFrame) -> DataFrame:
    """For each asking part, in the order of the words it asked for: training counts, customers and
    tables in the parent (kind 5); totals of each owner's words (kind 6): N, V, customers, tables."""

    def own(table):
        import pyarrow as pa

        owner = table.column("part")[0].as_py()
        asked = []
        for body in table.column("body").to_pylist():
            part, words, n, t = unpack(body)
            asked.append((int(part[0]), np.cumsum(words), n.astype(np.int64), t.astype(np.int64)))
        all_words = np.concatenate([a[1] for a in asked])
        words, count = summed(all_words, np.concatenate([a[2] for a in asked]))
        _, customers = summed(all_words, np.concatenate([a[3] for a in asked]))
        tables = (customers > 0).astype(np.int64)
        several = np.flatnonzero(customers > 1)
        rng, total = np.random.default_rng([SEED, 1, owner]), np.zeros(len(words))
        # The even law's share of a word: the owner knows its own words, an even part of all.
        even = np.full(len(several), 1.0 / (1 + len(words)))
        for i in range(BURN_IN + SAMPLES):
            others = np.maximum(tables.sum() - tables[several], 0).astype(float)
            tables[several] = restaurants.draw_tables(
                customers[several], even, others, ROOT_STRENGTH, ROOT_DISCOUNT, rng
            )
            if i >= BURN_IN:
                total += tables
        mean = total / SAMPLES
        whole = np.array([count.sum(), (count > 0).sum(), customers.sum()], np.int64)
        out = [(0, 6, pack(whole, np.array([mean.sum()])))]
        for part, mine, _, _ in asked:
            at = np.searchsorted(words, mine)
            out.append((part, 5, pack(np.array([owner], np.int64), count[at], customers[at], mean[at].astype(np.float32))))
        return pa.table({"part": pa.array([o[0] for o in out], pa.int32()), "kind": pa.array([o[1] for o in out], pa.int32()), "body": pa.array([o[2] for o in out], pa.binary())})

    return seated.where("kind = 3").groupBy("part").applyInArrow(own, PACKED)


def totals_of(answers: DataFrame) -> tuple[int, int, int, float]:
    """N, V, customers and tables of the parent."""
    whole = np.zeros(4)
    for row in answers.where("kind = 6").select("body").toLocalIterator():
        counts, tables = unpack(bytes(row.body))
        whole += [*counts.tolist(), float(tables[0])]
    return int(whole[0]), int(whole[1]), int(whole[2]), float(whole[3])


def scored_parts(packed: DataFrame, totals, heavy: dict, shares: Shares) -> DataFrame:
    """What each part's pairs add to rows: score, base score and known tokens, packed by blocks of rows."""
    shared = packed.sparkSession.sparkContext.broadcast((totals, heavy, shares))

    def score(table):
        import pyarrow as pa

        (tokens_all, distinct, customers, tables), large, where = shared.value
        own = table.column("part")[0].as_py()
        by_kind: dict[int, list[bytes]] = {1: [], 2: [], 5: []}
        for kind, body in zip(table.column("kind").to_pylist(), table.column("body").to_pylist(), strict=True):
            by_kind[kind].append(body)
        part = Part(by_kind[2], where, False)
        part.seat(*unpack(by_kind[1][0]))
        answers = {int(a[0][0]): a[1:] for a in map(unpack, by_kind[5])}
        count, served, mean = np.zeros(len(part.words), np.int64), np.zeros(len(part.words), np.int64), np.zeros(len(part.words), np.float32)
        for o, at in by_owner(where.of_word(part.words)):
            count[at], served[at], mean[at] = answers[o]
        even = 1.0 / (distinct + 1)
        p = np.maximum(served - ROOT_DISCOUNT * mean, 0.0)
        p = (p + (ROOT_STRENGTH + ROOT_DISCOUNT * tables) * even) / (ROOT_STRENGTH + customers)
        spread = where.spread_of(part.contexts).astype(float)
        rng = np.random.default_rng([SEED, 2, own])
        mean_tables, mean_total = np.zeros(len(part.n)), np.zeros(len(part.contexts))
        for i in range(BURN_IN + SAMPLES):
            totals_now = part.sweep(p, spread, rng)
            if i >= BURN_IN:
                mean_tables += part.tables / SAMPLES
                mean_total += totals_now / SAMPLES
        all_customers = part.customers.copy()
        for i in np.flatnonzero(spread > 1).tolist():
            all_customers[i], mean_total[i] = large[int(part.contexts[i])]
        seated = STRENGTH + all_customers[part.c]
        predicted = np.maximum(part.n - DISCOUNT * mean_tables, 0.0)
        predicted = (predicted + (STRENGTH + DISCOUNT * mean_total[part.c]) * p[part.w]) / seated
        value = np.log10(predicted)
        base = np.log10((count[part.w] + 1.0) / (tokens_all + 1.0 * (distinct + 1)))
        known = count[part.w] > 0
        sums_by: list[tuple] = []
        for body, at in zip(by_kind[2], part.spots, strict=True):
            row, times = unpack(body, 4)
            rows, inverse = ranked(row.astype(np.uint64), int(row.max()).bit_length() or 1)
            rows = rows.astype(np.int64)
            weigh = lambda x: np.bincount(inverse, x[at] * times, len(rows))  # noqa: B023, E731
            sums_by.append((rows, weigh(value), weigh(base), weigh(known)))
        blocks_of: dict[str, list] = {"block": [], "body": []}
        if sums_by:
            every = np.concatenate([x[0] for x in sums_by])
            rows, where_to = ranked(every.astype(np.uint64), int(every.max()).bit_length() or 1)
            rows = rows.astype(np.int64)
            value, base, known = (
                np.bincount(where_to, np.concatenate([x[k] for x in sums_by]), len(rows)) for k in (1, 2, 3)
            )
            bounds = np.flatnonzero(np.append(True, np.diff(rows >> BLOCK) > 0))
            for i, j in zip(bounds.tolist(), [*bounds[1:].tolist(), len(rows)], strict=True):
                blocks_of["block"].append(int(rows[i] >> BLOCK))
                blocks_of["body"].append(pack(rising(rows[i:j]), value[i:j], base[i:j], known[i:j].astype(np.int32)))
        return pa.table({"block": pa.array(blocks_of["block"], pa.int64()), "body": pa.array(blocks_of["body"], pa.binary())})

    return packed.groupBy("part").applyInArrow(score, "block bigint, body binary")


def summed_rows(scored: DataFrame) -> DataFrame:
    """Each row's sums over all parts."""

    def total(table):
        import pyarrow as pa

        bodies = [unpack(body) for body in table.column("body").to_pylist()]
        rows, where = np.unique(np.concatenate([np.cumsum(b[0]) for b in bodies]), return_inverse=True)
        value, base, known = (
            np.bincount(where, np.concatenate([b[k] for b in bodies]), len(rows)) for k in (1, 2, 3)
        )
        return pa.table({"row": rows, "score": value, "base_score": base, "n_known": known.astype(np.int64)})

    return scored.groupBy("block").applyInArrow(total, "row bigint, score double, base_score double, n_known bigint")


def numbered(docs: DataFrame, held_out: Column) -> DataFrame:
    """Rows with a number of their own; equal in every run over the same files."""
    return only(docs, "doc_id", "text").select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        held_out.alias("held_out"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def sizes(rows: DataFrame) -> DataFrame:
    """row, doc_id, held_out and n_tokens (words and the end)."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def count(batches):
        import pyarrow as pa

        for batch in batches:
            n = np.zeros(len(batch), np.int64)
            for first, data, offsets in blocks.slices(batch.column("text")):
                counts = blocks.word_counts(data, offsets)
                n[first : first + len(counts)] = counts + 1
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("row", "doc_id", "held_out")), pa.array(n)],
                ["row", "doc_id", "held_out", "n_tokens"],
            )

    return rows.mapInArrow(count, f"row bigint, doc_id {kind}, held_out boolean, n_tokens bigint")


def score(docs: DataFrame, held_out: Column | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row."""
    rows = numbered(docs, fold("doc_id", 7) == 2 if held_out is None else held_out)
    shares = first_pass(rows)
    seated = written(seat_parts(pairs_by_part(rows, shares, False), shares), "lm-seats")
    answers = written(word_owners(seated), "lm-words")
    totals = totals_of(answers)
    packed = (
        pairs_by_part(rows, shares, True)
        .unionByName(seated.where("kind = 1"))
        .unionByName(answers.where("kind = 5"))
    )
    summed_up = summed_rows(scored_parts(packed, totals, sums(seated), shares))
    return sizes(rows).join(summed_up, "row").select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(totals[0]).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def perplexity(scored: DataFrame) -> DataFrame:
    """Perplexity by fold, of the model and of the base."""
    tokens_all = F.sum("n_tokens")
    return scored.groupBy("held_out").agg(
        tokens_all.alias("n_tokens"),
        F.pow(F.lit(10.0), -F.sum("score") / tokens_all).alias("perplexity"),
        F.pow(F.lit(10.0), -F.sum("base_score") / tokens_all).alias("base_perplexity"),
    )
