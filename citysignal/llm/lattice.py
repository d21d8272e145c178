"""SentencePiece sampling: Gumbel top-k without replacement over a text's lattice.

The lattice has an edge for every piece of the vocabulary that matches, and one for the
UTF-8 bytes of each character that no single piece covers. A piece's weight is a Zipf law
of its rank in the model file, to the power ``alpha``: a model of merges stores ranks, not
probabilities. A segmentation's probability is the product of its weights over the sum for
all segmentations.

Sampling is a search, best first, over sets of segmentations that share a prefix. Each set
carries the largest perturbed log probability among its members: the maximum goes down to
one member, and the siblings left at every step get a Gumbel variable cut off there. Popping
the k best sets gives k distinct segmentations in order, distributed as k draws without
replacement. The k+1-th value is the threshold from which inclusion scores follow:
log(1 - exp(-exp(log_prob - threshold))).

Pieces never run over a boundary between a character and a following space mark or over a
line end, so the sum over the lattice is a product over chunks, each kept in a bounded memo of
its worker, which forgets what is rare when it is full; a document is walked as arrays over its chunks, whole, at any length. Chunks new to
the memo, and the searches and draws of many texts, are worked on side by side as arrays. The random
numbers are seeded by the row's key: repeated rows are sampled alike, null keys share
a seed. Null and empty texts have one segmentation, the empty one. Texts with fewer than k
segmentations give all of them.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import math

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citysignal.llm.common import only

SAMPLES = 2
ALPHA = 2.0
SEED = 17
MEMO = 400_000
EDGES = 20_000
# Characters of chunks that are worked on side by side; longer ones go one by one.
SHORT = 24
SLICE = 8192
# Characters of texts searched together.
TOGETHER = 800_000
CODES = 0x110000
# Edges without a piece of their own.
NOTHING, BYTES = -1, -2
# Below this, sums are not trusted.
LEAST = 1e-280
# Choices that leave less than this are worked out from what they leave.
CERTAIN = 1e-10
MARK = "▁"
STOPS = ".,;:!?"
_MODELS: dict[tuple[str, float], Lattice] = {}


class Lattice:
    """A model's pieces with weights, and memos of chunks."""

    def __init__(self, path: str, alpha: float):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        self.trie: dict = {}
        self.bytes_of: dict[int, int] = {}
        self.pieces = [p.piece for p in model.pieces]
        self.dummy_prefix = model.normalizer_spec.add_dummy_prefix
        ranks = [i for i, p in enumerate(model.pieces) if p.type == 1]
        total = sum((n + 3.0) ** -1.0 for n in range(len(ranks)))
        weight = lambda n: ((n + 3.0) ** -1.0 / total) ** alpha
        self.byte_weight = weight(len(ranks))
        for n, i in enumerate(ranks):
            at = self.trie
            for c in self.pieces[i]:
                at = at.setdefault(c, {})
            at[""] = (i, weight(n))
        self._lay_out(ranks, weight)
        self.longest = max((len(self.pieces[i]) for i in ranks), default=1)
        for i, p in enumerate(model.pieces):
            if p.type == 6:
                self.bytes_of[int(p.piece[1:-1], 16)] = i
        self.byte_value = {i: b for b, i in self.bytes_of.items()}
        # What each id is in a text, then the same for ids that begin one.
        inside = [
            bytes([self.byte_value[i]]) if i in self.byte_value else p.replace(MARK, " ").encode()
            for i, p in enumerate(self.pieces)
        ]
        self.spellings = inside + [x.removeprefix(b" ") if self.dummy_prefix else x for x in inside]
        used = [self.pieces[i] for i in ranks]
        if any("\n" in p or MARK in p.lstrip(MARK) for p in used):
            raise ValueError("pieces run over chunk boundaries")
        # Marks that no piece joins to a letter in front of them end a chunk as well.
        joined = {b for p in used for a, b in zip(p, p[1:], strict=False) if a.isalpha()}
        marks = "".join(c for c in STOPS if c not in joined)
        word = rf"{MARK}*[^{MARK}\n{regex.escape(marks)}]+" if marks else rf"{MARK}*[^{MARK}\n]+"
        if any(a in marks and not b.isalpha() and b != MARK for p in used for a, b in zip(p, p[1:], strict=False)):
            self.chunks = regex.compile(rf"\n|{MARK}*\p{{L}}+(?=[{regex.escape(marks)}])|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+")
        else:
            self.chunks = regex.compile(rf"\n|{word}|{MARK}*[{regex.escape(marks)}]+|{MARK}+")
        self.memo = MEMO
        self.reset()

    def _lay_out(self, ranks: list[int], weight) -> None:
        """The trie as arrays: ``base`` of a state plus a character's ``kind`` is the next state, if
        ``came_from`` there is the first; kind 0 leads nowhere."""
        next_of: list[dict[int, int]] = [{}]
        ends = {}
        for n, i in enumerate(ranks):
            state = 0
            for c in self.pieces[i]:
                to = next_of[state].setdefault(ord(c), len(next_of))
                if to == len(next_of):
                    next_of.append({})
                state = to
            ends[state] = (i, weight(n))
        codes = sorted({c for moves in next_of for c in moves})
        self.kind = np.zeros(CODES, np.int32)
        self.kind[codes] = np.arange(1, len(codes) + 1)
        kinds = [sorted(self.kind[list(moves)].tolist()) for moves in next_of]
        # States with many moves choose first, and leave where it is crowded; the others fill the gaps.
        taken, base, free, top = bytearray(b"\1"), np.zeros(len(next_of), np.int64), 1, len(codes)
        by_moves = sorted((x for x in range(len(next_of)) if kinds[x]), key=lambda x: -len(kinds[x]))
        for turn, state in enumerate(by_moves):
            own, tries = kinds[state], 0
            if turn and len(own) == 1 < len(kinds[by_moves[turn - 1]]):
                free = 1
            if top + len(codes) + 2 > len(taken):
                taken.extend(bytes(top + len(codes) + 2))
            spot = taken.find(0, max(free, own[0]))
            while any(taken[spot - own[0] + k] for k in own):
                spot, tries = taken.find(0, spot + 1), tries + 1
            at = spot - own[0]
            base[state], top = at, max(top, at + own[-1])
            for k in own:
                taken[at + k] = 1
            free = taken.find(0, spot if tries > 8 else free)
        place = np.zeros(len(next_of), np.int64)
        for state, moves in enumerate(next_of):
            for code, to in moves.items():
                place[to] = base[state] + self.kind[code]
        size = int(base.max()) + len(codes) + 1
        self.base, self.came_from = np.zeros(size, np.int32), np.full(size, NOTHING, np.int32)
        self.base[place] = base
        for state, moves in enumerate(next_of):
            self.came_from[place[list(moves.values())]] = place[state]
        self.weight_of, self.id_of = np.zeros(size), np.full(size, NOTHING, np.int32)
        for state, (i, w) in ends.items():
            self.id_of[place[state]], self.weight_of[place[state]] = i, w

    def reset(self) -> None:
        self.index: dict[str, int] = {}
        # Words by number, and the chunks' numbers of each.
        self.words: dict[str, int] = {}
        self.word_flat = np.zeros(0, np.int64)
        self.word_starts, self.word_sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        # In how many calls each word was met.
        self.word_met = np.zeros(0, np.int64)
        self.names: list[str] = []
        self.edges: dict[int, tuple] = {}
        # By chunk: probability of the best segmentation, its logarithm, whether there are
        # others, and where its ids are.
        self.p_best, self.log_best = np.zeros(0), np.zeros(0)
        self.several = np.zeros(0, bool)
        # The logarithm of the share of all segmentations but the best; what is no number yet is worked out when asked for.
        self.log_beside = np.zeros(0)
        self.lengths = np.zeros(0, np.int64)
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def best(self, i: int) -> tuple:
        return tuple(self.flat[self.starts[i] : self.starts[i] + self.sizes[i]].tolist())

    def edges_of(self, chunk: str):
        """Edges by their end, (start, ids, weight), and the forward sums."""
        n = len(chunk)
        into: list[list] = [[] for _ in range(n + 1)]
        for start in range(n):
            at, single = self.trie, False
            for end in range(start, n):
                at = at.get(chunk[end])
                if at is None:
                    break
                if "" in at:
                    i, w = at[""]
                    into[end + 1].append((start, (i,), w))
                    single |= end == start
            if not single:
                ids = tuple(self.bytes_of[b] for b in chunk[start].encode())
                into[start + 1].append((start, ids, self.byte_weight ** len(ids)))
        # Sums are scaled at each position, so that long chunks don't underflow.
        sums, scale = [1.0] + [0.0] * n, [0.0] * (n + 1)
        for end in range(1, n + 1):
            top = max(scale[s] for s, _, _ in into[end])
            total = 0.0
            for s, _, w in into[end]:
                total += sums[s] * w * (math.exp(scale[s] - top) if scale[s] != top else 1.0)
            if total < 1e-100:
                top += math.log(total)
                total = 1.0
            sums[end], scale[end] = total, top
        return into, sums, scale

    def shares(self, known, end: int) -> list[float]:
        """Of the edges into ``end``, the probability of each given that the path goes there."""
        into, sums, scale = known
        return [
            sums[s] * w * math.exp(scale[s] - scale[end]) / sums[end] for s, _, w in into[end]
        ]

    def forward(self, chunks: list[str]) -> dict:
        """Sums over segmentations and the best ones' last edges, by end, of short chunks side by side.

        Chunks are numbered by falling length (``order``), so that those that reach an end are the
        first ones (``reach`` of them). ``weights`` and ``ids`` hold the edges by end, then length, then
        chunk (``at`` is where). ``rest`` are the sums without the best segmentation, each an own
        sum of other edges, not a difference.
        """
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
        order = np.argsort(-lengths, kind="stable")
        lengths, n = lengths[order], len(chunks)
        width = int(lengths[0])
        reach = np.searchsorted(-lengths, -np.arange(width + 1), "right")
        longest = np.minimum(np.arange(width + 1), self.longest)
        ends = np.cumsum(longest * reach)
        at = ends[:, None] - (longest * reach)[:, None] + (np.arange(self.longest + 1) - 1) * reach[:, None]
        # Chunks in a row with a mark of their end.
        starts = np.cumsum(lengths + 1) - lengths - 1
        text = "\0".join([chunks[i] for i in order.tolist()]) + "\0"
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        row = np.repeat(np.arange(n), lengths + 1)
        inside = np.arange(len(row)) - starts[row]
        kind = self.kind[code]
        kind[starts + lengths] = 0
        weights, ids = np.zeros(int(ends[-1])), np.full(int(ends[-1]), NOTHING, np.int32)
        several, used = np.zeros(n, bool), set()
        spot = np.flatnonzero(inside < lengths[row])
        state, alone = np.zeros(len(spot), np.int32), np.ones(len(row), bool)
        for length in range(1, self.longest + 1):
            to = self.base[state] + kind[spot + (length - 1)]
            hit = np.flatnonzero(self.came_from[to] == state)
            if not len(hit):
                break
            spot, state = spot[hit], to[hit]
            w = self.weight_of[state]
            full = np.flatnonzero(w > 0.0)
            found, end = row[spot[full]], inside[spot[full]] + length
            cell = at[end, length] + found
            weights[cell], ids[cell] = w[full], self.id_of[state[full]]
            used.update((e, length) for e in np.flatnonzero(np.bincount(end)).tolist())
            if length == 1:
                alone[spot[full]] = False
            else:
                several[found] = True
        spelled = np.flatnonzero(alone & (inside < lengths[row]))
        if len(spelled):
            size = utf8_size(code[spelled])
            end = inside[spelled] + 1
            cell = at[end, 1] + row[spelled]
            weights[cell], ids[cell] = self.byte_weight**size, BYTES
            used.update((e, 1) for e in np.flatnonzero(np.bincount(end)).tolist())
        sums, best, rest = (np.zeros((width + 1, n)) for _ in range(3))
        back = np.zeros((width + 1, n), np.int64)
        sums[0] = best[0] = 1.0
        for end in range(1, width + 1):
            m = int(reach[end])
            total, top, beside, last = sums[end, :m], best[end, :m], rest[end, :m], back[end, :m]
            for length in range(int(longest[end]), 0, -1):
                if (end, length) not in used:
                    continue
                w = weights[at[end, length] : at[end, length] + m]
                summed, value = sums[end - length, :m] * w, best[end - length, :m] * w
                total += summed
                better = value > top
                beside += np.where(better, top + rest[end - length, :m] * w, summed)
                np.maximum(top, value, out=top)
                last[better] = length
        whole = np.arange(n)
        return {
            "order": order, "lengths": lengths, "reach": reach, "longest": longest, "at": at, "text": code, "starts": starts,
            "sums": sums, "back": back, "weights": weights, "ids": ids, "several": several,
            "sum": sums[lengths, whole], "best": best[lengths, whole], "rest": rest[lengths, whole],
        }

    def spelled(self, marks: np.ndarray, known: dict, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids row by row and their numbers; ``marks`` has an edge's id in the column of its end, and a
        row is of the chunk ``rows`` of ``known``."""
        counts = (marks >= 0).astype(np.int64)
        cells = np.nonzero(marks == BYTES)
        codes = known["text"][known["starts"][rows[cells[0]]] + cells[1]]
        counts[cells] = utf8_size(codes)
        flat = np.repeat(marks.ravel(), counts.ravel()).astype(np.int32)
        if len(codes):
            first = (np.cumsum(counts.ravel()) - counts.ravel())[cells[0] * marks.shape[1] + cells[1]]
            for at, code in zip(first.tolist(), codes.tolist(), strict=True):
                own = [self.bytes_of[b] for b in chr(code).encode()]
                flat[at : at + len(own)] = own
        return flat, counts.sum(axis=1)

    def _best_of_long(self, chunk: str) -> tuple[list[int], float, bool]:
        into, sums, scale = self.edges_of(chunk)
        n = len(chunk)
        score, back = [0.0] + [-math.inf] * n, [None] * (n + 1)
        for end in range(1, n + 1):
            for edge in into[end]:
                value = score[edge[0]] + math.log(edge[2])
                if value > score[end]:
                    score[end], back[end] = value, edge
        parts, end = [], n
        while end:
            parts.append(back[end][1])
            end = back[end][0]
        share = math.exp(score[n] - math.log(sums[n]) - scale[n])
        return [x for part in reversed(parts) for x in part], share, any(len(e) > 1 for e in into)

    def add(self, chunks: list[str]) -> None:
        """Take new chunks up, with their best segmentations."""
        shares, several, flats, sizes = [self.p_best], [self.several], [self.flat], [self.sizes]
        besides, lengths = [self.log_beside], [self.lengths]

        def put(names, share, more, flat, counts, beside):
            self.index.update(zip(names, range(len(self.names), len(self.names) + len(names)), strict=True))
            self.names.extend(names)
            shares.append(np.where(more, np.minimum(share, 1.0), 1.0))
            several.append(np.asarray(more, bool))
            flats.append(np.asarray(flat, np.int32))
            sizes.append(np.asarray(counts, np.int64))
            besides.append(np.asarray(beside, float))
            lengths.append(np.fromiter(map(len, names), np.int64, len(names)))

        alone = [c for c in chunks if len(c) > SHORT]
        fitting = [c for c in chunks if len(c) <= SHORT]
        for begin in range(0, len(fitting), SLICE):
            part = fitting[begin : begin + SLICE]
            known = self.forward(part)
            names = [part[i] for i in known["order"].tolist()]
            good = np.flatnonzero(known["best"] >= LEAST)
            alone += [names[r] for r in np.flatnonzero(known["best"] < LEAST).tolist()]
            at, width = known["lengths"].copy(), int(known["lengths"][0])
            marks = np.full((len(names), width), NOTHING, np.int32)
            for end in range(width, 0, -1):
                rows = np.flatnonzero(at == end)
                step = known["back"][end, rows]
                marks[rows, end - 1] = known["ids"][known["at"][end, step] + rows]
                at[rows] -= step
            flat, counts = self.spelled(marks[good], known, good)
            rest = known["rest"][good]
            with np.errstate(divide="ignore"):
                beside = np.where(rest >= LEAST, np.log(rest / known["sum"][good]), np.nan)
            share = known["best"][good] / known["sum"][good]
            put([names[r] for r in good.tolist()], share, known["several"][good], flat, counts, beside)
        for name in alone:
            ids, share, more = self._best_of_long(name)
            put([name], [share], [more], ids, [len(ids)], [np.nan])
        self.p_best, self.several = np.concatenate(shares), np.concatenate(several)
        self.log_best = np.concatenate([self.log_best, np.log(np.maximum(self.p_best[len(self.log_best) :], 1e-300))])
        self.flat, self.sizes = np.concatenate(flats), np.concatenate(sizes)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.log_beside, self.lengths = np.concatenate(besides), np.concatenate(lengths)

    def others(self, asked: np.ndarray, seeds: np.ndarray) -> tuple:
        """For each chunk asked for, a segmentation other than the best one: its probability, where its
        ids are, how many, and all ids.

        The best one is excluded by construction: the step that leaves its path, going
        backward, is drawn from what that path leaves over. No probability where the shares'
        rounding allowed no other; the caller then draws by ``other``.
        """
        p, starts, sizes = np.full(len(asked), np.nan), np.zeros(len(asked), np.int64), np.zeros(len(asked), np.int64)
        flats, total = [], 0
        fitting = np.flatnonzero(self.lengths[asked] <= SHORT)
        fitting = fitting[np.argsort(asked[fitting], kind="stable")]
        for begin in range(0, len(fitting), SLICE):
            part = fitting[begin : begin + SLICE]
            p[part], flat, counts = self._others(asked[part], seeds[part])
            starts[part], sizes[part] = total + np.cumsum(counts) - counts, counts
            flats.append(flat)
            total += len(flat)
        return p, starts, sizes, np.concatenate(flats) if flats else np.zeros(0, np.int32)

    def _others(self, asked: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        own, where = np.unique(asked, return_inverse=True)
        known = self.forward([self.names[i] for i in own.tolist()])
        place = np.empty(len(own), np.int64)
        place[known["order"]] = np.arange(len(own))
        where = place[where]
        sums, n, width = known["sums"], len(asked), int(known["lengths"][0])
        at, marks = known["lengths"][where], np.full((n, width), NOTHING, np.int32)
        kept, p, follow = np.ones(n), np.ones(n), np.ones(n, bool)
        # The draw lies above the probability of the whole best path; it says where to leave it.
        leave = self.p_best[asked]
        leave = leave + (1.0 - leave) * uniform(seeds, 0)
        usable = known["sum"][where] >= LEAST
        for end in range(width, 0, -1):
            rows = np.flatnonzero((at == end) & usable)
            if not len(rows):
                continue
            d, column = where[rows], np.arange(len(rows))
            reach, m = int(known["longest"][end]), int(known["reach"][end])
            first = int(known["at"][end, 1])
            weights = known["weights"][first : first + reach * m].reshape(reach, m)
            share = weights[:, d] * sums[end - reach : end][::-1][:, d] / sums[end, d]
            step = known["back"][end, d] - 1
            on, best = follow[rows], share[step, column]
            rest = share.copy()
            rest[step[on], column[on]] = 0.0
            summed = np.cumsum(rest, axis=0)
            stay = on & ((leave[rows] <= kept[rows] * best) | (summed[-1] <= 0.0))
            pick = (summed <= uniform(seeds[rows], end) * summed[-1]).sum(axis=0)
            last = reach - 1 - np.argmax(rest[::-1] > 0.0, axis=0)
            step = np.where(stay, step, np.minimum(pick, last))
            taken = share[step, column]
            p[rows] *= taken
            kept[rows] *= np.where(stay, taken, 1.0)
            follow[rows] = stay
            marks[rows, end - 1] = known["ids"][known["at"][end, step + 1] + d]
            at[rows] -= step + 1
        flat, counts = self.spelled(marks, known, where)
        return np.where(usable & ~follow, p, np.nan), flat, counts

    def known(self, i: int) -> tuple:
        """Edges of chunk ``i``; a few of the last ones are kept."""
        found = self.edges.get(i)
        if found is None:
            if len(self.edges) >= EDGES // 10:
                self.edges.clear()
            found = self.edges[i] = self.edges_of(self.names[i])
        return found

    def excluded(self, i: int, without: set) -> list[dict]:
        """Chunk ``i``'s excluded segmentations as a tree, going backward: nodes with their ``end``, the
        shares of the edges into it, ``next`` nodes by edge, and ``left``, the share of what is not excluded.

        Shares of edges off the tree are summed, not subtracted from 1, so a remainder far below
        rounding stays what it is, and is 0 only where nothing is left.
        """
        known = self.known(i)
        into, last = known[0], len(self.names[i])
        nodes = [{"end": last, "share": self.shares(known, last), "next": {}}]
        for ids in without:
            node, left = nodes[0], list(ids)
            while node["end"]:
                k = self._step(i, node["end"], left, into)
                start, part, _ = into[node["end"]][k]
                del left[len(left) - len(part) :]
                if k not in node["next"]:
                    node["next"][k] = len(nodes)
                    share = self.shares(known, start) if start else []
                    nodes.append({"end": start, "share": share, "next": {}})
                node = nodes[node["next"][k]]
        for node in reversed(nodes):
            weights = [
                x * nodes[node["next"][k]]["left"] if k in node["next"] else x
                for k, x in enumerate(node["share"])
            ]
            node["weights"], node["left"] = weights, math.fsum(weights)
        return nodes

    def beside_best(self, chunks: np.ndarray) -> np.ndarray:
        """The logarithm of the share of all segmentations of each chunk but the best."""
        found = self.log_beside[chunks]
        missing = np.isnan(found)
        if missing.any():
            for i in set(chunks[missing].tolist()):
                left = self.excluded(i, {self.best(i)})[0]["left"]
                self.log_beside[i] = math.log(left) if left > 0.0 else -math.inf
            found = self.log_beside[chunks]
        return found

    def other(self, i: int, rng, without: set) -> tuple[tuple, float] | None:
        """A segmentation of chunk ``i`` that is not in ``without``, and its probability.

        The others are excluded by construction, however many: going backward, a step is drawn by
        what its excluded segmentations leave of it. None where none is left.
        """
        known = self.known(i)
        into, nodes = known[0], self.excluded(i, without)
        node, end, done, p = nodes[0], len(self.names[i]), [], 1.0
        if nodes[0]["left"] <= 0.0:
            return None
        while end:
            share = node["share"] if node else self.shares(known, end)
            k = self._pick(node["weights"] if node else share, rng)
            p *= share[k]
            done.append(into[end][k][1])
            end = into[end][k][0]
            node = nodes[node["next"][k]] if node and k in node["next"] else None
        return tuple(x for part in reversed(done) for x in part), p

    def _step(self, i: int, end: int, left: list, into: list) -> int:
        """The edge into ``end`` that a segmentation with these ids ahead takes."""
        return next(
            k
            for k, (_, ids, _) in enumerate(into[end])
            if tuple(left[len(left) - len(ids) :]) == ids and self._on(i, end, k, left, into)
        )

    def _on(self, i: int, end: int, k: int, left: list, into: list) -> bool:
        """Whether edge ``k`` into ``end`` is of the best path: its length in characters fits."""
        start, ids, _ = into[end][k]
        if len(ids) > 1 or ids[0] in self.byte_value:
            return end - start == 1
        return end - start == len(self.pieces[ids[0]])

    @staticmethod
    def _pick(share: list[float], rng) -> int:
        u = rng.random() * sum(share)
        for k, x in enumerate(share):
            u -= x
            if u < 0.0 and x > 0.0:
                return k
        return max(k for k, x in enumerate(share) if x > 0.0)

    def split(self, texts: list[str]) -> list[np.ndarray]:
        """The chunks' numbers of each text; all stay valid until the next call.

        Where spaces are single, chunks lie within words: those of a word are looked up by it, once a call.
        """
        import pyarrow as pa
        import pyarrow.compute as pc

        cut: dict[int, list[str]] = {}
        spaced = []
        for i, text in enumerate(texts):
            if text[:1] in ("", " ") or not self.dummy_prefix or "  " in text or MARK in text:
                marked = text.replace(" ", MARK)
                cut[i] = self.chunks.findall(MARK + marked if text and self.dummy_prefix else marked)
            else:
                spaced.append(i)
        lists = pc.split_pattern(pa.array([texts[i] for i in spaced], pa.large_string()), " ")
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        chunks = set(itertools.chain.from_iterable(cut.values()))
        known, fresh, parts, new = self.missing(words, chunks)
        for make_room in (self.trim, self.reset):
            if max(len(self.names) + len(new), len(self.words) + len(fresh)) > self.memo and self.names:
                make_room()
                known, fresh, parts, new = self.missing(words, chunks)
        if new:
            self.add(list(new))
        if fresh:
            self.words.update(zip(fresh, range(len(self.words), len(self.words) + len(fresh)), strict=True))
            numbers = np.fromiter(map(self.index.__getitem__, parts), np.int64, len(parts))
            # A word's chunks are those that end within it.
            inside = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
            ends = np.cumsum(np.fromiter(map(len, fresh), np.int64, len(fresh)) + 1)
            sizes = np.diff(np.searchsorted(inside, ends, "right"), prepend=0)
            self.word_flat = np.concatenate([self.word_flat, numbers])
            self.word_sizes = np.concatenate([self.word_sizes, sizes])
            self.word_starts = np.cumsum(self.word_sizes) - self.word_sizes
            self.word_met = np.concatenate([self.word_met, np.zeros(len(fresh), np.int64)])
        self.word_met[known] += 1
        every = known[coded.indices.to_numpy(zero_copy_only=False)]
        ends = np.append(0, np.cumsum(self.word_sizes[every]))[np.asarray(lists.offsets) - lists.offsets[0].as_py()]
        numbers = self.within(every)
        out: list = [None] * len(texts)
        for i, begin, end in zip(spaced, ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            out[i] = numbers[begin:end]
        for i, own in cut.items():
            out[i] = np.fromiter(map(self.index.__getitem__, own), np.int64, len(own))
        return out

    def missing(self, words: list[str], chunks: set[str]) -> tuple[np.ndarray, list[str], list[str], set[str]]:
        """The words' numbers, those not yet known by the next ones; these words, their chunks in a row, and
        all chunks not yet known.

        Words of letters are one chunk. A space mark always begins a chunk, so the others are cut in one go; the
        empty one, whose mark would join the next word's, is the last.
        """
        numbers = np.fromiter(map(self.words.get, words, itertools.repeat(-1)), np.int64, len(words))
        at = np.flatnonzero(numbers < 0).tolist()
        whole = [i for i in at if words[i].isalpha()]
        cut = sorted((i for i in at if not words[i].isalpha()), key=lambda i: not words[i])
        numbers[whole + cut] = np.arange(len(self.words), len(self.words) + len(at))
        fresh = [words[i] for i in whole + cut]
        parts = [MARK + w for w in fresh[: len(whole)]]
        if cut:
            parts += self.chunks.findall(MARK + MARK.join(fresh[len(whole) :]))
        return numbers, fresh, parts, {c for c in chunks.union(parts) if c not in self.index}

    def trim(self) -> None:
        """Forget words that one call alone has met lately, and chunks that no other word has.

        Of the words left at most half as many as may be remembered stay, those met most.
        """
        kept = np.flatnonzero(self.word_met > 1)
        kept = np.sort(kept[np.argsort(-self.word_met[kept], kind="stable")[: self.memo // 2]])
        names, met, sizes = list(self.words), self.word_met[kept] // 2, self.word_sizes[kept]
        chunks, flat = np.unique(self.within(kept), return_inverse=True)
        begins = np.cumsum(self.sizes[chunks]) - self.sizes[chunks]
        pick = np.arange(int(self.sizes[chunks].sum())) + np.repeat(self.starts[chunks] - begins, self.sizes[chunks])
        held = [x[chunks] for x in (self.p_best, self.log_best, self.several, self.log_beside, self.lengths, self.sizes)]
        texts, ids = [self.names[i] for i in chunks.tolist()], self.flat[pick]
        self.reset()
        self.words = {names[i]: n for n, i in enumerate(kept.tolist())}
        self.word_flat, self.word_sizes, self.word_met = flat.astype(np.int64), sizes, met
        self.word_starts = np.cumsum(sizes) - sizes
        self.names, self.index = texts, {c: n for n, c in enumerate(texts)}
        self.p_best, self.log_best, self.several, self.log_beside, self.lengths, self.sizes = held
        self.starts, self.flat = begins, ids

    def within(self, words: np.ndarray) -> np.ndarray:
        """The chunks' numbers of words given by number."""
        sizes = self.word_sizes[words]
        begins = np.cumsum(sizes) - sizes
        pick = np.arange(int(sizes.sum())) + np.repeat(self.word_starts[words] - begins, sizes)
        return self.word_flat[pick]

    def samples(self, texts: list[str], keys: list[int], k: int) -> list[list[dict]]:
        """Up to ``k`` distinct segmentations of each text, by falling perturbed log probability.

        The texts' searches take their steps together, as arrays over their chunks in a row; each has
        its own random numbers, and its result does not depend on the others.
        """
        searches = [Search(at, key) for at, key in zip(self.split(texts), keys, strict=True)]
        drawn = Drawn()
        active = searches
        while active:
            popped = []
            for search in active:
                step = heapq.heappop(search.queue)
                if len(search.out) == k:
                    search.threshold = -step[0]
                else:
                    popped.append((search, *step))
            if popped:
                self.step(popped, drawn, k)
            active = [p[0] for p in popped if p[0].queue]
        self.ids(searches, drawn)
        for search in searches:
            for sample in search.out:
                gap = sample["log_prob"] - search.threshold
                sample["log_inclusion"] = (
                    0.0 if gap > 30 else gap if gap < -30 else math.log(-math.expm1(-math.exp(gap)))
                )
        return [search.out for search in searches]

    def sample(self, text: str, key: int, k: int) -> list[dict]:
        return self.samples([text], [key], k)[0]

    def step(self, popped: list[tuple], drawn: Drawn, k: int) -> None:
        """For each search its popped set's member, added to its samples, and the sets left beside it."""
        sizes = np.array([len(p[0].at) - p[4] for p in popped], np.int64)
        ends = np.cumsum(sizes)
        begins = (ends - sizes).tolist()
        chunk = np.concatenate([p[0].at[p[4] :] for p in popped])
        p_best, log_p, free = self.p_best[chunk], self.log_best[chunk], self.several[chunk]
        u = np.full(len(chunk), -1.0)
        plain = np.zeros(len(popped), bool)
        for i, (search, _, _, _, start, _, without, _) in enumerate(popped):
            if sizes[i]:
                search.rng.random(out=u[begins[i] + bool(without) : begins[i] + sizes[i]])
            plain[i] = bool(without) and without == {self.best(int(search.at[start]))}
        leaf = (u >= p_best) & free
        leaf[ends[plain] - sizes[plain]] = True
        leaves = np.flatnonzero(leaf)
        cuts = np.searchsorted(leaves, ends).tolist()
        seeds, low = np.empty(len(leaves), np.uint64), 0
        for (search, *_), high in zip(popped, cuts, strict=True):
            if high > low:
                seeds[low:high] = search.rng.integers(0, 2**64, high - low, np.uint64)
            low = high
        p, *found = self.others(chunk[leaves], seeds)
        number = np.where(np.isnan(p), -1, len(drawn.sizes) + np.arange(len(p)))
        drawn.take(*found)
        log_p[leaves] = np.log(np.maximum(p, 1e-300))
        # Draws that are left go one by one.
        empty, more, single = set(), {}, []
        lacking = np.isnan(p)
        by_search = np.searchsorted(ends, leaves[lacking], "right").tolist()
        one_by_one = [(i, int(x)) for i, x in zip(by_search, np.flatnonzero(lacking), strict=True)]
        one_by_one += [(i, -1) for i, x in enumerate(popped) if x[6] and not plain[i]]
        for i, x in sorted(one_by_one):
            search, without, spot = popped[i][0], popped[i][6], int(leaves[x]) if x >= 0 else begins[i]
            if i in empty:
                continue
            first = bool(without) and spot == begins[i]
            found = self.other(int(chunk[spot]), search.rng, without if first else {self.best(int(chunk[spot]))})
            log_p[spot] = self.log_best[chunk[spot]]
            if found is not None:
                log_p[spot] = math.log(max(found[1], 1e-300))
                more[spot] = len(drawn.sizes) + len(single)
                single.append(found[0])
                if x >= 0:
                    number[x] = more[spot]
            elif first:
                empty.add(i)
        own = np.fromiter(map(len, single), np.int64, len(single))
        drawn.take(np.cumsum(own) - own, own, np.fromiter(itertools.chain.from_iterable(single), np.int32, int(own.sum())))
        # What is left at each position from the start on, with values below this one's.
        before, noise = np.empty(len(chunk)), np.empty(len(chunk))
        taken = np.exp(log_p)
        here: list = [None] * len(popped)
        low = 0
        for i, (search, value, _, path, start, _, without, gone) in enumerate(popped):
            a, b, high = begins[i], begins[i] + int(sizes[i]), cuts[i]
            places, numbers = leaves[low:high] - a + start, number[low:high]
            low = high
            if i in empty:
                before[a:b], noise[a:b] = 0.0, 0.5
                continue
            valid = numbers >= 0
            if not valid.all():
                places, numbers = places[valid], numbers[valid]
            if without and not plain[i]:
                places, numbers = np.append(start, places), np.append(more[a], numbers)
            whole = log_p[a:b]
            if path is not None:
                kept = int(np.searchsorted(path["places"], start))
                places = np.concatenate([path["places"][:kept], places])
                numbers = np.concatenate([path["numbers"][:kept], numbers])
                whole = np.concatenate([path["log_p"][:start], whole])
            here[i] = {"places": places, "numbers": numbers, "log_p": whole}
            search.out.append(here[i] | {"perturbed": -value, "log_prob": float(whole.sum())})
            if b > a:
                before[a] = 0.0
                np.cumsum(log_p[a : b - 1], out=before[a + 1 : b])
                search.rng.random(out=noise[a:b])
                if without:
                    taken[a] += gone
        before += np.repeat([x[5] for x in popped], sizes)
        with np.errstate(divide="ignore"):
            mass = before + np.log1p(-np.minimum(taken, 1.0))
        mass[~free] = -np.inf
        # What rounding leaves of nearly certain choices is no measure of the rest.
        certain = np.flatnonzero((taken > 1.0 - CERTAIN) & free)
        if len(certain):
            touched = np.zeros(len(chunk), bool)
            touched[leaves] = number >= 0
            touched[list(more)] = True
            touched[[a for a, x in zip(begins, popped, strict=True) if x[6]]] = True
            plainly = certain[~touched[certain]]
            mass[plainly] = before[plainly] + self.beside_best(chunk[plainly])
            certain = certain[touched[certain]]
            for i, spot in zip(np.searchsorted(ends, certain, "right").tolist(), certain.tolist(), strict=True):
                if i not in empty:
                    left = self.excluded(int(chunk[spot]), self.held(popped[i], here[i], spot - begins[i], drawn))[0]["left"]
                    mass[spot] = before[spot] + math.log(left) if left > 0.0 else -np.inf
        with np.errstate(over="ignore"):
            bound = np.exp(np.minimum(mass + np.repeat([x[1] for x in popped], sizes), 700.0))
            cut = mass - np.log(bound - np.log(noise))
        for i, popped_set in enumerate(popped):
            if i in empty:
                continue
            search, start, a = popped_set[0], popped_set[4], begins[i]
            own = cut[a : a + int(sizes[i])]
            for j in largest(own, k + 2 - len(search.out)):
                if math.isfinite(own[j]):
                    search.ties += 1
                    held = self.held(popped_set, here[i], j, drawn)
                    left = (start + j, float(before[a + j]), held, float(taken[a + j]))
                    heapq.heappush(search.queue, (-float(own[j]), search.ties, here[i], *left))

    def held(self, popped_set: tuple, path: dict, j: int, drawn: Drawn) -> frozenset:
        """What is excluded at ``j`` after the start of a popped set once its member ``path`` is out."""
        search, _, _, _, start, _, without, _ = popped_set
        at = int(np.searchsorted(path["places"], start + j))
        changed = at < len(path["places"]) and path["places"][at] == start + j
        chosen = drawn.ids(int(path["numbers"][at])) if changed else self.best(int(search.at[start + j]))
        return (without if j == 0 else frozenset()) | {chosen}

    def ids(self, searches: list[Search], drawn: Drawn) -> None:
        """All ids of each sample: the best ones of its text's chunks but where it differs."""
        every = [(s, sample) for s in searches for sample in s.out]
        if not every:
            return
        chunk = np.concatenate([s.at for s, _ in every])
        counts = np.array([len(s.at) for s, _ in every], np.int64)
        ends = np.cumsum(counts)
        places = [sample.pop("places") for _, sample in every]
        changed = np.concatenate(places) + np.repeat(ends - counts, [len(x) for x in places])
        numbers = np.concatenate([sample.pop("numbers") for _, sample in every])
        sizes, own = self.sizes[chunk], drawn.sizes[numbers]
        sizes[changed] = own
        after = np.cumsum(sizes)
        pick = np.arange(int(sizes.sum())) + np.repeat(self.starts[chunk] - after + sizes, sizes)
        flat = self.flat[np.minimum(pick, len(self.flat) - 1)] if len(pick) else np.zeros(0, np.int32)
        first = np.cumsum(own) - own
        within = np.arange(int(own.sum()))
        flat[within + np.repeat((after - sizes)[changed] - first, own)] = drawn.flat[within + np.repeat(drawn.starts[numbers] - first, own)]
        bounds = np.append(0, after)[np.append(0, ends)].tolist()
        for (_, sample), begin, end in zip(every, bounds, bounds[1:], strict=False):
            sample.pop("log_p")
            sample["ids"] = flat[begin:end]

    def decoded(self, flat: np.ndarray, sizes: np.ndarray):
        """The texts of segmentations, as an Arrow array; ``flat`` has their ids in a row."""
        import pyarrow as pa

        ends = np.cumsum(sizes)
        if len(flat) and (flat.min() < 0 or flat.max() >= len(self.pieces)):
            raise ValueError("ids outside the vocabulary")
        pick = flat.astype(np.int64)
        pick[(ends - sizes)[sizes > 0]] += len(self.pieces)
        spelled = pa.array(self.spellings, pa.large_binary()).take(pa.array(pick))
        _, offsets, data = spelled.buffers()
        at = np.frombuffer(offsets, np.int64)[: len(pick) + 1] if len(pick) else np.zeros(1, np.int64)
        bounds = at[np.concatenate([[0], ends]).astype(np.int64)]
        whole = [pa.py_buffer(bounds.tobytes()), data if data is not None else pa.py_buffer(b"")]
        texts = pa.Array.from_buffers(pa.large_string(), len(sizes), [None, *whole])
        try:
            texts.validate(full=True)
        except pa.ArrowInvalid:
            raw = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, *whole])
            texts = pa.array([x.decode("utf-8", "replace") for x in raw.to_pylist()], pa.large_string())
        return texts

    def decode(self, ids) -> str:
        """The text of a segmentation."""
        raw = bytearray()
        for i in ids:
            byte = self.byte_value.get(int(i))
            if byte is None:
                raw += self.pieces[int(i)].replace(MARK, " ").encode()
            else:
                raw.append(byte)
        text = raw.decode("utf-8", "replace")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


class Search:
    """One text's search: its chunks, random numbers, sets still to pop and samples so far.

    A set: (-largest value, tie, prefix's path, position, log mass of the prefix, excluded, their mass).
    """

    def __init__(self, at: np.ndarray, key: int):
        self.at, self.rng = at, np.random.Generator(np.random.Philox(key=key))
        top = float(-np.log(-np.log(self.rng.random())))
        self.queue: list = [(-top, 0, None, 0, 0.0, frozenset(), 0.0)]
        self.out: list[dict] = []
        self.ties, self.threshold = 0, -math.inf


class Drawn:
    """Segmentations of chunks that were drawn, by number."""

    def __init__(self):
        self.flat, self.starts, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def take(self, starts: np.ndarray, sizes: np.ndarray, flat: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, len(self.flat) + starts])
        self.sizes, self.flat = np.concatenate([self.sizes, sizes]), np.concatenate([self.flat, flat])

    def ids(self, number: int) -> tuple:
        return tuple(self.flat[self.starts[number] : self.starts[number] + self.sizes[number]].tolist())


def utf8_size(codes: np.ndarray) -> np.ndarray:
    """Bytes in UTF-8 of each code point."""
    return 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)


def loaded(path: str, alpha: float = ALPHA) -> Lattice:
    if (path, alpha) not in _MODELS:
        _MODELS[path, alpha] = Lattice(path, alpha)
    return _MODELS[path, alpha]


def uniform(seeds: np.ndarray, step: int) -> np.ndarray:
    """Numbers in [0, 1), one a seed and step, by a mixing function of 64 bits."""
    x = seeds + np.uint64((step + 1) * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) * 2.0**-53


def largest(values: np.ndarray, n: int) -> list[int]:
    """Where the ``n`` largest values are, falling, the first of equal ones first."""
    at = np.arange(len(values))
    if len(values) > 4 * n:
        least = np.partition(values, len(values) - n)[len(values) - n]
        at = np.flatnonzero(values >= least)
    return at[np.argsort(-values[at], kind="stable")][:n].tolist()


def row_key(key, seed: int) -> int:
    raw = f"{seed}:{'' if key is None else key}".encode()
    return int.from_bytes(hashlib.blake2b(raw, digest_size=16).digest(), "little")


def encode(
    docs: DataFrame, model: str, k: int = SAMPLES, alpha: float = ALPHA, seed: int = SEED, digest: bool = False,
    verify: bool = False, memo: int = MEMO, together: int = TOGETHER,
) -> DataFrame:
    """doc_id, sample (1 to k), n_pieces, log_prob, perturbed, log_inclusion and ids, or with
    ``digest`` the SHA-256 of the ids as little-endian 32-bit numbers. With ``verify`` every
    sample is decoded, and ``round_trip`` is whether that gives the text. ``memo`` bounds the chunks and
    words that a worker remembers, ``together`` the characters of texts that are searched side by side;
    they cost memory and save time, and change no sample."""
    narrow = only(docs, "doc_id", "text").select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    last = "ids_sha256 string" if digest else "ids array<int>"
    schema = (
        f"doc_id {kind}, sample int, n_pieces bigint, log_prob double, perturbed double, "
        f"log_inclusion double, {last}" + ", round_trip boolean" * verify
    )

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        # What earlier work of this process has left over goes back first.
        pa.default_memory_pool().release_unused()
        lattice = loaded(model, alpha)
        lattice.memo = memo
        names = ["doc_id", *(part.split()[0] for part in schema.split(", ")[1:])]
        for batch in batches:
            source = batch.column("doc_id")
            ends = np.cumsum(pc.utf8_length(batch.column("text")).to_numpy(zero_copy_only=False))
            begin = 0
            while begin < len(batch):
                before = ends[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(ends, before + together, "right")))
                texts = batch.column("text").slice(begin, end - begin).to_pylist()
                keys = [row_key(x, seed) for x in source.slice(begin, end - begin).to_pylist()]
                sampled = lattice.samples(texts, keys, k)
                counts = np.fromiter(map(len, sampled), np.int64, len(sampled))
                every = list(itertools.chain.from_iterable(sampled))
                sizes = np.fromiter((len(s["ids"]) for s in every), np.int64, len(every))
                flat = np.concatenate([s["ids"] for s in every]) if every else np.zeros(0, np.int32)
                rows = np.repeat(np.arange(len(texts)), counts)
                first = np.repeat(np.cumsum(counts) - counts, counts)
                columns = [
                    source.slice(begin, end - begin).take(pa.array(rows)),
                    pa.array((np.arange(len(every)) - first + 1).astype(np.int32)),
                    pa.array(sizes),
                    *(pa.array([s[name] for s in every], pa.float64()) for name in ("log_prob", "perturbed", "log_inclusion")),
                ]
                if digest:
                    columns.append(pa.array([hashlib.sha256(s["ids"].astype("<i4").tobytes()).hexdigest() for s in every], pa.string()))
                else:
                    bounds = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                    columns.append(pa.ListArray.from_arrays(bounds, pa.array(flat.astype(np.int32, copy=False))))
                if verify:
                    wanted = batch.column("text").slice(begin, end - begin).take(pa.array(rows)).cast(pa.large_string())
                    columns.append(pc.equal(lattice.decoded(flat, sizes), wanted))
                yield pa.RecordBatch.from_arrays(columns, names)
                begin = end

    return narrow.mapInArrow(run, schema)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """The rows of ``encoded`` with ``text``, decoded from ``ids``, in place of the ids; null
    ids give a null text, and ids that are no UTF-8 its replacement character."""
    schema = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema if f.name != "ids"
    )

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        lattice = loaded(model)
        for batch in batches:
            for begin in range(0, len(batch), 500):
                part = batch.slice(begin, 500)
                ids = part.column("ids")
                sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                flat = pc.list_flatten(ids).to_numpy(zero_copy_only=False)
                texts = lattice.decoded(flat, sizes).cast(pa.string())
                texts = pc.if_else(ids.is_valid(), texts, pa.scalar(None, pa.string()))
                names = [n for n in part.schema.names if n != "ids"]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), texts], [*names, "text"])

    return encoded.mapInArrow(run, f"{schema}, text string" if schema else "text string")
