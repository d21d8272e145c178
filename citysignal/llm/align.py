"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

Both tokenizers split a text's bytes. Where tokens of both end at one offset the text falls into
groups: the ends of A are put into a table from end to index, addressed by the end itself (a
dictionary whose hash is the offset), the ends of B are looked up in it, and the common ends, in order,
slice both id lists. Inside a slice, each stretch between neighbouring ends of either
side lies in one token of each, and two tokens that overlap share exactly one stretch: so
stretches are the links. Many texts are laid end to end and aligned at once; every text ends a group.

How often two ids are linked is counted over all texts: tasks sum up the pairs of many texts before
they send them, and sums meet by pair. The counts are stored as sorted arrays that workers map
into memory (see ``mapped``), each with a mark for the highest of its B id; a second pass over the
stored pairs of each text looks them up by binary search. So texts are encoded once, a
frequent pair costs one row a flush, and nothing of the counts passes through the driver.

Tokenizer A's file is read by its own library. For texts of Latin letters (below U+0250), whose classes
all libraries agree on, a faster encoder works from the same vocabulary: its ids are the ranks of its merges.

Texts that are null, empty, or that either tokenizer does not give back byte for byte have no tokens: zeros
and an empty digest. Very long texts are encoded whole. Repeated rows and null ids keep
their rows, and count once each. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citysignal.llm import blocks, mapped
from citysignal.llm.common import ID_ROWS, only, small_side, text_of, written

# Bytes of texts that are encoded side by side, and pairs that are summed up before they are sent.
SLICE_BYTES = 1 << 19
FLUSH_PAIRS = 1_000_000
# Rows whose pairs are looked up or summed side by side.
STEP_ROWS = 512
PAIR_BITS = 32
# Texts are cut before a word after about this many characters.
PART_CHARS = 300
# The published pattern of byte-level vocabularies, and letters beyond those that all
# libraries class alike.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE_RUN = re.compile(r"\s\s\S|^\s\S")
BEYOND_LATIN = re.compile("[^\x00-\u024f]")


@functools.cache
def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable Latin-1 stands for itself,
    the other bytes for the letters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}


class Byte:
    """Tokenizer A: byte-level pieces of a leading space and the text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        letters = byte_letters()
        bytes_of = [b""] * self.tokenizer.get_vocab_size()
        for piece, i in self.tokenizer.get_vocab().items():
            bytes_of[i] = bytes(letters[c] for c in piece) if all(c in letters for c in piece) else piece.encode()
        self.pieces = pa.array(bytes_of, pa.binary())
        self.ranked = self._ranked(path, letters)

    def _ranked(self, path: str, letters: dict[str, int]):
        """The faster encoder, if the file asks for no more than ranked merges of one pattern's parts."""
        import tiktoken

        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        before, model = told["pre_tokenizer"] or {}, told["model"]
        plain = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        odd = [told["normalizer"], *(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))]
        if not plain or any(odd):
            return None
        added = {t["id"] for t in told["added_tokens"]}
        ranks = {bytes(letters[c] for c in p): i for p, i in model["vocab"].items() if i not in added}
        order = [ranks[bytes(letters[c] for c in "".join(m if isinstance(m, list) else m.split(" ")))] for m in model["merges"]]
        if order != sorted(order):
            return None
        # Where no run of white space stands before a word, its last character needs no look ahead.
        return [
            tiktoken.Encoding(pattern, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            for pattern in (PATTERN.replace(r"\s+(?!\S)|", ""), PATTERN)
        ]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        slow = []
        for i, text in enumerate(texts):
            if self.ranked is None or BEYOND_LATIN.search(text):
                slow.append(i)
            else:
                encoder = self.ranked[SPACE_RUN.search(text) is not None]
                out[i] = np.array(encoder.encode_ordinary(" " + text), np.int64)
        encoded = self.tokenizer.encode_batch_fast([" " + texts[i] for i in slow], add_special_tokens=False)
        for i, e in zip(slow, encoded, strict=True):
            out[i] = np.array(e.ids, np.int64)
        return out


def parts_of(text: str, size: int = PART_CHARS) -> list[str]:
    """The text cut at single spaces between printable ASCII characters; the spaces are left out."""
    out, at = [], 0
    space = text.find(" ", size)
    while space != -1:
        if "!" <= text[space - 1] <= "~" and "!" <= text[space + 1 : space + 2] <= "~":
            out.append(text[at:space])
            at = space + 1
            space = text.find(" ", at + size)
        else:
            space = text.find(" ", space + 1)
    return [*out, text[at:]]


class Piece:
    """Tokenizer B: SentencePiece, which puts the leading space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        bytes_of = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            is_byte = self.model.is_byte(i)
            bytes_of.append(bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("▁", " ").encode())
        self.pieces = pa.array(bytes_of, pa.binary())
        # Pieces that stay within a word let a text be cut before words: shorter queues, the same ids.
        words = self.model.encode("a b") == self.model.encode("a") + self.model.encode("b")
        self.cuts = words and not any(re.search(rb"[^ ] ", piece) for piece in bytes_of)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.cuts:
            return [np.array(ids, np.int64) for ids in self.model.encode(texts, num_threads=1)]
        parts, ends = [], [0]
        for text in texts:
            parts += parts_of(text)
            ends.append(len(parts))
        ids = self.model.encode(parts, num_threads=1)
        chain = itertools.chain.from_iterable
        return [np.fromiter(chain(ids[i:j]), np.int64) for i, j in itertools.pairwise(ends)]


class Side:
    """A tokenizer with the lengths of its ids' bytes and how ids are written in a group."""

    def __init__(self, tokenizer, last: str):
        self.encode, self.pieces = tokenizer.encode, tokenizer.pieces
        self.lengths = np.asarray(pc.binary_length(self.pieces)).astype(np.int64)
        # Two spellings an id: before another id of the group, and at the end of the side.
        self.spellings = [f"{i}{mark}".encode() for i in range(len(self.lengths)) for mark in (",", last)]

    def given_back(self, ids: np.ndarray) -> memoryview:
        """The bytes of the ids, one after the other."""
        body = self.pieces.take(pa.array(ids))
        return memoryview(body.buffers()[2] or b"").cast("B")[: int(self.lengths[ids].sum())]


@functools.lru_cache(maxsize=2)
def loaded(byte_path: str, piece_path: str) -> tuple[Side, Side, pa.Array]:
    """This worker's tokenizers, and all spellings of A's, then B's ids."""
    a, b = Side(Byte(byte_path), "|"), Side(Piece(piece_path), ";")
    return a, b, pa.array(a.spellings + b.spellings, pa.binary())


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of either side lie up to each common end."""
    index = np.zeros(int(ends_a[-1]) + 1 if len(ends_a) else 1, np.int64)
    index[ends_a] = np.arange(1, len(ends_a) + 1)
    upto_b = np.flatnonzero(index[ends_b] > 0)
    return index[ends_b[upto_b]], upto_b + 1


def spelled(a: np.ndarray, b: np.ndarray, upto_a: np.ndarray, upto_b: np.ndarray, spellings: pa.Array, size_a: int):
    """``a1,a2|b1;a3|b2,b3;``: the bytes of all groups, and where each begins."""
    last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    last_a[upto_a - 1] = last_b[upto_b - 1] = 1
    from_a, from_b = np.concatenate([[0], upto_a[:-1]]), np.concatenate([[0], upto_b[:-1]])
    code = np.empty(len(a) + len(b), np.int64)
    # A group's ids of A stand behind all ids of the groups before it, its ids of B behind those.
    code[np.arange(len(a)) + np.repeat(from_b, upto_a - from_a)] = 2 * a + last_a
    code[np.arange(len(b)) + np.repeat(upto_a, upto_b - from_b)] = 2 * (b + size_a) + last_b
    body = spellings.take(pa.array(code))
    at = np.frombuffer(body.buffers()[1], np.int32)[: len(code) + 1]
    return memoryview(body.buffers()[2]), at[np.append(from_a + from_b, len(code))]


def links_of(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of ids of all overlapping tokens, packed, a link each, and where each link ends."""
    size = int(ends_a[-1]) + 1
    is_a, is_b = np.zeros(size, np.int8), np.zeros(size, np.int8)
    is_a[ends_a] = is_b[ends_b] = 1
    ends = np.flatnonzero(is_a | is_b)
    # How many tokens end before each end.
    left = np.cumsum(is_a[ends], dtype=np.int64) - is_a[ends]
    right = np.cumsum(is_b[ends], dtype=np.int64) - is_b[ends]
    return (b[right] << PAIR_BITS) | a[left], ends


def aligned(texts: list[str], byte_path: str, piece_path: str) -> tuple[list, list, np.ndarray, np.ndarray, np.ndarray]:
    """By text: counts (n_a, n_b, n_groups, n_links) and digests; pairs and times, and where each text's end."""
    side_a, side_b, spellings = loaded(byte_path, piece_path)
    counts, digests = [(0, 0, 0, 0)] * len(texts), [""] * len(texts)
    asked = [i for i, text in enumerate(texts) if text]
    ids_a, ids_b = (side.encode([texts[i] for i in asked]) for side in (side_a, side_b))
    good = []
    for k, i in enumerate(asked):
        wanted = (" " + texts[i]).encode()
        if side_a.given_back(ids_a[k]) == wanted == side_b.given_back(ids_b[k]):
            good.append(k)
    if not good:
        none = np.zeros(0, np.int64)
        return counts, digests, none, none, np.zeros(len(texts) + 1, np.int64)
    rows = np.array([asked[k] for k in good])
    a, b = (np.concatenate([ids[k] for k in good]) for ids in (ids_a, ids_b))
    ends_a, ends_b = np.cumsum(side_a.lengths[a]), np.cumsum(side_b.lengths[b])
    # Where each text ends: its last token of either side.
    stop_a, stop_b = (_starts(np.array([len(ids[k]) for k in good])) for ids in (ids_a, ids_b))
    text_ends = ends_a[stop_a[1:] - 1]
    upto_a, upto_b = common_ends(ends_a, ends_b)
    groups = np.searchsorted(upto_a, stop_a, "right")
    body, begins = spelled(a, b, upto_a, upto_b, spellings, len(side_a.lengths))
    pairs, link_ends = links_of(a, b, ends_a, ends_b)
    stops = np.searchsorted(link_ends, text_ends, "right")
    links = np.diff(np.concatenate([[0], stops]))
    for k, row in enumerate(rows.tolist()):
        counts[row] = (len(ids_a[good[k]]), len(ids_b[good[k]]), int(groups[k + 1] - groups[k]), int(links[k]))
        digests[row] = hashlib.sha256(body[begins[groups[k]] : begins[groups[k + 1]] - 1]).hexdigest()
    # Sorted as one number, text before pair.
    right, left = pairs >> PAIR_BITS, pairs & ((1 << PAIR_BITS) - 1)
    size_a, size_b = len(side_a.lengths), len(side_b.lengths)
    key = np.sort((np.repeat(rows, links) * size_b + right) * size_a + left)
    fresh = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    times = np.diff(np.append(fresh, len(key)))
    both, left = np.divmod(key[fresh], size_a)
    owner, right = np.divmod(both, size_b)
    return counts, digests, (right << PAIR_BITS) | left, times, np.searchsorted(owner, np.arange(len(texts) + 1))


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
ALIGNED = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<int>"


def alignments(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """doc_id, the counts, the digest of the groups and the distinct pairs of ids with their links."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def align(batches):
        for batch in batches:
            texts = batch.column("body")
            for first, _, offsets in blocks.slices(texts, SLICE_BYTES):
                part = texts.slice(first, len(offsets) - 1).to_pylist()
                counts, digests, pairs, times, ends = aligned(part, byte_path, piece_path)
                ends = pa.array(ends.astype(np.int32))
                columns = [
                    batch.column("doc_id").slice(first, len(part)),
                    *(pa.array(c, pa.int64()) for c in zip(*counts, strict=True)),
                    pa.array(digests),
                    pa.ListArray.from_arrays(ends, pa.array(pairs)),
                    pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int32))),
                ]
                yield pa.RecordBatch.from_arrays(columns, NAMES)

    return (
        only(docs, "doc_id", "text")
        .select("doc_id", text_of().alias("body"))
        .mapInArrow(align, f"doc_id {kind}, {ALIGNED}")
    )


def stepped(batches):
    for batch in batches:
        for first in range(0, len(batch), STEP_ROWS):
            yield batch.slice(first, STEP_ROWS)


def keys_of(pairs: np.ndarray) -> np.ndarray:
    """A key for each packed pair: another for every pair, spread evenly."""
    return blocks.mixed(pairs.view(np.uint64))


def pair_counts(stored: DataFrame) -> DataFrame:
    """key, B id and n, its links in all texts. Tasks sum up many texts' pairs before the shuffle."""

    def summed(held):
        pairs, where = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
        return pairs, np.bincount(where, np.concatenate([t for _, t in held]), len(pairs)).astype(np.int64)

    def sent(pairs, n):
        columns = keys_of(pairs).view(np.int64), (pairs >> PAIR_BITS).astype(np.int32), n
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["key", "b", "n"])

    def count(batches):
        held, size = [], 0
        for batch in stepped(batches):
            held.append((batch.column("pairs").flatten().to_numpy(), batch.column("times").flatten().to_numpy()))
            size += len(held[-1][0])
            if size >= FLUSH_PAIRS:
                held = [summed(held)]
                size = len(held[0][0])
                if size >= FLUSH_PAIRS // 2:
                    yield sent(*held[0])
                    held, size = [], 0
        if held:
            yield sent(*summed(held))

    counted = stored.select("pairs", "times").mapInArrow(count, "key bigint, b int, n bigint")
    return counted.groupBy("key", "b").agg(F.sum("n").alias("n"))


def marked(counts: DataFrame) -> DataFrame:
    """key and value: twice the count, one more if it is the highest of its B id."""
    # At most one row an entry of B's vocabulary.
    best = small_side(counts.groupBy("b").agg(F.max("n").alias("most")), ID_ROWS)
    value = 2 * F.col("n") + (F.col("n") == F.col("most")).cast("long")
    return counts.join(best, "b").select("key", value.alias("value"), F.lit("").alias("name"))


def scored(stored: DataFrame, counts: mapped.SortedKeys) -> DataFrame:
    """The rows of ``stored`` with n_best and count_sum in place of their pairs."""
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    kind = stored.schema["doc_id"].dataType.simpleString()

    def score(batches):
        for batch in stepped(batches):
            pairs, times = batch.column("pairs"), batch.column("times").flatten().to_numpy().astype(np.int64)
            row = np.repeat(np.arange(len(batch)), np.asarray(pairs.value_lengths()))
            distinct, where = np.unique(pairs.flatten().to_numpy(), return_inverse=True)
            value = counts.values(keys_of(distinct))[where]
            best, total = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            np.add.at(best, row, times * (value & 1))
            np.add.at(total, row, times * (value >> 1))
            columns = [*(batch.column(c) for c in names), pa.array(best), pa.array(total), batch.column("groups_sha256")]
            yield pa.RecordBatch.from_arrays(columns, [*names, "n_best", "count_sum", "groups_sha256"])

    return stored.mapInArrow(
        score,
        f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
        "count_sum bigint, groups_sha256 string",
    )


def alignment(docs: DataFrame, byte_path: str, piece_path: str, **options) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 for every row."""
    stored = written(alignments(docs, byte_path, piece_path), "alignments")
    counts = written(pair_counts(stored), "pair-counts")
    return scored(stored, mapped.store(marked(counts), "pairs", **options))
