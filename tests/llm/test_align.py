"""Alignment of two tokenizers against loops over bytes."""

import collections
import hashlib

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from citysignal.llm import align
from citysignal.llm.queries import BYTES, PIECES, QUERIES

SF = "/root/testdata/sf0.001"


def brute(texts):
    """By row: (n_a, n_b, n_groups, n_links, n_best, count_sum, digest)."""
    a_side = Tokenizer.from_file(public_tokenizers.path(BYTES))
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECES))
    letters = align.byte_letters()
    rows, count = [], collections.Counter()
    for text in texts:
        if not text:
            rows.append(None)
            continue
        encoded = a_side.encode(" " + text, add_special_tokens=False)
        spans_a, spans_b, at = [], [], 0
        for i, piece in zip(encoded.ids, encoded.tokens, strict=True):
            raw = bytes(letters[c] for c in piece)
            spans_a.append((i, at, at + len(raw), raw))
            at += len(raw)
        at = 0
        for i in b_side.encode(text):
            piece = b_side.id_to_piece(i)
            raw = bytes([int(piece[3:5], 16)]) if b_side.is_byte(i) else piece.replace("▁", " ").encode()
            spans_b.append((i, at, at + len(raw), raw))
            at += len(raw)
        if {b"".join(s[3] for s in spans) for spans in (spans_a, spans_b)} != {(" " + text).encode()}:
            rows.append(None)
            continue
        links, low = [], 0
        for i, start, end, _ in spans_a:
            while spans_b[low][2] <= start:
                low += 1
            k = low
            while k < len(spans_b) and spans_b[k][1] < end:
                links.append((i, spans_b[k][0]))
                k += 1
        count.update(links)
        ends = sorted({s[2] for s in spans_a} & {s[2] for s in spans_b})
        groups, last = [], 0
        for end in ends:
            sides = (",".join(str(i) for i, s, e, _ in spans if last <= s and e <= end) for spans in (spans_a, spans_b))
            groups.append("|".join(sides))
            last = end
        rows.append((len(spans_a), len(spans_b), links, ";".join(groups)))
    best = collections.defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for row in rows:
        if row is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, links, groups = row
        digest = hashlib.sha256(groups.encode()).hexdigest()
        marks = sum(count[x] == best[x[1]] for x in links)
        out.append((n_a, n_b, groups.count(";") + 1, len(links), marks, sum(count[x] for x in links), digest))
    return out


def fields(r):
    return r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    docs = [d for d in docs if len(d.text) < 6000] + [d for d in docs if len(d.text) >= 6000]
    got = {r.doc_id: fields(r) for r in QUERIES["op12_aligned_tokens"](spark, SF).collect()}
    assert got == {d.doc_id: x for d, x in zip(docs, brute([d.text for d in docs]), strict=True)}


def test_awkward_texts(spark, monkeypatch):
    texts = [None, "", " ", "\n", "plain words here", "plain words here", "▁ mark", "  two  spaces \n\t x", "<|endoftext|> <s></s> <unk> <0x41>"]
    texts += ["ü\U0001f600 é 　日本語 ligature ﬁ ½", "\x00\x01\x7f", "a" * 3000 + " " * 500 + "b", "many words go round " * 4000]
    rows = [(i, t, "X", [1], "p", 3) for i, t in enumerate(texts)] + [(None, "plain words", None, None, None, None)]
    spark.conf.set("spark.sql.caseSensitive", "true")
    docs = spark.createDataFrame(rows, "doc_id long, text string, TEXT string, pairs array<int>, key string, n int")
    paths = public_tokenizers.path(BYTES), public_tokenizers.path(PIECES)
    got = align.alignment(docs.repartition(3), *paths, shard_keys=10).collect()
    spark.conf.unset("spark.sql.caseSensitive")
    found = {r.doc_id: fields(r) for r in got}
    wanted = brute([r[1] for r in rows])
    assert len(got) == len(rows) and found == {r[0]: w for r, w in zip(rows, wanted, strict=True)}
    assert found[6][0] == 0 and found[4][0] > 0 and found[8][0] > 0
    assert align.alignment(docs.limit(0), *paths).count() == 0


def test_texts_are_cut_at_single_spaces():
    texts = ["", "word", "a b c", "a  b", "ü b", "a b ", " a b", "a \t b c d", "x" * 50, "one two three four five six"]
    for text in texts:
        assert " ".join(align.parts_of(text, 2)) == text
    assert align.parts_of("one two  three ü four five", 2) == ["one", "two  three ü four", "five"]
    assert len(align.parts_of("a" * 3_000_000)) == 1


def test_tasks_send_pairs_in_flushes(spark, monkeypatch):
    rows = [(i, [i % 7, 7 + i % 5], [1, 2]) for i in range(100)]
    stored = spark.createDataFrame(rows, "doc_id long, pairs array<bigint>, times array<int>").coalesce(1)
    monkeypatch.setattr(align, "FLUSH_PAIRS", 12)
    got = sorted(r.n for r in align.pair_counts(stored).collect())
    assert got == sorted([*collections.Counter(i % 7 for i in range(100)).values(), *[40] * 5])
