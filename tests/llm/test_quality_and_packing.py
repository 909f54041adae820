"""Compression bands and histogram packing against brute force."""

import random
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import zstandard
from tokenizers import Tokenizer

from wardlens.llm import packing, quality
from wardlens.llm.common import placed_in_keys
from wardlens.llm.queries import QUERIES

JSON, RANKS = (public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken"))


def brute_measures(text):
    text = text or ""
    words = text.encode().split()
    found = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {i + k for i in range(len(words) - 2) if found[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    chars = sum(len(w.decode()) for w in words)
    return len(words), chars, sum(text.count(c) for c in "#*$%&|<>"), dup, len(inside), failed


def test_measures_of_all_documents(spark, folder, tables):
    texts = {r.doc_id: r.text for r in tables("documents").collect()}
    rows = QUERIES["op7_compression_bands"](spark, folder).collect()
    assert len(rows) == len(texts)
    compressor = zstandard.ZstdCompressor(level=3)
    for r in rows:
        assert tuple(r)[1:7] == brute_measures(texts[r.doc_id])
        raw = (texts[r.doc_id] or "").encode()
        if raw:
            assert abs(r.whole_ratio - len(compressor.compress(raw)) / len(raw)) < 1e-12
        assert not (r.kept and r.base_failed)


def test_bands_reject_both_ends(spark):
    draw = random.Random(3)
    prose = " ".join("".join(draw.choice("etaoinshrdlu") for _ in range(draw.randint(2, 9))) for _ in range(1500))
    noise = "".join(chr(draw.randint(33, 126)) + (" " if i % 40 == 39 else "") for i in range(9000))
    repeat = " ".join(f"{w} {i % 7}" for i, w in enumerate(["same words again with more"] * 900))
    docs = spark.createDataFrame([(1, prose), (2, noise), (3, repeat)], "doc_id long, text string")
    assert {r.doc_id: r.kept for r in quality.measure(docs).collect()} == {1: True, 2: False, 3: False}
    assert [r.doc_id for r in quality.keep_good(docs).collect()] == [1]


def test_odd_documents_and_empty_tables(odd_docs):
    rows = quality.measure(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.n_words == 0 and r.whole_ratio is None for r in rows if r.doc_id in (1, 2))
    assert quality.keep_good(odd_docs).schema == odd_docs.schema
    none = odd_docs.limit(0)
    assert quality.measure(none).count() == quality.keep_good(none).count() == 0
    assert packing.pack(packing.cut_documents(none, JSON, RANKS)).count() == 0


def brute_pieces(text, tokenizer, capacity=2048):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
    head = len(ids) % capacity
    cuts = ([0] if head else []) + list(range(head, len(ids) + 1, capacity))
    return [(p, a, ids[a:b]) for p, (a, b) in enumerate(zip(cuts, cuts[1:]))]


def check_packing(rows):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    return len(by)


def test_packing_of_all_documents(spark, folder, tables):
    tokenizer = Tokenizer.from_file(JSON)
    want = {}
    for r in tables("documents").collect():
        for piece, start, ids in brute_pieces(r.text, tokenizer):
            raw = b"".join(i.to_bytes(4, "little") for i in ids)
            want[r.doc_id, piece] = (start, len(ids), zlib.crc32(raw))
    rows = QUERIES["op8_histogram_packing"](spark, folder).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want
    total = sum(length for _, length, _ in want.values())
    assert check_packing(rows) <= -(-total // 2048) * 1.02 + 1


def test_sequences_hold_their_documents(odd_docs):
    pieces = packing.cut_documents(odd_docs, JSON, RANKS)
    packed = packing.pack(pieces).cache()
    rows = packed.collect()
    tokenizer = Tokenizer.from_file(JSON)
    want = Counter(
        tuple(ids) for r in odd_docs.collect() for _, _, ids in brute_pieces(r.text, tokenizer)
    )
    ids_of = lambda raw: tuple(int.from_bytes(raw[i : i + 4], "little") for i in range(0, len(raw), 4))
    assert Counter(ids_of(bytes(r.ids)) for r in rows) == want
    check_packing(rows)
    whole = {r.sequence_id: bytes(r.ids) for r in packing.assemble(packed).collect()}
    for r in rows:
        assert whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)


def test_plan_fills_each_rank_once():
    draw = random.Random(5)
    counts = {length: draw.randint(1, 400) for length in draw.sample(range(1, 101), 60)}
    plan = packing.best_fit_plan(counts, 100)
    used = defaultdict(int)
    for length, group in counts.items():
        ranks = sorted((a, b) for n, a, b, *_ in plan if n == length)
        assert ranks[0][0] == 0 and ranks[-1][1] == group
        assert all(x[1] == y[0] for x, y in zip(ranks, ranks[1:]))
    for length, a, b, items, first, _ in plan:
        assert (b - a) % items == 0
        for s in range(first, first + (b - a) // items):
            used[s] += items * length
    assert max(used.values()) <= 100
    gaps, opened = Counter(), 0
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            gap = min((g for g, n in gaps.items() if n and g >= length), default=None)
            if gap is None:
                gap, opened = 100, opened + 1
            else:
                gaps[gap] -= 1
            gaps[gap - length] += 1
    assert len(used) == opened


def test_ranks_of_a_hot_key(spark):
    rows = [(None if i % 50 == 0 else "hot" if i % 3 else f"k{i % 7}", i, i % 11) for i in range(5000)]
    df = spark.createDataFrame(rows, "key string, id long, w long")
    got = placed_in_keys(df, ["key"], ["id"], "rank", "w", "start").collect()
    by = defaultdict(list)
    for r in got:
        by[r.key].append((r["rank"], r.start, r.w))
    assert len(got) == 5000
    for parts in by.values():
        at = 0
        for i, (rank, start, w) in enumerate(sorted(parts)):
            assert (rank, start) == (i, at)
            at += w
