"""Repeated bytes by merged transforms against a table of all substrings."""

import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardlens.llm import bwt, queries

from conftest import DOCS


def brute(texts, length):
    """Maximal covered byte ranges of each text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        ranges = []
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                if ranges and i <= ranges[-1][1]:
                    ranges[-1][1] = i + length
                else:
                    ranges.append([i, i + length])
        out.append([tuple(r) for r in ranges])
    return out


def check(spark, texts, length, partitions=3):
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    found = {r.doc_id: [tuple(x) for x in r.repeated] for r in bwt.repeated_bytes(docs, match=bwt.Match(length)).collect()}
    assert [found[i] for i in range(len(texts))] == brute(texts, length)


def test_query_equals_all_substrings(spark, folder, tables):
    docs = tables("documents").orderBy("doc_id").collect()
    want = {}
    for r, ranges in zip(docs, brute([r.text for r in docs], 200)):
        raw, kept, at = (r.text or "").encode(), b"", 0
        for a, b in ranges:
            kept, at = kept + raw[at:a], b
        kept += raw[at:]
        want[r.doc_id] = (len(raw), sum(b - a for a, b in ranges), len(ranges), hashlib.sha256(kept).hexdigest())
    rows = queries.QUERIES["op11_merged_transforms"](spark, folder).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == want
    assert len(rows) == len(docs) and any(r.n_removed for r in rows)


@pytest.mark.parametrize("shard_bytes", [2_000, 1 << 24])
def test_passages_at_all_offsets(spark, monkeypatch, shard_bytes):
    monkeypatch.setattr(bwt, "SHARD_BYTES", shard_bytes)
    draw = random.Random(3)
    noise = lambda n: "".join(draw.choice("abcdefghij é") for _ in range(n))
    passage, texts = noise(260), []
    for n in (39, 40, 41, 60, 199, 200, 201, 260):
        a, b = draw.randint(0, 60), draw.randint(0, 90)
        texts += [noise(a) + passage[:n] + noise(b), noise(b) + passage[:n], passage[260 - n :] + noise(a)]
    texts += [passage[k : k + 45] + noise(30) for k in range(0, 215, 7)]
    edited = list(noise(3000))
    for k in range(40):
        edited[draw.randrange(3000)] = "X"
        texts.append("".join(edited))
    check(spark, texts, 40)
    check(spark, texts, 200)


def test_low_variety(spark):
    texts = ["a" * 39, "a" * 40, "a" * 41, "a" * 500, "ab" * 100, "b" * 20 + "ab" * 15, "abc" * 40 + "x" + "abc" * 12,
             "x" * 30 + "y" * 30, "y" * 30 + "x" * 30, "xy" * 21, "", None, "é" * 25, "漢" * 14, "hello " * 50 + "end"]
    check(spark, texts, 40)
    check(spark, texts, 200)


def test_many_copies_and_long_texts(spark):
    draw = random.Random(8)
    base = "".join(draw.choice("abcd ") for _ in range(1500))
    long_text = "".join(draw.choice("abcdefgh ") for _ in range(40_000))
    texts = [base] * 60 + [base[:700] + "!" + base[701:]] * 3 + [long_text, long_text[5000:25000] + "z", base + long_text[:300]]
    check(spark, texts, 200, partitions=7)


def test_a_text_longer_than_a_piece(spark, monkeypatch):
    monkeypatch.setattr(bwt, "PIECE", 1000)
    data = np.frombuffer(random.Random(4).randbytes(12_345), np.uint8)
    match = bwt.Match(200)
    whole = bwt.cuts(data, match)
    at = np.arange(0, 12_000, 7)
    hashes = bwt.range_hashes(data, at, at + 200)
    monkeypatch.setattr(bwt, "PIECE", 1 << 20)
    assert (bwt.cuts(data, match) == whole).all() and np.diff(whole).max() <= match.window
    assert len(set(hashes.tolist())) == len(at)
    assert (bwt.range_hashes(data[500:], at[200:220] - 500, at[200:220] - 300) == hashes[200:220]).all()


def test_odd_rows(spark, odd_docs):
    rows = bwt.repeated_bytes(odd_docs).collect()
    assert len(rows) == odd_docs.count() and set(rows[0].asDict()) == {*odd_docs.columns, "repeated"}
    copies = odd_docs.withColumn("text", F.when(F.col("doc_id") == 5, F.repeat("text", F.lit(9))).otherwise(F.col("text")))
    kept = bwt.without_ranges(bwt.repeated_bytes(copies)).collect()
    fives = [r for r in kept if r.doc_id == 5]
    assert len(fives) == 2 and all(r.kept == b"" and len(r.repeated) == 1 for r in fives)
    assert all(r.kept == (r.text or "").encode() for r in kept if r.doc_id not in (4, 5))
    assert bwt.repeated_bytes(spark.createDataFrame([], DOCS)).collect() == []


def test_transform_step_gives_the_intervals_of_longer_strings():
    draw = random.Random(2)
    syms = np.array([draw.randrange(1, 6) for _ in range(300)], "<u8")
    row = {"syms": syms.tobytes(), "counts": [101, 201, 1], "answers": None,
           "begins": np.r_[np.arange(101), np.arange(201), 0].astype("<i4").tobytes()}
    state = bwt._transform(row, 1, 99)
    texts = [syms[:100].tolist(), syms[100:].tolist()]
    for depth in range(2, 8):
        longer = bwt._longer({k: np.asarray(v) for k, v in state.items()})
        times = Counter(tuple(t[i : i + depth]) for t in texts for i in range(len(t) - depth + 1))
        assert sorted(longer["size"].tolist()) == sorted(times.values())
        for low, size in zip(longer["low"], longer["size"]):
            at = np.asarray(state["place"])[low : low + size]
            assert len({tuple(syms[p : p + depth].tolist()) for p in at}) == 1
        state = {**state, **longer}


def test_places_before_follow_from_the_transform():
    draw = random.Random(5)
    syms = np.array([draw.randrange(1, 5) for _ in range(400)], "<u8")
    row = {"syms": syms.tobytes(), "counts": [151, 251], "answers": None,
           "begins": np.r_[np.arange(151), np.arange(251)].astype("<i4").tobytes()}
    state = bwt._transform(row, 1, 99)
    assert "before" not in state and "before" not in bwt._TYPES
    before, place = bwt._before(np.asarray(state["bwt"])), np.asarray(state["place"])
    assert sorted(before.tolist()) == list(range(len(before)))
    texts = [syms[:150].tolist(), syms[150:].tolist()]
    reads = lambda p: (texts[0] + [0] + texts[1] + [0])[p + (p >= 150) :][: bwt.STEPS]
    inner = [i for i in range(len(before)) if place[i] not in (-1, 0, 150)]
    assert all(reads(place[before[i]]) == reads(place[i] - 1) for i in inner)


def test_refinement_keeps_what_is_read_later_only(spark, tmp_path):
    draw = random.Random(6)
    words = ["".join(draw.choice("abcdefgh") for _ in range(7)) for _ in range(900)]
    passage = " ".join(draw.choice(words) for _ in range(90))
    texts = [" ".join(draw.choice(words) for _ in range(60)) + passage[k:] for k in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    keyed = docs.select(F.col("doc_id").alias("_i"), F.xxhash64("text").alias("_h"), F.col("text").cast("binary").alias("_t"))
    shards = bwt._shards(keyed, bwt.Match(200), "bigint")
    folder = shards.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0].replace("//", "/")
    root, own = os.path.split(folder)
    present = {d for d in os.listdir(root)}
    prefixes, bare, depth = bwt.common_prefixes(shards, bwt.Match(200))
    assert depth > 2 and "syms" not in bare.columns and own not in os.listdir(root)
    left = [d.split("-")[0] for d in os.listdir(root) if d not in present]
    assert left.count("transforms") == 1 and left.count("places") == 1
    assert prefixes.count() == bare.count() > 0
