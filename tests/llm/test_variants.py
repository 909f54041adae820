"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from wardlens.llm import queries, variants

from conftest import DOCS


def brute_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            mark = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if mark % 31 == 0:
                at = mark % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def brute(words, ratio=10):
    """Near words share a text with one code point less, or differ in one place."""
    shorter, holes = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            shorter[w[:i] + w[i + 1 :]].add(w)
            holes[w[:i], w[i + 1 :]].add(w)
    near = defaultdict(set)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    for w in words:
        for longer in shorter.get(w, ()):
            near[w].add(longer)
            near[longer].add(w)
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        if best is not None and words[best] >= ratio * words[w]:
            forms[w] = best
    out = {}
    for w, n in words.items():
        root = w
        while root in forms:
            root = forms[root]
        form = forms.get(w)
        out[w] = (form, root, n, len(near[w]), words[form] if form else None)
    return out


def got(df):
    rows = df.collect()
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(found) == len(rows)
    return found


def test_query_equals_all_pairs(spark, folder, tables):
    docs = tables("documents").select("doc_id", "text").collect()
    found = got(queries.QUERIES["op12_dense_tiles"](spark, folder))
    assert found == brute(brute_words([(r.doc_id, r.text) for r in docs]))
    assert any(v[0] for v in found.values())


@pytest.mark.parametrize("block", [3, 512])
def test_crowded_buckets_and_chains(spark, block):
    draw = random.Random(5)
    words = {"".join(draw.choice("abé") for _ in range(draw.randint(7, 9))): draw.randint(1, 10**6) for _ in range(700)}
    words |= {"prefixed" + "".join(draw.choice("abcdefgh") for _ in range(2)) + "suffixed": 3 for _ in range(90)}
    words |= {"w" * n: 10**k for k, n in enumerate(range(7, 14))}
    words |= {"漢字" * 4: 5, "漢字" * 4 + "漢": 50, "x" * 3000: 2, "x" * 3001: 30}
    counts = spark.createDataFrame(list(words.items()), "word string, n long")
    found = got(variants.group_variants(counts, block=block))
    assert found == brute({w: n for w, n in words.items() if n >= 2})
    assert found["w" * 8][1] == "w" * 13 and found["x" * 3000][0] == "x" * 3001


def test_prefix_and_suffix_decide(spark):
    pairs = [("letters", "lettters", True), ("letters", "leters", True), ("letters", "letterz", True),
             ("letters", "eltters", False), ("letters", "letter", True), ("letters", "lettersxx", False),
             ("aaaaaaa", "aaaaaaaa", True), ("abababab", "babababa", False)]
    for a, b, near in pairs:
        words = spark.createDataFrame([(a, 2), (b, 40)], "word string, n long")
        assert got(variants.group_variants(words))[a][3] == near, (a, b)


def test_odd_rows(spark, odd_docs):
    text = " Ärgerlich ärgerlich ÄRGERLICH ×÷abcdefg" * 3
    long_word = "x" * 400_000
    more = spark.createDataFrame([(9, f"{long_word} {long_word} {long_word}y {long_word}y {text}", "en", "s", 1)], DOCS)
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    found = got(variants.group_variants(variants.word_counts(
        odd_docs.select("doc_id", "text").union(more.select("doc_id", "text")), slip_every=0
    )))
    assert found.pop(long_word) == (None, long_word, 2, 1, None)
    assert found.pop(long_word + "y") == (None, long_word + "y", 2, 1, None)
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame([(9, text)], "doc_id long, text string"))
    assert got(variants.group_variants(variants.word_counts(docs))) == brute(brute_words([*rows, (9, text)]))
    assert {"Ärgerlich", "ärgerlich"} <= set(found)


def test_empty_tables(spark):
    assert variants.group_variants(variants.word_counts(spark.createDataFrame([], DOCS))).collect() == []
    words = spark.createDataFrame([(None, 5), ("", 4), ("a", 4), ("b", 50)], "word string, n long")
    assert got(variants.group_variants(words)) == brute({"": 4, "a": 4, "b": 50})
