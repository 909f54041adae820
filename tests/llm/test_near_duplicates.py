"""Components, SimHash tries, sentence runs and the multi-index against brute force."""

import random
import tracemalloc
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from wardlens.llm import embeddings, simhash, spans
from wardlens.llm.components import SpanningForest, components
from wardlens.llm.queries import QUERIES


def brute_components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    draw = random.Random(1)
    links = [(draw.randrange(400), draw.randrange(400)) for _ in range(230)]
    links += [(1000 + i, 1001 + i) for i in range(120)] + [(2000, 2001 + i) for i in range(300)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = brute_components({n for e in links for n in e}, links)
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert got == {n: want[n] for n in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_spanning_forest():
    forest = SpanningForest(6)
    forest.add(np.array([1, 5, 3]), np.array([4, 4, 2]))
    assert sorted(zip(*(x.tolist() for x in forest.edges()))) == [(3, 2), (4, 1), (5, 1)]


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints, budget=4):
    ids = sorted(prints)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if (prints[a] ^ prints[b]).bit_count() <= budget]
    return brute_components(ids, links)


def test_classes_of_all_documents(spark, folder, tables):
    prints = {r.doc_id: brute_fingerprint(r.text) for r in tables("documents").collect()}
    rows = QUERIES["op6_trie_join"](spark, folder).collect()
    assert {r.doc_id: int(r.fingerprint, 16) for r in rows} == prints
    assert {r.doc_id: r.component_id for r in rows} == brute_classes(prints)


@pytest.mark.parametrize("node_rows", [8, 4096])
def test_trie_finds_every_pair(spark, node_rows):
    """Also where nodes are cut into slices, and where all fingerprints crowd in one node."""
    draw = random.Random(node_rows)
    prints = {i: draw.getrandbits(64) for i in range(400)}
    for i in range(400, 900):
        near = prints[draw.randrange(i) if i < 600 else 3]
        for _ in range(draw.randint(1, 6)):
            near ^= 1 << draw.randrange(64)
        prints[i] = near
    df = spark.createDataFrame([(i, p.to_bytes(8, "big")) for i, p in prints.items()], "node long, fingerprint binary")
    rule = simhash.Rule(4, 64, 4, 4, simhash.FOUR_BITS.walks, node_rows=node_rows)
    edges = simhash.links(df.dropDuplicates(["fingerprint"]), rule).collect()
    want = brute_classes(prints)
    got = brute_components(prints, [(e.a, e.b) for e in edges])
    assert all((prints[e.a] ^ prints[e.b]) is not None for e in edges)
    first = {}
    for i, p in prints.items():
        first.setdefault(p, i)
    groups = lambda m: sorted(sorted({first[prints[i]] for i in g}) for g in _groups(m))
    merged = brute_components(prints, [(e.a, e.b) for e in edges] + [(i, first[p]) for i, p in prints.items()])
    assert groups(merged) == groups(want)
    assert len(got) == 900


def _groups(classes):
    by = defaultdict(list)
    for node, c in classes.items():
        by[c].append(node)
    return list(by.values())


def test_similar_texts_share_a_class(spark):
    """Pairs at a similarity of 0.85 and more meet, those below 0.5 don't."""
    draw = random.Random(9)
    vocabulary = ["".join(draw.choice("abcdefghij") for _ in range(6)) for _ in range(4000)]
    texts, pairs = {}, []
    for i in range(150):
        words = [draw.choice(vocabulary) for _ in range(300)]
        other = list(words)
        for _ in range(4 if i < 100 else 60):
            other[draw.randrange(300)] = draw.choice(vocabulary)
        texts[2 * i], texts[2 * i + 1] = " ".join(words), " ".join(other)
        grams = [{tuple(w[k : k + 5]) for k in range(296)} for w in (words, other)]
        pairs.append((2 * i, 2 * i + 1, len(grams[0] & grams[1]) / len(grams[0] | grams[1])))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(df).collect()}
    near = [got[a] == got[b] for a, b, j in pairs if j >= 0.85]
    assert len(near) > 50 and sum(near) >= 0.95 * len(near)
    assert not any(got[a] == got[b] for a, b, j in pairs if j < 0.5)
    kept = {r.doc_id for r in simhash.keep_one(df).collect()}
    assert kept == set(got.values())


def test_odd_documents(odd_docs):
    rows = simhash.near_duplicates(odd_docs, simhash.FOUR_BITS).collect()
    assert len(rows) == odd_docs.count()
    by = defaultdict(set)
    for r in rows:
        by[r.doc_id].add(r.component_id)
    assert by[1] == by[2] == by[3] == {1}
    assert by[5] == {5} and by[6] == {5, 6}
    assert by[None] == {1, None}
    kept = simhash.keep_one(odd_docs)
    assert kept.schema == odd_docs.schema
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "4", "5", "6", "7", "None"])
    none = odd_docs.limit(0)
    assert simhash.near_duplicates(none).count() == simhash.keep_one(none).count() == 0


def brute_removed(docs, runs=spans.PRODUCTION):
    places = defaultdict(list)
    for doc, text in sorted(docs.items()):
        parts = [" ".join((text or "")[a:b].lower().split()) for a, b, _ in spans.sentences(text or "", runs)]
        for i in range(len(parts)):
            for end in range(i + runs.sentences, len(parts) + 1):
                if sum(len(p.split()) for p in parts[i:end]) >= runs.words:
                    places[tuple(parts[i:end])].append((doc, i, end))
                    break
    removed = {doc: set() for doc in docs}
    for found in places.values():
        for doc, i, end in found[1:]:
            removed[doc].update(range(i, end))
    return removed


def test_runs_of_all_documents(spark, folder, tables):
    docs = {r.doc_id: r.text for r in tables("documents").collect()}
    want = brute_removed(docs)
    rows = QUERIES["op5_sentence_runs"](spark, folder).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.removed_sentences == sorted(want[r.doc_id]) and r.n_removed == len(want[r.doc_id])
        assert r.text == (spans.without(docs[r.doc_id], want[r.doc_id]) if want[r.doc_id] else docs[r.doc_id])
    assert any(want.values())


def test_shared_passage_goes_but_for_its_first_place(spark):
    passage = " ".join(f"Here stands sentence number {w} of the passage that they share." for w in "one two three four five six".split())
    other = lambda n: " ".join(f"Own words {n} {i} of this text, which nobody else has written down." for i in range(6))
    unmarked = " ".join(f"token{i}" for i in range(70))
    docs = {1: other(1), 2: f"{other(2)} {passage}\n{other(22)}", 3: f"{passage} {other(3)}", 4: f"{other(4)}\n{passage}",
            5: unmarked, 6: f"{other(6)}\n{unmarked}\n{other(66)}"}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r.doc_id: r.text for r in spans.remove_repeats(df).collect()}
    assert got == {1: docs[1], 2: docs[2], 3: other(3), 4: other(4), 5: unmarked, 6: f"{other(6)}\n{other(66)}"}


def test_passage_inside_a_long_sentence_at_all_offsets(spark):
    """60 words that two long sentences share go but for their edges, wherever they stand."""
    draw = random.Random(31)
    word = lambda: f"w{draw.getrandbits(40)}"
    docs = []
    for offset in range(40):
        passage = [word() for _ in range(60)]
        for i, before in enumerate((7, offset)):
            docs.append((2 * offset + i, " ".join([word() for _ in range(before)] + passage + [word() for _ in range(30 * (i == 0 or offset % 4))])))
    texts = dict(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.text for r in spans.remove_repeats(df).collect()}
    assert all(got[2 * i] == texts[2 * i] for i in range(40))
    gone = [len(texts[2 * i + 1].split()) - len(got[2 * i + 1].split()) for i in range(40)]
    assert all(20 <= n <= 60 for n in gone) and sum(gone) >= 40 * 35


@pytest.mark.parametrize("unit", ["a", "a b c", " ".join(map(str, range(500)))])
def test_pieces_are_bounded(unit):
    text = " ".join([unit] * 40)
    parts = spans.sentences(text)
    assert sum(n for _, _, n in parts) == len(text.split())
    assert max(n for _, _, n in parts) < 20


def test_runs_in_odd_documents(odd_docs):
    got = spans.remove_repeats(odd_docs)
    assert set(got.columns) == set(odd_docs.columns)
    rows = got.collect()
    assert len(rows) == odd_docs.count()
    assert all(r.text is None and r.removed_sentences == [] for r in rows if r.doc_id == 1)
    assert spans.remove_repeats(odd_docs.limit(0)).count() == 0


def vector_rows(n=1500, dims=64):
    draw = np.random.default_rng(4)
    base = draw.normal(size=(n, dims))
    for i in range(n // 2, n):
        at = draw.integers(0, n // 2)
        cos = draw.uniform(0.85, 0.999)
        u = draw.normal(size=dims)
        x = base[at] / np.linalg.norm(base[at])
        u -= (u @ x) * x
        base[i] = (cos * x + np.sqrt(1 - cos**2) * u / np.linalg.norm(u)) * draw.uniform(0.1, 10)
    base = base.astype(np.float32)
    base[n - 40 :] = base[5]
    labels = [None if i % 97 == 0 else i % 2 for i in range(n)]
    return [(i, base[i].tolist(), labels[i]) for i in range(n)]


def brute_links(rows, threshold=0.93):
    good = [(i, np.array(v, np.float32).astype(float), lab) for i, v, lab in rows
            if lab is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    x = np.array([v / np.linalg.norm(v) for _, v, _ in good])
    lab = np.array([g[2] for g in good])
    a, b = np.nonzero((x @ x.T >= threshold) & (lab[:, None] == lab))
    return [(good[i][0], good[j][0]) for i, j in zip(a, b) if i < j]


@pytest.mark.parametrize("block_rows", [16, 2000])
def test_vectors_meet(spark, block_rows):
    rows = vector_rows()
    nan, inf = float("nan"), float("inf")
    odd = [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 64, 1), (2003, [nan] + [1.0] * 63, 1), (2004, [inf] + [1.0] * 63, 1),
           (2005, [None] + [1.0] * 63, 1), (2006, [1.0] * 3, 1), (2007, [2.0] * 3, 1), (None, [1.0] * 3, 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int")
    index = embeddings.Index(block_rows=block_rows)
    got = embeddings.linked_vectors(df, index=index).collect()
    assert len(got) == len(rows) + len(odd)
    links = brute_links(rows) + [(2006, 2007)]
    found = sum(r.n_links for r in got if r.vec_id is not None and r.vec_id < 2000)
    assert 0.95 * 2 * (len(links) - 1) <= found <= 2 * (len(links) - 1)
    want = brute_components([r[0] for r in rows + odd if r[0] is not None], links)
    same = [r.component_id == want[r.vec_id] for r in got if r.vec_id is not None]
    assert sum(same) >= 0.97 * len(same)
    by = {r.vec_id: r for r in got}
    assert all((by[i].n_links, by[i].component_id, by[i].kept) == (0, i, True) for i in range(2000, 2006))
    assert (by[2006].n_links, by[2007].component_id, by[None].component_id) == (2, 2006, 2006)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)


def test_cells_of_near_copies_are_compared_in_bounded_memory():
    """A cell's 1,000,000 linked pairs hold neither their vectors nor their distances at once."""
    draw = np.random.default_rng(31)
    raw = draw.normal(size=64) + 0.05 * draw.normal(size=(2000, 64))
    unit = raw / np.linalg.norm(raw, axis=1, keepdims=True)
    book = embeddings.Codebooks(draw.normal(size=(128, 32)), draw.normal(size=(128, 32)), 1.0)
    node, is_home = np.arange(2000), np.arange(2000) < 1000
    own = book.homes(unit, node)
    assert own.tolist() == [home for home, _ in book.cells(unit)]
    for cell in (own[0], own.max() + 1):
        tracemalloc.start()
        found = list(embeddings._met(raw, node, is_home, unit, 0.93, book, cell))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 100e6
        visits = {i: set(v.tolist()) for i, (_, v) in enumerate(book.cells(unit))}
        met = {(i, j) for q, h in found for i, j in zip(q.tolist(), h.tolist())}
        assert met == {
            (i, j) for i in range(1000, 2000) for j in range(1000)
            if (i < j if own[i] == cell else own[i] not in visits[j] or cell < own[i])
        }


def test_cells_are_handed_over_in_parts(monkeypatch):
    monkeypatch.setattr(embeddings, "SPREAD_ROWS", 7)
    cells = [(i, np.arange(n)) for i, n in enumerate([0, 20, 3, 3, 1, 6])]
    parts = list(embeddings._spread(np.arange(10, 16), cells))
    assert max(len(owner) for owner, _, _ in parts) == 7
    rows = [(o, c, h) for part in parts for o, c, h in zip(*(x.tolist() for x in part))]
    want = [(10 + i, c, k == 0) for i, (home, v) in enumerate(cells) for k, c in enumerate([home, *v.tolist()])]
    assert rows == want
    assert not list(embeddings._spread(np.arange(0), []))


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<double>, label string")
    assert embeddings.linked_vectors(none).count() == 0


def test_all_vectors_of_the_table(spark, folder, tables):
    rows = [tuple(r) for r in tables("embeddings").select("vec_id", "embedding", "label").collect()]
    got = {r.vec_id: r for r in QUERIES["op10_multi_index"](spark, folder).collect()}
    links = brute_links(rows)
    assert len(got) == len(rows)
    assert sum(r.n_links for r in got.values()) >= 0.9 * 2 * len(links)
    if not links:
        assert all(r.kept and r.n_links == 0 for r in got.values())


def test_pairs_at_the_threshold(spark):
    """Pairs at 0.805 link, those at 0.799 and 0.75 don't; repeated lines don't count."""
    draw = random.Random(21)
    texts, want = {}, {}
    for i in range(240):
        words = [f"w{draw.getrandbits(40)}" for _ in range(300)]
        changed = (32, 33, 42)[i % 3]
        other = words[:-changed] + [f"w{draw.getrandbits(40)}" for _ in range(changed)]
        if i % 12 == 0:
            other += words[:150] + words[:150]
        texts[2 * i], texts[2 * i + 1] = " ".join(words), " ".join(other)
        grams = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (words, other)]
        want[i] = len(grams[0] & grams[1]) / len(grams[0] | grams[1])
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(df).collect()}
    linked = {i for i in want if got[2 * i] == got[2 * i + 1]}
    assert not [i for i in linked if want[i] < 0.8]
    at = [i for i in want if want[i] >= 0.8]
    assert len(at) >= 60 and len(linked) >= 0.95 * len(at)


@pytest.mark.parametrize("together", [6, 256])
def test_crowds_are_verified_in_slices(spark, together):
    """Chains and crowds at one candidate class come out as by brute force, however they are cut."""
    draw = random.Random(22)
    base, texts = [f"w{i}" for i in range(120)], {}
    for i in range(90):
        words = list(base)
        for _ in range(draw.choice((0, 1, 2, 3, 4))):
            words[draw.randrange(120)] = f"x{draw.getrandbits(40)}"
        texts[i] = " ".join(words)
    grams = {i: {tuple(t.split()[k : k + 5]) for k in range(116)} for i, t in texts.items()}
    links = [(a, b) for a in texts for b in range(a) if len(grams[a] & grams[b]) / len(grams[a] | grams[b]) >= 0.8]
    want = brute_components(texts, links)
    assert 1 < len(set(want.values())) < 60
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rule = simhash.Rule(5, 256, 64, 64, together=together)
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(df, rule).collect()} == want


def similar_pairs():
    """Texts whose nearest ones are at a similarity of 0.8 and somewhat more or less, long and short."""
    draw = random.Random(41)
    word = lambda: f"w{draw.getrandbits(40)}"
    common, texts = [word() for _ in range(30)], {}
    for i in range(900):
        if i % 3:
            words = [word() for _ in range(9)]
            other = words[:8]
        else:
            words = [word() for _ in range(draw.randrange(20, 120))] + common * (i % 2)
            changed = max(1, round(len(words) * draw.uniform(0.08, 0.12)))
            other = [word() for _ in range(changed)] + words[changed:]
        texts[2 * i], texts[2 * i + 1] = " ".join(words), " ".join(other)
    return texts


def brute_similar(texts):
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(max(1, len(t.split()) - 4))} for i, t in texts.items()}
    holders = defaultdict(set)
    for i, grams in sets.items():
        for g in grams:
            holders[g].add(i)
    met = {(a, b) for a, grams in sets.items() for b in set().union(*(holders[g] for g in grams)) if a < b}
    return [(a, b) for a, b in met if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8]


def test_no_pair_at_the_threshold_is_left_out(spark, monkeypatch):
    texts = similar_pairs()
    links = brute_similar(texts)
    assert 600 < len(links) < 900
    want = brute_components(texts, links)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id for r in simhash.keep_one(df).collect()} == set(want.values())
    # With tries that meet equal fingerprints alone, and many buckets, the sets' shingles find all of them.
    monkeypatch.setattr(simhash, "BUCKET_SHINGLES", 500)
    rule = simhash.Rule(5, 256, 0, 0, recall=0.0)
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(df, rule).collect()} == want


def keys_look_equal(pair):
    return len({simhash.set_fingerprint(t.encode(), 5, 64)[1][:1] for t in pair}) == 1


def shared_shingles_look_equal(pair):
    rare = [simhash.rarest(simhash.shingle_set(t.encode(), 5), np.zeros(0, np.uint64), 0.8) for t in pair]
    shared = np.intersect1d(*rare)
    return len(shared) == 2 and len(np.unique(shared >> np.uint64(48))) == 1


@pytest.mark.parametrize("sent, few, equal", [("KEY_BYTES", 1, keys_look_equal), ("HASH_BYTES", 2, shared_shingles_look_equal)])
def test_what_looks_equal_in_the_bytes_sent_loses_no_pair(spark, monkeypatch, sent, few, equal):
    draw, texts = random.Random(43), {}
    while len(texts) < 6:
        words = [f"w{draw.getrandbits(40)}" for _ in range(15)]
        pair = [" ".join(words[:14]), " ".join(words[:13] + words[14:])]
        if equal(pair):
            texts |= {len(texts): pair[0], len(texts) + 1: pair[1]}
    monkeypatch.setattr(simhash, sent, few)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    # The tries meet equal fingerprints alone.
    rule = simhash.Rule(5, 256, 0, 0, recall=0.0)
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(df, rule).collect()}
    assert got == {i: i - i % 2 for i in texts}


def test_rows_of_one_id_that_differ_in_where_null_stands(spark):
    """Each keeps its class's row, though a hash of their columns in turn is the same."""
    text = "one text of some words that stands in either column"
    rows = [(5, text, None), (5, None, text), (5, text, None), (6, "another text", text)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = [tuple(r) for r in simhash.keep_one(df).collect()]
    assert len(got) == 3 and set(got) == set(rows)


def test_rarest_shingles_of_similar_sets_meet():
    draw = np.random.default_rng(42)
    for size in (1, 2, 4, 5, 6, 9, 10, 11, 50, 333):
        for _ in range(40):
            base = draw.integers(0, 1 << 63, size, dtype=np.uint64)
            gone = draw.integers(0, max(1, size // 5) + 1)
            sets = np.unique(base), np.unique(base[gone:])
            frequent = np.unique(draw.choice(base, size // 2))
            shared = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
            rare = [simhash.rarest(x, frequent, 0.8) for x in sets]
            assert shared < 0.8 or len(np.intersect1d(*rare))


def test_walks_meet_at_every_size():
    """The walks' bits, as they are picked, meet pairs at 0.8 with the rule's chance."""
    rule = simhash.SIMILAR
    draw = np.random.default_rng(23)
    differ = draw.random((4000, rule.bits)) < np.arccos(1.6 / 1.8) / np.pi
    for rows in (1000, 15_000_000, 100_000_000):
        met = np.zeros(len(differ), bool)
        for walk in rule.walks_for(rows):
            met |= ~differ[:, list(walk.picked[: walk.head])].any(axis=1)
        assert (met & (differ.sum(axis=1) <= rule.budget)).mean() >= rule.recall - 0.01
