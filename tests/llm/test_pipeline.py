"""The pipeline's rows against its stages done by hand."""

from collections import Counter, defaultdict

import pytest

import corpus_pipeline as pipeline
from wardlens.llm import quality, simhash, spans
from wardlens.llm.common import AT_ONCE, map_batches

from test_mixing_and_sharding import brute_targets
from test_near_duplicates import brute_removed
from test_quality_and_packing import check_packing


def grams(text):
    words = text.lower().encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_stages_are_the_ordered_five():
    assert [name for name, _ in pipeline.STAGES] == [
        "quality_rules", "simhash_near_dedup", "substring_dedup", "mix_sources", "best_fit_packing"
    ]


def test_each_stage_does_its_work_on_what_the_last_kept(spark, folder, tables):
    docs = tables("documents").cache()
    states = [docs]
    for _, step in pipeline.STAGES:
        states.append(step(spark, states[-1], folder).cache())
    assert all(s.columns == docs.columns for s in states[1:-1])
    rows = [s.collect() for s in states]

    verdicts = {r.doc_id: r.kept for r in quality.measure(docs).collect()}
    assert {r.doc_id for r in rows[1]} == {i for i, kept in verdicts.items() if kept}

    kept = {r.doc_id for r in rows[2]}
    texts = {r.doc_id: r.text for r in rows[1]}
    shingles = {i: grams(t) for i, t in texts.items()}
    likeness = lambda a, b: len(shingles[a] & shingles[b]) / len(shingles[a] | shingles[b])
    ids = sorted(texts)
    near = [(a, b) for i, b in enumerate(ids) for a in ids[:i] if likeness(a, b) >= 0.85]
    assert sum(not (a in kept and b in kept) for a, b in near) >= 0.95 * len(near)
    gone = [i for i in ids if i not in kept]
    assert all(max(likeness(i, k) for k in ids if k != i) >= 0.5 for i in gone)

    left = {r.doc_id: r.text for r in rows[2]}
    removed = brute_removed(left)
    want = {i: spans.without(t, removed[i]) if removed[i] else t for i, t in left.items()}
    assert {r.doc_id: r.text for r in rows[3]} == {i: t for i, t in want.items() if t}
    assert all(r.n_chars == len(r.text) for r in rows[3] if removed[r.doc_id])

    sizes, most = Counter(), defaultdict(int)
    for r in rows[3]:
        sizes[r.source] += len(r.text.encode().split())
        most[r.source] = max(most[r.source], len(r.text.encode().split()))
    mixed = Counter()
    for r in rows[4]:
        mixed[r.source] += len(r.text.encode().split())
    for source, target in brute_targets(sizes).items():
        assert abs(mixed[source] - target) <= most[source]
    assert max(Counter(r.doc_id for r in rows[4]).values()) <= 3

    pieces = Counter((r.doc_id, r.piece) for r in rows[5])
    copies = Counter(r.doc_id for r in rows[4])
    assert {i: n for (i, piece), n in pieces.items() if piece == 0} == dict(copies)
    total = sum(r.length for r in rows[5])
    assert check_packing(rows[5]) <= 1.02 * total / 2048 + 1


def test_run_equals_the_stages(spark, folder):
    rows = pipeline.run(spark, folder).collect()
    assert rows and {"doc_id", "piece", "sequence_id", "offset"} <= set(rows[0].asDict())
    check_packing(rows)


@pytest.mark.parametrize("name", [name for name, _ in pipeline.STAGES])
def test_stages_take_odd_and_empty_tables(spark, folder, odd_docs, name):
    step = dict(pipeline.STAGES)[name]
    got = step(spark, odd_docs, folder)
    assert got.count() >= 0
    if name != "best_fit_packing":
        assert got.columns == odd_docs.columns
    assert step(spark, odd_docs.limit(0), folder).count() == 0


def test_texts_become_python_objects_a_part_at_a_time(spark):
    docs = spark.range(0, 2500, 1, 1).selectExpr("id AS doc_id", "repeat(concat('w', id, ' '), 60) AS text")
    seen = map_batches(docs, lambda batch: {"n": [batch.num_rows]}, "n long", AT_ONCE).collect()
    assert sum(r.n for r in seen) == 2500 and max(r.n for r in seen) <= AT_ONCE
    assert map_batches(docs.filter("doc_id < 0"), lambda batch: {"n": [batch.num_rows]}, "n long", AT_ONCE).collect() == []
    wanted = simhash.fingerprints(docs, simhash.SIMILAR).collect()
    assert [r.doc_id for r in wanted] == list(range(2500))
    text = ("w7 " * 60).encode()
    assert wanted[7].fingerprint == simhash.set_fingerprint(text, 5, 256)[0]
