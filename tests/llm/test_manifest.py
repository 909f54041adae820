"""The Merkle manifest against a tree built by hand."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from wardlens.llm import manifest, queries

from conftest import DOCS


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_leaf(r, more=0):
    values = (r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"])
    values = [v + more if k == 3 and v is not None else v for k, v in enumerate(values)]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """The root and each leaf's steps as (siblings, own place in the run)."""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, i in enumerate(at):
            run = nodes[i // 2 * 2 : i // 2 * 2 + 2]
            steps[leaf].append((run[: i % 2] + run[i % 2 + 1 :], i % 2))
            at[leaf] = i // 2
        nodes = [h("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]
    return nodes[0] if nodes else None, steps


def brute(rows):
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    found, subroots = [], []
    for lang in langs:
        own = [r for r in rows if r["lang"] == lang]
        own.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, brute_leaf(r)))
        subroot, steps = tree([brute_leaf(r) for r in own])
        subroots.append(subroot)
        found.append((own, steps))
    root, top = tree(subroots)
    out = []
    for (own, steps), subroot, above in zip(found, subroots, top):
        for r, s in zip(own, steps):
            s = s + above
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            node = brute_leaf(r, 1 if hit else 0)
            for others, place in s:
                node = h("".join(others[:place] + [node] + others[place:]))
            siblings = h("".join(x for others, _ in s for x in others))
            out.append((r["doc_id"], brute_leaf(r), subroot, root, siblings, node, node == root))
    return sorted(out, key=repr)


def got(query_rows):
    return sorted(
        ((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in query_rows), key=repr
    )


def query(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    return queries.QUERIES["op13_interval_manifest"](spark, str(tmp_path))


def test_query_equals_trees_by_hand(spark, folder, tables):
    rows = [r.asDict() for r in tables("documents").collect()]
    found = queries.QUERIES["op13_interval_manifest"](spark, folder).collect()
    assert got(found) == brute(rows)
    assert 0 < sum(not r.verified for r in found) < len(found) / 3


def test_odd_rows(spark, odd_docs, tmp_path):
    rows = [r.asDict() for r in odd_docs.collect()]
    assert got(query(spark, odd_docs, tmp_path).collect()) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 64, 65, 129])
def test_sizes_around_a_band(spark, tmp_path, n):
    rows = [(i * 3, f"text {i}", None if i % 5 == 0 and n < 64 else "en", "s", i) for i in range(n)]
    docs = spark.createDataFrame(rows, DOCS)
    names = ("doc_id", "text", "lang", "source", "n_chars")
    found = query(spark, docs, tmp_path).collect()
    assert got(found) == brute([dict(zip(names, r)) for r in rows])


def test_many_groups_and_bands(spark):
    leaves = spark.range(9000).select(
        "id", F.concat(F.lit("g"), F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 300)).alias("grp"),
        manifest.digest(F.col("id").cast("string")).alias("leaf"),
    )
    proofs = manifest.prove(leaves, "grp", ["id"])
    fold = manifest.folded(F.col("leaf"), F.col("proof"))
    rows = proofs.select("*", fold.alias("end"), F.size("proof").alias("depth")).collect()
    assert len(rows) == 9000 and all(r.end == r.root for r in rows)
    hot = [r for r in rows if r.grp == "g0"]
    assert {r.depth for r in hot} == {(len(hot) - 1).bit_length() + 8}
    groups = sorted({r.grp for r in rows}, key=str.encode)
    subroots = []
    for g in groups:
        own = sorted((r for r in rows if r.grp == g), key=lambda r: r.id)
        subroots.append(tree([r.leaf for r in own])[0])
        assert {r.subroot for r in own} == {subroots[-1]}
    assert {r.root for r in rows} == {tree(subroots)[0]}


def test_any_changed_leaf_is_found(spark):
    leaves = spark.range(70).select(
        "id", F.lit("x").alias("grp"), manifest.digest(F.col("id").cast("string")).alias("leaf")
    )
    proofs = manifest.prove(leaves, "grp", ["id"])
    other = manifest.digest(F.concat(F.col("id").cast("string"), F.lit("!")))
    assert proofs.filter(manifest.folded(other, F.col("proof")) == F.col("root")).isEmpty()
