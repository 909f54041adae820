"""The schedule and the shards against what they promise."""

import zlib
from collections import Counter, defaultdict

import pytest

from compare import connect, difference
from wardlens.llm import mixing, sharding
from wardlens.llm.queries import CHECKS, QUERIES


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_agrees_with_sql(spark, folder, name):
    assert difference(QUERIES[name](spark, folder), connect(folder), CHECKS[name]) is None


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, target = sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total > most * sizes[s]}
        if not full:
            target |= {s: left * weight[s] / total for s in open_}
            break
        target |= {s: most * sizes[s] for s in full}
        left -= sum(most * sizes[s] for s in full)
        open_ -= full
    return target


def test_targets_and_schedule(spark):
    rows = [(i, "b" if i % 3 == 0 else ["a", "ü", None, "tiny", "c"][i % 5] if i % 40 else "tiny", "w " * (1 + i % 90)) for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    sizes = Counter()
    for _, source, text in rows:
        sizes[source] += len(text.split())
    placed, parts = mixing.mix(docs, block=64)
    want = brute_targets(sizes)
    got = {r.source: r.target for r in placed.select("source", "target").distinct().collect()}
    assert got == pytest.approx(want)
    taken = defaultdict(int)
    for r in mixing.taken(placed, parts).collect():
        taken[r.source] += r.taken
        assert r.taken <= 3 * r.size
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)
    slots = {}
    for r in parts.collect():
        slots.setdefault(r.slot, set()).add(r.source)
    assert all(len(s) == 1 for s in slots.values())
    # At every prefix of the schedule each source is near its share.
    n, seen = len(slots), Counter()
    total = sum(want.values())
    assert set(slots) == set(range(n))
    for t in range(n):
        seen[next(iter(slots[t]))] += 1
        assert all(abs(seen[s] - (t + 1) * want[s] / total) <= 6 for s in want)


def test_mixed_documents_come_by_pass(spark):
    rows = [(i, f"s{i % 4}", f"text {i} " * 20) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.mixed(docs, block=64)
    assert got.columns == docs.columns
    words = Counter()
    for r in got.collect():
        words[r.source] += len(r.text.split())
    want = brute_targets({f"s{i}": 4000 for i in range(4)})
    assert all(abs(words[s] - want[s]) <= 40 for s in want)


def test_the_results_own_schedule_is_even(spark):
    """Documents in order of their first slot: at every place each source has been read near its share."""
    rows = [(i, f"s{i % 3}", f"text {i} " * 32) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.taken(*mixing.mix(docs, block=64)).collect()
    assert all((r.first_slot is None) == (r.taken == 0) == (r.n_slots == 0) for r in got)
    assert all(r.taken <= 64 * r.n_slots for r in got)
    want = brute_targets({f"s{i}": 500 * 64 for i in range(3)})
    total, seen, read = sum(want.values()), Counter(), 0
    # First passes only: sources are read once as long as the smallest share lasts.
    first = sorted((r for r in got if r.taken), key=lambda r: r.first_slot)
    upto = min(max(r.first_slot for r in first if r.source == s) for s in want)
    for r in (r for r in first if r.first_slot < upto):
        seen[r.source] += 1
        read += 1
        assert all(abs(seen[s] - read * want[s] / total) <= 6 for s in want)
    assert read > 500


def test_mixed_keeps_columns_sources_and_order(spark):
    """Rows that differ in an extra column only keep theirs, and a source of one long text stays."""
    rows = [(1, "a", "same text here", i % 3, None if i % 2 else {"k": i % 3}) for i in range(12)]
    rows += [(2, None, f"no source {i} " * 9, 0, None) for i in range(30)]
    rows += [(2, "", f"empty source {i} " * 9, 0, None) for i in range(30)]
    rows += [(3, "long", "word " * 5000, 7, {"a|b": 1})]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, `x.y` int, _key map<string,int>")
    got = mixing.mixed(docs, slot_col="slot", block=16)
    assert got.columns == [*docs.columns, "slot"]
    found = got.collect()
    kinds = lambda table: {(r.doc_id, r.source, r.text, r["x.y"], str(r["_key"])) for r in table}
    assert kinds(found) <= kinds(docs.collect())
    assert {r["x.y"] for r in found if r.doc_id == 1} == {0, 1, 2}
    assert len({(r["x.y"], str(r["_key"])) for r in found if r.doc_id == 1}) == 6
    assert {r.source for r in found} == {"a", None, "", "long"}
    assert sum(r.source == "long" for r in found) == 1
    # The slots tell the order: early rows hold every short source, not one after the other.
    early = sorted(found, key=lambda r: r.slot)[: len(found) // 2]
    assert {r.source for r in early} >= {None, ""}


def test_odd_documents_mix(odd_docs):
    placed, parts = mixing.mix(odd_docs)
    assert mixing.taken(placed, parts).count() == odd_docs.count()
    got = mixing.mixed(odd_docs)
    assert got.schema == odd_docs.schema and got.count() > 0
    none = odd_docs.limit(0)
    assert mixing.taken(*mixing.mix(none)).count() == mixing.mixed(none).count() == 0


def test_shards_of_all_documents(spark, folder, tables):
    docs = {r.doc_id: (r.text or "").encode() for r in tables("documents").collect()}
    rows = QUERIES["op3_label_propagation"](spark, folder).collect()
    assert {r.doc_id: (r["size"], r.text_crc32) for r in rows} == {
        i: (len(t) + 8, zlib.crc32(t)) for i, t in docs.items()
    }
    check_shards(rows, 24)


def check_shards(rows, shards):
    slots = defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < shards and r.law == "bytes"
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_linked_rows_gather_and_bytes_stay_even(spark):
    """Pairs and small groups end in one shard; a group of a third of all rows fills several."""
    rows = []
    for i in range(6000):
        group = "hot" if i % 3 == 0 else f"pair {i // 12}" if i % 6 == 1 or i % 12 == 8 else f"own {i}"
        rows.append((i, group, f"{group} " * (1 + zlib.crc32(group.encode()) % 60)))
    docs = spark.createDataFrame(rows, "doc_id long, grp string, text string")
    got = sharding.shard_documents(docs, 24).collect()
    check_shards(got, 24)
    load, where = Counter(), defaultdict(Counter)
    group_of = {i: g for i, g, _ in rows}
    for r in got:
        load[r.shard] += r["size"]
        where[group_of[r.doc_id]][r.shard] += 1
    mean = sum(load.values()) / 24
    assert max(load.values()) <= 1.01 * mean and min(load.values()) >= 0.99 * mean
    several = [c for g, c in where.items() if g.startswith("pair") and c.total() > 1]
    assert len(several) > 300 and sum(len(c) == 1 for c in several) >= 0.95 * len(several)
    hot = sorted(where["hot"].values(), reverse=True)
    share = sum(hot) * (8 + len(rows[0][2])) / sum(load.values())
    full = round(24 * share)
    assert sum(hot[:full]) >= 0.6 * sum(hot)


def cut_pairs(group_of, shard_of):
    """Links of copies to the next one that lie in two shards."""
    members = defaultdict(list)
    for node, group in group_of.items():
        members[group].append(shard_of[node])
    return sum(a != b for found in members.values() for a, b in zip(sorted(found), sorted(found)[1:]))


def greedy_shards(size_of, group_of, shards):
    """Brute force: whole groups, largest first, each to the emptiest shard."""
    members = defaultdict(list)
    for node, group in group_of.items():
        members[group].append(node)
    load, shard_of = [0] * shards, {}
    for nodes in sorted(members.values(), key=lambda g: -sum(size_of[n] for n in g)):
        at = load.index(min(load))
        load[at] += sum(size_of[n] for n in nodes)
        shard_of |= dict.fromkeys(nodes, at)
    return shard_of, load


def test_a_table_of_copies_only_keeps_nearly_all_pairs(spark):
    """4,000 texts twice each, of all sizes: no part of the table is dealt without its links."""
    draw = zlib.crc32
    texts = [f"text {i} " * (1 + draw(b"%d" % i) % 200) for i in range(4000)]
    rows = [(i, texts[i % 4000]) for i in range(8000)]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 24).collect()
    check_shards(got, 24)
    load, shard_of = Counter(), {}
    for r in got:
        load[r.shard] += r["size"]
        shard_of[r.doc_id] = r.shard
    mean = sum(load.values()) / 24
    assert max(load.values()) <= 1.01 * mean and min(load.values()) >= 0.99 * mean
    group_of = {i: i % 4000 for i in range(8000)}
    best, even = greedy_shards({r.doc_id: r["size"] for r in got}, group_of, 24)
    assert cut_pairs(group_of, best) == 0 and max(even) <= 1.01 * mean
    assert cut_pairs(group_of, shard_of) <= 40  # within a hundredth of that


def test_a_hot_group_of_small_rows_is_numbered_in_parts(spark, monkeypatch):
    """A third of all rows is one short text: its rows have several slices, and shards stay even."""
    monkeypatch.setattr(sharding, "GROUP_ROWS", 300)
    rows = [(i, "hot" if i % 3 == 0 else f"own text {i} " * 30) for i in range(6000)]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 24).collect()
    check_shards(got, 24)
    load = Counter()
    for r in got:
        load[r.shard] += r["size"]
    mean = sum(load.values()) / 24
    assert len(got) == 6000 and max(load.values()) <= 1.01 * mean and min(load.values()) >= 0.99 * mean


def test_a_group_of_small_and_large_rows_moves_together(spark):
    """Links between rows of different sizes: the small one of a pair goes with the large one."""
    rows = [(i, 2000 if i < 3000 else 20) for i in range(6000)] + [(i, 500) for i in range(6000, 9000)]
    links = [(i, i % 3000) for i in range(6000)]
    found = sharding.balanced_shards(
        spark.createDataFrame(rows, "node long, size long"), spark.createDataFrame(links, "node long, hub long"), 24
    ).collect()
    shard_of = {r.node: r.shard for r in found}
    assert len(found) == len(shard_of) == 9000
    load = Counter()
    for r in found:
        load[r.shard] += r["size"]
    mean = sum(load.values()) / 24
    assert max(load.values()) <= 1.01 * mean and min(load.values()) >= 0.99 * mean
    assert cut_pairs({i: i % 3000 for i in range(6000)}, shard_of) <= 30


def test_odd_documents_shard(odd_docs):
    rows = sharding.shard_documents(odd_docs, 24).collect()
    assert len(rows) == odd_docs.count()
    check_shards(rows, 24)
    assert sharding.shard_documents(odd_docs.limit(0), 24).count() == 0
