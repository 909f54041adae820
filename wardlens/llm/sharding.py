"""Sharding by balanced label propagation: linked documents gather, shards stay of one size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wardlens.llm.common import placed_in_keys
from wardlens.sources.staging import stage

#: Size classes per doubling, and hash slices of a class, in the global order by size.
CLASSES, SLICES = 8, 32
#: Shares of the bytes that are dealt last, smallest rows, to even the shards out.
TAILS = (0.25, 0.05)
#: Groups dealt last stay together up to this share of a shard.
WHOLE = 0.002
#: Rows of one group that are numbered in one task.
GROUP_ROWS = 1_000_000


def _size_class(size: Column) -> Column:
    return F.floor(F.log2(F.greatest(size, F.lit(1))) * CLASSES).cast("int")


def _by_size(rows: DataFrame) -> DataFrame:
    """Rows in falling order of size class, for the first deal: ``rank``."""
    slot = (F.lit(-1) * F.col("class") * SLICES + F.pmod(F.xxhash64("node"), F.lit(SLICES))).cast("int")
    return placed_in_keys(rows.withColumn("_place", slot), [], ["_place", "node"], "rank", slice_by=F.col("_place"))


def _by_group(rows: DataFrame) -> DataFrame:
    """Rows in falling order of size class and then by group: ``start`` (bytes before the row).

    A group of many rows has slices of its own, so that no task numbers all of it.
    """
    slot = (F.lit(-1) * F.col("class") * SLICES + F.pmod(F.xxhash64("group"), F.lit(SLICES))).cast("int")
    split = F.col("parts") > 1
    place = F.struct(
        slot.alias("slot"), F.when(split, F.col("group")).otherwise(0).alias("group"),
        F.when(split, F.pmod(F.xxhash64("node"), F.col("parts"))).otherwise(-1).alias("part"),
    )
    return placed_in_keys(
        rows.withColumn("_place", place), [], ["_place", "group", "node"], "rank", "size", "start",
        slice_by=F.col("_place"),
    ).drop("_place")


def _filled(part: DataFrame, edges: Sequence[float]) -> DataFrame:
    """Rows in falling order of size laid along the shards' free room; ``edges`` are its ends, in bytes.

    Rows of a group that is to stay whole go where the group's middle lies.
    """
    laid = stage(_by_group(part), "laid")
    small = laid.filter("whole").groupBy("whole", "group").agg(
        F.min("start").alias("_first"), F.sum("size").alias("_bytes")
    )
    middle = F.coalesce(F.col("_first") + F.col("_bytes") / 2, F.col("start") + F.col("size") / 2)
    shard = sum((F.when(middle >= e, 1).otherwise(0) for e in edges), F.lit(0)).cast("int")
    return stage(laid.join(small, ["whole", "group"], "left").select("node", "size", shard.alias("shard")), "filled")


def _levels(loads: list[int], more: int) -> list[float]:
    """What each shard gets of ``more`` bytes so that the emptiest rise to one level."""
    order = sorted(loads)
    filled, level = 0, 0.0
    for i, load in enumerate(order):
        filled += load
        level = (filled + more) / (i + 1)
        if i + 1 == len(order) or level <= order[i + 1]:
            break
    return [max(0.0, level - load) for load in loads]


def _loads(placed: DataFrame, shards: int) -> list[int]:
    found = {r["shard"]: r["size"] for r in placed.groupBy("shard").agg(F.sum("size").alias("size")).collect()}
    return [int(found.get(s, 0)) for s in range(shards)]


def _propagate(
    state: DataFrame, links: DataFrame, shards: int, level: float, turn: int
) -> DataFrame:
    """One round: every row may move to the shard that holds most of its neighbours.

    Neighbours are counted per hub and shard before they reach the rows, so a hub costs ``shards``
    numbers whatever its size.  Of two equal shards one with room wins, then the one that the hub's
    hash prefers, so two neighbours don't change places.  Neighbours that need several shards by their bytes gather
    in as many, those that hold most of them.  A shard takes no more than its room below ``level``:
    moves are weighed by doublings of their gain in a histogram, the driver gives each shard's
    room to the largest first, and within a class running sums of bytes tell which moves fit.
    """
    full = [load >= 0.97 * level for load in _loads(state, shards)]
    here = links.join(state, "node")
    tally = [F.count_if(F.col("shard") == s).alias(f"n{s}") for s in range(shards)]
    # Written first, so that the join deals both sides anew and a large hub's rows can be split.
    tallies = stage(here.groupBy("hub").agg(F.sum("size").alias("bytes"), *tally), "tallies")
    votes = here.join(tallies, "hub")
    names = [f"n{s}" for s in range(shards)]
    summed = votes.groupBy("node", "size", "shard").agg(
        F.min("hub").alias("hub"), F.count("*").alias("hubs"), F.sum("bytes").alias("bytes"), *(F.sum(n).alias(n) for n in names)
    )
    ranked = F.sort_array(F.array(*(
        F.struct(
            (2 * F.col(n) - int(full[s])).alias("rank"), F.xxhash64("hub", F.lit(s)).alias("p"),
            F.lit(s).alias("s"), F.col(n).alias("n"),
        )
        for s, n in enumerate(names)
    )), asc=False)
    needed = F.least(F.ceil(F.col("bytes") / (0.95 * level)), F.lit(shards)).cast("int")
    own = F.get(F.array(*names), F.col("shard"))
    wish = summed.select(
        "node", "size", "shard", own.alias("own"), "hubs", F.slice(ranked, F.lit(1), F.greatest(needed, F.lit(1))).alias("best")
    )
    there = F.array_contains(F.transform("best", lambda b: b["s"]), F.col("shard"))
    pick = F.get("best", F.pmod(F.xxhash64("node"), F.size("best")).cast("int"))
    wish = wish.select("node", "size", "shard", "own", "hubs", there.alias("there"), pick.alias("best"))
    moves = ~F.col("there")
    gain = F.floor(F.log2(F.greatest(F.col("best.n") - F.col("own") + F.col("hubs"), F.lit(1)))).cast("int")
    wish = stage(
        wish.select("node", "size", "shard", F.when(moves, F.col("best.s")).alias("to"), gain.alias("gain")),
        "wishes",
    )
    loads = _loads(wish, shards)
    histogram = wish.filter("to IS NOT NULL").groupBy("to", "gain").agg(F.sum("size").alias("size")).collect()
    room: dict[tuple[int, int], float] = {}
    for s in range(shards):
        left = max(0.0, level - loads[s])
        for r in sorted((r for r in histogram if r["to"] == s), key=lambda r: -r["gain"]):
            room[s, r["gain"]] = left
            left = max(0.0, left - r["size"])
    spark = state.sparkSession
    # One row per shard and doubling of the gain: bounded by the number of shards.
    allowed = spark.createDataFrame(
        [(s, g, share) for (s, g), share in room.items()], "_to int, _gain int, _room double"
    )
    movers = placed_in_keys(
        wish.filter("to IS NOT NULL").withColumn("_turn", F.xxhash64("node", F.lit(turn))),
        ["to", "gain"], ["_turn", "node"], "rank", "size", "before",
    )
    fits = (F.col("to") == F.col("_to")) & (F.col("gain") == F.col("_gain"))
    moved = movers.join(F.broadcast(allowed), fits).select(
        "node", "size",
        F.when(F.col("before") + F.col("size") <= F.col("_room"), F.col("to")).otherwise(F.col("shard")).alias("shard"),
    )
    stay = wish.filter("to IS NULL").select("node", "size", "shard")
    return stage(stay.union(moved), "shards")


def balanced_shards(rows: DataFrame, links: DataFrame, shards: int, rounds: int = 5) -> DataFrame:
    """A shard for every row: ``node``, ``size``, ``shard``; bytes per shard nearly equal.

    ``rows`` has a unique long ``node`` and a long ``size``; ``links`` has ``node`` and a long
    ``hub``: rows with a hub in common are neighbours (one row per node and hub).  Linked rows are
    dealt in order of size and move towards their neighbours under quotas; the others then fill
    the shards to one level, the smallest rows last.  Of linked rows the smallest groups (rows with
    the same least hub), up to a quarter of all bytes, wait for that too and are then laid group by
    group; a group with any larger row moves with it.  Neighbours that exceed a shard together are
    cut.  The driver sees sums per shard and per size class only.
    """
    hubs = links.groupBy("hub").agg(F.count("*").alias("_n")).filter("_n > 1").select("hub")
    shared = stage(links.join(hubs, "hub").select("node", "hub"), "links")
    homes = shared.groupBy("node").agg(F.min("hub").alias("_home"))
    classed = stage(
        rows.join(homes, "node", "left").select(
            "node", "size", F.col("_home").isNotNull().alias("linked"),
            F.coalesce("_home", "node").alias("group"), _size_class(F.col("size")).alias("class"),
        ),
        "rows",
    )
    classes = sorted(
        (r["linked"], r["class"], int(r["size"] or 0))
        for r in classed.groupBy("linked", "class").agg(F.sum("size").alias("size")).collect()
    )
    total, below, tail = sum(c[2] for c in classes), 0, {}
    for linked, size_class, size in classes:
        below += size
        tail[linked, size_class] = sum(below <= share * total for share in TAILS)
    spark = rows.sparkSession
    # One row per size class: bounded by the doublings of a size.
    named = spark.createDataFrame(
        [(k, c, t) for (k, c), t in tail.items()], "linked boolean, class int, tail int"
    )
    level = total / shards
    each = classed.join(F.broadcast(named), ["linked", "class"])
    groups = each.filter("linked").groupBy("linked", "group").agg(
        F.min("tail").alias("_tail"), F.max("class").alias("_class"),
        (F.sum("size") <= WHOLE * level).alias("_whole"), F.ceil(F.count("*") / GROUP_ROWS).alias("_parts"),
    )
    parted = stage(
        each.join(groups, ["linked", "group"], "left").select(
            "node", "size", "linked", "group",
            F.coalesce("_class", "class").alias("class"), F.coalesce("_tail", "tail").alias("tail"),
            F.coalesce("_whole", F.lit(False)).alias("whole"),
            F.coalesce("_parts", F.lit(1)).cast("long").alias("parts"),
        ),
        "parted",
    )
    first = _by_size(parted.filter("linked AND tail = 0"))
    lap = F.expr(f"rank div {shards}") % 2
    at = (F.col("rank") % shards).cast("int")
    state = stage(
        first.select("node", "size", F.when(lap == 0, at).otherwise(shards - 1 - at).alias("shard")), "dealt"
    )
    inner = stage(shared.join(state.select("node"), "node", "left_semi"), "links")
    for turn in range(rounds):
        state = _propagate(state, inner, shards, 0.98 * level, turn)
    placed, loads = state, _loads(state, shards)
    for number in range(len(TAILS) + 1):
        # Linked rows that are not in a tail are placed already.
        part = parted.filter((F.col("tail") == number) & ((F.col("tail") > 0) | ~F.col("linked")))
        weight = int(part.agg(F.sum("size")).first()[0] or 0)
        edges, edge = [], 0.0
        for share in _levels(loads, weight):
            edge += share
            edges.append(edge)
        filled = _filled(part, edges[:-1])
        loads = [a + b for a, b in zip(loads, _loads(filled, shards))]
        placed = placed.union(filled)
    return placed


def shard_documents(
    docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", rounds: int = 5
) -> DataFrame:
    """Documents in shards of nearly equal bytes, equal texts together where they fit.

    Columns: the id, ``size`` (UTF-8 bytes of the text, 0 for NULL, plus 8), ``text_crc32``,
    ``law`` ("bytes"), ``shard``, ``slot`` (from 0 in each shard, without gaps).  Every row is a
    document of its own, also with a NULL or repeated id.  Other columns are not read.  An empty
    table gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    narrow = docs.select(
        F.col(id_col),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text, F.octet_length(text)).alias("hub"),
        F.monotonically_increasing_id().alias("node"),
    )
    known = stage(narrow, "documents")
    placed = balanced_shards(known.select("node", "size"), known.select("node", "hub"), shards, rounds)
    joined = known.join(placed.select("node", "shard"), "node")
    slotted = placed_in_keys(joined, ["shard"], ["node"], "slot")
    return slotted.select(
        id_col, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot"
    )
