"""Language-model scores by prediction by partial matching over the bytes of words."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wardlens.llm.common import arrow_schema, text_bytes
from wardlens.sources.staging import stage

#: Bytes of context in the table of windows.  A key packs the order, the context and the symbol.
#: Longer contexts reach back to the start of the word.
ORDER = 4
#: Symbols that a byte-context can be followed by: any byte.
ALPHABET = 256
#: Stands for a word: the end of a text.  No word holds white space.
END = b"\n"
SPACE = 32
#: Rows of a batch.
BLOCK = 100_000


def file_chunks(rows: int = 8192) -> Column:
    """A number for every ``rows`` rows of a file, for tables read from files.

    It depends on the file and the place in it alone, not on how a job splits its input.
    """
    return F.xxhash64("_metadata.file_path", F.floor(F.col("_metadata.row_index") / rows))


def _windows(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Every byte's window of words, and where each word's begin.

    A word is its bytes and a space, and its first context is the space before it; contexts don't
    reach further back.  So a word's code length is the same wherever it stands, and is found
    once for all its uses.
    """
    data = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.int64)
    spaces = np.flatnonzero(data == SPACE)
    at = np.arange(len(data))
    since = at - np.maximum.accumulate(np.where(data == SPACE, at, 0))
    reach = np.minimum(np.concatenate(([0], since[:-1])) + 1, ORDER)
    context = np.zeros(len(data), np.int64)
    for back in range(1, ORDER + 1):
        shifted = np.concatenate((np.zeros(back, np.int64), data[:-back]))
        context |= np.where(reach >= back, shifted << (8 * (back - 1)), 0)
    keys = (reach << 40) | (context << 8) | data
    return keys[1:], spaces[:-1]


END_WINDOW = (1 << 40) | (SPACE << 8) | END[0]


def _shorter(keys: np.ndarray) -> np.ndarray:
    """The same windows with one context byte less."""
    order = (keys >> 40) - 1
    context = (keys >> 8) & ((1 << (8 * np.maximum(order, 0))) - 1)
    return (order << 40) | (context << 8) | (keys & 255)


def _batches(names: pa.Schema, *columns) -> Iterator[pa.RecordBatch]:
    """Columns cut into batches of a schema."""
    for i in range(0, len(columns[0]), BLOCK):
        yield pa.RecordBatch.from_arrays(
            [pa.array(c[i : i + BLOCK], t) for c, t in zip(columns, names.types)], schema=names
        )


def _chunk_words(docs: DataFrame) -> DataFrame:
    """The distinct words of each chunk, the end among them, and their counts in training texts.

    ``docs`` has ``chunk``, ``text`` (bytes) and ``held``.  A task counts the chunks that it reads,
    so a frequent word is a row per chunk, or two where a chunk is split.
    """
    schema = arrow_schema("chunk long, word binary, n long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counts = None, Counter()
        for batch in batches:
            for chunk, text, held in zip(*(c.to_pylist() for c in batch.columns)):
                if chunk != now and counts:
                    yield from _batches(schema, [now] * len(counts), list(counts), list(counts.values()))
                    counts = Counter()
                now = chunk
                words = text.lower().split()
                if held:
                    for word in words:
                        counts.setdefault(word, 0)
                    counts.setdefault(END, 0)
                else:
                    counts.update(words)
                    counts[END] += 1
        if counts:
            yield from _batches(schema, [now] * len(counts), list(counts), list(counts.values()))

    return docs.select("chunk", "text", "held").mapInArrow(count, "chunk long, word binary, n long")


def trie(vocabulary: DataFrame) -> DataFrame:
    """The byte-context trie of the training words: ``key`` (order, context, symbol), ``uses``, ``kinds``.

    ``uses`` counts every use of a word, ``kinds`` every different word once: the first tells how
    words begin, the second how words go on that were not seen before.
    """
    schema = arrow_schema("key long, uses long, kinds long")

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, weight = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            is_end = np.array([w == END for w in words])
            keys, n = np.full(is_end.sum(), END_WINDOW), weight[is_end]
            if not is_end.all():
                used, starts = _windows([w for w in words if w != END])
                sizes = np.diff(np.concatenate((starts, [len(used)])))
                keys, n = np.concatenate((keys, used)), np.concatenate((n, np.repeat(weight[~is_end], sizes)))
            once = np.ones(len(keys), np.int64)
            while len(keys):
                keys, at = np.unique(keys, return_inverse=True)
                sums = np.zeros((2, len(keys)), np.int64)
                np.add.at(sums[0], at, n)
                np.add.at(sums[1], at, once)
                yield from _batches(schema, keys, *sums)
                deeper = keys >> 40 > 0
                keys, (n, once) = _shorter(keys[deeper]), sums[:, deeper]

    counted = vocabulary.filter("n > 0").select("word", "n").mapInArrow(edges, "key long, uses long, kinds long")
    return counted.groupBy("key").agg(*(F.sum(c).cast("long").alias(c) for c in ("uses", "kinds")))


class Escapes:
    """How often a context meets a symbol it does not know, by kind of context.

    A kind is the order (``ORDER`` + 1 for longer ones), how the context was come to (0 as the
    longest, 1 by an escape, 2 since all longer ones are new, 3 by an escape after that), the
    doubling of the number of symbols seen, and the number of different ones.  The figures are those of leaving each training symbol out once; they are mixed with two
    observations at the usual share, different ones to seen and different ones.
    """

    SEEN, KINDS = 48, 10

    def __init__(self, rows: list[tuple[int, int, int]] = ()):
        size = (ORDER + 2) * 4 * self.SEEN * self.KINDS
        self.new, self.all = np.zeros(size), np.zeros(size)
        for kind, new, total in rows:
            self.new[kind] += new
            self.all[kind] += total

    @classmethod
    def kind(cls, order, way, seen, kinds):
        size = np.minimum(np.log2(np.maximum(seen, 1)).astype(np.int64), cls.SEEN - 1)
        few = np.minimum(kinds, cls.KINDS - 1)
        return ((order * 4 + way) * cls.SEEN + size) * cls.KINDS + few

    def share(self, order, way, seen, kinds):
        """The probability of an unknown symbol; 1 where nothing was seen."""
        at = self.kind(order, way, seen, kinds)
        usual = kinds / np.maximum(seen + kinds, 1)
        found = (self.new[at] + 2 * usual) / (self.all[at] + 2)
        return np.where(seen > 0, np.clip(found, 1e-9, 1 - 1e-9), 1.0)


def _tally(kinds: np.ndarray, new: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sums of new and all observations per kind."""
    found, at = np.unique(kinds, return_inverse=True)
    sums = np.zeros((2, len(found)), np.int64)
    np.add.at(sums[0], at, weight * new)
    np.add.at(sums[1], at, weight)
    return found, sums[0], sums[1]


class Contexts:
    """A part of the trie that answers for the windows whose contexts it holds."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], counts[order]
        owner = self.keys >> 8
        self.contexts, starts, self.owner = np.unique(owner, return_index=True, return_inverse=True)
        if not len(starts):
            self.contexts, self.totals = np.array([-1]), np.zeros(1, np.int64)
            self.kinds = self.excluded = self.totals
            return
        self.totals = np.add.reduceat(self.counts, starts)
        self.kinds = np.diff(np.concatenate((starts, [len(owner)])))
        # What a context's symbols make up of the next shorter context, where they are excluded.
        below = np.where(self.keys >> 40 > 0, self._count(_shorter(self.keys)), 0)
        self.excluded = np.add.reduceat(below, starts)

    def _at(self, table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(table, wanted), max(len(table) - 1, 0))
        return at, (table[at] == wanted) if len(table) else np.zeros(len(wanted), bool)

    def _count(self, wanted: np.ndarray) -> np.ndarray:
        at, hit = self._at(self.keys, wanted)
        return np.where(hit, self.counts[at], 0) if len(self.keys) else np.zeros(len(wanted), np.int64)

    def escapes(self, least_order: int) -> tuple[np.ndarray, ...]:
        """Observations of contexts of at least ``least_order``, each symbol left out once."""
        mine = self.keys >> 40 >= least_order
        order, n, own = (self.keys >> 40)[mine], self.counts[mine], self.owner[mine]
        once = n == 1
        seen, kinds = self.totals[own] - 1, self.kinds[own] - once
        rest = seen > 0
        plain = Escapes.kind(order, 0, seen, kinds)[rest], once[rest], n[rest]
        parts = [plain]
        # Left out here, a symbol seen once is next looked for in the shorter context; so is any
        # symbol of a context seen once, which is then new.
        for way, down in ((1, once & rest & (order > 0)), (2, (self.totals[own] == 1) & (order > 0))):
            parts.append(self._below(order[down], self.keys[mine][down], own[down], way))
        lone = (self.totals[own] == 1) & (order > 1)
        shorter = _shorter(self.keys[mine][lone])
        under, at = self._count(shorter), self._at(self.contexts, shorter >> 8)[0]
        then = (under == 1) & (self.totals[at] > 1)
        parts.append(self._below(order[lone][then] - 1, shorter[then], at[then], 3))
        return _tally(*(np.concatenate(p) for p in zip(*parts)))

    def _below(self, order: np.ndarray, keys: np.ndarray, own: np.ndarray, way: int) -> tuple[np.ndarray, ...]:
        """Observations one byte below the given windows, whose symbols are left out."""
        shorter = _shorter(keys)
        at, n = self._at(self.contexts, shorter >> 8)[0], self._count(shorter)
        seen, kinds = self.totals[at] - 1, self.kinds[at] - (n == 1)
        if way != 2:
            seen, kinds = seen - (self.excluded[own] - n), kinds - (self.kinds[own] - 1)
        rest = seen > 0
        return Escapes.kind(order - 1, way, seen, kinds)[rest], (n == 1)[rest], np.ones(rest.sum(), np.int64)

    def log10(self, windows: np.ndarray, escapes: Escapes) -> np.ndarray:
        """Log probabilities of windows' symbols after their contexts.

        From the longest known context down, a context knows the symbol, with its count's share
        of what is not escaped, or is escaped from; symbols of the longer context are excluded
        from it.  A symbol that no context knows shares what is left with all others unknown.
        """
        score = np.zeros(len(windows))
        todo = np.arange(len(windows))
        keys = windows.copy()
        before, fresh = np.full(len(windows), -1), np.zeros(len(windows), np.int64)
        while len(todo):
            order = keys >> 40
            at, known = self._at(self.contexts, keys >> 8)
            last = before[todo]
            after = last >= 0
            seen = np.where(known, self.totals[at] - np.where(after, self.excluded[last], 0), 0)
            kinds = np.where(known, self.kinds[at] - np.where(after, self.kinds[last], 0), 0)
            n = self._count(keys)
            found = n > 0
            escape = escapes.share(order, 2 * fresh[todo] + after, seen, kinds)
            hit = np.log10(np.maximum(n, 1) / np.maximum(seen, 1)) + np.log10(np.where(found, 1 - escape, 1.0))
            score[todo] += np.where(found, hit, np.log10(escape))
            before[todo] = np.where(known, at, last)
            fresh[todo] |= ~known & ~after
            lost = ~found & (order == 0)
            if lost.any():
                last = before[todo[lost]]
                score[todo[lost]] -= np.log10(ALPHABET - np.where(last >= 0, self.kinds[last], 0))
            more = ~found & (order > 0)
            todo, keys = todo[more], _shorter(keys[more])
        return score


def _base_edges(edges: DataFrame) -> np.ndarray:
    """Contexts of up to one byte: at most (1 + 256) * 256 rows of key and counts, for all tasks."""
    short = edges.filter(F.col("key") < F.lit(2 << 40)).collect()
    return np.array([tuple(r) for r in short], np.int64).reshape(-1, 3).T


def _by_place(rows: DataFrame) -> DataFrame:
    """Rows dealt by the last two bytes of their contexts, which all but the shortest share."""
    place = F.shiftright("key", 8).bitwiseAND(F.lit(0xFFFF))
    return rows.withColumn("place", place).repartition("place").select("key", "uses", "kinds")


def _window_keys(vocabulary: DataFrame, spot: Column) -> DataFrame:
    """The distinct windows of each ``spot``'s words: ``spot``, ``key``."""
    schema = arrow_schema("spot long, key long")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, spots = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            real = np.array([w != END for w in words])
            if real.any():
                used, starts = _windows([w for w in words if w != END])
                sizes = np.diff(np.concatenate((starts, [len(used)])))
                # A key has 43 bits, which leaves 20 for the spot.
                pairs = np.unique((np.repeat(spots[real], sizes) << 43) | used)
                yield from _batches(schema, pairs >> 43, pairs & ((1 << 43) - 1))
            yield from _batches(schema, spots[~real], np.full((~real).sum(), END_WINDOW))

    return vocabulary.select("word", spot.alias("spot")).mapInArrow(keys, "spot long, key long").distinct()


def _prefixes(words: list[bytes], counts: list[int]) -> dict[bytes, dict[int, int]]:
    """Contexts that reach back to the start of a word from ``ORDER`` bytes on, with their symbols' counts."""
    nodes: dict[bytes, dict[int, int]] = {}
    for word, n in zip(words, counts):
        if n:
            for i in range(ORDER, len(word) + 1):
                node = nodes.setdefault(word[:i], {})
                symbol = word[i] if i < len(word) else SPACE
                node[symbol] = node.get(symbol, 0) + n
    return nodes


def _prefix_escapes(words: list[bytes], counts: list[int]) -> tuple[np.ndarray, ...]:
    rows = [
        (seen - 1, len(node) - (n == 1), n == 1, n)
        for node in _prefixes(words, counts).values()
        for seen in (sum(node.values()),) if seen > 1
        for n in node.values()
    ]
    seen, kinds, once, n = np.array(rows, np.int64).reshape(-1, 4).T
    return _tally(Escapes.kind(ORDER + 1, 0, seen, kinds), once, n)


def word_scores(
    words: list[bytes], counts: list[int], keys: np.ndarray, begin: np.ndarray, go_on: np.ndarray, escapes: Escapes
) -> np.ndarray:
    """Log10 probabilities of words, each with its end, after the space before it.

    ``words`` that begin alike must come together; ``keys`` (sorted) are their windows, scored by
    uses (``begin``) and by kinds of words (``go_on``).  The first bytes have all before them in
    their windows.  From then on the whole beginning of the word is the longest context.  Where
    it doesn't know the next symbol it is escaped from, and its symbols are excluded from the
    windows' probabilities; after that the beginning is new, and the windows go on alone.
    """
    nodes = _prefixes(words, counts)
    seen = np.array([sum(node.values()) for node in nodes.values()], np.int64)
    share = escapes.share(ORDER + 1, 0, seen, np.array([len(node) for node in nodes.values()], np.int64))
    stay, leave = np.log10((1 - share) / np.maximum(seen, 1)).tolist(), np.log10(share).tolist()
    steps = {
        prefix: ({symbol: s + math.log10(n) for symbol, n in node.items()}, out)
        for (prefix, node), s, out in zip(nodes.items(), stay, leave)
    }
    del nodes
    real = [w for w in words if w != END]
    used, starts = _windows(real) if real else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    at = np.searchsorted(keys, used)
    first = np.concatenate(([0.0], np.cumsum(begin[at]))).tolist()
    later = np.concatenate(([0.0], np.cumsum(go_on[at]))).tolist()
    places = iter(starts.tolist())
    values = np.zeros(len(words))
    for nth, word in enumerate(words):
        if word == END:
            values[nth] = begin[np.searchsorted(keys, END_WINDOW)]
            continue
        lo = next(places)
        hi = lo + len(word) + 1
        total = first[min(lo + ORDER, hi)] - first[lo]
        for i in range(ORDER, len(word) + 1):
            prefix = word[:i]
            known = steps.get(prefix)
            if known is None:
                total += later[hi] - later[lo + i]
                break
            node, out = known
            step = node.get(word[i] if i < len(word) else SPACE)
            if step is not None:
                total += step
                continue
            context = (ORDER << 40) | (int.from_bytes(prefix[-ORDER:], "big") << 8)
            others = np.array([context | s for s in node], np.int64)
            left = 1 - float((10 ** go_on[np.searchsorted(keys, others)]).sum())
            total += out - math.log10(max(left, 1e-9)) + later[hi] - later[lo + i]
            break
        values[nth] = total
    return values


def score_vocabulary(vocabulary: DataFrame) -> DataFrame:
    """``word``, ``n`` and ``score`` of every word of the corpus, by a model of the training counts ``n``.

    Tables of contexts and windows, which grow with the corpus, meet by the last two bytes of the
    context; words and the windows they use by the first bytes of the word.
    """
    edges = stage(trie(vocabulary), "trie")
    base = _base_edges(edges)
    ddl = "model int, kind long, fresh long, total long"
    stats_schema = arrow_schema(ddl)

    def parts(batches: Iterator[pa.RecordBatch]) -> tuple[list[Contexts], np.ndarray]:
        """The models by uses and by kinds of words, and the windows to score."""
        tables = [np.stack([c.to_numpy() for c in b.columns]) for b in batches]
        rows = np.concatenate(tables, axis=1) if tables else np.zeros((3, 0), np.int64)
        known = np.concatenate((base, rows[:, rows[1] >= 0]), axis=1)
        return [Contexts(known[0], known[1]), Contexts(known[0], known[2])], rows[0, rows[1] < 0]

    def observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for model, part in enumerate(parts(batches)[0]):
            found = part.escapes(2)
            yield from _batches(stats_schema, np.full(len(found[0]), model), *found)

    spot = F.pmod(F.xxhash64(F.substring("word", 1, ORDER)), F.lit(_spots(vocabulary)))
    placed = vocabulary.withColumn("spot", spot)

    def observe_words(group: pa.Table) -> pa.Table:
        found = _prefix_escapes(group.column("word").to_pylist(), group.column("n").to_pylist())
        columns = [np.zeros(len(found[0]), np.int64), *found]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, stats_schema.types)], schema=stats_schema)

    long_ = edges.filter(F.col("key") >= F.lit(2 << 40)).select("key", "uses", "kinds")
    seen = _by_place(long_).mapInArrow(observe, ddl).union(
        placed.filter("n > 0").groupBy("spot").applyInArrow(observe_words, ddl)
    )
    # One row per kind of context, whose number is fixed.
    rows = [tuple(r) for r in seen.groupBy("model", "kind").agg(F.sum("fresh"), F.sum("total")).collect()]
    for model in (0, 1):
        found = Contexts(base[0], base[1 + model]).escapes(0)
        rows += [(model, *(int(x) for x in r)) for r in zip(*found)]
    escapes = [Escapes([r[1:] for r in rows if r[0] == model]) for model in (0, 1)]
    point_ddl = "key long, begin double, go_on double"
    point_schema = arrow_schema(point_ddl)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, wanted = parts(batches)
        for i in range(0, len(wanted), BLOCK):
            some = wanted[i : i + BLOCK]
            yield from _batches(point_schema, some, *(m.log10(some, e) for m, e in zip(models, escapes)))

    used = stage(_window_keys(placed, F.col("spot")), "windows")
    none = F.lit(-1).cast("long")
    wanted = used.select("key", none.alias("uses"), none.alias("kinds")).distinct()
    points = _by_place(long_.union(wanted)).mapInArrow(score, point_ddl)
    met = used.join(points, "key")
    word_schema = arrow_schema("word binary, n long, score double")

    def rate(words: pa.Table, windows: pa.Table) -> pa.Table:
        keys = windows.column("key").to_numpy()
        order = np.argsort(keys)
        begin, go_on = (windows.column(c).to_numpy()[order] for c in ("begin", "go_on"))
        values = word_scores(
            words.column("word").to_pylist(), words.column("n").to_pylist(), keys[order], begin, go_on, escapes[0]
        )
        return pa.Table.from_arrays(
            [words.column("word").combine_chunks(), words.column("n").combine_chunks(), pa.array(values)],
            schema=word_schema,
        )

    both = placed.groupBy("spot").cogroup(met.groupBy("spot"))
    return both.applyInArrow(rate, "word binary, n long, score double")


def _spots(vocabulary: DataFrame, words: int = 50_000) -> int:
    """Into how many parts the words are dealt: some tens of thousands in each, at any size."""
    return max(1, vocabulary.count() // words)


def _before(items: np.ndarray) -> np.ndarray:
    """How often each item occurs before its place."""
    order = np.argsort(items, kind="stable")
    place = np.arange(len(items))
    new = np.concatenate(([True], items[order][1:] != items[order][:-1]))
    out = np.empty(len(items), np.int64)
    out[order] = place - np.maximum.accumulate(np.where(new, place, 0))
    return out


def score_texts(
    docs: DataFrame,
    held: Column,
    chunk: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    prior: float = 1600.0,
) -> DataFrame:
    """Score every document by a model of those that are not ``held``.

    Columns: the id, ``held_out``, ``n_tokens`` (lower-cased words, and an end), ``n_known`` (of
    them, those in the training part), ``train_tokens``, ``base_score`` (log10 of the tokens by
    their counts plus one) and ``score`` (log10 of the bytes of the words and their ends by
    partial matching, adapting to the text: a word's own count so far in the text is added to
    ``prior`` times its probability by the corpus).  ``chunk`` numbers parts of the table that fit a task; it must not depend
    on how the input is split, see ``file_chunks``.

    The corpus gives a table of words that grows with it; each chunk is joined to the words that
    it uses, and nothing of the corpus is held whole anywhere.  A NULL or empty text is an end
    alone; a NULL ``held`` means training; ids are copied, NULL or repeated; equal texts have
    equal scores.  Other columns are not read.  Without training texts all bytes are equally
    likely.  An empty table gives no rows.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(
        F.coalesce(chunk, F.lit(0)).alias("chunk"), text_bytes(text_col).alias("text"),
        F.coalesce(held, F.lit(False)).alias("held"), F.col(id_col).alias("id"),
    )
    used = stage(_chunk_words(narrow), "words")
    vocabulary = stage(used.groupBy("word").agg(F.sum("n").cast("long").alias("n")), "vocabulary")
    total, distinct = vocabulary.filter("n > 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    total, distinct = int(total), int(distinct)
    scores = stage(score_vocabulary(vocabulary), "scores")
    needed = used.select("chunk", "word").join(scores, "word")
    ddl = (
        f"`{id_col}` {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double"
    )
    schema = arrow_schema(ddl)

    def rate(texts: pa.Table, found: pa.Table) -> pa.Table:
        at = {w: i for i, w in enumerate(found.column("word").to_pylist())}
        counts, values = found.column("n").to_numpy(), found.column("score").to_numpy()
        base = np.log10((counts + 1) / (total + distinct + 1))
        share, known = prior * 10**values, counts > 0
        out = [[], [], [], []]
        for text in texts.column("text"):
            words = text.as_py().lower().split()
            words.append(END)
            places = np.fromiter(map(at.__getitem__, words), np.int64, len(words))
            chance = (_before(places) + share[places]) / (np.arange(len(places)) + prior)
            out[0].append(len(places))
            out[1].append(int(np.count_nonzero(known[places])))
            out[2].append(float(base[places].sum()))
            out[3].append(float(np.log10(chance).sum()))
        return pa.Table.from_arrays(
            [texts.column("id").combine_chunks(), texts.column("held").combine_chunks(),
             pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
             pa.array([total] * len(out[0]), pa.int64()),
             pa.array(out[2], pa.float64()), pa.array(out[3], pa.float64())], schema=schema,
        )

    return narrow.groupBy("chunk").cogroup(needed.groupBy("chunk")).applyInArrow(rate, ddl)
