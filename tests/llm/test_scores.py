"""Scores by partial matching against a model written out plainly."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardlens.llm import ppm
from wardlens.llm.queries import QUERIES




def score(docs, **how):
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return ppm.score_texts(docs, held, F.lit(1).cast("long"), **how)


def is_held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


class Plain:
    """Contexts as dictionaries; the same escapes and exclusions, one symbol at a time."""

    def __init__(self, words):
        self.uses, self.kinds, self.long = (defaultdict(Counter) for _ in range(3))
        for word, n in words.items():
            marked = b" " + word + (b"" if word == b"\n" else b" ")
            for i in range(1, len(marked)):
                for k in range(min(i, 4) + 1):
                    self.uses[marked[i - k : i]][marked[i]] += n
                    self.kinds[marked[i - k : i]][marked[i]] += 1
                if i > 4:
                    self.long[marked[1:i]][marked[i]] += n
        self.escapes = [self.observe(self.uses, True), self.observe(self.kinds, False)]

    def observe(self, table, long):
        seen = defaultdict(lambda: [0, 0])

        def note(order, way, total, kinds, new, n):
            if total > 0:
                entry = seen[order, way, int(math.log2(total)), min(kinds, 9)]
                entry[0] += new * n
                entry[1] += n

        for context, symbols in table.items():
            total = sum(symbols.values())
            for s, n in symbols.items():
                note(len(context), 0, total - 1, len(symbols) - (n == 1), n == 1, n)
                if not context:
                    continue
                under = table[context[1:]]
                below, others = sum(under.values()), sum(under[x] for x in symbols)
                if n == 1 and total > 1:
                    note(len(context) - 1, 1, below - (others - under[s]) - 1,
                         len(under) - (len(symbols) - 1) - (under[s] == 1), under[s] == 1, 1)
                if total == 1:
                    note(len(context) - 1, 2, below - 1, len(under) - (under[s] == 1), under[s] == 1, 1)
                    if len(context) > 1 and under[s] == 1 and below > 1:
                        last = table[context[2:]]
                        note(len(context) - 2, 3, sum(last.values()) - (sum(last[x] for x in under) - last[s]) - 1,
                             len(last) - (len(under) - 1) - (last[s] == 1), last[s] == 1, 1)
        for symbols in self.long.values() if long else ():
            for n in symbols.values():
                note(5, 0, sum(symbols.values()) - 1, len(symbols) - (n == 1), n == 1, n)
        return seen

    def escape(self, model, order, way, total, kinds):
        if total <= 0:
            return 1.0
        new, every = self.escapes[model].get((order, way, int(math.log2(total)), min(kinds, 9)), (0, 0))
        return min(max((new + 2 * kinds / (total + kinds)) / (every + 2), 1e-9), 1 - 1e-9)

    def window(self, model, context, symbol):
        table = (self.uses, self.kinds)[model]
        p, excluded, fresh = 1.0, set(), 0
        while True:
            known = table.get(context)
            symbols = {s: n for s, n in (known or {}).items() if s not in excluded}
            total = sum(symbols.values())
            leave = self.escape(model, len(context), 2 * fresh + bool(excluded), total, len(symbols))
            if symbol in symbols:
                return p * (1 - leave) * symbols[symbol] / total
            p *= leave
            fresh |= known is None and not excluded
            excluded |= set(known or ())
            if not context:
                return p / (256 - len(excluded))
            context = context[1:]

    def word(self, word):
        marked = b" " + word + (b"" if word == b"\n" else b" ")
        p, lost = 1.0, False
        for i in range(1, len(marked)):
            near, s = marked[max(0, i - 4) : i], marked[i]
            if i <= 4:
                p *= self.window(0, near, s)
                continue
            node = self.long.get(marked[1:i])
            if lost or node is None:
                lost = True
                p *= self.window(1, near, s)
            elif s in node:
                total = sum(node.values())
                p *= (1 - self.escape(0, 5, 0, total, len(node))) * node[s] / total
            else:
                lost = True
                total = sum(node.values())
                left = 1 - sum(self.window(1, near, x) for x in node)
                p *= self.escape(0, 5, 0, total, len(node)) * self.window(1, near, s) / max(left, 1e-9)
        return p


def test_scores_agree_with_a_plain_model(spark, tables):
    docs = tables("documents").orderBy("doc_id").limit(60)
    texts = {r.doc_id: (r.text or "").encode().lower().split() for r in docs.collect()}
    words = Counter()
    for doc, text in texts.items():
        if not is_held(doc):
            words.update(text)
            words[b"\n"] += 1
    model, total = Plain(words), sum(words.values())
    rows = {r.doc_id: r for r in score(docs).collect()}
    assert set(rows) == set(texts)
    chance = {}
    for doc, text in texts.items():
        r, seen, want, base = rows[doc], Counter(), 0.0, 0.0
        for i, w in enumerate([*text, b"\n"]):
            if w not in chance:
                chance[w] = model.word(w)
            want += math.log10((seen[w] + 1600 * chance[w]) / (i + 1600))
            base += math.log10((words[w] + 1) / (total + len(words) + 1))
            seen[w] += 1
        assert (r.held_out, r.n_tokens, r.train_tokens) == (is_held(doc), len(text) + 1, total)
        assert r.n_known == sum(words[w] > 0 for w in [*text, b"\n"])
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score == pytest.approx(want, rel=1e-6)


def test_probabilities_after_a_context_sum_to_one():
    words = {f"w{i * i % 977}x".encode(): 1 + i % 5 for i in range(400)} | {b"\n": 30}
    model = Plain(words)
    for table, nth in ((model.uses, 0), (model.kinds, 1)):
        for context in list(table)[::37]:
            assert 0.8 < sum(model.window(nth, context, s) for s in range(256)) <= 1 + 1e-9


def test_chunks_do_not_change_scores(spark, tables):
    docs = tables("documents")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    one = {r.doc_id: r.score for r in score(docs).collect()}
    many = {r.doc_id: r.score for r in ppm.score_texts(docs, held, F.col("doc_id") % 9).collect()}
    assert one == pytest.approx(many, rel=1e-9)


def test_query_covers_all_documents(spark, folder, tables):
    rows = QUERIES["op1_partial_matching"](spark, folder).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in tables("documents").select("doc_id").collect()}
    assert all(r.score < 0 and np.isfinite(r.score) for r in rows)


def test_odd_documents(spark, odd_docs):
    rows = score(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = defaultdict(set)
    for r in rows:
        by[r.doc_id].add(r.score)
        assert np.isfinite(r.score)
    assert by[1] == by[2] == by[3] and len(by[5]) == 1
    assert score(odd_docs.limit(0)).count() == 0
    all_held = ppm.score_texts(odd_docs, F.lit(True), F.lit(1).cast("long")).collect()
    assert all(r.train_tokens == r.n_known == 0 and np.isfinite(r.score) for r in all_held)
