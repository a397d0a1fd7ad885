import math
import zlib
from collections import Counter, defaultdict

import cases
import numpy as np
import pytest

from weatherlake.llm import ngram_model, queries


class Brute:
    def __init__(self, rows):
        self.tokens = [(key, [*cases.words(cases.lower(text)), None]) for key, text in rows]
        self.words, self.pairs = Counter(), Counter()
        for key, tokens in self.tokens:
            if not self.held_out(key):
                self.words.update(tokens)
                self.pairs.update(zip(["<s>", *tokens[:-1]], tokens))
        self.after = Counter(word for _, word in self.pairs)
        self.d, self.d1 = self.discounts(self.pairs), self.discounts(self.after)
        self.word_rest = sum(self.d1[min(k, 3)] for k in self.after.values())
        self.total, self.rest = Counter(), defaultdict(float)
        for (before, _), n in self.pairs.items():
            self.total[before] += n
            self.rest[before] += self.d[min(n, 3)]

    @staticmethod
    def held_out(key):
        return key is not None and zlib.crc32(str(key).encode()) % 7 == 2

    @staticmethod
    def discounts(counts):
        n = [sum(c == k for c in counts.values()) for k in (1, 2, 3, 4)]
        if not all(n):
            return [0, 0.5, 1, 1.5]
        y = n[0] / (n[0] + 2 * n[1])
        found = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
        return [0, *(d if 0 <= d <= k else k / 2 for k, d in zip((1, 2, 3), found))]

    def word(self, word):
        size, types = len(self.words), len(self.pairs)
        if not types:
            return 1 / (size + 1)
        n = self.after[word]
        return (n - self.d1[min(n, 3)]) / types + self.word_rest / types / (size + 1)

    def pair(self, before, word):
        if not self.total[before]:
            return self.word(word)
        n = self.pairs[before, word]
        return (n - self.d[min(n, 3)]) / self.total[before] + self.rest[before] / self.total[before] * self.word(word)

    def rows(self):
        n, size = sum(self.words.values()), len(self.words)
        for key, tokens in self.tokens:
            score = sum(math.log10(self.pair(b, w)) for b, w in zip(["<s>", *tokens[:-1]], tokens))
            base = sum(math.log10((self.words[w] + 1) / (n + size + 1)) for w in tokens)
            yield key, self.held_out(key), len(tokens), sum(w in self.words for w in tokens), n, base, score


def check(docs, got):
    brute = Brute([(row.doc_id, row.text) for row in docs.select("doc_id", "text").collect()])
    order = lambda rows: sorted(rows, key=lambda r: (repr(r[0]), r[2], r[6]))
    got = order([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got.collect()])
    want = order(brute.rows())
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9)
    return brute, got


@pytest.mark.parametrize("table", [cases.edge, cases.documents, cases.clashing])
def test_equals_brute_force(spark, table):
    docs = table(spark)
    check(docs, ngram_model.train_and_score(docs))


def test_query_and_held_out_texts(spark):
    folder = "/root/testdata/sf0.01"
    brute, rows = check(spark.read.parquet(f"{folder}/documents.parquet"), queries.op8_ngram_model(spark, folder))
    held = [r for r in rows if r[1]]
    assert held and sum(r[6] for r in held) > sum(r[5] for r in held)
    some = ["the", "<s>", "of", "no such word"]
    for before in some:
        whole = sum(brute.pair(before, word) for word in brute.words) + brute.pair(before, "unknown word")
        assert whole == pytest.approx(1)


def test_empty_tables(spark):
    assert ngram_model.train_and_score(cases.empty(spark)).count() == 0
    only_held_out = spark.createDataFrame([(k, "a b", "en", "s", 1) for k in range(60) if Brute.held_out(k)], cases.SCHEMA)
    check(only_held_out, ngram_model.train_and_score(only_held_out))


def test_pairs_are_one_to_one():
    for words in (0, 1, 5, 1000, (1 << 32) - 3):
        pairs = ngram_model.Pairs(words)
        left, right = (np.random.default_rng(k).integers(0, words + 1, 2000, dtype=np.uint64) for k in (1, 2))
        a, b = pairs.ids(pairs.key(left, right))
        assert (a == left).all() and (b == right).all()
    with pytest.raises(ValueError):
        ngram_model.Pairs(1 << 32)


def test_packed_counts_round_trip():
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 63, 5000, dtype=np.uint64))
    counts = np.arange(len(keys), dtype=np.uint64)
    a, b = ngram_model.unpack(ngram_model.pack(keys, counts), 2)
    assert (a == keys).all() and (b == counts).all()


def test_tasks_that_send_their_counts_in_parts_count_the_same(spark, monkeypatch):
    streams = [np.random.default_rng(k).integers(0, 50, 400, dtype=np.uint64) << np.uint64(58) for k in range(9)]
    whole = Counter(np.concatenate(streams).tolist())
    for limit in (10, 10_000):
        monkeypatch.setattr(ngram_model, "HELD_KEYS", limit)
        gathered = ngram_model.Gathered(2)
        for batch in ngram_model.counted(iter(streams), 4, 62):
            for part, blob in zip(*(c.to_pylist() for c in batch.columns)):
                gathered.add(part, blob)
        got = {int(k): int(n) for _, (keys, counts) in gathered for k, n in zip(keys, counts)}
        assert got == whole
