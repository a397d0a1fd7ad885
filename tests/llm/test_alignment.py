import hashlib
import random
from collections import Counter

import cases
import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from weatherlake.llm import alignment, queries
from weatherlake.llm.queries import BYTE_TOKENIZER, PIECE_TOKENIZER, tokenizer_path

FILES = tokenizer_path(BYTE_TOKENIZER), tokenizer_path(PIECE_TOKENIZER)


@pytest.fixture(scope="module")
def plain():
    """(groups of a text) by the libraries and a walk over both sides; none where the bytes differ."""
    a_side = Tokenizer.from_file(FILES[0])
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    alphabet = alignment.byte_alphabet()
    names = {i: piece for piece, i in a_side.get_vocab().items()}

    def b_bytes(i):
        piece = b_side.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_side.is_byte(i) else piece.replace("▁", " ").encode()

    def groups(text):
        if not text:
            return []
        a = a_side.encode(" " + text, add_special_tokens=False).ids
        b = b_side.encode(text)
        a_parts = [bytes(alphabet[c] for c in names[i]) for i in a]
        b_parts = [b_bytes(i) for i in b]
        if not b"".join(a_parts) == b"".join(b_parts) == (" " + text).encode():
            return []
        found, i, j = [], 0, 0
        while i < len(a):
            start_i, start_j, left, right = i, j, len(a_parts[i]), len(b_parts[j])
            while left != right:
                if left < right:
                    i += 1
                    left += len(a_parts[i])
                else:
                    j += 1
                    right += len(b_parts[j])
            i, j = i + 1, j + 1
            found.append((a[start_i:i], b[start_j:j]))
        return found

    return groups


def written(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def expected(plain, rows):
    all_groups = [plain(row.text) for row in rows]
    links = [Counter((x, y) for a, b in groups for x in a for y in b) for groups in all_groups]
    docs = Counter(pair for own in links for pair in own)
    most = {}
    for (x, _), n in docs.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for row, groups, own in zip(rows, all_groups, links):
        digest = hashlib.sha256(written(groups).encode()).hexdigest() if groups else ""
        out.append((
            row.doc_id, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(own.values()),
            sum(n for pair, n in own.items() if docs[pair] == most[pair[0]]), sum(n * docs[pair] for pair, n in own.items()), digest,
        ))
    return sorted(out, key=repr)


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def rows_of(df):
    return sorted((tuple(row[name] for name in NAMES) for row in df.collect()), key=repr)


def odd_texts(spark):
    texts = ["a▁b", "<s> <0x41> </s> <|endoftext|>", "aaaa" * 700, " ", "\n\n", "  two  spaces ", "中文字符 and é😀", "\x00", "￼", "tab\tend\r\n", "ab" * 40, "ab" * 40]
    return spark.createDataFrame([(i % 9, text) for i, text in enumerate(texts)], "doc_id LONG, text STRING")


@pytest.mark.parametrize("table", [cases.edge, cases.clashing, odd_texts, lambda spark: cases.documents(spark, 60)])
@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 50, 0.5])
def test_equals_a_plain_walk(spark, plain, monkeypatch, table, frequent):
    """With all pairs looked up, some of them, and none."""
    monkeypatch.setattr(alignment, "FREQUENT", frequent)
    docs = table(spark)
    assert rows_of(alignment.align_documents(docs, *FILES)) == expected(plain, docs.collect())


def test_query(spark, plain):
    docs = cases.documents(spark)
    assert rows_of(queries.op12_alignment(spark, "/root/testdata/sf0.001")) == expected(plain, docs.collect())


def test_parts_of_texts_with_many_links(spark, plain, monkeypatch):
    docs = odd_texts(spark).unionByName(cases.documents(spark, 20).select("doc_id", "text"))
    want = expected(plain, docs.collect())
    own = alignment.aligner(*FILES)
    texts = [row.text for row in docs.collect()]
    for limit in (1, 7, 1000):
        monkeypatch.setattr(alignment, "LINKS_AT_ONCE", limit)
        found = {}
        for which, pairs, times in alignment.Chunk(own, texts).pairs():
            for text, pair, n in zip(which.tolist(), pairs.tolist(), times.tolist()):
                assert (text, pair) not in found
                found[text, pair] = n
        for i, text in enumerate(texts):
            links = Counter(x * own.b_ids.size + y for a, b in plain(text) for x in a for y in b)
            assert links == {pair: n for (k, pair), n in found.items() if k == i}
    # The workers are forked from another process, so the limit is set in what they are sent.
    assert rows_of(alignment.align_documents(docs, *FILES)) == want


def test_groups_as_text_and_pair_table(spark, plain):
    docs = cases.documents(spark, 30)
    aligned = alignment.align(docs, *FILES, with_groups=True)
    texts = {row.doc_id: row.text for row in docs.collect()}
    assert all(row.groups == written(plain(texts[row.doc_id])) for row in aligned.collect())
    size = sentencepiece.SentencePieceProcessor(model_file=FILES[1]).get_piece_size()
    counts = {row.pair: (row.docs, row.best) for row in alignment.pair_counts(aligned, size).collect()}
    want = Counter()
    for text in texts.values():
        want.update({x * size + y for a, b in plain(text) for x in a for y in b})
    assert {pair: n for pair, (n, _) in counts.items()} == want
    for pair, (n, best) in counts.items():
        assert best == (n == max(m for other, m in want.items() if other // size == pair // size))


def test_empty_table(spark):
    assert alignment.align_documents(cases.empty(spark), *FILES).count() == 0


def test_labels_of_random_cuts():
    rng = random.Random(5)
    for _ in range(300):
        length = rng.randint(1, 60)
        a = sorted({*rng.sample(range(1, length + 1), rng.randint(1, length)), length})
        b = sorted({*rng.sample(range(1, length + 1), rng.randint(1, length)), length})
        common = sorted(set(a) & set(b))
        a_group, b_group = alignment.group_labels(np.array(a), np.array(b))
        assert a_group.tolist() == [sum(c < end for c in common) for end in a]
        assert b_group.tolist() == [sum(c < end for c in common) for end in b]


def test_long_chain_of_overlaps():
    """No common end but the last: one group, whatever the number of tokens between."""
    a = np.append(np.arange(2, 200_000, 2), 200_001)
    b = np.append(np.arange(1, 200_000, 2), 200_001)
    a_group, b_group = alignment.group_labels(a, b)
    assert not a_group.any() and not b_group.any()
