import hashlib
import random

import cases
import pyarrow as pa
import pytest

from weatherlake.llm import piece_bpe, queries
from weatherlake.llm.queries import PIECE_TOKENIZER, tokenizer_path


@pytest.fixture(scope="module")
def own():
    return piece_bpe.encoder(tokenizer_path(PIECE_TOKENIZER))


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def check(own, docs, got):
    found = sorted(repr((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256)) for r in got.collect())
    want = []
    for row in docs.collect():
        ids = [*own.library.encode(row.text or ""), own.library.eos_id()]
        want.append(repr((row.doc_id, len(ids), digest(" ".join(map(str, ids))), digest(own.library.decode(ids)))))
    assert found == sorted(want)


@pytest.mark.parametrize("table", [cases.edge, cases.documents, cases.clashing])
def test_equals_the_library(spark, own, table):
    docs = table(spark)
    check(own, docs, piece_bpe.encode_documents(docs, tokenizer_path(PIECE_TOKENIZER)))


def test_query(spark, own):
    folder = "/root/testdata/sf0.01"
    check(own, spark.read.parquet(f"{folder}/documents.parquet"), queries.op3_sentencepiece(spark, folder))


def test_empty_table_and_full_output(spark):
    path = tokenizer_path(PIECE_TOKENIZER)
    assert piece_bpe.encode_documents(cases.empty(spark), path).count() == 0
    rows = piece_bpe.encode_documents(cases.documents(spark, 5), path, with_ids=True).collect()
    texts = {row.doc_id: row.text for row in cases.documents(spark, 5).collect()}
    assert all(row.decoded == texts[row.doc_id] and len(row.ids) == row.n_tokens for row in rows)


def test_random_texts_equal_the_library(own):
    rng = random.Random(7)
    parts = ["a", "b", "e", "t", " ", "  ", "\n", "▁", "é", "中", "😀", "\x00", "\t", "the", "in", "ing", " " * 17, "0", "1", "　", "<s>", "<0x41>", "</s>", "﻿", "é"]
    for _ in range(6000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        assert own.encode(text) == own.library.encode(text), repr(text)


def test_the_pair_test_equals_merging_the_pair(own):
    rng = random.Random(3)
    pieces = sorted(own.halves)
    for _ in range(20_000):
        left, right = rng.choice(pieces), rng.choice(pieces)
        *_, merged = own.merges(left + right)
        assert own._compatible((left, right)) == (merged == [left, right]), (left, right)


def test_each_prefix_has_its_encodings_last_token(own):
    text = "▁international,naïve▁▁▁▁spacing中文"
    last = own.last_tokens(text)
    for end in range(1, len(text) + 1):
        *_, merged = own.merges(text[:end])
        assert last[end] == merged[-1]


def test_long_text_without_blanks(own):
    text = "abcdefghij" * 20_000
    assert own.encode(text) == own.library.encode(text)


PARTS = ["a", "b", "e", "t", " ", "  ", "\n", "\n\n", "▁", "é", "中", "😀", "\x00", "\t", "the", "in", "ing", "tion", "0", "1", "　", "</s>", "ß", "้", "xq", " " * 17]


def test_unseen_segments_are_not_encoded_one_by_one():
    own = piece_bpe.PieceEncoder(tokenizer_path(PIECE_TOKENIZER))
    rng = random.Random(11)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60))) for _ in range(5000)]
    single, calls = own.last_tokens, []
    own.last_tokens = lambda text: calls.append(text) or single(text)
    got = list(own.encode_all(pa.array([*texts, None])))
    assert got == [*own.library.encode(texts), []]
    # Long segments only, which are not remembered either.
    assert all(len(segment) > piece_bpe.LONGEST_REMEMBERED for segment in calls)


def test_many_chunks_and_forgotten_segments(own, monkeypatch):
    monkeypatch.setattr(piece_bpe, "CHUNK_BYTES", 1000)
    fresh = piece_bpe.PieceEncoder(tokenizer_path(PIECE_TOKENIZER))
    fresh.remembered.limit = 50
    fresh.tested = fresh.tested[:1]
    fresh._slots = lambda pairs: pairs * 0  # all pairs meet in one slot
    rng = random.Random(12)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60))) for _ in range(600)]
    assert list(fresh.encode_all(pa.array(texts))) == own.library.encode(texts)


@pytest.mark.parametrize("text", ["\n", "\n\nb", "b\n\n", "  ", " \n ", "▁▁\n▁", "a\nb  c\n\n▁d", "é", "中\n", ""])
def test_texts_stand_alone(own, text):
    assert list(own.encode_all(pa.array([text, text, "", text + "x", text]))) == own.library.encode([text, text, "", text + "x", text])


def test_side_by_side_equals_one_by_one(own):
    rng = random.Random(13)
    characters = [c for c in own.tokens[1 : own.width] if c not in "\n▁"] + ["😀", "\U0010ffff"]
    words = list({"".join(rng.choice(characters[:200] if rng.random() < 0.9 else characters) for _ in range(rng.randint(1, 48))) for _ in range(3000)})
    words += [w for w in own.tokens[1:] if "\n" not in w]
    assert own._encode_side_by_side(words) == [own._encode(w) for w in words]
