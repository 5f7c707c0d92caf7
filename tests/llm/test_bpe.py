import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from macroloom.llm import bpe
from macroloom.llm.queries import BYTE_BPE


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(BYTE_BPE)


def texts():
    rng = random.Random(5)
    bits = ["the ", "word", " \t", "\n\n", "  ", "é", "日本語", "<|endoftext|>", "don't", "\x1c", "\u00a0", "!", "42", "🙂", "'s", "\u2003", "x" * 40, "token = \"ab12\""]
    made = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    shared = " ".join(rng.choice(["alpha", "beta", "gamma", "de", "l'eau,"]) for _ in range(3000))
    return [*made, shared, shared[7:], "a" * 200_000, " " * 5000, "", shared + made[3] + shared]


def test_chunks_agree_with_whole_texts(tokenizer):
    encoder, decoder = bpe.ChunkEncoder(BYTE_BPE), bpe.IdDecoder(BYTE_BPE)
    all_texts = texts()
    for _ in range(2):  # the second time from the stores
        for text, ids in zip(all_texts, encoder.encode([t.encode() for t in all_texts])):
            want = tokenizer.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == want
            assert decoder.decode(ids) == tokenizer.decode(want, skip_special_tokens=False) == text
    assert sum(map(len, encoder.chunks)) < sum(len(t.encode()) for t in all_texts)


def test_emptied_stores_change_nothing(tokenizer, monkeypatch):
    monkeypatch.setattr(bpe, "STORE_BYTES", 200)
    encoder = bpe.ChunkEncoder(BYTE_BPE)
    for text in texts()[:80]:
        assert np.frombuffer(encoder.encode([text.encode()])[0], "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_odd_rows(spark, tokenizer):
    rows = [(1, "some text", "x"), (1, "some text", "y"), (None, "", "z"), (3, None, "ids")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(bpe.encode_documents(docs, BYTE_BPE).collect(), key=str)
    assert [(r.doc_id, len(r.ids) // 4, r.decoded) for r in got] == [(1, 2, "some text"), (1, 2, "some text"), (3, 0, ""), (None, 0, "")]
    assert bpe.encode_documents(docs.where("false"), BYTE_BPE).count() == 0


class Counting:
    def __init__(self, tokenizer):
        self.tokenizer, self.asked = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.asked += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_new_pieces_are_encoded_together_and_once(tokenizer):
    encoder = bpe.ChunkEncoder(BYTE_BPE)
    encoder.tokenizer = Counting(encoder.tokenizer)
    rng = random.Random(7)
    words = ["".join(rng.choice("aeioustrnlé日") for _ in range(rng.randint(1, 30))) for _ in range(5000)]
    text = " ".join(words) + "\n\n" + " ".join(words[::-1])
    want = tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode([text.encode()])[0], "<u4").tolist() == want
    assert encoder.tokenizer.asked < 50
    asked = encoder.tokenizer.asked
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode([text.encode()] * 2)] == [want] * 2
    assert encoder.tokenizer.asked == asked


def test_a_table_too_small_changes_nothing(tokenizer, monkeypatch):
    monkeypatch.setattr(bpe, "TABLE_BITS", 15)
    encoder = bpe.ChunkEncoder(BYTE_BPE)
    rng = random.Random(8)
    for _ in range(4):
        text = " ".join(str(rng.randint(0, 10**6)) for _ in range(14_000))
        assert np.frombuffer(encoder.encode([text.encode()])[0], "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
