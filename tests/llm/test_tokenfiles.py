import glob

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from macroloom.llm import rangecoder, tokenfiles
from macroloom.llm.queries import BYTE_BPE


@settings(max_examples=30, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 6), st.integers(0, 65535)), max_size=400), st.integers(1, 90))
def test_round_trip(ids, block):
    ids = np.array(ids, np.int64)
    coded = rangecoder.encode(ids, block)
    assert len(coded) == -(-len(ids) // block)
    assert np.array_equal(rangecoder.decode(coded, len(ids), 65536, block), ids)


def test_learns_and_resets():
    rng = np.random.default_rng(3)
    ids = rng.zipf(1.4, 12_000) % 30_000
    coded = rangecoder.encode(ids, 4096)
    assert 8 * sum(map(len, coded)) < 13 * len(ids)
    assert 8 * sum(map(len, rangecoder.encode(np.tile(np.arange(50), 200)))) < 0.5 * 10_000
    assert np.array_equal(rangecoder.decode(coded[1:2], 4096, 30_000), ids[4096:8192])  # a block alone
    with pytest.raises(ValueError):
        rangecoder.encode(np.array([65536]))


def test_damage_is_an_error():
    data = tokenfiles.pack(np.array([5, 0]), np.array([False, True]), np.array([3, 2]), np.array([1, 2, 3, 4, 5]))
    names, absent, lengths, ids = tokenfiles.unpack(data)
    assert (names.tolist(), absent.tolist(), lengths.tolist(), ids.tolist()) == ([5, 0], [False, True], [3, 2], [1, 2, 3, 4, 5])
    for at in (0, 9, 40, len(data) - 1):
        with pytest.raises(ValueError):
            tokenfiles.unpack(data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :])


def test_files_hold_the_documents_in_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenfiles, "SEGMENT", 300)
    texts = ["some words of text " * (i % 9) for i in range(80)] + [None, "", "x" * 30_000, "again", "again"]
    ids = [(i * 37) % 80 for i in range(80)] + [200, 201, 202, 203, 203]
    docs = spark.createDataFrame([*((i, t, "s") for i, t in zip(ids, texts)), (None, "no id", "s")], "doc_id long, text string, segment string")
    folder = str(tmp_path / "tokens")
    tokenfiles.write_tokens(docs, folder, BYTE_BPE)
    got = sorted(tokenfiles.read_tokens(spark, folder).collect(), key=lambda r: r.start)
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    want = sorted([(i, t) for i, t in zip(ids, texts)] + [(-1, "no id")], key=lambda x: x[0])
    start = 0
    for r, (i, t) in zip(got, want, strict=True):
        own = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        assert (r.doc_id if r.doc_id is not None else -1, r.start, np.frombuffer(r.ids, "<u4").tolist()) == (i, start, own)
        start += len(own)
    assert glob.glob(folder + "/*.parquet")
    tokenfiles.write_tokens(docs.where("false"), folder + "2", BYTE_BPE)
    assert tokenfiles.read_tokens(spark, folder + "2").count() == 0


def test_known_blocks_are_predicted_as_in_decoding():
    rng = np.random.default_rng(4)
    tokens = (rng.zipf(1.5, (3, 500)) % 40 + 1).astype(np.int32)
    states, model = rangecoder.predictions(tokens, 4), rangecoder.Model(3, 4)
    for step in range(500):
        model.predict()
        token, sure1 = tokens[:, step], model.sure1 * (model.guess1 != model.guess2)
        part = np.where(model.guess2 == token, 0, np.where(model.guess1 == token, 1, 2))
        assert (states[:, step] == model.sure2 + 4 * sure1 + 16 * part).all()
        model.learn(token)


def test_odd_blocks_and_ids():
    rng = np.random.default_rng(5)
    for ids in (np.arange(65536), np.full(9000, 65535), rng.integers(0, 65536, 20_000), np.array([0]), rng.integers(0, 2, 8193)):
        for block in (1, 2, 1000, 8192) if len(ids) < 10_000 else (1000, 8192):
            coded = rangecoder.encode(ids, block)
            assert np.array_equal(rangecoder.decode(coded, len(ids), 65536, block), ids)
    with pytest.raises(ValueError):
        rangecoder.encode(np.arange(9000), 8193)
    with pytest.raises(ValueError):
        rangecoder.decode(rangecoder.encode(np.array([7])), 1, 7)
