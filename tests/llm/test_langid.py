import math

import numpy as np
import pytest

from macroloom.llm import langid
from macroloom.llm.queries import MULTI_BPE, op1_language_id


@pytest.fixture(scope="module")
def pieces():
    return langid.Pieces(MULTI_BPE)


def all_segmentations(data, probability):
    """Brute force: every way to cut, one by one."""
    if not data:
        return 1.0
    return sum(probability[data[:k]] * all_segmentations(data[k:], probability) for k in range(1, len(data) + 1) if data[:k] in probability)


def test_forward_sums_every_segmentation(pieces):
    rng = np.random.default_rng(3)
    weights = rng.random((len(pieces.pieces), 2)) * 1e-3
    words = ["the", "token", "été", "ñandú", "日本", "a"]
    got = langid.word_scores(words, pieces, langid.tilted(weights, pieces))
    for lang in range(2):
        probability = {p: weights[i, lang] for i, p in enumerate(pieces.pieces)}
        for word, score in zip(words, got[:, lang]):
            assert math.isclose(score, math.log(all_segmentations((" " + word).encode(), probability)), rel_tol=1e-9)


def test_expected_counts_cover_the_bytes(pieces):
    weights = np.full((len(pieces.pieces), 1), 1 / len(pieces.pieces))
    counts = langid.expected_counts(["tion", "tion" * 40], np.array([2.0, 1.0]), np.array([0, 0]), pieces, langid.tilted(weights, pieces))
    assert math.isclose(sum(c * len(p) for c, p in zip(counts[:, 0], pieces.pieces)), 2 * 5 + 161, rel_tol=1e-9)
    assert all(len(r) <= langid.WORD_BYTES and r.decode() is not None for r in langid.runs_of("é" * 500))


def test_held_out_accuracy(spark):
    got = op1_language_id(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").where("held_out").collect()
    assert got.count() == docs.count() and len(rows) > 200
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark):
    rows = [(1, "the and of the", "en", 1), (2, "der die und das", "de", 2), (2, "der die und das", "de", 2), (3, None, "de", 3), (4, "", None, 4), (None, "12 ½ !", "en", 5), (5, "und " * 50_000, None, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    model = langid.train(docs, MULTI_BPE)
    got = sorted(((r.doc_id or 0, r.lang_pred) for r in langid.identify(docs, model).collect()))
    assert got == [(0, "und"), (1, "en"), (2, "de"), (2, "de"), (3, "und"), (4, "und"), (5, "de")]
    none = langid.train(docs.where("false"), MULTI_BPE)
    assert {r.lang_pred for r in langid.identify(docs, none).collect()} == {"und"}
    assert langid.identify(docs.where("false"), model).count() == 0
