import zlib

import numpy as np

from macroloom.llm import quality
from macroloom.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"


def test_features_of_a_text_do_not_depend_on_its_neighbours():
    texts = [b"", b"a bc  d\n", b" ", b"the the the", "Größe größer".encode(), b"x"]
    text, bucket, share = quality.features(texts)
    for i, t in enumerate(texts):
        alone = quality.features([t])
        assert bucket[text == i].tolist() == alone[1].tolist() and share[text == i].tolist() == alone[2].tolist()
    total = np.bincount(text, share, len(texts))
    assert np.allclose(total[[0, 2]], 0) and np.allclose(total[[1, 3, 4]], 1)
    # Brute force over the n-grams that a text has, spaces around words counted in.
    grams = {n: [g for w in t.split() for g in [(b" " + w + b" ")[i : i + n] for i in range(len(w) + 3 - n)]] for t in [b"a bc  d\n"] for n in quality.GRAMS}
    assert sum(map(len, grams.values())) + 3 + 2 == int((text == 1).sum())


def test_held_out_accuracy(spark):
    scored = {r.doc_id: r for r in QUERIES["op11_quality"](spark, DATA).collect()}
    labels = [r for r in spark.read.parquet(f"{DATA}/labels.parquet").collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(scored) == spark.read.parquet(f"{DATA}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in scored.items())
    good = np.array([scored[r.doc_id].score for r in labels if r.quality == 1])
    bad = np.array([scored[r.doc_id].score for r in labels if r.quality == 0])
    assert (good[:, None] > bad).mean() > 0.95 and (good >= 0.3).mean() > 0.97


def frame(spark, table, schema="doc_id long, text string, label int, score string"):
    return spark.createDataFrame(table, schema)


def test_odd_rows_and_labels(spark):
    clean = [(i, f"plain words number {i % 7} in a row", None, "s") for i in range(40)]
    noisy = [(100 + i, "### $$$ " * (i % 5 + 1), None, "s") for i in range(40)]
    odd = [(200, None, None, "s"), (201, "", None, "s"), (None, "plain words", None, "s"), (0, clean[0][1], None, "s"), (202, "plain words " * 50000, None, "s")]
    docs = frame(spark, clean + noisy + odd)
    marks = [(i, 1) for i in range(30)] + [(100 + i, 0) for i in range(30)] + [(None, 1), (3, None), (999, 0), (5, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    model = quality.train(docs, labels, sample=20)
    got = quality.score_quality(docs, model)
    assert got.columns == ["doc_id", "score"] and got.count() == 85
    score = {r.doc_id: r.score for r in got.collect()}
    assert all(score[i] > 0.8 for i in range(40)) and all(score[100 + i] < 0.2 for i in range(40)) and score[202] > 0.8
    assert score[200] == score[201] and 0 < score[200] < 1
    assert np.array_equal(quality.train(docs.repartition(5), labels, sample=20).vectors, model.vectors)
    assert quality.score_quality(docs.where("false"), model).count() == 0


def test_labels_of_no_or_one_class(spark):
    docs = frame(spark, [(1, "a b", None, "s"), (2, None, None, "s")])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.train(docs, none) is None
    assert [r.score for r in quality.score_quality(docs, None).collect()] == [0.5, 0.5]
    one = quality.train(docs, spark.createDataFrame([(1, 0)], "doc_id long, quality int"))
    assert [r.score for r in quality.score_quality(docs, one).collect()] == [0.0, 0.0]
    assert [r.score for r in quality.score_quality(docs, one, target=0).collect()] == [1.0, 1.0]
