import os
import re
import sys

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import corpus_pipeline
from macroloom.llm.queries import BYTE_BPE
from test_decontaminate import brute as passages
from test_neardup import brute as classes

DATA = "/root/testdata/sf0.001"
SECRETS = (r"(?i)(?<=token = \")([0-9a-f]{40})", r"(?i)(?<=password=)([0-9a-f]{18})", r"(?i)\b(AKIA[0-9A-Z]{16})\b")


def test_stages_against_brute_force(spark):
    documents = spark.read.parquet(f"{DATA}/documents.parquet")
    extra = spark.createDataFrame([(-1, None, "en", "s", 0), (-2, "12 34", "en", "s", 5), (-3, "", None, None, None)], documents.schema)
    docs, rows = documents.union(extra), None
    benchmark = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, DATA)
        rows = {r.doc_id: r for r in out.collect()}
        if n < 4:
            assert out.columns == documents.columns
        if name == "language":
            assert set(before) - set(rows) >= {-1, -2, -3} and len(rows) >= 0.97 * (len(before) - 3)
        elif name == "near_duplicates":
            found = classes([(i, r.text) for i, r in before.items()])
            assert set(rows) == {i for i, c in found.items() if i == c} and len(rows) < len(before)
        elif name == "decontaminated":
            assert set(rows) == {i for i, r in before.items() if not passages(r.text, benchmark)[1]} and len(rows) < len(before)
        elif name == "masked":
            assert set(rows) == set(before)
            for i, r in rows.items():
                want = before[i].text
                for s in {m for p in SECRETS for m in re.findall(p, want)}:
                    want = want.replace(s, "[SECRET]")
                assert r.text == want and r.n_chars == len(want)
        else:
            tokenizer = Tokenizer.from_file(BYTE_BPE)
            assert set(rows) == set(before)
            for i, r in rows.items():
                assert np.frombuffer(r.ids, "<u4").tolist() == tokenizer.encode(before[i].text, add_special_tokens=False).ids
                assert (r.text, r.n_tokens) == (before[i].text, len(r.ids) // 4)
            continue
        docs = spark.createDataFrame(list(rows.values()), documents.schema)
    assert {r.doc_id for r in corpus_pipeline.run(spark, DATA).collect()} == set(rows)


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA)
        assert out.count() == 0
        docs = docs.sparkSession.createDataFrame([], docs.schema)


def test_copies_under_one_id_and_clashing_columns(spark):
    """Columns named like the stages' results stay, and of rows that share an id or have none one of equal text stays."""
    text = spark.read.parquet(f"{DATA}/documents.parquet").where("lang = 'en' and length(text) > 400").orderBy("doc_id").limit(2).collect()
    one, two = text[0].text, text[1].text
    names = ["lang_pred", "score", "items", "spans", "n_words", "n_hit", "weight", "kept", "component_id", "row", "shared"]
    rows = [(5, one), (5, one), (5, one), (7, one), (None, two), (None, two), (3, None), (3, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, *[f"{n}{k}" for n in names]) for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names))
    kept = corpus_pipeline.near_duplicates(spark, docs, DATA)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(5, one), (None, two), (3, None)], key=str)
    clean = corpus_pipeline.decontaminated(spark, docs, DATA)
    assert clean.columns == docs.columns and {r["n_hit"][:5] for r in clean.collect()} <= {"n_hit"}
    # The language stage learns from the documents it gets, so it gets all others too.
    every = spark.read.parquet(f"{DATA}/documents.parquet").select("*", *[F.lit(n).alias(n) for n in names])
    judged = corpus_pipeline.language(spark, every, DATA)
    assert judged.columns == every.columns and judged.where("score = 'score' and lang_pred = 'lang_pred'").count() == judged.count() > 0


def test_texts_go_to_the_tasks_once(spark):
    docs = spark.createDataFrame([(1, "one two", "en", 7), (None, None, None, None)], "doc_id long, text string, `la.ng` string, n_chars long")
    rows = corpus_pipeline.packed(docs)
    assert [c for c in rows.schema["row"].dataType.names if c == "text"] == []
    assert corpus_pipeline.unpacked(rows, docs).columns == docs.columns
    assert sorted(corpus_pipeline.unpacked(rows, docs).collect(), key=str) == sorted(docs.collect(), key=str)
