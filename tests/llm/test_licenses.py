import pytest
from pyspark.sql import functions as F

from macroloom.llm import licenses
from macroloom.llm.queries import op10_licenses

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def known(spark):
    return licenses.templates(spark)


@pytest.fixture(scope="module")
def model(spark, known):
    return licenses.train(licenses.paragraphs(spark.read.parquet(f"{DATA}/documents.parquet")), known)


def test_families_unknown_and_none(spark, known, model):
    lines = {
        "Released under the MIT License.": "mit",
        "word thing licensed under the Apache License, Version 2.0. thing": "apache",
        "LICENSED UNDER CC BY-NC 4.0.": "cc-by-nc",
        "Licensed under CC BY-SA 4.0.": "cc-by-sa",
        "This work is licensed under the GNU General Public License, version 3.": "gpl",
        "This program is licensed under the terms of the Example Public License.": "unknown",
        "thering of the and is was it that onreing": None,
        "the work of this person is free": None,
        "": None,
    }
    texts = list(lines)
    rows = [(1, "\n".join(texts), "x"), (2, None, "x"), (3, "", "x"), (4, texts[0], "x"), (4, texts[0], "x"), (None, texts[0], "x"), (5, "word " * 60_000 + texts[0], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, family string")
    got = licenses.find_licenses(docs, known, model).collect()
    assert {r.paragraph: r.family for r in got if r.doc_id == 1} == {i: f for i, (_, f) in enumerate(lines.items()) if f}
    assert [r.family for r in got if r.doc_id == 4] == ["mit", "mit"] and [r.family for r in got if r.doc_id is None] == ["mit"]
    assert licenses.find_licenses(docs.where("false"), known, model).count() == 0
    empty = licenses.train(licenses.paragraphs(docs.where("false")), known)
    assert "mit" in {r.family for r in licenses.find_licenses(docs, known, empty).collect()}


def test_held_out_notices(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    wanted = {"gnu general public": "gpl", "cc by-nc": "cc-by-nc", "mit license": "mit", "apache license": "apache"}
    want = {(d.doc_id, n, f) for d in docs for n, line in enumerate((d.text or "").split("\n")) for mark, f in wanted.items() if mark in line.lower()}
    got = {(r.doc_id, r.paragraph, r.family) for r in op10_licenses(spark, DATA).collect()}
    assert want and want <= got
    assert len(got - want) <= 0.02 * len(want) + 1


def test_plan_has_no_python(spark):
    plan = op10_licenses(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "InArrow"))


def test_every_paragraph_trains_and_calibrates(spark, known):
    """One notice-like line among far more others than a bounded sample took, repeated often enough to matter."""
    common = "license software copyright permission work"
    prose = spark.range(30_000).select(F.concat(F.lit("plain words number "), F.sha2(F.col("id").cast("string"), 256)).alias("text"))
    often = spark.range(10_000).select(F.concat(F.lit(common + " "), F.col("id") + 100_000).alias("text"))
    lines = licenses.vectors(prose.union(often), known)
    counted = []
    keep, licenses.stored = licenses.stored, lambda df, purpose: counted.append((purpose, keep(df, purpose))) or counted[-1][1]
    try:
        model = licenses.train(lines, known)
    finally:
        licenses.stored = keep
    tables = dict(counted)
    assert tables["license-background"].agg(F.sum("n")).first()[0] == 40_000
    assert abs(tables["license-rows"].where("family = 'none'").agg(F.sum("weight")).first()[0] / licenses.BACKGROUND - 2 / 3) < 0.05
    docs = spark.createDataFrame([(1, common), (2, "Released under the MIT License.")], "doc_id long, text string")
    assert [(r.doc_id, r.family) for r in licenses.find_licenses(docs, known, model).collect()] == [(2, "mit")]
