import hashlib

import pytest

from macroloom.llm import secrets
from macroloom.llm.common import cannot_be_in, may_be_in
from macroloom.llm.queries import MULTI_BPE, op6_secrets


@pytest.fixture(scope="module")
def words(spark):
    return secrets.dictionary(spark, MULTI_BPE).cache()


@pytest.fixture(scope="module")
def model(spark, words):
    return secrets.train(secrets.labelled_findings(spark), words)


def digest(n):
    return hashlib.sha1(str(n).encode()).hexdigest()


def rows():
    token, pair = digest(1), "AKIA" + digest(2)[:16].upper()
    texts = {
        1: (f'some words token = "{token}" more\nand {token} again', {token}),
        2: (f'SOME!! TOKEN = "{token.upper()}"!! WORDS!!', {token.upper()}),
        3: (f"in | the | {pair} | of", {pair}),
        4: (f"x password={digest(3)[:18]}, y", {digest(3)[:18]}),
        5: ("number 4921553912345678 and mail a.b@mail5.example.com then internationalization2go", set()),
        6: ("see /usr/share/lib/python3.11/site-packages and org.example.module1.Class2", set()),
        7: ("", set()),
        8: (None, set()),
        9: ("word " * 30_000 + f'token = "{digest(4)}"', {digest(4)}),
        10: ("5" * 100_000, set()),
    }
    return texts


def test_findings_and_masking(spark, words, model):
    texts = rows()
    data = [(i, t, "src/a", "k") for i, (t, _) in texts.items()] + [(1, texts[1][0], "src/a", "k"), (None, texts[4][0], "b", "k")]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string, value string")
    found = secrets.find_secrets(docs, words, model)
    by = {}
    for r in found.collect():
        by.setdefault(r.doc_id, set()).add(r.secret)
    assert {i: by.get(i, set()) for i in texts} == {i: want for i, (_, want) in texts.items()}
    assert by[None] == texts[4][1]
    masked = secrets.mask_secrets(docs, found)
    assert masked.columns == docs.columns and masked.count() == len(data)
    for r in masked.collect():
        text, want = texts[r.doc_id if r.doc_id is not None else 4]
        for s in want:
            text = text.replace(s, secrets.MASK)
        assert r.text == text
    assert secrets.find_secrets(docs.where("false"), words, model).count() == 0


def test_texts_without_findings_are_not_shuffled(spark):
    docs = spark.createDataFrame([(i if i % 100 else None, f"text {i} key-{i};", i) for i in range(1, 1001)], "doc_id long, text string, n int")
    found = spark.createDataFrame([(i, f"key-{i};") for i in range(5, 1000, 50)] + [(None, "key-100;")], "doc_id long, secret string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        masked = secrets.mask_secrets(docs, found)
        got = {r.n: (r.doc_id, r.text) for r in masked.collect()}
        assert "BroadcastHashJoin" in masked._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    hit = {*range(5, 1000, 50), 100}
    assert got == {i: (i if i % 100 else None, f"text {i} " + (secrets.MASK if i in hit else f"key-{i};")) for i in range(1, 1001)}
    ids = found.select("doc_id")
    some, rest = may_be_in(docs, "doc_id", ids).count(), cannot_be_in(docs, "doc_id", ids).count()
    assert some + rest == 1000 and 30 <= some < 60


def test_held_out_accuracy(spark, words):
    labelled = secrets.labelled_findings(spark)
    model = secrets.train(labelled.where("n % 3 != 1"), words)
    judged = model.transform(secrets.features(labelled.where("n % 3 = 1").select("source", "before", "value", "after", "label"), words))
    right = judged.where("prediction = label").count() / judged.count()
    assert right > 0.97


def test_plan_has_no_python(spark):
    plan = op6_secrets(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "InArrow"))


def test_agrees_with_patterns_of_planted_secrets(spark):
    import re

    got = {(r.doc_id, r.secret) for r in op6_secrets(spark, "/root/testdata/sf0.01").select("doc_id", "secret").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    want = {(d.doc_id, m) for d in docs for p in (r'(?i)token\W+([0-9a-f]{40})', r"(?i)password=([0-9a-f]{18})", r"(?i)\b(AKIA[0-9A-Z]{16})\b") for m in re.findall(p, d.text)}
    assert want and got == want


def test_every_named_value_and_url_passwords(spark, words, model):
    texts = {
        1: ("password=Hunter!22 token=abc!defgh", {"Hunter!22", "abc!defgh"}),
        2: ("db password=k7!pQz92 secret=Xy!zzz99", {"k7!pQz92", "Xy!zzz99"}),
        3: ('{"password":"Hunt!r22","token":"abc!defg"}', {"Hunt!r22", "abc!defg"}),
        4: ("SECRET_KEY=q8!Rt5xw DB_PASSWORD_PROD=Zp4!mm7k", {"q8!Rt5xw", "Zp4!mm7k"}),
        5: ("jdbc:x://h/d;user=a;password=Hunter!22;secret=Xy!zzz99", {"Hunter!22", "Xy!zzz99"}),
        6: ("at postgres://app:s3!cr7@db.host/main", {"s3!cr7"}),
        7: ("the secretary: something", set()),
    }
    docs = spark.createDataFrame([(i, t, "src/a") for i, (t, _) in texts.items()], "doc_id long, text string, source string")
    values = {(r.id, r.value) for r in secrets.candidates(docs).collect()}
    assert {(i, v) for i, (_, want) in texts.items() for v in want} <= values
    found = secrets.find_secrets(docs, words, model)
    assert {(r.doc_id, r.secret) for r in found.collect()} == {(i, v) for i, (_, want) in texts.items() for v in want}
    assert all(v not in r.text for r in secrets.mask_secrets(docs, found).collect() for v in texts[r.doc_id][1])
