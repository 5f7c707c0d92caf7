"""Registered queries against their SQL, and the guard around them."""

import os
import subprocess
import sys

import pytest

from macroloom.llm.queries import ORACLES, QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "embeddings"):
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    result = connection.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    df = QUERIES[name](spark, DATA)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(tuple, df.select(names).collect()), key=str) == sorted(result.fetchall(), key=str)


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_entry_works_without_the_operators(tmp_path):
    """The entry module still offers all other queries where this part is not there."""
    for name in ("__spark_entry__.py", "macroloom"):
        os.symlink(os.path.join(ROOT, name), tmp_path / name)
    code = (
        "import sys; sys.modules['macroloom.llm'] = None\n"
        "class Gone:\n"
        "    def find_spec(self, name, *_):\n"
        "        if name.startswith(('macroloom.llm', 'corpus_pipeline')): raise ModuleNotFoundError(name, name=name)\n"
        "del sys.modules['macroloom.llm']; sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.QUERIES), len(e.queries()) > 80)"
    )
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=100)
    assert out.stdout.split() == ["True", "True"], out.stderr
