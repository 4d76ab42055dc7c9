import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from talkweave.plans.queries import QUERIES, SQL

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def rows(df):
    cols = sorted(df.columns)
    return cols, sorted(map(str, df[cols].astype(object).where(df[cols].notna(), None).itertuples(index=False, name=None)))


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")
@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    assert rows(QUERIES[name](spark, DATA).toPandas()) == rows(duck.execute(SQL[name]).df())


def test_tsv_export_of_late_turns(spark, tmp_path):
    """A conversation whose first user or assistant turn is its third keeps its row, as in the SQL."""
    c = duckdb.connect()
    c.execute("CREATE TABLE conversations AS SELECT CAST(c AS BIGINT) AS conv_id, CAST(t + 2 * (c % 2) AS INTEGER) AS turn, CASE t % 2 WHEN 0 THEN 'user' ELSE 'assistant' END AS role, 'Turn ' || t || '.' AS text FROM range(6) a(c), range(4) b(t)")
    c.execute("CREATE TABLE region AS SELECT 'r' || i AS r_name FROM range(3) x(i)")
    for t in ("conversations", "region"):
        c.execute(f"COPY {t} TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
    got = rows(QUERIES["tsv_export"](spark, str(tmp_path)).toPandas())
    assert len(got[1]) == 6 and got == rows(c.execute(SQL["tsv_export"]).df())


def test_entry(spark):
    import __spark_entry__

    assert set(SQL) <= set(__spark_entry__.queries()) and set(SQL) <= set(__spark_entry__.oracle_sql())
    assert __spark_entry__.entry(spark).count() > 0


@pytest.mark.parametrize("gone", [("talkweave/llm", "tests/llm"), ("talkweave/llm", "tests/llm", "corpus_pipeline.py")])
def test_entry_without_llm(tmp_path, gone):
    """A copy without the training-data operators, with or without the pipeline's module, still lists all other queries."""
    root = Path(__file__).resolve().parents[1]
    away = {root / g for g in gone}
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=lambda d, names: [n for n in names if n in (".git", "__pycache__") or Path(d, n) in away])
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); print(len(q), len(s), [k for k in [*q, *s] if k[:2] == 'op' and k[2].isdigit() or k == 'pipeline'])"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True)
    assert out.stdout.split("\n")[0] == f"{len(QUERIES)} {len(SQL)} []", out.stderr
