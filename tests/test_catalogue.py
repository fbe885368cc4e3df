import re
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from paperloom.plans import inventory as catalogue

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[1]


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        c.sql(f"create view {p.stem} as select * from '{p}'")
    return c


def plain(v):
    return round(float(v), 9) if not isinstance(v, (int, str, bool, type(None))) and hasattr(v, "as_integer_ratio") else v


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    rows = df.collect()
    assert df.columns and len(set(df.columns)) == len(df.columns)
    if name not in catalogue.ORACLES:
        return
    columns, other = sorted(df.columns), duck.sql(catalogue.ORACLES[name])
    assert sorted(other.columns) == columns
    mine = sorted(repr(tuple(plain(r[c]) for c in columns)) for r in rows)
    theirs = sorted(repr(tuple(plain(r[other.columns.index(c)]) for c in columns)) for r in other.fetchall())
    assert mine == theirs


def test_cleaners_run_over_whole_texts(spark):
    """The last word of every line of every document is in the cleaned text."""
    docs = {str(r["doc_id"]): r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for name in ("clean_full_text", "strip_references", "clean_comprehensive", "reclean_changed"):
        got = {r[0]: r[1] for r in catalogue.QUERIES[name](spark, SF).collect()}
        assert set(got) == set(docs), name
        for k, t in docs.items():
            last = [w[-1] for x in t.split("\n") if (w := re.findall(r"[a-z]{3,}", x))]
            assert all(w in got[k] for w in last), (name, k)


def test_entry_and_guard(tmp_path):
    """Without the training-data operators the entry file imports and has all other queries."""
    code = "import __spark_entry__ as e; q = e.queries(); assert 'dedup_keep_recent' in q and set(e.oracle_sql()) <= set(q); print(sum(k.startswith('op') or k == 'pipeline' for k in q))"
    for p in ROOT.iterdir():
        if p.name not in ("corpus_pipeline.py", "paperloom", ".git"):
            (tmp_path / p.name).symlink_to(p)
    (tmp_path / "paperloom").mkdir()
    for p in (ROOT / "paperloom").iterdir():
        if p.name != "llm":
            (tmp_path / "paperloom" / p.name).symlink_to(p)
    out = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, check=False)
    assert out.returncode == 0 and out.stdout.strip() == "0", out.stderr


def test_nothing_imports_the_operators():
    for p in (ROOT / "paperloom").rglob("*.py"):
        if "llm" not in p.parts:
            assert "paperloom.llm" not in p.read_text(), p
