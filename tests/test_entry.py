import os
import re
import subprocess
import sys

import duckdb
import pytest

import tidemark.catalog as catalog

SF = "/root/testdata/sf0.001"
NAMES = ["label_consolidation", "w01_authoritative_runs", "f01_admission_verdicts", "j13_w04_run_differences", "flow_identity"]


def test_every_oracle_has_its_query():
    assert set(catalog.oracle_sql()) <= set(catalog.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")
@pytest.mark.parametrize("name", NAMES)
def test_oracles(spark, name):
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"create view {f.removesuffix('.parquet')} as select * from read_parquet('{SF}/{f}')")
    df = catalog.queries()[name](spark, SF)
    want = c.sql(catalog.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    rows = sorted(map(repr, (tuple(r) for r in df.select(columns).collect())))
    assert rows == sorted(map(repr, c.sql(f"select {', '.join(columns)} from ({catalog.oracle_sql()[name]})").fetchall()))


def test_the_engine_works_without_the_optional_parts(tmp_path):
    code = "import sys; sys.modules['tidemark.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert e.queries() and 'pipeline' not in e.queries() and not any(n.startswith('op') for n in e.queries())"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)


def test_nothing_else_imports_the_optional_part():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for folder, _, names in os.walk(os.path.join(root, "tidemark")):
        if os.path.basename(folder) in ("llm", "__pycache__"):
            continue
        for n in names:
            if n.endswith(".py"):
                text = open(os.path.join(folder, n), encoding="utf-8").read()
                assert not re.search(r"\bllm\b", text), n
