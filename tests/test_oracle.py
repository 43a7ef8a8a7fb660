"""Every registered query against its DuckDB statement (rows, columns,
values), plus the entry smoke check."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_check import compare, duck
from risingtide.plans import catalog

SQLS = E.oracle_sql()
NAMES = sorted(catalog.QUERIES)  # the optional subpackage has its own tests


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(SQLS)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    if name not in SQLS:
        assert df.count() >= 0
        return
    res = compare(df, con, SQLS[name], exact=True)
    assert res["match"], res


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:3] == ["symbol", "news_source", "news_data"]


def test_other_queries_without_the_optional_subpackage(tmp_path):
    """The contract imports without the corpus operators, and an error inside
    them is not hidden."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/risingtide", tmp_path / "risingtide", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.oracle_sql()), len(e.queries()))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}

    def run():
        return subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)

    done = run()
    assert done.stdout.split() == ["True", str(len(catalog.QUERIES))], done.stderr
    (tmp_path / "risingtide" / "llm").mkdir()
    (tmp_path / "risingtide" / "llm" / "__init__.py").write_text("import no_such_library\n")
    assert "no_such_library" in run().stderr
