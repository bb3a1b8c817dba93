"""The driver contract, and every registered query against its DuckDB oracle on sf0.001."""

from __future__ import annotations

import os
import sys

import pytest

from .conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "scripts"))


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["archive", "paper_id", "tex_path", "pos", "image_ref", "caption"]
    assert df.count() > 0


def test_every_query_has_a_name_match():
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 40


def _names():
    import __spark_entry__ as E
    return sorted(E.oracle_sql())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, name):
    from check_oracle import compare
    res = compare(spark, SF_SMALL, [name], verbose=True)
    assert res[name][0] == "OK", res[name]


def test_runs_from_another_directory():
    """Python workers started outside the repository still run the archive step."""
    import pathlib
    import subprocess
    import tempfile
    tmp_path = pathlib.Path(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    script = tmp_path / "drive.py"
    script.write_text(
        "import importlib.util\n"
        f"spec = importlib.util.spec_from_file_location('__spark_entry__', {os.path.join(ROOT, '__spark_entry__.py')!r})\n"
        "E = importlib.util.module_from_spec(spec); spec.loader.exec_module(E)\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')"
        ".config('spark.sql.shuffle.partitions', '4').getOrCreate()\n"
        f"print('ROWS', E.queries()['archive_members'](spark, {SF_SMALL!r}).count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True,
                         timeout=600)
    assert "ROWS " in out.stdout, out.stderr[-2000:]
    assert int(out.stdout.split("ROWS ")[1].split()[0]) > 0
