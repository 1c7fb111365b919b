"""Every registered query against its SQL twin, and those without one for rows."""

import os
import subprocess
import sys

import pytest
from places import DATA, ROOT

from tapeline.plans import registry


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, same, name):
    df = registry.QUERIES[name](spark, DATA)
    if name in registry.ORACLE_SQL:
        same(df, registry.ORACLE_SQL[name])
    else:
        assert df.count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_imports_without_llm_or_session(tmp_path):
    """The entry works in a copy that lacks the llm folder and corpus_pipeline.py."""
    import shutil

    shutil.copytree(os.path.join(ROOT, "tapeline"), tmp_path / "tapeline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; assert e.queries() and not [q for q in e.queries() if q[:2] == 'op' and q[2].isdigit() or q == 'pipeline']"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, check=True)


def test_indicator_chain_is_one_shuffle_without_python(spark):
    from tapeline.plans.bar_queries import labelled

    plan = labelled(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan and "Arrow" not in plan


def test_pushdown_and_pruning(spark):
    from tapeline.plans.bar_queries import bars

    plan = bars(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "l_returnflag" not in plan.split("ReadSchema")[1]
