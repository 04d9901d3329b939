import importlib.util
import subprocess
import sys

import __spark_entry__ as entry


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_library_does_not_need_the_optional_subpackage():
    code = "import sys; sys.modules['braidflow.llm'] = None; import braidflow.plans.catalogue, braidflow.plans.flow, braidflow.streaming"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=importlib.util.find_spec("__spark_entry__").origin.rpartition("/")[0])
