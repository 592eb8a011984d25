"""The oracle strings need no Spark session, no JVM and no Spark jars."""

import os
import subprocess
import sys

from conftest import ROOT

CODE = """
import glob, os, zipfile
def refuse(*a, **k):
    raise AssertionError("a jar was looked up")
glob.glob = refuse
zipfile.ZipFile = refuse
import __spark_entry__ as e
sql = e.oracle_sql()
assert len(sql) >= 50 and all(isinstance(v, str) for v in sql.values())
from pyspark.sql import SparkSession
assert SparkSession.getActiveSession() is None
"""


def test_oracle_sql_needs_no_session_and_no_jars():
    env = os.environ | {"PYTHONPATH": ROOT, "JAVA_HOME": "/nonexistent", "SPARK_HOME": "/nonexistent"}
    done = subprocess.run([sys.executable, "-c", CODE], cwd=ROOT, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]


WITHOUT = """
import sys
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name in ("corpus_pipeline", "marginflow.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Absent())
import __spark_entry__ as e
assert len(e.queries()) >= 60 and len(e.oracle_sql()) >= 55
assert not [x for x in e.queries() if x.startswith("op") or x == "pipeline"]
assert not [m for m in sys.modules if m.startswith("marginflow.llm")]
"""


def test_entry_works_without_the_training_data_subpackage():
    done = subprocess.run([sys.executable, "-c", WITHOUT], cwd=ROOT, env=os.environ | {"PYTHONPATH": ROOT},
                          capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
