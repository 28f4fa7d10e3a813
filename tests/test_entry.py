import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
CODE = """
import sys
sys.path.insert(0, {root!r})
{hide}
import __spark_entry__ as e
print(len([q for q in e.queries() if q.startswith("q_")]), [q for q in e.queries() if not q.startswith("q_")])
assert set(e.oracle_sql()) <= set(e.queries())
"""


def run(hide=""):
    out = subprocess.run([sys.executable, "-c", CODE.format(root=str(ROOT), hide=hide)], capture_output=True, text=True)
    return out.returncode, out.stdout + out.stderr


def test_other_queries_are_there_without_the_llm_folder():
    code, out = run("sys.modules['cohortkit.llm'] = None")
    assert code == 0 and out.strip().endswith("[]") and int(out.split()[0]) >= 44


def test_every_query_has_an_oracle():
    from cohortkit.plans.oracle import SQL
    from cohortkit.plans.queries import QUERIES
    assert set(SQL) == set(QUERIES)


def test_other_import_errors_are_not_swallowed():
    code, out = run("sys.modules['cohortkit.llm'] = None; sys.modules['cohortkit.operators'] = None")
    assert code != 0 and "cohortkit.operators" in out
