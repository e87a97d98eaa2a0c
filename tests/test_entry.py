"""The driver's entry where something the training-data subpackage needs is missing."""

import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
class Blocked:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == "xxhash":
            raise ModuleNotFoundError("blocked", name=name)
sys.meta_path.insert(0, Blocked())
import warnings
with warnings.catch_warnings(record=True) as seen:
    warnings.simplefilter("always")
    import __spark_entry__ as entry
    names = entry.queries()
assert "scd2_build" in names and not any(n.startswith("op2_") or n == "pipeline" for n in names), list(names)
from importlib.util import find_spec
print(len(names), [str(w.message) for w in seen if "left out" in str(w.message)])
"""


def test_other_queries_stay_without_a_dependency():
    root = Path(__file__).resolve().parents[1]
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    if (root / "dugout" / "llm" / "queries.py").exists():
        assert "xxhash cannot be imported" in done.stdout
