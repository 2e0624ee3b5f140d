"""The driver contract, with and without the optional subpackage."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["engagement", "n", "percent"] and df.count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_imports_without_the_optional_subpackage():
    code = "import sys; sys.modules['threadloom.llm'] = None; import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries())"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) > 80 and out[1] == "False"


def test_nothing_else_imports_the_optional_subpackage():
    others = [p for p in (ROOT / "threadloom").rglob("*.py") if "llm" not in p.parts]
    assert others and not [p for p in others if "threadloom.llm" in p.read_text() or "corpus_pipeline" in p.read_text()]
