import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_the_rest_works_without_the_training_data_package(tmp_path):
    shutil.copytree(ROOT / "pitpanel", tmp_path / "pitpanel", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = (
        "import __spark_entry__ as e; q = e.queries();"
        "assert 'stock_state' in q and 'pipeline' not in q and not any(n.startswith('op') and n[2].isdigit() for n in q);"
        "assert set(e.oracle_sql()) <= set(q)"
    )
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)


def test_nothing_else_imports_the_package():
    for file in (ROOT / "pitpanel").rglob("*.py"):
        if "llm" not in file.relative_to(ROOT).parts:
            assert "pitpanel.llm" not in file.read_text(), file
