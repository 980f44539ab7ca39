"""The registry with, without and with a broken training-data subpackage."""

import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[1]
CORE = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q); print(len(q), 'window_metrics' in q)"


def copy(folder, llm):
    for name in ("fluxmill", "__spark_entry__.py", "corpus_pipeline.py"):
        source = REPO / name
        for path in [source] if source.is_file() else sorted(source.rglob("*.py")):
            inner = path.relative_to(REPO)
            if "llm" in inner.parts and not llm or inner.name == "corpus_pipeline.py" and not llm:
                continue
            (folder / inner).parent.mkdir(parents=True, exist_ok=True)
            (folder / inner).write_text(path.read_text())


def run(folder, code):
    return subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True)


@pytest.mark.parametrize("leftovers", [False, True])
def test_without_the_subpackage(tmp_path, leftovers):
    copy(tmp_path, llm=False)
    if leftovers:
        (tmp_path / "fluxmill" / "llm" / "__pycache__").mkdir(parents=True)
    done = run(tmp_path, CORE + "; assert not [n for n in q if n.startswith('op') or n == 'pipeline']")
    assert done.returncode == 0 and done.stdout.split()[1] == "True", done.stderr
    assert "left out" not in done.stderr


def test_with_a_library_missing(tmp_path):
    if not (REPO / "fluxmill" / "llm" / "__init__.py").exists():
        pytest.skip("the subpackage is left out")
    copy(tmp_path, llm=True)
    done = run(tmp_path, "import sys; sys.modules['ahocorasick'] = None; " + CORE)
    assert done.returncode == 0 and done.stdout.split()[1] == "True", done.stderr
    assert "left out" in done.stderr and "ahocorasick" in done.stderr
    whole = run(tmp_path, CORE + "; assert 'pipeline' in q and 'op1_preference_format' in q")
    assert whole.returncode == 0, whole.stderr
