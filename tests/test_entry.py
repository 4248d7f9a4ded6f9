import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("pipeline", [False, True])
def test_the_library_works_without_its_optional_part(tmp_path, pipeline):
    """Also where an empty folder or the pipeline's module is left of it."""
    shutil.copytree(ROOT / "tidemill", tmp_path / "tidemill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    if pipeline:
        shutil.copy(ROOT / "corpus_pipeline.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'word_count' in q and 'pipeline' not in q and not any(n[:2] == 'op' and n[2].isdigit() for n in q)"
    clean = {name: value for name, value in os.environ.items() if name != "PYTHONPATH"}
    for _ in range(2):
        subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=clean, check=True, timeout=120)
        (tmp_path / "tidemill" / "llm" / "__pycache__").mkdir(parents=True, exist_ok=True)


def test_every_query_has_a_name_of_its_own():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
