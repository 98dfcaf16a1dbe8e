"""The entry points where the training-data part is not installed."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def names(folder, *more: str) -> list[str]:
    code = f"import __spark_entry__ as e; {'; '.join(more) or 'pass'}; print(*sorted(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())"
    run = subprocess.run([sys.executable, "-B", "-c", code], cwd=folder, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    return run.stdout.split()


def test_queries_without_the_training_data_part(tmp_path):
    from adlumen.queries import all_queries

    shutil.copytree(ROOT / "adlumen", tmp_path / "adlumen", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    assert names(tmp_path) == sorted(all_queries())
    # the pipeline's file alone brings nothing
    if (ROOT / "corpus_pipeline.py").exists():
        shutil.copy(ROOT / "corpus_pipeline.py", tmp_path)
        assert names(tmp_path) == sorted(all_queries())


def test_errors_inside_the_training_data_part_are_not_hidden(tmp_path):
    shutil.copytree(ROOT / "adlumen", tmp_path / "adlumen", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    (tmp_path / "adlumen/llm").mkdir()
    (tmp_path / "adlumen/llm/__init__.py").touch()
    (tmp_path / "adlumen/llm/queries.py").write_text("import nothing_of_this_name\n")
    code = "import __spark_entry__ as e; e.queries()"
    run = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert run.returncode and "nothing_of_this_name" in run.stderr
