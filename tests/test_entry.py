"""The entry works without the corpus operators, and without a package that only they need."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def _names(setup: str) -> set[str]:
    code = f"import sys, warnings\nwarnings.simplefilter('ignore')\n{setup}\nsys.path.insert(0, {str(ROOT)!r})\nimport __spark_entry__ as e\nprint(*e.queries())"
    return set(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split())


def test_core_queries_need_neither_the_corpus_folder_nor_its_packages():
    from snapmart.plans import queries
    for missing in ("snapmart.llm", "zstandard", "corpus_pipeline"):
        names = _names(f"sys.modules[{missing!r}] = None")
        assert set(queries.REGISTRY) <= names and "pipeline" not in names
