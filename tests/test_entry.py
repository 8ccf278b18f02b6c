"""The entry stands without the training-data operators, whatever of theirs is missing."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("missing", ["corpus_pipeline", "crease.llm", "zstandard", "public_tokenizers"])
def test_entry_imports_without(missing):
    code = (
        f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e;"
        "q, s = e.queries(), e.oracle_sql();"
        "assert 'fact_ball' in q and not [n for n in q if n.startswith('op') or n == 'pipeline'];"
        "assert set(s) <= set(q)"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
