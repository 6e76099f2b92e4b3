"""The entry module works without the optional training-data folder."""

import subprocess
import sys

from .conftest import ROOT


def test_entry_without_the_optional_folder():
    code = "import sys; sys.modules['souk.llm'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr[-2000:]
    assert out.stdout.split()[-2:] == ["134", "134"]
