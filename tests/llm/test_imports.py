"""What the Python workers of an executor load with the operators."""

import subprocess
import sys
from pathlib import Path


def test_operators_do_without_pandas():
    """Each worker would hold a copy of it, some 70 MB."""
    code = (
        "import sys; from peakloom.llm import bpe, codes, decontaminate, manifest, neardup, quality, topk; "
        "sys.exit('pandas' in sys.modules)"
    )
    assert subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[2], check=False).returncode == 0
