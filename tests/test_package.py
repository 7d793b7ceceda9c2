import subprocess
import sys
from pathlib import Path

import pytest

import quarterline

ROOT = Path(__file__).parents[1]


def test_import_needs_no_spark():
    code = "import sys, quarterline; assert quarterline.__version__; assert 'pyspark' not in sys.modules"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_every_exported_name_resolves():
    assert all(getattr(quarterline, name) is not None for name in quarterline.__all__)


def test_unknown_name():
    with pytest.raises(AttributeError, match="nothing_here"):
        quarterline.nothing_here  # noqa: B018


def test_core_does_not_import_the_text_subpackage():
    core = [p for p in (ROOT / "quarterline").rglob("*.py") if "llm" not in p.parts]
    assert core and not [p for p in core if "quarterline.llm" in p.read_text()]
