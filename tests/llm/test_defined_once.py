"""No function of a module hides an earlier one of the same name."""

import ast
from pathlib import Path

import pytest

from folioframe import llm


@pytest.mark.parametrize("path", sorted(Path(llm.__file__).parent.glob("*.py")), ids=lambda p: p.stem)
def test_defined_once(path):
    names = [x.name for x in ast.parse(path.read_text()).body if isinstance(x, ast.FunctionDef | ast.ClassDef)]
    assert sorted(names) == sorted(set(names))
