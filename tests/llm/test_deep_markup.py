import pytest
from statloom.llm.markup import convert_text


@pytest.mark.parametrize("depth", [1, 5, 9, 300])
def test_nested_markup_goes_whatever_its_depth(depth):
    assert convert_text("a " + "{{x|" * depth + "y" + "}}" * depth + " b")[1].split() == ["a", "b"]
    assert convert_text("a " + "\\emph{x " * depth + "y" + "}" * depth + " b")[1].split() == ["a", *["x"] * depth, "y", "b"]
