import pytest
from statloom.llm.eval_leaks import Index, Leaks

ITEM = [f"w{i}" for i in range(13)]


@pytest.mark.parametrize("before", [0, 3_000, 1_000_000])
@pytest.mark.parametrize("unknown", ["zz", "w1"])
def test_the_smallest_leak_after_a_long_text(before, unknown):
    index = Index([(1, " ".join(ITEM), None)], Leaks())
    assert index.leaks([unknown] * before + ["zz", *ITEM, "zz"]) == {1: (13, False)}
    assert index.leaks([unknown] * before + ITEM[:12] + ["zz", ITEM[12]]) == {}
