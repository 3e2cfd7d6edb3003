import inspect
import re

import numpy as np
import pytest

from morphloom.llm.common import give_back, tidy


def resident() -> int:
    """Megabytes that this process holds."""
    with open("/proc/self/status") as status:
        return int(re.search(r"VmRSS:\s+(\d+)", status.read())[1]) // 1024


def test_freed_memory_goes_back():
    give_back()
    before = resident()
    rows = [b"%060d" % i for i in range(1_500_000)]
    last = [rows[-1], np.zeros(10)]  # what stays lies behind what goes
    held = resident()
    del rows
    give_back()
    assert held - before > 100
    assert resident() - before < (held - before) / 2
    assert last


def test_kinds_of_functions_stay_apart():
    def stream(batches):
        for b in batches:
            yield b + 1

    assert list(tidy(stream)(iter([1, 2]))) == [2, 3]
    assert tidy(lambda rows: rows * 2)(3) == 6
    assert tidy(lambda left, right: left - right)(5, 2) == 3
    for run in (stream, lambda rows: rows, lambda left, right: left):
        assert len(inspect.getfullargspec(tidy(run)).args) == len(inspect.getfullargspec(run).args)


def test_errors_come_through():
    def stream(batches):
        yield next(batches)
        raise ValueError("broken")

    with pytest.raises(ValueError, match="broken"):
        list(tidy(stream)(iter([1])))
    with pytest.raises(ZeroDivisionError):
        tidy(lambda rows: 1 / rows)(0)
