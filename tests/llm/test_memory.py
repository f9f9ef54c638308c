"""Memory that the driver keeps after a fit."""

import re
from pathlib import Path

import numpy as np

from assayline.llm.common import give_back


def _own_mb() -> float:
    text = Path("/proc/self/smaps_rollup").read_text()
    return int(re.search(r"\nPss_Anon:\s+(\d+)", text)[1]) / 1024


def test_freed_memory_goes_back_to_the_system():
    pieces = [np.ones(7500) for _ in range(2500)]  # 143 MB in pieces below a mapping's size
    last = pieces[-1]
    pieces.clear()
    before = _own_mb()
    give_back()
    assert before - _own_mb() > 100
    assert last.sum() == 7500
