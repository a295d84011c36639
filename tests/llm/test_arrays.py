import re
from pathlib import Path

import numpy as np
import pytest

from pathkin.llm.arrays import freed


def anonymous_mb():
    return int(re.search(r"RssAnon:\s+(\d+)", Path("/proc/self/status").read_text())[1]) / 1024


@pytest.mark.skipif(not Path("/proc/self/status").exists(), reason="memory can't be read here")
def test_a_task_gives_its_memory_back():
    """Blocks that are freed below one that stays are given back too, and all results come through."""

    def run(batches):
        for n in batches:
            blocks = [np.ones(10_000) for _ in range(n)]
            kept.append(blocks[-1])
            yield len(blocks)

    kept = []
    before = anonymous_mb()
    assert list(freed(run)(iter([2000, 10]))) == [2000, 10]
    assert anonymous_mb() - before < 40
