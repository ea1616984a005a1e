import re
from pathlib import Path

import numpy as np

from tidewatch.llm import texts


def held() -> float:
    """MB of this process."""
    found = re.search(r"Pss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())
    return int(found.group(1)) / 1024


def test_worker_gives_memory_back_after_a_task():
    kept = []

    def work(batches):
        # Smaller than what the allocator maps on its own, with one block in use on top.
        arrays = [np.ones(2_000) for _ in range(8_000)]
        kept.append(np.ones(2_000))
        for batch in batches:
            yield batch, len(arrays)

    texts.release_memory()
    before = held()
    run = texts.releasing(work)(iter([1, 2]))
    assert next(run) == (1, 8_000)
    assert held() > before + 100
    assert list(run) == [(2, 8_000)]
    assert held() < before + 40
