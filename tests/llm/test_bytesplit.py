import numpy as np

from skyledger.llm import bytesplit as B


def own_mb() -> float:
    with open("/proc/self/smaps_rollup") as f:
        return next(int(line.split()[1]) for line in f if line.startswith("Pss_Anon:")) / 1024


def test_thrifty_hands_all_freed_memory_back():
    """What lay below memory still in use used to stay with a waiting worker."""
    pins = []

    def work(batches):
        for batch in batches:
            pieces = [np.ones(60_000, np.uint8) for _ in range(2500)]
            pins.append(np.ones(60_000, np.uint8))
            del pieces
            yield batch

    before = own_mb()
    for _ in B.thrifty(work)(iter([None])):
        pass
    assert own_mb() - before < 30
