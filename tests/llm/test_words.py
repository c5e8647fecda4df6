import numpy as np

from tideline.llm import words


def test_long_power_tables_are_not_kept_and_hashes_stay():
    """Hashing a whole batch at once must not leave tables of its size in the worker for later stages."""
    rng = np.random.default_rng(3)
    small = rng.integers(0, 256, 1000, dtype=np.uint8)
    expected = words.span_hashes(small, np.array([0, 10, 500]), np.array([5, 60, 1000]))
    large = np.concatenate((rng.integers(0, 256, 3 * words.KEPT_POWERS, dtype=np.uint8), small))
    at = 3 * words.KEPT_POWERS
    found = words.span_hashes(large, np.array([0, 10, 500]) + at, np.array([5, 60, 1000]) + at)
    assert (found == expected).all()
    assert max(len(held[0]) for held in words._powers.values()) <= words.KEPT_POWERS


def test_released_hands_back_what_a_task_freed():
    import psutil
    import pyarrow as pa

    from tideline.llm.shared import released

    def run(batches):
        for batch in batches:
            held = [pa.array([b"x" * 2000] * 2000) for _ in range(100)]   # some 400 MB, freed at once
            del held
            yield batch

    batch = pa.RecordBatch.from_arrays([pa.array([1, 2])], names=["a"])
    process = psutil.Process()
    out = list(released(run)(iter([batch])))
    assert out == [batch]
    pa.default_memory_pool().release_unused()
    settled = process.memory_info().rss
    list(released(run)(iter([batch])))
    assert process.memory_info().rss < settled + 100_000_000
