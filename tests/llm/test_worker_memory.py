"""Python workers give their free memory back at a task's end: Spark keeps them, and idle ones count as the executor's."""

from __future__ import annotations

import ctypes
import os

import numpy as np
import pyarrow as pa
import pytest


def resident_mb() -> float:
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE") / 1e6


def texts(n: int = 40) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(range(n), pa.int64()), pa.array([str(i) for i in range(n)]), pa.array([f"word{i} and others that follow {i % 7}" for i in range(n)]),
         pa.array(range(n), pa.int32()), pa.array([0] * n, pa.int64())], names=["doc_id", "text_md5", "text", "number", "slot"])


@pytest.mark.skipif(not os.path.exists("/proc/self/statm") or not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="needs Linux and glibc")
def test_free_memory_below_what_is_kept_leaves_the_process():
    from strata.llm.common import give_back
    held = [b"x" * 50_000 for _ in range(4000)]
    kept = held[::400]  # pieces in use between the free ones: nothing shrinks by itself
    del held
    before = resident_mb()
    give_back()
    assert before - resident_mb() > 100
    assert sum(map(len, kept)) == 10 * 50_000


def test_every_task_of_the_pipeline_gives_back_at_its_end(monkeypatch):
    from strata.llm import common, near_dedup, packing, token_counts, toxicity
    from strata.llm.queries import tokenizer_path
    path, calls = tokenizer_path(), []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))

    class Bits:
        value = bytes([255] * 16)

    class NoModel:
        value = None

    tasks = [(toxicity.segmenter(1 << 20), texts()), (toxicity.frequency_counter(1 << 20), texts()), (toxicity.scorer(NoModel, 1 << 20), None),
             (near_dedup.sketcher(5, 1 << 20, 4), texts()), (near_dedup.set_reader(5, 1 << 20, Bits), texts()),
             (near_dedup.comparer(85, 0.8), None), (near_dedup.open_vertices(85, 0.8), None), (near_dedup.verifier(85, 0.8), None),
             (packing.tokenizer(path, 2, 1 << 20, 1000), texts()), (packing.curve_keys(np.zeros((1, 1))), None),
             (packing.cutter(4096, False, False), None), (token_counts.counter(path, 1 << 20, 1000), texts())]
    for k, (task, rows) in enumerate(tasks, 1):
        made = list(task(iter([] if rows is None else [rows])))
        assert bool(made) == (rows is not None)
        assert len(calls) == k
