"""Workers live on from stage to stage, so a task gives back what it has freed."""

import psutil
import pyarrow as pa

from tierflow.llm.common import map_rows


class Rows:
    def mapInArrow(self, run, schema):
        return run


def test_task_gives_freed_memory_back():
    pinned, held = [], lambda: psutil.Process().memory_info().rss / 1e6

    def rows(batch):
        blocks = [b"x" * 100_000 + bytes([k % 256]) for k in range(3_000)]
        pinned.append(b"y" * 100_000)  # behind the blocks, so that they are not the end of the heap
        yield pa.record_batch([pa.array([len(blocks)])], ["n"])

    run = map_rows(Rows(), rows, "n long")
    before = held()
    got = list(run(iter([pa.record_batch([pa.array([1])], ["id"])])))
    assert [b.column(0).to_pylist() for b in got] == [[3_000]]
    assert held() - before < 100
