"""Workers outlive their tasks; what a task has freed goes back to the system."""

import pyarrow as pa
import pytest

from hivelens.llm.common import frugal

pinned = []


def resident_mb():
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * 4096 / 1e6


def fill():
    blocks = [b"x" * 100_000 for _ in range(3000)]
    pinned.append(blocks[-1])  # holds the end of the heap, so that nothing before it is given back by itself


def of_batches(batches):
    for batch in batches:
        fill()
        yield batch


def of_table(table):
    fill()
    return table


@pytest.mark.parametrize("f", [of_batches, of_table])
def test_a_task_gives_back_what_it_freed(f):
    table = pa.table({"a": [1, 2]})
    before = resident_mb()
    out = frugal(f)(table.to_batches() if f is of_batches else table)
    assert pa.Table.from_batches(list(out)) == table if f is of_batches else out == table
    assert resident_mb() < before + 100


def test_memory_is_given_back_after_an_error_too():
    def fails(batches):
        fill()
        yield from batches
        raise ValueError("bad row")

    before = resident_mb()
    with pytest.raises(ValueError):
        list(frugal(fails)(pa.table({"a": [1]}).to_batches()))
    assert resident_mb() < before + 100
