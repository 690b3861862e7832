"""Python workers serve many stages: what one kept is gone before the next one counts."""

import pyarrow as pa
import pytest

from creditloom.llm import jaccard, memo, toxicity


class Shared:
    def __init__(self, value):
        self.value = value


PAIR = (b" " * 60 + toxicity._END,) * 2
TEXTS = pa.RecordBatch.from_arrays([pa.array(["0"]), pa.array(["some words of a text"])], ["label", "text"])
SETS = pa.RecordBatch.from_arrays([pa.array(["some words of a text"]), pa.array([1], pa.int64()), pa.array([2], pa.int64())],
                                  ["text", "sid", "other"])


@pytest.mark.parametrize("run, batch", [
    (toxicity._count_entries, TEXTS), (toxicity._count_cells(Shared(PAIR)), TEXTS),
    (toxicity._weigh(Shared((*PAIR, {}))), TEXTS), (jaccard._sets, SETS)])
def test_a_later_stage_does_not_hold_an_earlier_ones_tables(run, batch):
    memo.per_process("vocabulary", 1, lambda: [0] * 1000)
    assert list(run(iter([batch])))
    built = []
    memo.per_process("vocabulary", 1, lambda: built.append(1))
    assert built == [1]
