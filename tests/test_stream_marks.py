"""The processor of the feed stream takes plain rows, also without times or names of responses."""

import pytest

from wattframe.streaming.ingest import NewerThanMark


class Held:
    def __init__(self, value=None):
        self.value = value

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


@pytest.mark.parametrize("known, wanted, left", [(None, "abcef", 9), ((4,), "cef", 9), ((9,), "", 9)])
def test_rows_later_than_all_responses_before(known, wanted, left):
    processor = NewerThanMark()
    processor.mark = Held(known)
    rows = [(1, 2, 20, 9, "r3", "f"), (1, 2, None, 3, None, "a"), (1, 2, 10, 7, "r2", "e"), (1, 2, 10, 4, "r1", "b"),
            (1, 2, 10, 6, "r1", "c"), (1, 2, 10, 6, "r2", "d"), (1, 2, None, 3, "r0", "g")]
    passed = processor.handleInputRows((1, 2), iter(rows), None)
    assert "".join(sorted(row[-1] for row in passed)) == wanted and processor.mark.value == (left,)
