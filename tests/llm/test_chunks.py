"""Sets and features of texts don't depend on how many bytes one numpy pass takes."""

import numpy as np
import pyarrow as pa
import pytest

from courtlake.llm import ngram_join, toxicity
from courtlake.llm import words as w

TEXTS = [None, "", " \n ", "one", "Ä b c", "a b c d e " * 400, "x" * 5000, *(f"word{k % 7} and Word{k % 11} again, {k}" for k in range(200))]


def _all(limit):
    out = []
    for make in (lambda d, o: ngram_join.document_sets(d, o, 4), toxicity.text_features):
        parts = []
        for first, last, data, offsets in w.chunks(pa.array(TEXTS), limit):
            docs, values = make(data, offsets)
            assert last - first == 1 or len(data) <= limit
            parts.append((docs + first, values))
        out += [np.concatenate([p[k] for p in parts]) for k in (0, 1)]
    return out


@pytest.mark.parametrize("limit", [1, 64, 4096])
def test_passes_of_any_size_agree(limit):
    assert all(np.array_equal(x, y) for x, y in zip(_all(limit), _all(1 << 30), strict=True))
