"""The sample of the quality fit stands in the driver in few bytes."""

import numpy as np

from keepwell.llm import subword_quality as Q
from tests.llm.cases import prose


def test_a_feature_has_eight_bytes():
    rows = [Q._counted(text, 17) for text in (prose(1, 400), "a a a", "", None)]
    for used, times, n in rows:
        assert used.dtype == times.dtype == np.uint32
        assert times.sum() == n or (n, len(used)) == (1, 0)
    assert len(rows[0][0]) > 500


def test_fit_takes_empty_texts():
    texts, labels = [prose(k, 40) if k % 3 else None for k in range(60)], [k % 2 for k in range(60)]
    model = Q.fit_rows(texts, labels, Q.Settings(epochs=2))
    assert np.isfinite(model.weight).all() and np.isfinite(model.bias).all()
