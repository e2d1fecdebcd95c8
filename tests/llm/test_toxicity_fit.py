"""A part of the toxicity fit works on its features in blocks."""

from types import SimpleNamespace

import numpy as np
import pandas as pd

from salesmart.llm import toxicity


def test_a_part_of_the_toxicity_fit_is_worked_on_in_blocks(monkeypatch):
    rng = np.random.default_rng(3)
    held = SimpleNamespace(value=rng.normal(size=1 << toxicity.BITS))
    lists = [np.unique(rng.integers(0, 500, n)).astype(np.int32) for n in (40, 0, 300, 7, 90, 120)]
    group = pd.DataFrame({"label": [0, 1, 1, 0, 1, 0], "place": np.zeros(6), "buckets": lists})
    monkeypatch.setattr(toxicity, "STEPS", 20)
    whole = toxicity._fit_part(held)(group)
    monkeypatch.setattr(toxicity, "HELD_FEATURES", 100)
    blocks = toxicity._blocks(np.array([len(x) for x in lists]))
    assert len(blocks) > 2 and [a for a, _ in blocks[1:]] == [b for _, b in blocks[:-1]] and blocks[-1][1] == 6
    parts = toxicity._fit_part(held)(group)
    np.testing.assert_allclose(parts["weights"][0], whole["weights"][0], rtol=1e-4, atol=1e-8)
    assert abs(parts["bias"][0] - whole["bias"][0]) < 1e-9
