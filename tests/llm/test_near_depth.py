"""The trees' depth follows the limit, and shallow neighbours are compared."""

import numpy as np
import pytest

from folioflow.llm import near


@pytest.mark.parametrize("percent, depth", [(95, 3), (85, 3), (80, 2), (70, 1), (62, 1), (40, 1)])
def test_depth(percent, depth):
    assert near.shallowest(percent) == depth
    assert percent < 62 or (1 - (percent / 100) ** depth) ** near.TREES <= near.MISSED


def test_neighbours():
    labels = np.array([[1, 2, 3, 4], [1, 2, 9, 9], [1, 7, 7, 7]])
    for percent, found in ((85, []), (80, [0]), (70, [0, 1])):
        assert near._neighbours(labels, np.zeros(3), np.full(3, 100), percent, 1)[0].tolist() == found
