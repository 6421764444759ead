"""What a worker of the language stage allocates at a time."""

import tracemalloc
from types import SimpleNamespace

import numpy as np

from cohortwise.llm import language_crf


def test_a_slice_of_words_takes_little_memory():
    labeller = language_crf.Labeller(SimpleNamespace(languages=list("abcd"), transitions=np.zeros((4, 4))))
    labeller.known = {f"w{i}": i for i in range(1000)}
    labeller.table = np.random.default_rng(1).random((1024, 4), np.float32) + 0.01
    words = [f"w{i % 1000}" for i in range(256)]
    tracemalloc.start()
    means = labeller.means([words] * (labeller.slice // 256))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.allclose(means.sum(axis=1), 1) and peak < 40e6
