"""What training takes on the driver: the memory follows what is not zero."""

import tracemalloc

import numpy as np

from placeledger.llm.langid import Shares, train as train_languages
from placeledger.llm.toxicity import Presence, train as train_toxicity


def peak_mb(run):
    tracemalloc.start()
    out = run()
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return out, peak


def test_language_model_is_fitted_without_writing_out_zeros():
    rng = np.random.default_rng(1)
    labels = np.arange(3000) % 3
    at = [np.unique(rng.integers(0, 1300, 60) * 3 + k) for k in labels]
    share = [np.full(len(a), 1 / len(a), dtype=np.float32) for a in at]
    model, peak = peak_mb(lambda: train_languages(Shares(at, share, 4096), labels, ["a", "b", "c"], epochs=2))
    assert peak < 12  # with zeros: 49 MB
    hits = [np.argmax(model.rows[a].mean(axis=0) + model.bias) for a in at[:300]]
    assert (np.array(hits) == labels[:300]).mean() > 0.95


def test_toxicity_model_is_fitted_without_writing_out_zeros():
    rng = np.random.default_rng(2)
    labels = np.arange(8000) % 2
    docs = [np.unique(np.append(rng.integers(0, 3000, 40) * 2 + k, 9000 + k)) for k in labels]
    model, peak = peak_mb(lambda: train_toxicity(docs, labels, 0.5, [[] for _ in docs], rounds=50))
    assert peak < 48  # with zeros: 64 MB for the matrix beside the counts
    score = [model.bias + model.weights[np.isin(model.features, d)].sum() for d in docs]
    assert ((np.array(score) > 0) == (labels == 1)).mean() > 0.95


def test_presence_multiplies_as_the_matrix_does():
    sets, columns = [np.array([3, 5, 9]), np.array([], dtype=np.int64), np.array([9])], np.array([3, 9, 11])
    dense, p = np.array([[1, 1, 0], [0, 0, 0], [0, 1, 0]]), Presence(sets, columns)
    assert np.array_equal(p.times(np.array([1.0, 2, 4])), dense @ [1, 2, 4])
    assert np.array_equal(p.turned_times(np.array([1.0, 2, 4])), dense.T @ [1, 2, 4])
