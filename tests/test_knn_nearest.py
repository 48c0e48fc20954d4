"""Nearest rows by a rough product first: the same rows and distances as measuring every pair, for a fraction of the work."""

import time

import numpy as np
import pytest

from tidemill.operators import knn as K


def _every_pair(q, t, k):
    d2 = K.squared_distances(q, t)
    at = np.argsort(d2, axis=1, kind="stable")[:, :k]
    return at, np.take_along_axis(d2, at, axis=1)


@pytest.mark.parametrize("make", ["spread", "copies", "far", "few", "infinite"])
def test_nearest_equals_every_pair(make):
    rng = np.random.default_rng(5)
    q, t = rng.normal(size=(70, 16)), rng.normal(size=(300, 16))
    if make == "copies":
        t = np.repeat(t[:20], 15, axis=0)
        q[:10] = t[:10]
    if make == "far":  # rounding of the product is larger than the distances
        q, t = 1e6 + 1e-3 * q, 1e6 + 1e-3 * t
    if make == "few":
        t = t[:4]
    if make == "infinite":
        t[7, 3] = np.inf
    got, want = K.nearest(q, t, 5), _every_pair(q, t, 5)
    assert np.array_equal(got[0], want[0]) and np.array_equal(got[1], want[1])


def test_nearest_takes_a_fraction_of_the_time():
    rng = np.random.default_rng(6)
    q, t = rng.normal(size=(1000, 64)), rng.normal(size=(4096, 64))

    def seconds(f):
        f(q, t, 5)
        at = time.process_time()
        f(q, t, 5)
        return time.process_time() - at

    assert seconds(K.nearest) < 0.6 * seconds(_every_pair)
