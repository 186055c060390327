import numpy as np

from tripstream.llm.blocks import pack, unpack


def test_arrays_come_back_with_their_values():
    rng = np.random.default_rng(1)
    given = [np.zeros(0, np.int64), rng.integers(-(1 << 62), 1 << 62, 1000), np.arange(300), np.array([0, 1 << 31, (1 << 32) - 1]), np.array([1 << 40]),
             rng.random(77), np.array([], float), np.array([True, False]).astype(np.uint8), np.array([5], np.int8)]
    back = unpack(pack(*given))
    assert len(back) == len(given)
    for a, b in zip(given, back):
        assert a.tolist() == b.tolist()
    assert back[1].dtype == np.int64 and back[2].dtype.itemsize == 2 and len(pack(np.arange(100_000))) < 60_000
