"""The linear program's tables, made fast, hold what they held."""

import numpy as np

from wattlake.llm import packing


def test_fillings_of_all_rooms_are_those_of_each():
    rng = np.random.default_rng(3)
    for share in (0.05, 0.2, 0.9):  # few lengths with a price, and many
        prices = np.zeros(201)
        some = rng.random(200) < share
        prices[1:][some] = (np.arange(1, 201) * rng.uniform(0.9, 1, 200))[some]
        best, taken = packing.price_table(prices, 200)
        fillings = packing.dearest_of_all(taken)
        assert fillings == [packing.dearest(taken, room) for room in range(201)]
        for room, filling in enumerate(fillings):
            assert sum(filling) <= room and abs(sum(prices[x] for x in filling) - best[room]) < 1e-9
        want = np.zeros(201)
        for room in range(1, 201):
            want[room] = max([want[room - 1]] + [want[room - x] + prices[x] for x in range(1, room + 1) if prices[x] > 0])
        assert np.allclose(best, want, rtol=0, atol=1e-9)
