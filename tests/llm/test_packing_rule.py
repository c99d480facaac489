"""Every whole document goes to the cheapest sequence with room."""

import random

from loomdoc.llm.packing import capacities, pack


def test_cheapest_with_room():
    rng = random.Random(1)
    for lengths in ([rng.randrange(1, 3000) for _ in range(1000)], [1900] * 200 + [rng.randrange(1, 200) for _ in range(900)], [5], []):
        room, cost, at = capacities(sum(lengths), 2048), [0.0] * len(capacities(sum(lengths), 2048)), [0] * len(lengths)
        for d, start, n, s, _ in pack(lengths, 2048):
            assert start == at[d]
            left = lengths[d] - start
            able = [q for q in range(len(room)) if room[q] >= left]
            assert s == (min(able, key=lambda q: (cost[q], q)) if able else max(range(len(room)), key=lambda q: (room[q], -q)))
            assert n == (left if able else room[s])
            room[s], cost[s], at[d] = room[s] - n, cost[s] + n + n * n / 2048, start + n
        assert at == lengths and not any(room)
