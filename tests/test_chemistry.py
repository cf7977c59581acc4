import itertools
import random

import pytest

from sportlake.operators import chemistry

SCHEMA = "match_id long, player_id long, team_id string, delta double"


def _by_hand(d1, d2, same):
    mean = (d1 + d2) / 2
    together = -abs(mean) if d1 * d2 < 0 else mean
    return together if same else -together


@pytest.mark.parametrize(
    "d1,d2,same,other",
    [(0.1, 0.3, 0.7, 0.3), (0.1, -0.3, 0.4, 0.6), (-0.1, -0.3, 0.3, 0.7), (0.0, -0.4, 0.3, 0.7)],
)
def test_worked_examples(spark, d1, d2, same, other):
    rows = [(1, 1, "x", d1), (1, 2, "x", d2), (2, 3, "x", d1), (2, 4, "y", d2)]
    coeffs = chemistry.coefficients(
        chemistry.contributions(chemistry.pairs(spark.createDataFrame(rows, SCHEMA)))
    )
    got = {(r.player_a, r.player_b): r.coeff for r in coeffs.collect()}
    assert got == {(1, 2): pytest.approx(same), (3, 4): pytest.approx(other)}


@pytest.mark.parametrize("block_rows", [256, 7, 1])
def test_pairs_equal_brute_force(spark, block_rows):
    rng = random.Random(5)
    rows = []
    for match, size in enumerate([1, 2, 9, 60, 14]):
        for player in rng.sample(range(200), size):
            rows.append((match, player, rng.choice("xy"), rng.choice([0.0, rng.uniform(-1, 1)])))
    expected = {}
    for a, b in itertools.combinations(sorted(rows, key=lambda r: (r[0], r[1])), 2):
        if a[0] == b[0]:
            expected[a[0], a[1], b[1]] = _by_hand(a[3], b[3], a[2] == b[2])
    got = chemistry.pairs(spark.createDataFrame(rows, SCHEMA), block_rows).collect()
    assert len(got) == len(expected)
    for r in got:
        key = r.match_id, r.player_a, r.player_b
        assert r.contribution == pytest.approx(expected[key], abs=1e-15)


def test_mirrored(spark):
    one = spark.createDataFrame([(1, 2, 0.4)], "player_a long, player_b long, coeff double")
    got = sorted(map(tuple, chemistry.mirrored(one).collect()))
    assert got == [(1, 2, 0.4), (2, 1, 0.4)]
