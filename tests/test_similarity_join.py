"""The weighted similarity join against every two forms, and how its work grows."""

import random

import pytest

from kinweave.functions.similarity import similarities
from kinweave.operators import similarity_join
from kinweave.operators.similarity_join import Asked, near_forms, weighted_pairs

SYLLABLES = "pel lic cia mar zo ot ta via no bru fer ran di qua glia zuc ca ro te des co mor ret fran che li de ni gi iii wi".split()


def all_pairs(words, threshold):
    pairs = [(a, b) for i, a in enumerate(words) for b in words[i + 1 :]]
    found = similarities([p[0] for p in pairs], [p[1] for p in pairs])
    return {p for p, s in zip(pairs, found) if s >= threshold}


def words(seed, letters, n, longest):
    rng = random.Random(seed)
    made = {"".join(rng.choices(letters, k=rng.randint(1, longest))) for _ in range(n)}
    return sorted(made | {w.replace(x, y, 1) for w in made for x, y in (("m", "ni"), ("iii", "m"), ("n", "ri"), ("vi", "w"))})


@pytest.mark.parametrize("threshold", [0.8, 0.6, 0.45])
@pytest.mark.parametrize("letters,n,longest", [("minrvwsfi", 100, 9), ("abcdeilmnorstuéß", 120, 12), ("mi", 30, 10)])
def test_walk_loses_no_pair(letters, n, longest, threshold):
    some = words(7, letters, n, longest)
    got = {(some[i], some[p]) for p, near in near_forms(Asked(some, threshold), some) for i in near.tolist() if some[i] < some[p]}
    want = all_pairs(some, threshold)
    assert want <= got and len(got) <= len(want) + 5


def test_join_is_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(similarity_join, "FORMS_A_SHARD", 3)
    monkeypatch.setattr(similarity_join, "ASKED_AT_ONCE", 50)
    some = words(3, "abcdeilmnorstuéß日", 150, 8) + ["m", "iii", "nii", "ém", "-a"]
    df = spark.createDataFrame([(w,) for w in some + ["", None, some[0]]], "form string")
    assert {(r.a, r.b) for r in weighted_pairs(df, 0.7).collect()} == all_pairs(sorted(set(some)), 0.7)
    assert weighted_pairs(df.limit(0), 0.8).count() == 0


def test_walk_grows_slower_than_the_pairs(monkeypatch):
    rng = random.Random(2)
    steps = []
    plain = Asked.step
    monkeypatch.setattr(Asked, "step", lambda self, active, *rest: steps.append(len(active)) or plain(self, active, *rest))
    cells = []
    for n in (500, 2000):
        some = set()
        while len(some) < n:
            some.add("".join(rng.choices(SYLLABLES, k=rng.randint(2, 5))))
        steps.clear()
        list(near_forms(Asked(sorted(some), 0.8), sorted(some)))
        cells.append(sum(steps))
    assert cells[1] < 10 * cells[0]  # all pairs: 16 times
    assert cells[1] < 2000 * 2000  # rows of a table of distances, beside some ten a pair
