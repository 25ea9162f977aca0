"""Near-duplicates of the pipeline, against brute force."""

import math
import random

import corpus_pipeline
import numpy as np
import pytest
from conftest import frame

from lectern.llm.signatures import PLACES, fewest, links_within, shingle_sets, signature
from lectern.llm.simhash import similar_documents


def slow_set(t):
    w = (t or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def slow_components(rows):
    sets, part = [slow_set(t) for _, t in rows], list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]) and part[a] != part[b]:
                part = [min(part[a], part[b]) if p in (part[a], part[b]) else p for p in part]
    least = {}
    for (i, _), p in zip(rows, part, strict=True):
        least[p] = min(least.get(p, 1 << 62), 1 << 62 if i is None else i)
    return [(i, least[p]) for (i, _), p in zip(rows, part, strict=True)]


@pytest.fixture(scope="module")
def near():
    """Copies with single words replaced, on both sides of a similarity of 0.8."""
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(3000)]
    out = []
    for k in range(30):
        words = rng.choices(vocabulary, k=rng.choice([60, 200, 500]))
        out.append((10 * k, " ".join(words)))
        for c in range(1, 4):
            changed = list(words)
            for at in rng.sample(range(len(words)), max(1, len(words) * c // 60)):
                changed[at] = rng.choice(vocabulary)
            out.append((10 * k + c, " ".join(changed)))
    return out


@pytest.mark.parametrize("tile", [3, 4096])
def test_similar_documents_are_linked(spark, near, rows, none, tile):
    every = near + [(None if i is None else i + 1000, t) for i, t in rows]
    got = similar_documents(frame(spark, every), tile=tile).collect()
    assert sorted(map(tuple, got), key=str) == sorted(slow_components(every), key=str)
    assert similar_documents(none).count() == 0


def test_stage_drops_similar_documents(spark, near):
    want = {i for i, c in slow_components(near) if i == c}
    assert len(want) < len(near) - 25
    assert {r["doc_id"] for r in corpus_pipeline.simhash_near_dedup(spark, frame(spark, near), "").collect()} == want


def test_count_filter_keeps_what_is_similar():
    assert fewest(0.8) == max(m for m in range(PLACES) if sum(math.comb(PLACES, k) * 0.8**k * 0.2 ** (PLACES - k) for k in range(m)) <= 1e-6)
    rng = random.Random(2)
    base = [f"w{rng.randrange(5000)}" for _ in range(400)]
    texts = [" ".join(base)]
    for c in (2, 4, 8, 60, 200):
        changed = list(base)
        for at in rng.sample(range(400), c):
            changed[at] = "x" + changed[at]
        texts.append(" ".join(changed))
    sets = list(shingle_sets(texts, 5))
    signs = [signature(s)[0] for s in sets]
    alike = lambda a, b: len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    shared = lambda a, b: sum(x == y for x, y in zip(a, b, strict=True))
    for a in range(6):
        for b in range(a):
            if alike(sets[a], sets[b]) >= 0.8:
                assert shared(signs[a], signs[b]) >= fewest(0.8)
    assert shared(signs[0], signs[5]) < fewest(0.8)
    linked = {v for v, _ in links_within(list(range(6)), signs, sets, 0.8)}
    assert linked and linked == {b for b in range(1, 6) if any(alike(sets[a], sets[b]) >= 0.8 for a in range(6) if a != b)}
