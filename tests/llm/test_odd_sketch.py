"""Odd-sketch near-duplicates against all pairs of sets of word tuples."""

import random
import re

import numpy as np
import pytest

from gridpanel.llm import odd_sketch as O

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def word_set(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + 3]) for i in range(max(1, len(w) - 2))} if w else set()


def brute(docs):
    sets = [word_set(t) for _, t in docs]
    at = list(range(len(docs)))

    def find(x):
        while at[x] != x:
            x = at[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            n = len(a & sets[j])
            if n and 100 * n >= 85 * len(a | sets[j]):
                at[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    rows = [(d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(docs)]
    return sorted(((*r, r[0] == r[2]) for r in rows), key=str)


def corpus(seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["Ünï", "A.", "b,"]
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    docs = [text(r.choice([1, 2, 3, 4, 30, 80])) for _ in range(30)]
    for base in [text(40), text(90), text(200), text(7)]:
        docs += [base, base.upper(), base.replace(" ", "\n")]
        for _ in range(25):         # similarities on both sides of the threshold
            w = base.split(" ")
            for _ in range(r.randint(1, max(2, len(w) // 20))):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            docs.append(" ".join(w))
    passage = text(60)
    docs += [passage + " " + text(r.choice([1, 3, 6, 12, 40])) for _ in range(25)]
    rows = [(1000 - i, t) for i, t in enumerate(docs)]
    return rows + [(2, None), (3, ""), (4, " \t\n"), (None, docs[40]), (None, "lone words here of a null id"),
                   (5, docs[3]), (5, docs[3]), (6, docs[5]), (6, docs[41]), (7, "x " * 20_000)]


@pytest.mark.parametrize("small, block", [(32, 1000), (2, 5)])
def test_matches_all_pairs(spark, documents, monkeypatch, small, block):
    monkeypatch.setattr(O, "SMALL", small)
    monkeypatch.setattr(O, "BLOCK", block)
    docs = corpus(block)
    got = O.near_duplicates(documents(docs, ", cls string, n int, kept string, key int, component_id string")).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(docs)


def test_empty_table(spark, documents):
    assert O.near_duplicates(documents([])).collect() == []


def test_sketch_limit_keeps_linked_pairs():
    r = np.random.default_rng(3)
    over, same, off = 0, [], []
    for _ in range(400):
        both = r.integers(0, 2**63, 170, dtype=np.uint64)       # 170 of 200 common: the threshold
        a, b = (np.unique(np.concatenate((both, r.integers(0, 2**63, 15, dtype=np.uint64)))) for _ in range(2))
        mins = O.min_hashes(np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]))
        same.append((mins[:, 0] == mins[:, 1]).mean())
        keys, sketch = O.band_keys(mins), O.odd_sketches(mins)
        assert (keys[0] == keys[1]).any()
        off.append(int(np.bitwise_count(sketch[0] ^ sketch[1]).sum()))
        over += off[-1] > O.sketch_limit()
    assert over == 0 and abs(np.mean(same) - 0.85) < 0.01
    # the odd sketch's estimate of the similarity
    estimate = 1 + O.BITS / (4 * O.SAMPLES) * np.log(1 - 2 * np.array(off) / O.BITS)
    assert abs(estimate.mean() - 0.85) < 0.01
    far = O.min_hashes(np.concatenate((a, a + np.uint64(1))), np.array([0, len(a), 2 * len(a)]))
    sketch = O.odd_sketches(far)
    assert np.bitwise_count(sketch[0] ^ sketch[1]).sum() > O.sketch_limit()


def test_overlaps_are_exact(monkeypatch):
    monkeypatch.setattr(O, "COLUMNS", 7)
    r = np.random.default_rng(5)
    sets = [np.unique(r.integers(0, 60, r.integers(1, 40), dtype=np.uint64)) for _ in range(20)]
    got = O.overlaps(sets[:12], sets[12:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[12:]] for a in sets[:12]]


def test_long_texts_are_read_in_pieces(monkeypatch):
    text = ("Lorem  ipsum\tdolor " * 30 + "y" * 500 + " z ").encode()
    whole = O.word_hashes(text)
    monkeypatch.setattr(O, "SLICE", 16)
    assert (O.word_hashes(text) == whole).all() and len(whole) == 92
