"""The join against all pairs of sets of word tuples."""

import random
import re

import numpy as np
import pytest

from gridpanel.llm import jaccard as J

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def word_sets(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs):
    sets = [word_sets(t) for _, t in docs]
    at = list(range(len(docs)))

    def find(x):
        while at[x] != x:
            x = at[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            n = len(a & sets[j])
            if n and 100 * n >= 75 * len(a | sets[j]):
                at[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            ids[find(i)] = min(d, ids.get(find(i), d))
    return sorted(((d, len(sets[i]), ids.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(docs)), key=str)


def corpus(seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Ünï", "A.", "b,"]
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    passage = text(60)
    docs = [text(r.choice([1, 2, 4, 5, 6, 30, 80])) for _ in range(40)]
    for base in [text(60), text(120), text(9)]:
        docs += [base, base.upper(), base.replace(" ", "\n")]
        for _ in range(14):
            w = base.split(" ")
            for _ in range(r.randint(1, 4)):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            docs.append(" ".join(w))
    docs += [passage + " " + text(r.choice([2, 5, 12, 60])) for _ in range(20)]
    rows = [(1000 - i, t) for i, t in enumerate(docs)]
    return rows + [(2, None), (3, ""), (4, " \t\n"), (None, docs[40]), (None, "lone words here of a null id"),
                   (5, docs[3]), (5, docs[3]), (6, docs[5]), (6, docs[41]), (7, "x " * 20_000)]


@pytest.mark.parametrize("long_, sets, queries", [(200, 1000, 100), (1, 7, 3)])
def test_matches_all_pairs(spark, documents, monkeypatch, long_, sets, queries):
    monkeypatch.setattr(J, "LONG", long_)
    monkeypatch.setattr(J, "SHARD_SETS", sets)
    monkeypatch.setattr(J, "QUERIES", queries)
    monkeypatch.setattr(J, "LONG_QUERIES", queries)
    docs = corpus(long_)
    got = J.join(documents(docs, ", cls string, n int, token string, component_id string")).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(docs)


def test_keep_one_of_each_component(spark, documents):
    docs = corpus(5)
    frame = documents(docs, ", cls int, row_key string")
    kept = J.keep_one(frame)
    assert kept.schema.simpleString() == frame.schema.simpleString()
    joined = brute(docs)
    want = {c for _, n, c in joined if n and c is not None}
    ids = [r.doc_id for r in kept.collect() if r.doc_id not in (2, 3, 4)]
    assert {i for i in ids if i is not None} == want
    assert sorted(i for i in ids if i in (5, 7)) == [i for i in (5, 7) if i in want]
    assert kept.where("doc_id in (2, 3, 4)").count() == 3


def test_empty_table(spark, documents):
    assert J.join(documents([])).count() == 0
    assert J.keep_one(documents([])).count() == 0


def test_merge_skip_counts_like_a_counter():
    r = random.Random(4)
    for _ in range(200):
        lists = [sorted(r.sample(range(30), r.randint(1, 20))) for _ in range(r.randint(1, 12))]
        t = r.randint(1, len(lists))
        count = {v: sum(v in x for x in lists) for v in range(30)}
        assert J.merge_skip([list(x) for x in lists], t) == sorted((v, c) for v, c in count.items() if c >= t)


def test_shard_search_is_exact():
    r = np.random.default_rng(2)
    sets = [np.sort(r.choice(300, r.integers(1, 120), replace=False)).astype(np.uint64) for _ in range(60)]
    sets += [np.sort(np.unique(np.concatenate((s[: int(len(s) * 0.9)], r.choice(300, 3).astype(np.uint64))))) for s in sets]
    shard = J.Shard(sets)
    for q in sets:
        want = [i for i, s in enumerate(sets) if J.links(len(np.intersect1d(q, s)), len(q), len(s))]
        assert shard.search(q) == want


def test_a_shard_of_near_copies_is_searched_in_little_time():
    import time

    r = np.random.default_rng(7)
    base, sets = r.integers(0, 1 << 62, 390), []
    for edits in r.integers(2, 17, 1000):
        copy = base.copy()
        for a in r.integers(0, 386, edits):
            copy[a:a + 5] = r.integers(0, 1 << 62, 5)
        sets.append(np.unique(copy).astype(np.uint64))
    shard, start = J.Shard(sets), time.process_time()
    got = [shard.search(q) for q in sets[:40]]
    assert time.process_time() - start < 2      # the heap merge took 6
    for q, found in zip(sets[:3], got, strict=False):
        assert found == [i for i, s in enumerate(sets) if J.links(len(np.intersect1d(q, s)), len(q), len(s))]
    assert 0 < len(got[0]) < 1000


def test_copies_too_far_from_all_do_not_ask_on_long_lists(spark, documents, monkeypatch):
    monkeypatch.setattr(J, "LONG", 3)
    asked, search = [], J._search

    def counted(source, classes, index, queries, at_once, *rest):
        if at_once == J.LONG_QUERIES:
            asked.append(queries.select("cls").distinct().count())
        return search(source, classes, index, queries, at_once, *rest)

    monkeypatch.setattr(J, "_search", counted)
    monkeypatch.setattr(J, "LONG_QUERIES", 251)
    r = random.Random(9)
    base = [f"b{i}" for i in range(120)]

    def copy(name, edits):      # each edit makes five of the 116 shingles its own
        w = list(base)
        for k in range(edits):
            w[8 + 22 * k] = f"{name}_{k}"
        return " ".join(w)

    far = [(i, copy(f"far{i}", 5)) for i in range(30)]          # 25 of their own, more than a seventh
    links = J._list_links
    monkeypatch.setattr(J, "_list_links", lambda source, classes, labels, every=False: links(source, classes, None, every))
    near = far + [(100 + i, copy(f"near{i}", r.randint(0, 3))) for i in range(12)]
    assert sorted(map(tuple, J.join(documents(near)).collect()), key=str) == brute(near)
    assert 0 < sum(asked) <= 12     # those that are near; all but one asked before


def test_few_candidates_on_long_lists_are_probed():
    r = np.random.default_rng(8)
    common = r.integers(0, 1 << 62, 300)
    own = lambda n: r.integers(0, 1 << 62, n)
    sets = [np.unique(np.concatenate((common[i % 3:240], own(160)))).astype(np.uint64) for i in range(300)]
    sets += [np.unique(np.concatenate((sets[i][:390].astype(np.int64), own(9)))).astype(np.uint64) for i in range(20)]
    shard = J.Shard(sets)
    for q in sets[::13]:
        assert shard.search(q) == [i for i, s in enumerate(sets) if J.links(len(np.intersect1d(q, s)), len(q), len(s))]
    assert not shard.asked.any()


@pytest.mark.parametrize("text", ["a b c d e f", "A  b\tc\nd e", "a", "a b", "", "é É ß a b c", "x" * 5000 + " y", "a b c d e a b c d e"])
def test_shingle_counts(text):
    code, first = J.shingles([b"pad", text.encode(), None, text.upper().encode() if text.isascii() else text.encode()])
    assert first[2] - first[1] == len(word_sets(text)) and first[3] == first[2]
    assert (code[first[1]:first[2]] == code[first[3]:first[4]]).all()


@pytest.mark.parametrize("long_", [200, 2])
def test_links_are_all_links(spark, documents, monkeypatch, long_):
    monkeypatch.setattr(J, "LONG", long_)
    monkeypatch.setattr(J, "SHARD_SETS", 9)
    docs = [(i, t) for i, (_, t) in enumerate(corpus(3))]
    members, links = J.links_of(documents(docs))
    of = {}
    for r in members.where("cls is not null").collect():
        of.setdefault(r.cls, set()).add(r.doc_id)
    sets = {i: word_sets(t) for i, t in docs}
    first = {c: min(ids) for c, ids in of.items()}
    assert all(len({frozenset(sets[i]) for i in ids}) == 1 for ids in of.values())
    got = sorted(tuple(sorted((first[r.a], first[r.b]))) for r in links.collect())
    heads = sorted(first.values())
    want = [(i, j) for i in heads for j in heads if i < j and (n := len(sets[i] & sets[j])) and 100 * n >= 75 * len(sets[i] | sets[j])]
    assert got == want and len(got) > 50


def test_long_texts_have_the_same_shingles_in_pieces(monkeypatch):
    r = random.Random(6)
    texts = [" ".join(f"W{r.randrange(50)}" for _ in range(400)).encode(), b"", b"a b", b"  lead  " + b"x" * 300 + b" y z\t"]
    whole = J.shingles(texts)
    for piece in (8, 100, 1000):
        monkeypatch.setattr(J, "PIECE", piece)
        got = J.shingles(texts)
        assert (got[0] == whole[0]).all() and (got[1] == whole[1]).all()


def test_a_text_of_40_mb_takes_bounded_memory():
    import subprocess
    import sys

    code = ("import resource, sys; sys.path.insert(0, %r)\n"
            "from gridpanel.llm import jaccard, quality, odd_sketch\n"
            "text = b' '.join(b'w%%d' %% (i * 7919 %% 100003) for i in range(6_000_000))\n"
            "jaccard.shingles([text]); x, first = quality.encode([text]); odd_sketch.shingles([text])\n"
            "assert len(text) > 40_000_000 and len(x) == 93_750\n"
            "print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)" % sys.path[0])
    root = __file__.rsplit("/tests/", 1)[0]
    code = code.replace(repr(sys.path[0]), repr(root))
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert int(done.stdout) < 900
