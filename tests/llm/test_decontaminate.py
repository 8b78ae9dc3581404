"""Suffix-array decontamination against a window set held in Python."""

import hashlib
import random
import re

import pytest

from gridpanel.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=13):
    out = []
    sets = {}
    for i, t in items:
        w = plain_words(t)
        for s in range(max(1, len(w) - window + 1) if w else 0):
            sets.setdefault(tuple(w[s:s + window]), set()).add(i)
    for d, t in docs:
        w, hit, found = plain_words(t), set(), set()
        for n in {len(k) for k in sets}:
            for s in range(len(w) - n + 1):
                if (k := tuple(w[s:s + n])) in sets:
                    hit.update(range(s, s + n))
                    found |= sets[k]
        names = sorted(str(i) for i in found if i is not None)
        out.append((d, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def tables(seed=1):
    r = random.Random(seed)
    vocabulary = ["The", "of", "Über", "naïve", "a1", "b", "c", "d'e", "X"]

    def text(n):
        return " ".join(r.choice(vocabulary) for _ in range(n))

    items = [(i, text(r.choice([3, 12, 13, 14, 40]))) for i in range(12)]
    items += [(12, items[3][1]), (13, None), (14, ""), (15, "?!"), (None, text(20)), (3, text(15))]
    docs = [(i, text(r.randint(0, 60))) for i in range(60)]
    for i, t in items:
        if t:
            docs.append((100 + (i or 0), text(30) + " " + t + " " + text(9)))
            docs.append((200 + (i or 0), text(5) + " " + " ".join(t.split()[:16]).upper()))
    docs += [(300, None), (301, ""), (302, "..."), (None, items[4][1]), (100, docs[62][1]), (100, docs[62][1])]
    docs.append((303, text(30_000) + " " + items[4][1]))
    return docs, items


def bench(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 as n_words", "'x' as spans")


@pytest.mark.parametrize("limit", [D.MAX_BENCHMARK_BYTES, 300])
def test_matches_brute_force_with_one_or_many_parts(spark, documents, limit):
    docs, items = tables()
    found = D.overlap(documents(docs, ", n_words bigint, digest string"), bench(spark, items), max_benchmark_bytes=limit)
    assert sorted((tuple(r) for r in D.digest_columns(found).collect()), key=str) == brute(docs, items)


def test_longest_match_and_place(spark, documents):
    item = " ".join(f"w{i}" for i in range(30))
    text = "x y z " + " ".join(f"W{i}" for i in range(5, 25)) + " q " + " ".join(f"w{i}" for i in range(13))
    docs, items = documents([(1, text)]), bench(spark, [(7, item)])
    for limit in (D.MAX_BENCHMARK_BYTES, 1):
        assert sorted(tuple(m) for m in D.matches(docs, items, max_benchmark_bytes=limit).collect()) == [
            (1, "7", 0, 24, 13), (1, "7", 5, 3, 20)]
    found = D.overlap(docs, items).first()
    assert found["items"] == ["7"]
    assert [(s.start, s.end) for s in found.spans] == [(3, 23), (24, 37)]


@pytest.mark.parametrize("limit", [D.MAX_BENCHMARK_BYTES, 300])
def test_drop_contaminated_keeps_columns_and_clean_rows(spark, documents, limit):
    docs, items = tables(2)
    frame = documents(docs, ", digest string, n_words bigint")
    left = D.drop_contaminated(frame, bench(spark, items), max_benchmark_bytes=limit)
    assert left.schema == frame.schema
    bad = [b[0] for b in brute(docs, items) if b[5]]
    kept = [r.doc_id for r in left.collect()]
    assert sorted(map(str, kept)) == sorted(str(d) for (d, t) in docs
                                            if not [b for b in brute([(d, t)], items) if b[5]])
    assert bad


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id bigint, text string")
    r = D.digest_columns(D.overlap(documents([(1, "a b")]), none)).collect()
    assert [(x.n_words, x.n_hit, x.contaminated) for x in r] == [(2, 0, False)]
    assert D.overlap(documents([]), none).count() == 0
    assert D.drop_contaminated(documents([]), none).count() == 0


def test_a_hot_line_of_many_items_stays_small():
    import resource

    line = " ".join(f"h{i}" for i in range(13))
    test = D.build_test_set([(str(k), f"{line} own{k}".encode()) for k in range(400)], 13)
    hits = D.search_shard([f"{line} x ".encode() * 20_000, b"clean words"], test, 13)
    assert len(hits.items[0]) == 400 and not hits.items[1] and len(hits.spans[0]) == 20_000
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    n = sum(len(found[0]) for found in hits.matches(test))      # a report's rows come in bounded pieces
    assert n == 400 * 20_000
    assert (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) < 300 * 1024


def test_matches_do_not_depend_on_the_pieces(monkeypatch):
    r = random.Random(4)
    items = [(str(k), " ".join(r.choice("abc") for _ in range(30)).encode()) for k in range(6)]
    texts = [(" ".join(r.choice("abc") for _ in range(60)) + " " + items[k][1].decode()).encode() for k in range(6)]
    test = D.build_test_set(items, 4)
    hits = D.search_shard(texts, test, 4)
    whole = sorted(x for found in hits.matches(test) for x in zip(*(a.tolist() for a in found), strict=True))
    monkeypatch.setattr(D, "MATCHES_AT_ONCE", 1)
    pieces = list(hits.matches(test))
    assert len(pieces) == 6 and sorted(x for found in pieces for x in zip(*(a.tolist() for a in found), strict=True)) == whole
