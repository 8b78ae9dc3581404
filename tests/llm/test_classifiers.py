"""The trained operators: held-out accuracy, exact parts against plain versions, odd input."""

import random

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from gridpanel.llm import language, quality, toxicity, training
from gridpanel.llm.training import fold, labelled_sample, without_copies

ODD = [None, "", "   ", "?!.", "ok", "word " * 30_000, "\x00 ​ é"]


# ---- toxicity --------------------------------------------------------------------

def brute_segments(scores):
    """All maximal segments by their recursive definition: the best one (shortest, then
    leftmost of equals), then the same to its left and right."""
    def rec(lo, hi):
        best = None
        for a in range(lo, hi):
            total = 0.0
            for b in range(a, hi):
                total += scores[b]
                if total > 1e-12 and (best is None or total > best[2] + 1e-9 or abs(total - best[2]) <= 1e-9 and b + 1 - a < best[1] - best[0]):
                    best = (a, b + 1, total)
        return [] if best is None else rec(lo, best[0]) + [best] + rec(best[1], hi)
    return rec(0, len(scores))


def test_segments_match_the_definition():
    r = random.Random(2)
    for _ in range(300):
        scores = [round(r.uniform(-3, 2), 3) for _ in range(r.randint(0, 25))]
        got = toxicity.maximal_segments(np.array(scores))
        want = brute_segments(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_segments_take_linear_time():
    scores = np.where(np.arange(400_000) % 3 == 0, 1.0, -0.6)
    assert len(toxicity.maximal_segments(scores)) > 0


def test_unseen_words_inherit_from_their_stem():
    odds = toxicity.log_odds({"badd": (0, 60), "baddx$": (0, 30), "baddy$": (0, 30), "good": (300, 30)}, 300, 60)
    scorer = toxicity.Scorer(odds)
    bad, new, good = (float(scorer(w)[0]) for w in ("baddx", "baddzzz", "goodly"))
    assert bad > 1 and new > 1 and good < 0


def test_runs_without_spaces_are_scored_to_their_end():
    odds = toxicity.log_odds({"vil": (0, 40), "vile$": (0, 60), "毒蛇$": (0, 60), "plain$": (300, 30)}, 300, 60)
    scorer = toxicity.Scorer(odds)
    joined, chinese = "plain" * 20 + "vile", "天地玄黄宇宙洪荒" * 4 + "毒蛇"
    assert scorer(joined).max() > 1 and scorer(chinese).max() > 1
    for text in (joined, chinese, "a " + chinese + "word" + joined, "๑ ไทย ok x" + "y" * 40):
        places = toxicity.spans(text)
        assert toxicity.words_of(text) == [text[a:b] for a, b in places]
        assert {i for a, b in places for i in range(a, b)} == {i for i, c in enumerate(text) if toxicity.WORD.match(c)}
    assert toxicity.words_of("a bc_" + "d" * 40) == ["a", "bc", "d" * 40]


def test_words_need_no_pattern_search(monkeypatch):
    every = "".join(f"a{chr(i)}b" for i in [*range(0x3000), *range(0x1f000, 0x1fb00), 0x1d400, 0xffff, 0x10000, 0x10ffff])
    texts = ["", " ", "_a_b", "Two words, 3rd\x85x", every, "caf\u00e9 \U0001f600ok \U0001d400b\ud800c " * 3]
    want = [[text[a:b] for a, b in toxicity.spans(text)] for text in texts]
    for size in (7, toxicity.PIECE):
        monkeypatch.setattr(toxicity, "PIECE", size)
        assert [toxicity.words_of(text) for text in texts] == want
    plain = [text for text in texts if toxicity.HAS_UNSPACED.search(text) is None]
    assert len(plain) == 5
    want = [toxicity.WORD.findall(text) for text in plain]
    monkeypatch.setattr(toxicity, "WORD", None)
    assert [toxicity.words_of(text) for text in plain] == want


def test_word_scores_do_not_depend_on_the_cache(monkeypatch):
    odds = {"bad": 1.0, "badd": 2.0, "baddxy": 3.0, "bad$": 4.0, "baddx$": 5.0, "on$": -1.0}
    words = ["bad", "badd", "baddx", "baddxy", "baddxyz", "bady", "on", "one", "b", "", "\u00e9bad"]
    want = [next((odds[f] for f in reversed(toxicity.chain(w)) if f in odds), 0.0) - toxicity.DRIFT for w in words]
    for size in (1, 3, 100):
        monkeypatch.setattr(toxicity, "CACHE_WORDS", size)
        scores = toxicity.WordScores(odds)
        for _ in range(3):
            assert [scores[w] for w in words] == want
            assert len(scores) <= 3 + size and {"bad", "baddx", "on"} <= scores.keys()      # the known words stay


def test_features_are_counted_once_a_document():
    rows = [("Badd badd baddxyz", 1), ("baddxyz on", 0), ("", 0), ("on on _ on", 1)]
    batch = pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows]), pa.array([n for _, n in rows], pa.int32())], ["text", "label"])
    want = {}
    for text, label in rows:
        for f in {f for w in toxicity.words_of(text.lower()) for f in toxicity.chain(w)}:
            want.setdefault(f, [0, 0])[label] += 1
    got = [r for out in toxicity.count_features([batch]) for r in out.to_pylist()]
    assert len(got) == len(want) and {r["feature"]: [r["n0"], r["n1"]] for r in got} == want


def test_bands_of_many_sets_are_those_of_each():
    r = np.random.default_rng(3)
    sets = [np.sort(r.integers(0, 2**63, n).astype(np.uint64)) for n in (1, 5, 400, 2)]
    got = training._bands(sets)
    for s, bands in zip(sets, got, strict=True):
        least = [training.mix(s ^ np.uint64(k)).min() for k in range(1, training.BANDS * training.ROWS + 1)]
        want = np.zeros(training.BANDS, np.uint64)
        for i in range(training.ROWS):
            want = training.mix(want ^ np.array(least[i::training.ROWS], np.uint64))
        assert bands.tolist() == want.view(np.int64).tolist()
    assert training._bands([]) == []


@pytest.fixture
def labelled(documents, spark):
    r = random.Random(5)
    plain = [f"plain{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(500):
        words = [r.choice(plain) for _ in range(r.randint(20, 120))]
        toxic = i % 5 == 0
        for _ in range(4 * toxic):
            words.insert(r.randrange(len(words)), r.choice(["vile", "scum", "slurr" + r.choice("abcdefgh")]))
        rows.append((i, " ".join(words) if i % 7 else " ".join(w.upper() + "!!" for w in words)))
        labels.append((i, int(i % 7 > 0), int(toxic), "x"))
    labels += [(None, 1, 1, "x"), (3, None, None, "x"), (4, 0, 0, "x"), (99_999, 1, 1, "x")]
    return documents(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int, text string")


def test_toxicity_held_out_and_passages(labelled, documents):
    docs, labels = labelled
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model).withColumn("held", fold("doc_id", 5) == 0).collect()
    for held in (True, False):
        part = [x for x in got if x.held == held]
        assert sum((x.score >= 0.5) == (x.doc_id % 5 == 0) for x in part) >= 0.97 * len(part)
    text = {r.doc_id: r.text for r in docs.collect()}
    found = [text[x.doc_id][p.start:p.end] for x in got if x.doc_id % 35 and x.doc_id % 5 == 0 for p in x.passages]
    assert found and all(any(w in f for w in ("vile", "scum", "slurr")) for f in found)
    odd = toxicity.score(documents([(i, t) for i, t in enumerate(ODD)]), model).collect()
    assert len(odd) == len(ODD) and all(0 <= x.score < 0.5 and not x.passages for x in odd)
    kept = toxicity.remove_toxic(docs, model)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} == {x.doc_id for x in got if x.score < 0.5}


def test_toxicity_without_training_rows(labelled, documents):
    docs, labels = labelled
    model = toxicity.fit(docs, labels.where("toxic = 1"))
    assert {r.score for r in toxicity.score(docs, model).collect()} == {0.0}
    assert toxicity.score(documents([]), toxicity.fit(documents([]), labels.limit(0))).count() == 0


def test_sample_is_bounded_and_leaves_the_fold_out(labelled):
    docs, labels = labelled
    rows = labelled_sample(docs, labels, "toxic", 5, 0, 20).withColumn("fold", fold("id", 5)).collect()
    assert sum(r.label == 1 for r in rows) == 20 and sum(r.label == 0 for r in rows) == 20
    assert 0 not in {r.fold for r in rows}


def test_copies_in_the_sample_are_one_witness(spark):
    rows = [(i, "a copied text of some words here", 1) for i in range(50)] + [(100, "quite another text it is", 1), (101, "", 0)]
    df = spark.createDataFrame(rows, "id bigint, text string, label int")
    assert sorted(r.id for r in without_copies(df).collect()) == [0, 100, 101]


def test_a_common_passage_makes_no_copies(spark):
    r = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, passage + " " + " ".join(f"w{r.randrange(10**6)}" for _ in range(20)), i % 2) for i in range(400)]
    rows += [(1000 + i, rows[i][1] + " more", i % 2) for i in range(30)]        # 30 near copies
    df = spark.createDataFrame(rows, "id bigint, text string, label int")
    assert sorted(r.id for r in without_copies(df).collect()) == list(range(400))


def test_repeated_rows_and_other_columns_get_the_same_scores(labelled):
    docs, labels = labelled
    more = docs.unionByName(docs.where("doc_id < 20")).withColumns({"score": F.lit("x"), "label": F.lit(1), "id": F.lit("i")})
    for module in (toxicity, quality):
        model = module.fit(docs, labels)
        one = {x.doc_id: x.score for x in module.score(docs, model).collect()}
        two = module.score(more, model).collect()
        assert len(two) == more.count() and all(abs(x.score - one[x.doc_id]) < 1e-12 for x in two)


# ---- quality ---------------------------------------------------------------------

def plain_scores(net, texts):
    """The network's scores one text and one passage at a time."""
    w, out = net.weights, []
    for text in texts:
        x, _ = quality.encode([(text or "").encode()])
        h = [np.tanh(row.astype(float) @ w["encode"] + w["shift"]) for row in x]
        attend = np.exp([float(np.tanh(a @ w["tanh"]) / (1 + np.exp(-(a @ w["gate"]))) @ w["attend"]) for a in h])
        z = sum(a * b for a, b in zip(attend / attend.sum(), h, strict=True)) @ w["score"] + w["offset"][0]
        out.append(1 / (1 + np.exp(-z)))
    return out


def test_quality_scores_against_a_plain_version(labelled):
    docs, labels = labelled
    net = quality.fit(docs, labels)
    rows = docs.orderBy("doc_id").collect()
    got = {x.doc_id: x.score for x in quality.score(docs, net).collect()}
    for r, want in zip(rows, plain_scores(net, [r.text for r in rows]), strict=True):
        assert abs(got[r.doc_id] - want) < 1e-6


def test_features_do_not_depend_on_the_texts_beside():
    texts = [b"One two.", b"  lead", None, b"trail \n", b" \t", b"A-b c!" * 50, b"last"]
    x, first = quality.encode(texts)
    for i, t in enumerate(texts):
        assert (x[first[i]:first[i + 1]] == quality.encode([t])[0]).all(), t


def test_quality_reads_long_texts_in_blocks(monkeypatch):
    text = b"  " + b" ".join(b"w%d." % (i % 37) for i in range(5_000)) + b" \n"
    whole, first = quality.encode_block([text])
    monkeypatch.setattr(quality, "LONG", 100)
    monkeypatch.setattr(quality, "BLOCK", 3)
    x, f = quality.encode([b"short", text, None])
    assert f.tolist() == [0, 1, 1 + first[-1], 2 + first[-1]]
    assert b"".join(quality.blocks_of(text)) == text
    assert np.abs(x[1:-1] - whole).max() < 0.08     # a byte pair a block differs: the line ends there


def test_quality_held_out(labelled, documents):
    docs, labels = labelled
    net = quality.fit(docs, labels)
    got = quality.score(docs, net, with_passages=True).withColumn("held", fold("doc_id", 3) == 1).collect()
    for held in (True, False):
        part = [x for x in got if x.held == held]
        assert sum((x.score >= 0.5) == (x.doc_id % 7 > 0) for x in part) >= 0.97 * len(part)
    assert all(abs(sum(p.attention for p in x.passages) - 1) < 1e-6 for x in got)
    odd = quality.score(documents([(i, t) for i, t in enumerate(ODD)]), net, with_passages=True).collect()
    assert all(0 <= x.score <= 1 for x in odd) and [len(x.passages) for x in sorted(odd)] == [1, 1, 1, 1, 1, 469, 1]
    only = quality.fit(docs, labels.where("quality = 1"))
    assert {x.score for x in quality.score(docs, only).collect()} == {1.0}
    assert quality.score(documents([]), net).count() == 0


def test_quality_gradient_is_that_of_its_loss():
    r = np.random.default_rng(0)
    x, first, y = r.normal(size=(7, quality.FEATURES)) * 0.2, np.array([0, 3, 4, 7]), np.array([1.0, 0.0, 1.0])
    p = {"encode": r.normal(size=(quality.FEATURES, 4)) * 0.3, "shift": r.normal(size=4), "tanh": r.normal(size=(4, 3)),
         "gate": r.normal(size=(4, 3)), "attend": r.normal(size=3), "score": r.normal(size=4), "offset": np.zeros(1)}

    def loss():
        q = quality.AttentionNetwork(p).forward(x, first)["p"]
        return (-(y * np.log(q) + (1 - y) * np.log(1 - q)).mean()
                + 5e-5 * ((p["encode"] ** 2).sum() + (p["score"] ** 2).sum()))

    g = quality.AttentionNetwork(p).gradient(x, first, y)
    for k in p:
        i = tuple(r.integers(0, n) for n in p[k].shape)
        p[k][i] += 1e-6
        up = loss()
        p[k][i] -= 2e-6
        down = loss()
        p[k][i] += 1e-6
        assert abs((up - down) / 2e-6 - g[k][i]) < 1e-6, k


def test_quality_trains_on_whole_documents_as_far_as_the_bound(documents, spark, monkeypatch):
    docs = documents([(1, " ".join(["good"] * 64 * 300)), (2, "bad words"), (3, None)])
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id bigint, quality int")
    bags = []
    monkeypatch.setattr(quality, "train", lambda b, y: bags.extend(len(x) for x in b))
    quality.fit(docs, labels, folds=10**9, held_out=-1)
    assert sorted(bags) == [1, 1, 300]
    bags.clear()
    quality.fit(docs, labels, folds=10**9, held_out=-1, most_passages=1)
    assert sorted(bags) == [1, 300]


def test_passage_features():
    x, first = quality.encode([b"a a a b", None, b" ", b"x " * 130])
    assert first.tolist() == [0, 1, 2, 3, 6]
    assert np.allclose(x[0, -4:], [0.5, 0.5, 0.75, 1 / 20]) and not x[1].any() and np.allclose(x[5, -4:-1], [0.5, 0.5, 1])


# ---- language --------------------------------------------------------------------

@pytest.fixture(scope="module")
def net(spark):
    from gridpanel.session import table

    docs = table(spark, "/root/testdata/sf0.001", "documents")
    return docs, language.fit(docs)


def test_language_held_out(net):
    docs, found = net
    got = language.identify(docs, found).join(docs.select("doc_id", "lang"), "doc_id").where(fold("doc_id", 4) == 2).collect()
    assert sum(x.lang_pred == x.lang for x in got) >= 0.95 * len(got)


def test_language_tables_equal_the_convolution(net):
    _, n = net
    r = np.random.default_rng(0)
    x = r.integers(0, 256, (3, language.WINDOW)).astype(np.uint8)
    pooled = [sum(n.taps[w][k][x[:, k:k + language.WINDOW - w + 1]] for k in range(w)).max(axis=1) for w in n.taps]
    z = np.maximum(np.hstack(pooled) + n.bias, 0) @ n.head + n.offset
    z -= z.max(axis=1, keepdims=True)
    assert np.allclose(language.Identifier(n).log_probabilities(x), z - np.log(np.exp(z).sum(axis=1, keepdims=True)), atol=1e-4)


def test_windows_cover_the_text():
    for n in (0, 1, 255, 256, 257, 1000):
        data = np.arange(1, n + 1, dtype=np.uint64).astype(np.uint8)
        assert (language.windows(data).ravel()[:n] == data).all() and len(language.windows(data)) == max(1, -(-n // 256))


def test_language_odd_texts_and_filter(net, documents):
    _, n = net
    odd = documents([(i, t) for i, t in enumerate(ODD)])
    got = {x.doc_id: x for x in language.identify(odd, n).collect()}
    assert [got[i].lang_pred == "und" for i in range(len(ODD))] == [True, True, True, True, False, False, False]
    assert all(0 <= x.score <= 1 for x in got.values())
    kept = language.keep_identified(odd, n, least=0.0)
    assert kept.schema == odd.schema and {r.doc_id for r in kept.collect()} == {4, 5, 6}


def test_language_training_counts_ids_and_copies_once(spark, documents, monkeypatch):
    r, seen = random.Random(3), {}
    words = {"aa": ["alpha", "beta", "gamma", "delta", "rho"], "zz": ["zorn", "wurm", "topf", "pferd", "kraut"]}
    rows = [(i, " ".join(f"{r.choice(words[k])}{r.randrange(99)}" for _ in range(30)), k)
            for i, k in enumerate(["aa", "zz"] * 20)]
    rows += [(0, rows[0][1] + f" x{i}", "aa") for i in range(200)] + [(1000 + i, rows[2][1], "aa") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    monkeypatch.setattr(language, "train", lambda x, y, languages: seen.update(y=y, languages=languages))
    language.fit(df, folds=10**9, held_out=-1, per_language=1000)
    n = np.bincount(seen["y"])
    assert seen["languages"] == ["aa", "zz"] and 0 < n[0] <= 22 and n[1] >= 15
    language.fit(df, folds=10**9, held_out=-1, per_language=1000, per_windows=5)
    assert 0 < np.bincount(seen["y"]).max() <= 12


def test_language_without_training_rows(documents):
    none = language.fit(documents([(1, "text")]))
    assert [(x.lang_pred, x.score) for x in language.identify(documents([(1, "text"), (2, None)]), none).collect()] == [("und", 0.0)] * 2
    assert language.identify(documents([]), none).count() == 0
