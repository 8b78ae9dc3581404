import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gridpanel.llm import packing as P

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [None, "", " ", "a", "Hello world", " lead", "trail ", "two  spaces", "a \n b", "\n \nx", "tab\t x", "it's we'll 12 3.5",
         "é ü 漢字 ½ ² 😀", "<|endoftext|> in text", "word " * 3000, "x" * 5000, "\r\n\r\n a", "a  b", "don't  'S"]


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(PATH)


def ids(whole, text):
    return whole.encode(text or "", add_special_tokens=False).ids


def test_encoder_gives_the_library_s_ids(whole):
    r = random.Random(0)
    encode = P.Encoder(PATH, cache_words=50)
    alphabet = "ab é'\n\t .,1½漢 ​<|>"
    for text in TEXTS + ["".join(r.choice(alphabet) for _ in range(r.randint(1, 40))) for _ in range(400)]:
        assert np.frombuffer(encode(text or ""), "<u4").tolist() == ids(whole, text), repr(text)
    assert encode.words is not None
    vocabulary = sorted(whole.get_vocab())
    for _ in range(1500):       # random joins of decoded vocabulary entries
        text = whole.decode([whole.token_to_id(r.choice(vocabulary)) for _ in range(r.randint(1, 12))])
        assert np.frombuffer(encode(text), "<u4").tolist() == ids(whole, text), repr(text)


def test_other_tokenizer_files_go_through_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    encode = P.Encoder(path)
    assert encode.words is None
    assert np.frombuffer(encode("Hello world"), "<u4").tolist() == Tokenizer.from_file(path).encode("Hello world", add_special_tokens=False).ids


def test_pack_is_whole_gapless_and_tight(spark, documents, whole):
    r = random.Random(1)
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, "w " * r.randint(0, 900)) for i in range(150)] + [(100, "a b"), (100, "a b"), (None, "n")]
    size = 256
    out = P.pack(documents(docs, ", id string, part string, piece string").repartition(5), PATH, size=size).collect()
    want = []
    for d, t in docs:
        x = [*ids(whole, t), 2]
        first = len(x) if len(x) <= size else len(x) % size or size
        cuts = [0, *range(first, len(x) + 1, size)]
        want += [(d, k, a, b - a, zlib.crc32(np.array(x[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out), key=str) == sorted(want, key=str)
    by = {}
    for r in out:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    assert len(by) <= 1.03 * sum(r.length for r in out) / size + 1


def test_ids_on_request_and_empty(spark, documents, whole):
    out = P.pack(documents([(1, "Hello world")]), PATH, with_ids=True).first()
    assert np.frombuffer(out.ids, "<u4").tolist() == [*ids(whole, "Hello world"), 2]
    assert P.pack(documents([]), PATH).count() == 0


@pytest.mark.parametrize("n, want", [(1, [(0, 1)]), (8, [(0, 8)]), (9, [(0, 1), (1, 8)]), (16, [(0, 8), (8, 8)])])
def test_cut(n, want):
    assert P.cut(n, 8) == want


def test_plan_uses_every_piece_once():
    r = np.random.default_rng(0)
    for size in (8, 40):
        histogram = np.concatenate(([0], r.integers(0, 50, size)))
        plan = P.plan_packing(histogram, size)
        used = np.zeros(size + 1, int)
        for content, n in plan.patterns:
            assert sum(content) <= size and n > 0
            for x in content:
                used[x] += n
        assert (used == histogram).all()
    assert set(map(sum, P.patterns(12).tolist())) == {12}


def test_fit_is_near_a_feasible_histogram():
    pats = P.patterns(30)
    wanted = np.bincount(pats.ravel(), np.repeat(np.random.default_rng(1).integers(0, 20, len(pats)), 3), 31).astype(float)
    x = P.non_negative_fit(pats, wanted)
    got = np.bincount(pats.ravel(), np.repeat(x, 3), 31)
    assert (x >= 0).all() and np.abs(got - wanted)[1:].max() < 0.02 * wanted[1:].max()
