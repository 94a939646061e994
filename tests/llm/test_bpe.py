import hashlib

import public_tokenizers as P
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")
ENCODER = bpe.Encoder(PATH, P.PATTERN)
EXACT = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})
TEXTS = ["", "Hello  world, it's   1234!\n\n x", "aaaaaaaaaaaaaaaaaaaaaaaa", "é ü 漢字 \U0001f600" * 50, "<|endoftext|>",
         "ab" * 30_000, " " * 5000, "=" * 777, "\x00\x01 \x7f", "Die Öffnung der Straße!"]


@given(st.lists(st.text(max_size=60), max_size=6))
@settings(max_examples=150, deadline=None)
def test_replay_equals_the_exact_encoder(texts):
    assert [x.tolist() for x in ENCODER.encode(texts)] == [EXACT.encode_ordinary(t) for t in texts]


@given(st.lists(st.text("\t\n\x0b\x0c\r\x1c\x1d\x1f \x85\xa0\u2003\u3000a1's-", max_size=12), max_size=6))
@settings(max_examples=200, deadline=None)
def test_white_space_of_every_kind(texts):
    assert [x.tolist() for x in ENCODER.encode(texts)] == [EXACT.encode_ordinary(t) for t in texts]


def test_merges_that_step_back_in_rank():
    # "abc" has a lower rank than "bc", so a merge makes a pair of lower rank
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 300, b"bc": 500, b"cab": 400, b"ab": 600, b"bcb": 450}
    vocab = bpe.Vocabulary(ranks)
    words = [b"abc", b"abcabc", b"bcbcbc", b"xabcbcab", b"", b"ab"]
    ids, offset = bpe.replay(words, vocab)
    got = [ids[a:b].tolist() for a, b in zip(offset[:-1], offset[1:], strict=True)]
    assert got == [[ranks[w]] if w in ranks else bpe.merge_word(w, vocab) for w in words]


@given(st.lists(st.text("ab e", max_size=200), max_size=4))
@settings(max_examples=100, deadline=None)
def test_repeats_merge_from_the_left(texts):
    assert [x.tolist() for x in ENCODER.encode(texts)] == [EXACT.encode_ordinary(t) for t in texts]


def test_round_trip_of_odd_texts(docs_of):
    rows = [(i, t) for i, t in enumerate([*TEXTS, TEXTS[1], None])] + [(None, "x")]
    got = sorted(map(tuple, bpe.round_trip(docs_of(rows), PATH, P.PATTERN).collect()), key=str)
    want = []
    for i, t in rows:
        ids = EXACT.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_encode_then_decode(docs_of):
    docs = docs_of(list(enumerate(TEXTS)))
    back = bpe.decode(bpe.encode(docs, PATH, P.PATTERN), PATH, P.PATTERN)
    assert {r[0]: bytes(r[1]).decode() for r in back.collect()} == dict(enumerate(TEXTS))


def test_empty_table(docs_of, spark):
    empty = docs_of([(1, "x")]).where("false")
    assert bpe.round_trip(empty, PATH, P.PATTERN).count() == 0


def test_whole_table(spark):
    from tidemark.llm.common import table

    docs = table(spark, "/root/testdata/sf0.001", "documents")
    want = {r.doc_id: len(EXACT.encode_ordinary(r.text or "")) for r in docs.collect()}
    assert {r.doc_id: r.n_tokens for r in bpe.query(spark, "/root/testdata/sf0.001").collect()} == want
