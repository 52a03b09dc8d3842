"""Exact ids against the public encoder, round trips, and edge tables."""

import base64
import time

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from leadmill.llm import bpe

CONTENT = bpe.read_vocabulary(bpe.VOCABULARY)
ENCODER = bpe.encoder_for(CONTENT)
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, CONTENT.splitlines())}
PUBLIC = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=RANKS, special_tokens={})
PARTS = ["a", "aaaa", "in", "the", "ing", " ", "  ", "\n", "é", "你好", "🙂", "'s", "\x00", "zz", "100", "<|endoftext|>", "ÃÂ", "﷽", "नमस्ते"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=40))
def test_same_ids_on_odd_parts(parts):
    text = "".join(parts)
    assert ENCODER.encode(text) == PUBLIC.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=120))
def test_same_ids_and_round_trip(text):
    ids = ENCODER.encode(text)
    assert ids == PUBLIC.encode_ordinary(text) and ENCODER.decode(ids) == text


@pytest.mark.parametrize("text", ["a" * 300_000, "abcdefgh" * 30_000, "é" * 50_000, " " * 50_000])
def test_long_runs_take_linear_time(text):
    began = time.time()
    ids = ENCODER.encode(text)
    assert time.time() - began < 5 and ENCODER.decode(ids) == text


def test_same_ids_on_a_long_run():
    assert ENCODER.encode("abab" * 5000) == PUBLIC.encode_ordinary("abab" * 5000)


def test_every_token_round_trips():
    assert ENCODER.decode_bytes(list(range(ENCODER.size))) == b"".join(sorted(RANKS, key=RANKS.get))


def test_table(spark):
    rows = [(1, "hello world", "x"), (2, None, "x"), (3, "", None), (4, "  ", "x"), (1, "hello world", "y"), (None, "a", "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    got = sorted(((r.doc_id, r.ids) for r in bpe.encode_table(df).collect()), key=str)
    want = sorted(((i, PUBLIC.encode_ordinary(t or "")) for i, t, _ in rows), key=str)
    assert got == want
    back = sorted(((r.doc_id, r.text) for r in bpe.decode_table(bpe.encode_table(df)).collect()), key=str)
    assert back == sorted(((i, t or "") for i, t, _ in rows), key=str)
    counts = bpe.count_tokens(df, ["doc_id"]).where("doc_id = 1").collect()
    assert [r.n_tokens for r in counts] == [2, 2]
    assert bpe.encode_table(df.limit(0)).count() == 0
