import base64
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pageloom.llm import byte_bpe, dac
from pageloom.session import work_path
from tests.llm.plain import AWKWARD, frame, sha

WORD_TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text_is_encoded_as_by_the_reference_library(reference, text):
    own = byte_bpe.codec(RANKS, public_tokenizers.PATTERN)
    ids = own.encode(text)
    assert ids == reference.encode_ordinary(text)
    assert own.bpe.decode(ids) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(sorted(b"aaabethino nrsg1!")), min_size=1, max_size=120).map(bytes), st.data())
def test_appends_and_edits_leave_the_table_of_the_new_text(text, data):
    bpe = byte_bpe.codec(RANKS, public_tokenizers.PATTERN).bpe
    cut = data.draw(st.integers(0, len(text)))
    grown = bpe.table(text[:cut])
    grown.append(text[cut:])
    assert grown.last == bpe.table(text).last
    start = data.draw(st.integers(0, len(text)))
    end = data.draw(st.integers(start, len(text)))
    more = data.draw(st.sampled_from([b"", b"x", b"the", b"aaaa"]))
    grown.replace(start, end, more)
    assert grown.text == text[:start] + more + text[end:]
    assert grown.last == bpe.table(grown.text).last


def test_an_edit_far_from_the_end_touches_few_entries():
    table = byte_bpe.codec(RANKS, public_tokenizers.PATTERN).bpe.table(b"thantionsh" * 400)
    assert table.replace(50, 53, b"xyz") < 200


def test_every_prefix_is_known(reference):
    text = b"internationalisation"
    table = byte_bpe.codec(RANKS, public_tokenizers.PATTERN).bpe.table(text)
    for n in range(1, len(text) + 1):
        assert table.ids(n) == reference._encode_single_piece(text[:n])


def test_long_texts_are_cut_without_a_change(monkeypatch):
    own = byte_bpe.codec(RANKS, public_tokenizers.PATTERN)
    whole = own.encode(AWKWARD[9][1])
    monkeypatch.setattr(byte_bpe, "LONG_TEXT", 100)
    assert own.encode(AWKWARD[9][1]) == whole


def test_round_trip_of_awkward_rows(spark, reference):
    got = byte_bpe.round_trip(frame(spark), RANKS, public_tokenizers.PATTERN).collect()
    want = []
    for key, text, *_ in AWKWARD:
        ids = reference.encode_ordinary(text or "")
        want.append((key, len(ids), sha(",".join(map(str, ids))), sha(text or "")))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert byte_bpe.round_trip(frame(spark).limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
    lists = byte_bpe.encode_documents(frame(spark), RANKS, public_tokenizers.PATTERN).collect()
    assert sorted(len(r.ids) for r in lists) == sorted(w[1] for w in want)


@pytest.mark.parametrize("n", [0, 1, 5, 511, 512, 513, 3000])
def test_any_token_is_read_directly(n):
    rng = np.random.default_rng(n)
    ids = rng.choice([0, 3, 200, 255, 256, 65_535, 65_536, 1 << 25, (1 << 32) - 1], n).astype("<u4")
    segment = dac.Segment(dac.pack(ids, np.array([n])))
    assert [segment.token(i) for i in range(n)] == ids.tolist()
    for _ in range(30):
        a, b = sorted(rng.integers(0, n + 1, 2))
        assert segment.tokens(a, b).tolist() == ids[a:b].tolist()


@pytest.mark.parametrize("limit", [1 << 20, 40])
def test_token_files_of_awkward_rows(spark, monkeypatch, limit):
    monkeypatch.setattr(dac, "SEGMENT_IDS", limit)
    path = public_tokenizers.path("word_bpe_49k.json")
    folder = work_path(spark, "tokens")
    dac.write_token_files(frame(spark), folder, path, 2)
    got = sorted(dac.read_token_files(spark, folder).collect(), key=lambda r: r.start)
    tokenizer, at = Tokenizer.from_file(path), 0
    rows = sorted(AWKWARD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert len(got) == len(rows)
    for r, (key, text, *_) in zip(got, rows):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        assert tuple(r) == (key, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_token_files_of_no_rows(spark):
    folder = work_path(spark, "tokens")
    dac.write_token_files(frame(spark).limit(0), folder, public_tokenizers.path("word_bpe_49k.json"), 2)
    assert dac.read_token_files(spark, folder).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("aAbBzÉéİıΣσςǅß\u0301\u00adﬁ漢ไ9٣.,!'#<|>_-\u2019"), st.characters(codec="utf-8")), max_size=12), max_size=8))
def test_words_put_together_have_the_ids_of_the_whole_text(words):
    text = " ".join(words)
    path = public_tokenizers.path("word_bpe_49k.json")
    ids = np.frombuffer(dac._words(path).documents([text.encode()])[0], "<u4").tolist()
    assert ids == WORD_TOKENIZER.encode(text, add_special_tokens=False).ids
