from hashlib import sha256

import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from adlumen.llm import bpe
from adlumen.llm.queries import QUERIES, TOKENIZER
from tests.llm import brute


@pytest.fixture(scope="module")
def merges():
    return bpe.Merges(TOKENIZER)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


ODD = st.lists(st.sampled_from(
    ["a", "aa", "the", " ", "  ", "\n", "\t", "　", "\x1c", "\x85", "é", "中", "'s", "'LL", "0", "١", "½", "😀", "́", "<|endoftext|>", "!", "_"]),
    max_size=40).map("".join)


@settings(max_examples=300, deadline=None)
@given(ODD)
def test_same_ids_as_the_library(merges, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert merges.encode(text) == ids
    one = bpe.Decoder(merges)
    assert "".join(one.push([i], n == len(ids) - 1) for n, i in enumerate(ids)) == text


@pytest.mark.parametrize("piece", ["a" * 9000, "ab" * 7000, "=-" * 6000, "0123456789" * 900, "é" * 5000, " " * 9000, "theiningtionab" * 700])
def test_long_pieces_from_a_small_buffer(merges, library, piece):
    assert merges.encode(piece) == library.encode(piece, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abcdeinth ", min_size=1, max_size=900), st.integers(1, 40))
def test_final_tokens_do_not_depend_on_what_follows(merges, text, step):
    raw = text.replace(" ", "").encode() or b"a"
    ids, held = [], b""
    for at in range(0, len(raw), step):
        done, held = merges.push(held, raw[at:at + step], at + step >= len(raw))
        ids += done
        assert len(held) <= merges.reach + max(map(len, merges.bytes.values()))
    assert ids == merges.merge_long(raw) == merges.merge(raw)


def test_lookahead_follows_falling_ranks():
    # bc before ab: whether ab is merged hangs on one byte beyond; cd before bc: on two
    size = [1, 1, 1, 1, 2, 2, 2]
    assert bpe.lookahead([(0, 1, 4)], size) == 1
    assert bpe.lookahead([(1, 2, 4), (0, 1, 5)], size) == 2
    assert bpe.lookahead([(2, 3, 4), (1, 2, 5), (0, 1, 6)], size) == 3


def test_bytes_that_are_no_text(merges, library):
    ids = [merges.letters[b] for b in "é中".encode()[1:]] + [merges.letters[0xFF]]
    one = bpe.Decoder(merges)
    assert "".join(one.push([i], n == len(ids) - 1) for n, i in enumerate(ids)) == library.decode(ids, skip_special_tokens=False)


def test_query_agrees_with_the_library(spark, small, library):
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op6_bpe_round_trip"](spark, small).collect()}
    for r in brute.rows(small, "documents"):
        ids = library.encode(r["text"], add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert got[r["doc_id"]] == (len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256(text.encode()).hexdigest())


def test_nulls_ties_long_and_empty(spark):
    long = "word " * 100_000
    given_ = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, long, 1), (3, long, 1), (None, "a", 1)], "doc_id long, text string, ids int")
    got = bpe.digests(bpe.decode(bpe.encode(given_, TOKENIZER), TOKENIZER)).collect()
    none = sha256(b"").hexdigest()
    assert [tuple(r)[1:] for r in got[:2]] == [(0, none, none)] * 2
    assert got[2][1:] == got[3][1:] and got[2].n_tokens == 100_001 and got[2].decoded_sha256 == sha256(long.encode()).hexdigest()
    assert bpe.digests(bpe.decode(bpe.encode(given_.limit(0), TOKENIZER), TOKENIZER)).count() == 0
