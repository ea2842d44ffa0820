import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from gaugework.llm import bpe, token_files
from gaugework.session import new_table_path

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "", " ", "  a  b\n\n c\x1c d\x1c\x1c e f   g", "\n \n", "x" * 5000, "don't  I'LL we're ½ ² १२ 字字", " lead", "trail ",
    "tab\t x", "<|endoftext|> hi", "é" * 700 + "!!!", "a b c", "\U0001f600 ok 　 z", "word, word. word.\nNext",
]


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_ranks(RANKS), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(encoder):
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder.vocabulary.ranks, special_tokens={})
    return lambda t: np.array(coder.encode_ordinary(t), dtype="<u4").tobytes()


def test_encoder_equals_reference(encoder, reference, prose):
    texts = [*TEXTS, *(prose(200, i) for i in range(20))]
    assert encoder.encode(pa.array(texts)) == [reference(t) for t in texts]
    assert encoder.encode(pa.array([], pa.string())) == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab \n\t é'.,9٣s\x1c"), max_size=25), min_size=1, max_size=5))
def test_encoder_on_odd_texts(encoder, reference, texts):
    assert encoder.encode(pa.array(texts)) == [reference(t) for t in texts]


def test_merges_one_by_one(encoder):
    """The trees do what repeated search for the leftmost pair of lowest rank does."""
    rng, ranks = random.Random(3), encoder.vocabulary.ranks
    for _ in range(200):
        piece = bytes(rng.choice(b"etaoin shr\xc3\xa9") for _ in range(rng.randint(2, 40)))
        parts = [bytes([b]) for b in piece]
        while True:
            found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not found:
                break
            _, i = min(found)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        want = b"".join(ranks[p].to_bytes(4, "little") for p in parts)
        assert encoder.encode_pieces([piece]) == [want]


def test_long_pieces_alone(encoder, reference):
    """Pieces without a space, up to 200,000 bytes: the lone tree does what the trees in arrays do."""
    rng = random.Random(11)
    texts = ["".join(rng.choice(letters) for _ in range(n)) for n, letters in (
        (2_100, "etaoin"), (5_000, "abcdefghijklmnopqrstuvwxyz"), (9_000, "é字a"), (60_000, "thein"), (200_000, "abcdefghijklmnopqrstuvwxyz"))]
    assert encoder.encode_strings(texts) == [reference(t) for t in texts]
    many = [f"{i}".translate(str.maketrans("0123456789", "abcdefghij")) * 500 for i in range(1000, 1040)]
    assert encoder.encode_strings(many) == [reference(t) for t in many]


def test_encode_and_decode(docs, reference):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "n"), (50, None), (3, "again")]
    encoded = bpe.encode(docs(rows), RANKS, public_tokenizers.PATTERN)
    found = bpe.decode(encoded, RANKS).collect()
    got = sorted((str(r["id"]), bytes(r["ids"]), bytes(r["decoded"])) for r in found)
    assert got == sorted((str(i), reference(t or ""), (t or "").encode()) for i, t in rows)
    assert bpe.decode(bpe.encode(docs([]), RANKS, public_tokenizers.PATTERN), RANKS).count() == 0


def test_round_trip(docs, reference):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "n"), (50, None), (3, "again")]
    found = bpe.round_trip(docs(rows), RANKS, public_tokenizers.PATTERN).collect()
    got = sorted((str(r["id"]), bytes(r["ids"]), bytes(r["decoded"])) for r in found)
    assert got == sorted((str(i), reference(t or ""), (t or "").encode()) for i, t in rows)
    assert bpe.round_trip(docs([]), RANKS, public_tokenizers.PATTERN).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1500))
def test_addressable_codes(ids):
    levels = token_files.to_levels(np.array(ids, dtype=np.uint32))
    assert token_files.from_levels(levels).tolist() == ids
    for place in range(0, len(ids), 37):
        assert token_files.access(levels, place) == ids[place]


def test_files(spark, docs, prose, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_TOKENS", 500)
    rows = [(i * 7 % 101, prose(40 + i, i)) for i in range(101)] + [(200, None), (201, ""), (202, "w " * 9000), (None, "first"), (5, "twin"), (203, "<|endoftext|> hi"), (204, "a <|endoftext|>b\n<|endoftext|>")]
    folder = new_table_path(spark, "test-token-files")
    token_files.write(docs(rows), folder, JSON, end_id=2)
    tokenizer = Tokenizer.from_file(JSON)
    ids = {r: [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2] for r in rows}
    found = sorted(token_files.read_documents(spark, folder).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in found] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))
    left, place, all_ids = dict(ids), 0, []
    for r in found:
        assert r["start"] == place
        own = next(k for k, v in left.items() if k[0] == r["doc_id"] and len(v) == r["n_tokens"]
                   and zlib.crc32(np.array(v, dtype="<u4").tobytes()) == r["ids_crc32"])
        all_ids += left.pop(own)
        place += r["n_tokens"]
    assert not left
    places = [0, 1, 499, 500, len(all_ids) // 2, len(all_ids) - 1]
    assert token_files.tokens_at(spark, folder, places) == {p: all_ids[p] for p in places}
    empty = new_table_path(spark, "test-token-files")
    token_files.write(docs([]), empty, JSON, end_id=2)
    assert token_files.read_documents(spark, empty).count() == 0


def test_random_strings_equal_the_library():
    """Spaces, controls, letters, literals of added tokens and parts of them."""
    import random

    rng, parts = random.Random(7), ["a", "Bc", "é", " ", "  ", "\n", "\t", "\r", "\x00", "\x1c", "\u00a0", "\u3000", "1", "'s", "<|endoftext|>", "<|endo", "|>", "."]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(20_000)]
    tokenizer = Tokenizer.from_file(JSON)
    want = [x.ids for x in tokenizer.encode_batch(texts, add_special_tokens=False)]
    with open(JSON) as f:
        found = token_files.memo(f.read()).encode(pa.array(texts))
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in found] == want
    assert tokenizer.encode("<|endoftext|> hi", add_special_tokens=False).ids[0] == 50256


def test_digest_is_stable(encoder):
    assert hashlib.sha256(encoder.encode(pa.array(["Hello world"]))[0]).hexdigest() == \
        hashlib.sha256(np.array([15496, 995], dtype="<u4").tobytes()).hexdigest()
