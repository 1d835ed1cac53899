"""Byte-level BPE against the tiktoken library and a quadratic merge loop."""

import base64
import hashlib
import random
import struct

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from aurum.llm import byte_bpe

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
DOCS = "doc_id long, text string, ids string, n_tokens string, decoded int"
TEXTS = [None, "", " ", "\n\n  a", "Hello, world!  It's 2024.", "<|endoftext|> is plain text", "naïve café — Ünïcode", "日本語のテキスト",
         "🙂👩‍👩‍👧‍👦 é", "a\x1c\x1db\x85c d e", "x" * 5000, "ab" * 3000 + "!?" * 500, "\t 　 \t", "١٢٣ 4½ Ⅷ",
         "\x00\x01\x7f", " ".join(f"w{i}" for i in range(3000))]


@pytest.fixture(scope="module")
def tokens():
    return byte_bpe.read_ranks(RANKS)


@pytest.fixture(scope="module")
def library(tokens):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})


def quadratic(piece, ranks):
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        least, at = min((ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if least == 1 << 60:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def test_hash_is_minimal_and_perfect(tokens):
    built = byte_bpe.PerfectHash.build(tokens)
    assert sorted(built.index.tolist()) == list(range(len(tokens)))
    assert built.places(tokens).tolist() == list(range(len(tokens)))
    strange = [b"no such token %d" % i for i in range(1000)]
    assert all(tokens[p] != s for p, s in zip(built.places(strange).tolist(), strange))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 9, 100])
def test_hash_of_few_keys(n):
    keys = [b"key %d" % i for i in range(n)]
    built = byte_bpe.PerfectHash.build(keys)
    if n:
        assert built.places(keys).tolist() == list(range(n))
    with pytest.raises(ValueError, match="differ"):
        byte_bpe.PerfectHash.build([b"a", b"a"])


def test_heap_joins_as_a_quadratic_loop_does(tokens):
    codec = byte_bpe.Codec(tokens, PATTERN, byte_bpe.PerfectHash.build(tokens))
    ranks = {t: i for i, t in enumerate(tokens)}
    rng = random.Random(1)
    for _ in range(400):
        piece = bytes(rng.choice(b"aabbcde the\xc3\xa9") for _ in range(rng.randrange(1, 40)))
        assert codec.merged(piece) == quadratic(piece, ranks)


def test_ids_are_those_of_the_library(spark, library):
    rng = random.Random(2)
    letters = "abc deé ñ.,!?\n\t 'srm12½日語　​🙂"
    texts = TEXTS + ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(300)] + TEXTS[4:6]
    docs = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in enumerate(texts)] + [(None, "no id", "", "", 0)], DOCS)
    encoded = byte_bpe.encode(docs.repartition(3), RANKS, PATTERN)
    back = {r.doc_id: r for r in byte_bpe.decode(encoded, RANKS, PATTERN).collect()}
    assert len(back) == len(texts) + 1
    for i, t in [*enumerate(texts), (None, "no id")]:
        want = library.encode_ordinary(t or "")
        assert np.frombuffer(back[i].ids, "<u4").tolist() == want and back[i].n_tokens == len(want)
        assert bytes(back[i].decoded) == (t or "").encode()


def test_digests(spark, library):
    docs = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in enumerate(TEXTS)], DOCS)
    for r in byte_bpe.verdicts(docs, RANKS, PATTERN).collect():
        want = library.encode_ordinary(TEXTS[r.doc_id] or "")
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(want)}I", *want)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((TEXTS[r.doc_id] or "").encode()).hexdigest()
    assert byte_bpe.verdicts(docs.limit(0), RANKS, PATTERN).count() == 0


def test_groups_and_memory_do_not_change_ids(spark, library, monkeypatch, tokens):
    monkeypatch.setattr(byte_bpe, "GROUP", 40)
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 6)
    codec = byte_bpe.Codec(tokens, PATTERN, byte_bpe.PerfectHash.build(tokens))
    texts = [t or "" for t in TEXTS]
    for _ in range(2):
        assert [np.frombuffer(i, "<u4").tolist() for i in codec.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_white_space_letters_and_digits_are_those_of_the_library(library):
    import regex
    split = regex.compile(PATTERN)
    for start in range(0, 0x30000, 64):
        text = "".join(f"a{chr(c)}1 {chr(c)} " for c in range(start, start + 64) if not 0xD800 <= c < 0xE000)
        want = [library.decode_bytes(library.encode_ordinary(p)) for p in split.findall(text)]
        assert [i for p in split.findall(text) for i in library.encode_ordinary(p)] == library.encode_ordinary(text)
        assert b"".join(want) == text.encode()


def test_broken_rank_files_are_an_error(tmp_path):
    path = tmp_path / "ranks"
    path.write_bytes(base64.b64encode(b"a") + b" 0\n")
    with pytest.raises(ValueError, match="256"):
        byte_bpe.read_ranks(str(path))
    path.write_bytes(base64.b64encode(b"a") + b" 7\n")
    with pytest.raises(ValueError, match="gap"):
        byte_bpe.read_ranks(str(path))
