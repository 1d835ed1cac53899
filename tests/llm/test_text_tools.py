"""Shingles, signature trees and token ids against plain versions."""

import re

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from aurum.llm import shingles, signature_tree as tree
from aurum.llm.tokens import Encoder

TEXT = st.text(alphabet=list(" \t\n\x0b\x0cabAZé中ß .,!1' "), max_size=60)


def plain_shingles(text, width=5):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x20\x09-\x0d]+", lower)
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=6))
def test_shingle_sets_are_those_of_a_plain_split(texts):
    got = shingles.shingle_sets(pa.array(texts, pa.string()))
    want = [plain_shingles(t) for t in texts]
    assert [len(g) for g in got] == [len(w) for w in want]
    for i, a in enumerate(want):
        for j, b in enumerate(want):
            assert len(np.intersect1d(got[i], got[j])) == len(a & b)


def test_blocks_and_slices_do_not_change_the_sets(monkeypatch):
    texts = pa.array([" ".join(f"w{i * k % 97}" for i in range(60)) for k in range(1, 30)] + [None, "", "one two"])
    whole = shingles.shingle_sets(texts)
    monkeypatch.setattr(shingles, "BLOCK", 100)
    assert all((a == b).all() for a, b in zip(whole, shingles.shingle_sets(texts), strict=True))
    assert all((a == b).all() for a, b in zip(whole[5:], shingles.shingle_sets(texts.slice(5)), strict=True))


def test_trees_never_prune_a_linked_pair():
    rng = np.random.default_rng(1)
    for _ in range(60):
        base = rng.integers(0, 2**63, 120, dtype=np.uint64)
        sets = []
        for _ in range(24):
            keep = base[rng.random(len(base)) < rng.uniform(0.5, 1.0)]
            extra = rng.integers(0, 2**63, rng.integers(0, 40), dtype=np.uint64)
            sets.append(np.unique(np.concatenate([keep, extra, base[:1]])))
        top = tree.build([tree.leaf(i, len(s), tree.bitmap(s)) for i, s in enumerate(sets)], fanout=3)
        found = {tuple(sorted((a.id, b.id))) for a, b in tree.candidates(top, top, lambda a, b: False)}
        for i, a in enumerate(sets):
            for j in range(i):
                both = len(np.intersect1d(a, sets[j]))
                if 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                    assert (j, i) in found


ENCODER = Encoder(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=300, deadline=None)
@given(st.one_of(TEXT, st.text(max_size=40), st.lists(st.sampled_from(
    [" the", "the", "  ", "'s", "'ll", "\n", "<|endoftext|>", "naïve", "x.", "1.5"]), max_size=10).map("".join)))
def test_ids_are_those_of_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    assert ENCODER.by_chunk
    assert ENCODER.ids(ENCODER.encode(text)).tolist() == ENCODER.tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_survive_a_full_cache():
    small = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    small.chunks.size = small.pieces.size = 3
    text = "one two, three one four! five two six. " * 5 + "x" * 300
    for _ in range(2):
        assert small.ids(small.encode(text)).tolist() == small.tokenizer.encode(text, add_special_tokens=False).ids


def test_added_tokens_in_a_text_have_the_ids_of_an_unmodified_tokenizer():
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ("hi <|endoftext|> x", "<|endoftext|>", "a<|endoftext|><|endoftext|>b  c", "one two <|endoftext|", "x <|endoftext|>\n"):
        assert ENCODER.ids(ENCODER.encode(text)).tolist() == plain.encode(text, add_special_tokens=False).ids
    assert ENCODER.ids(ENCODER.encode("hi <|endoftext|> x")).tolist() == [5303, 220, 50256, 2124]
