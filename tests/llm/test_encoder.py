"""Token ids by looked-up pieces are the tokenizer's own, and a word is encoded once, whatever stands around it."""

import random

import numpy as np
import public_tokenizers
import pytest

from cartulary.llm import tokens

ODD = ["", "\n", " ", "a", "\na", "a\n", "a  b", "a\tb", "a\0b", "क़क़ a", "क़.", "x̸.", "é,%%% b", "\nReat,'s", "it's, 'tis", "x' x'. x'", "42 42, 42.%",
       "<|endoftext|> </s>", "İstanbul. ǅ, ß!!", "١٢ x²,", "中文。好 字.", "Å, Å!", "`a_ _b_", "a　b"]
PARTS = ["the", " ", "\n", ",", "%%%", "'", "s", "É", "ñ", "1", "²", "中", "́", "क़", ".", "_", "  ", "̸"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_the_tokenizers(name, monkeypatch):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    plain, encoder, rng = Tokenizer.from_file(path), tokens.Encoder(path), random.Random(3)
    plain.encode_special_tokens = True
    texts = ODD + ["".join(rng.choices(PARTS, k=rng.randint(1, 14))) for _ in range(3000)]
    want = [np.array(e.ids, "<u4").tobytes() for e in plain.encode_batch_fast(texts, add_special_tokens=False)]
    for size in (len(texts), 7):
        monkeypatch.setattr(tokens, "REMEMBERED", 5 * size)
        assert [x for at in range(0, len(texts), size) for x in encoder.encode(texts[at:at + size])] == want
    assert encoder.encode([]) == [] and encoder.encode(["a  b"] * 2) == want[6:7] * 2


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_a_known_word_is_not_encoded_again(name, monkeypatch):
    encoder, given = tokens.Encoder(public_tokenizers.path(name)), []
    encoder.encode(["thheednt\nthheednt thheednt , ,%%% $$$"])
    monkeypatch.setattr(encoder, "_ids", lambda texts, plain=False, ids=encoder._ids: (given.extend(texts), ids(texts, plain))[1])
    monkeypatch.setattr(encoder, "_word_ids", lambda words, ids=encoder._word_ids: (given.extend(words), ids(words))[1])
    encoder.encode(["thheednt,%%%\nthheednt$$$ thheednt,%%%\nthheednt,"])
    assert not [g for g in given if "thheednt" in g]


def test_an_earlier_memory_gives_only_its_own_pieces():
    known = {f"word{i}": bytes([i % 251]) * 4 for i in range(1000)}
    earlier = tokens.Earlier(known)
    assert earlier.among([*list(known)[::3], "", "strange"]) == {p: known[p] for p in list(known)[::3]}
    assert tokens.Earlier({}).among(["a"]) == {} and earlier.among([]) == {}
    assert earlier.pieces.nbytes + earlier.ids.nbytes + earlier.hashes.nbytes < 45 * len(known)
