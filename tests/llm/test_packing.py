"""Packing: fresh words share a call of the tokenizer and keep their ids."""

import random
import struct

from ledgerline.llm import op5_packing as op5

PIECES = ["a", "B", "é", "É", "İ", "I", "̇", "h", "H", "̱", "Σ", "ς", "'", "'S", "'ll", "'D", ".", ",", "*", "&", "!",
          "<|endoftext|>", "<|", "|>", "1", "²", "一", "…", "—", "̸", "<", " ", "\t", "\x1c", "\x85", " ", "😀", "K", "ß"]


class Counted:
    def __init__(self, tok):
        self.tok, self.texts = tok, 0

    def encode_batch_fast(self, texts, **kw):
        self.texts += len(texts)
        return self.tok.encode_batch_fast(texts, **kw)


def test_fresh_words_are_encoded_together():
    path = op5.default_tokenizer()
    encoder = op5.WordEncoder(path)
    encoder.tok = tok = Counted(encoder.tok)
    rng = random.Random(7)
    texts = [None, ""] + ["".join(rng.choices(PIECES, k=rng.randint(1, 12))) for _ in range(5000)]
    texts += [f"{a}\0{b} {b} \0" for a in PIECES[:12] for b in PIECES[:3]]  # the separator itself in a text
    words = list({w for t in texts if t for w in t.encode().split()})
    got = encoder.encode(words)
    assert tok.texts < len(words) / 2
    for parted in (True, False):
        encoder.parted, encoder.words = parted, {}
        again = encoder.encode(words)
        assert again == got
    for w in words:
        ids = tok.tok.encode(w.decode(), add_special_tokens=False).ids
        assert got[w] == struct.pack(f"<{len(ids)}I", *ids)
    whole = [tok.tok.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert op5.encode_texts(texts, path) == [struct.pack(f"<{len(i)}I", *i) for i in whole]


def test_lower_case_letters_pass_no_normalizer():
    path = op5.default_tokenizer()
    encoder = op5.WordEncoder(path)
    encoder.tok = tok = Counted(encoder.tok)
    rng = random.Random(11)
    words = list({"".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(1, 40))).encode() for _ in range(3000)})
    words += [w.capitalize() + b"," for w in words[:500]] + ["Ā".encode()]
    got = encoder.encode(words)
    assert tok.texts <= 2  # the comma and the one word of no ASCII letters
    for w in words:
        ids = tok.tok.encode(w.decode(), add_special_tokens=False).ids
        assert got[w] == struct.pack(f"<{len(ids)}I", *ids)
