import random
import sys

import public_tokenizers

from clicklake.llm import piece_codec

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _plain(enc, text):
    chunks = piece_codec._CHUNK.findall(" " + text) if text else []
    return b"".join(enc.drawn(c, int(b)) for c, b in zip(chunks, enc.bases(text, len(chunks)), strict=True))


def test_pieces_of_odd_texts_equal_the_agenda_form(monkeypatch):
    rng = random.Random(5)
    signs = "abcdefghij thenation \n\t▁éß日本😀\0\x1c<>0x"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(150))) for _ in range(100)]
    texts += ["", " ", "  ", "\n\n", "▁", "a" * 40 + " " * 30 + "b", "sixteen-letters- seventeen-letters"]
    for dropout in (0.0, 0.1, 0.5, 1.0):
        for nodes, step in ((200_000, 16_384), (3, 50)):
            monkeypatch.setattr(piece_codec, "MAX_NODES", nodes)
            monkeypatch.setattr(piece_codec, "STEP", step)
            enc = piece_codec.Encoder(piece_codec.model(PIECES), 9, dropout)
            assert enc.texts(texts) == [_plain(enc, t) for t in texts]


def test_pieces_take_no_python_calls_a_chunk():
    """Words that occur once, and merges skipped in them, are encoded many at a time."""
    rng = random.Random(6)
    text = " ".join("".join(rng.choice("aeioutnsrl") for _ in range(rng.randint(4, 12))) for _ in range(4000))
    enc, calls = piece_codec.Encoder(piece_codec.model(PIECES), 3, 0.1), 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event == "call"

    sys.setprofile(count)
    try:
        got = enc.texts([text])
    finally:
        sys.setprofile(None)
    assert calls < 4000
    assert got == [_plain(enc, text)]
