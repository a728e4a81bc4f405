"""The memo of chunks against the library, and how often it asks for a chunk."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers

from cantogram.llm import bpe
from cantogram.llm.token_files import LibraryEncoder


@pytest.fixture(scope="module")
def content():
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as file:
        return file.read()


def test_odd_texts_and_small_memos_give_the_library_ids(content, monkeypatch):
    rng = random.Random(1)
    pieces = [*"ab1 .,\n\t_'s\0é́Ⅷ¾一中ǅ \xa0!?-", "<|endoftext|>", " ", ". ", ", ", "a.", "B,", "\r\n", "'s", "..", ".\n"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(30))) for _ in range(4000)]
    library = LibraryEncoder(content)
    expected = [np.array(e.ids, dtype="<u4").tobytes() for e in library.library.encode_batch_fast(texts, add_special_tokens=False)]
    monkeypatch.setattr(bpe, "MEMO", 300)
    for encoder in (library, bpe.RankBpe(content)):
        assert [x for k in range(0, 4000, 200) for x in encoder.encode(texts[k : k + 200])] == expected


def test_words_in_use_are_asked_for_once(monkeypatch):
    """Words that come in every batch outlast the full memo, and a full stop after a word makes no chunk of its own."""
    asked = []
    monkeypatch.setattr(bpe, "MEMO", 200)
    chunks = bpe.Chunks(lambda strings: asked.extend(strings) or [s.encode() for s in strings], {})
    common = [f" c{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(50)]
    for k in range(20):
        text = "x" + "".join(common) + "".join(f"{w}." for w in common) + f" new{k}" * 2 + "".join(f" n{k}q{i}" for i in range(40))
        assert chunks.ids([text]) == [text.encode()]
    assert all(asked.count(w) == 1 for w in common) and not any(w.endswith(".") and len(w) > 1 for w in asked)


def test_white_space_beside_anything_gives_the_library_ids(content, monkeypatch):
    """Texts lie side by side in one array: what ends one and begins the next must not meet."""
    rng = random.Random(2)
    white = [chr(c) for c in (*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, 0x180E, 0x2000, 0x200A, 0x200B, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF)]
    pieces = [*white, *" \n\n  ", *"a7.,_'", "é", "中", "“", "Ж", "😀", "<|endoftext|>", "<|endof", "text|>", "b.", "Ⅷ,", "'re."]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(12))) for _ in range(8000)]
    library = LibraryEncoder(content)
    expected = [np.array(e.ids, dtype="<u4").tobytes() for e in library.library.encode_batch_fast(texts, add_special_tokens=False)]
    monkeypatch.setattr(bpe, "MEMO", 1000)
    for encoder in (library, bpe.RankBpe(content)):
        for form in (pa.string(), pa.large_string()):
            flat, at = encoder.chunks.flat(pa.array(["x y", *texts, "z"], form).slice(1, len(texts)))
            assert [flat[a:b] for a, b in zip(at, at[1:])] == expected


def test_a_word_that_is_known_makes_no_object():
    """Many known words cost Python a few bytes for each of their own bytes, not a string and two places in lists."""
    chunks = bpe.Chunks(lambda strings: [b"1234"] * len(strings), {})
    chunks.ids(["w w"])
    text = " ".join("w" * 500_000)
    tracemalloc.start()
    found = chunks.ids([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [b"1234" * 500_000] and peak < 40 * 500_000, peak / 500_000


def test_memos_of_long_chunks_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_BYTES", 20_000, raising=False)
    chunks = bpe.Chunks(lambda strings: [s.encode() for s in strings], {})
    for k in range(50):
        assert chunks.ids([text := f"{k}" * 1000 + " a"]) == [text.encode()]
    assert chunks.known.nbytes < 30_000


def test_pieces_hold_all_rows_in_order(monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 10)
    rows = ["", None, "a" * 25, "b" * 4, "c" * 4, None, "d" * 9, "", "e" * 30, ""]
    for texts in (rows, [], [None], ["x" * 11]):
        batch = pa.record_batch([pa.array(texts, pa.string())], names=["text"])
        parts = list(bpe.pieces(batch))
        assert [t for p in parts for t in p.column(0).to_pylist()] == texts
        assert all(p.num_rows == 1 or len("".join(t or "" for t in p.column(0).to_pylist()[:-1])) <= 10 for p in parts)
