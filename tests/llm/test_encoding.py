"""The column encoder against the tokenizer itself, and what it gives to the tokenizer."""

import random

import pyarrow as pa
import pytest

from cdrlake.llm.encoding import ColumnEncoder
from cdrlake.llm.queries import BYTE_BPE, WORD_BPE

#: among them accents that compose with small letters only, letters that become a letter and an accent, and marks in runs
PARTS = [
    "Word", "word", "WORD", "don't", "DON'T", "rock'n'roll.", "a.b", "x&&&", '".', "'.", "''s", "—.", "½.", "5a.", "a5,", "é,", "É!", "ß?", "ſ.",
    "J̌", "ǰ", "T̈.", "é.", "É", "İ.", "İ", "i̇.", "ΑΣ.", "Σ", "KK", "word̀,", "≠", "a≠",
    "<|ENDOFTEXT|>", "<|EndOfText|>.", "<|endoftext|>", "a<|endoftext|>b", "<|endof text|>", "日本。", "ǰ.", "\t", "\n", "\r\n", " ", "  ", " ", "\x85", "​.", "#1:", "[x]", "{y}", "A_b", "`c`", "~D~", "🙂.", "a🙂",
]


@pytest.mark.parametrize("path", [WORD_BPE, BYTE_BPE])
def test_columns_get_the_ids_of_the_tokenizer(path):
    draw, encoder = random.Random(7), ColumnEncoder(path)
    texts = [*PARTS, *("".join(p + draw.choice(["", " ", " ", "\n"]) for p in draw.choices(PARTS, k=draw.randrange(1, 9))) for _ in range(6000)), "", None]
    flat, counts = encoder.encode(pa.array(texts))
    ids, at = flat.tolist(), 0
    for text, n in zip(texts, counts.tolist()):
        assert ids[at : at + n] == encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, repr(text)
        at += n


def test_a_word_is_given_to_the_tokenizer_once_however_written():
    encoder = ColumnEncoder(WORD_BPE)
    encoder.encode(pa.array(["Word word WORD, word. wOrd! word&&& (word) word;", "élan élan, élan."]))
    assert {k for k in encoder.known if k.lower().startswith(("word", "élan"))} == {"word", "élan"}
