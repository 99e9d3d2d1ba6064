"""Words that differ only by the marks that close them go through the tokenizer once."""

import public_tokenizers
from tokenizers import Tokenizer

from orderloom.llm.tokens import WordTokenizer

WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_closed_words_are_made_of_known_parts():
    whole, ours = Tokenizer.from_file(WORDS), WordTokenizer(WORDS, 1)
    asked, encode_each = [], ours._encode_each

    def noted(words):
        asked.extend(w for run in words for w in run.split())
        return encode_each(words)

    ours._encode_each = noted
    first = ["stone, stone. Stone!!! stone### stone", "época; época### (stone) don't stone's. it.'s stone<| 9, ,"]
    second = ["river. stone? Stone### época, river", "", "<|endoftext|>. Stone, river### ###"]
    for texts in (first, second):
        flat, ends = ours.encode(texts)
        for text, a, b in zip(texts, [0, *ends[:-1]], ends, strict=True):
            assert flat[a:b].tolist() == whole.encode(text, add_special_tokens=False).ids + [1]
    for word in ("stone", "época", "river", "###"):
        assert asked.count(word) == 1
    assert not {"stone,", "stone.", "stone!!!", "stone###", "época;", "river.", "stone?"} & set(asked)
