"""The word pattern of op5_bpe with its character classes spelled out."""

import numpy as np
import regex

from tallygate.llm import bpe


def test_spelled_out_classes_are_the_tokenizers_pattern():
    rng = np.random.default_rng(8)
    pattern = regex.compile(bpe.PATTERN)
    often = "'strevmlld 'S9.\n"
    for chars, words in ((bpe._PLAIN, bpe._WORDS),
                         ("".join(c for c in bpe._PLAIN if c.isascii()), bpe._ASCII_WORDS)):
        texts = [f"a{c}b {c}'{c}s1{c}" for c in chars]
        texts += ["".join(rng.choice(list(often * 9 + chars), 200)) for _ in range(300)]
        for text in texts:
            assert not bpe._ODD.search(text)
            assert words.findall(text.lower()) == pattern.findall(text.lower())
