"""What is remembered of words."""

import numpy as np

from wardflow.llm import toxicity


def test_words_that_are_no_hits_share_a_place():
    f = toxicity.Features({"bad$": 3.0, "awful": 2.5})
    texts = [" ".join(f"w{'abcdefgh'[k % 8]}{'xyz'[k % 3]}{'klmn'[k // 24 % 4]}" for k in range(96)) + " bad awfully you", None, "BAD! b4d b..a,d Ok, ok!!!"]
    x = f.matrix(texts)
    assert len(f.row) > 96 and len(f.known) < 12
    assert np.allclose(x[0, [0, 12, 14]], [2 / 99, 1, np.log1p(2)]) and not x[1].any()
    assert np.allclose(x[2, [0, 2, 8, 9]], [3 / 5, 2 / 5, 4 / 5, 1 / 5])
