"""Chunks of texts, encoded together."""

from __future__ import annotations

import numpy as np
from tokenizers import Tokenizer

from forgepulse.llm.tokens import TokenIds, vocabulary


def test_chunks_of_neighbouring_texts_are_encoded_together(monkeypatch):
    texts = ["Once upon a time", None, "", "it's 3 o'clock\nonce", "naïve 日本 <|x", "  two  spaces ", "upon a time"]
    ours, whole, learned = TokenIds(vocabulary()), Tokenizer.from_file(vocabulary()), []
    learn = ours.learn
    monkeypatch.setattr(ours, "learn", lambda chunks: (learned.append(set(chunks)), learn(chunks)))
    found = [np.frombuffer(ids, "<u4").tolist() for ids in ours.each(texts)]
    assert found == [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert len(learned) == 1
    monkeypatch.setattr("forgepulse.llm.tokens.CHARS_AT_ONCE", 5)
    assert [np.frombuffer(ids, "<u4").tolist() for ids in ours.each(texts)] == found
