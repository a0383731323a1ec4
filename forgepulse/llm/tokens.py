"""Token ids of whole texts, by the tokenizers library, with words remembered.

The vocabulary file drops white space and never joins across it, so a text's ids are
those of its chunks between spaces and line ends, in order. Chunks repeat; each worker
encodes a chunk once and remembers it, up to a bound. A chunk of ASCII and Latin-1
letters is its own normal form and its pieces are found by a short expression; any other
goes through the whole tokenizer.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import cache
from struct import pack

from forgepulse.llm.common import uncollected

MOST_CHUNKS = 500_000
# Characters of the texts that are split and encoded together; a longer text is alone.
CHARS_AT_ONCE = 1_000_000
SPECIAL = "<|"

# Letters of Latin-1 that are neither signs nor numbers.
PLAIN = re.compile(r"[\x00-\x7fÀ-ÖØ-öø-ÿ]*")
# How this tokenizer splits such text in lower case.
PIECES = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\t\n\x0b\x0c\r a-z0-9ß-öø-ÿ]+"
)


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class TokenIds:
    """Little-endian unsigned 32-bit ids of texts, as bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        # For pieces that are already split and in lower case.
        self.pieces = Tokenizer.from_file(path)
        self.pieces.normalizer = normalizers.Sequence([])
        self.pieces.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.chunks: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}

    def __call__(self, text: str | None) -> bytes:
        return self.together([text])[0]

    def each(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text; new chunks of neighbours are encoded together."""
        group: list[str | None] = []
        chars = 0
        for text in texts:
            group.append(text)
            chars += len(text or "")
            if chars > CHARS_AT_ONCE:
                yield from self.together(group)
                group, chars = [], 0
        yield from self.together(group)

    def together(self, texts: list[str | None]) -> list[bytes]:
        split = [text.replace("\n", " ").split(" ") if text else [] for text in texts]
        if len(self.chunks) > MOST_CHUNKS:
            self.chunks.clear()
        missing = set().union(*split).difference(self.chunks)
        if missing:
            with uncollected():
                self.learn(list(missing))
        return [b"".join(map(self.chunks.__getitem__, chunks)) for chunks in split]

    def learn(self, chunks: list[str]) -> None:
        plain, others, split = [], [], []
        for c in chunks:
            if c.isascii() and c.isalpha():
                plain.append(c)
                split.append([c.lower()])
            elif PLAIN.fullmatch(c) and SPECIAL not in c:
                plain.append(c)
                split.append(PIECES.findall(c.lower()))
            else:
                others.append(c)
        if len(self.known) > MOST_CHUNKS:
            self.known.clear()
        fresh = list({p for pieces in split for p in pieces}.difference(self.known))
        self.known |= zip(fresh, self.encoded(self.pieces, fresh), strict=True)
        self.chunks |= {
            c: b"".join(map(self.known.__getitem__, pieces)) for c, pieces in zip(plain, split, strict=True)
        }
        self.chunks |= zip(others, self.encoded(self.whole, others), strict=True)

    @staticmethod
    def encoded(tokenizer, texts: list[str]) -> list[bytes]:
        batch = tokenizer.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        return [pack(f"<{len(ids)}I", *ids) for ids in (e.ids for e in batch)]


@cache
def token_ids(path: str) -> TokenIds:
    """One per worker, whose memory so serves all its tasks."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return TokenIds(path)
