"""Byte-level BPE from a tokenizer file (vocabulary and merges as JSON), and safe places to cut long texts.

Ids are those of the ``tokenizers`` library for the same file (a test holds them together on whole tables);
the merging itself is done by ``tiktoken``, which needs no offsets and takes a sixth of the time. That asks
for ids in the order of the merges, which is checked when the file is read.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator

import numpy as np

MODEL = "byte_bpe_50k.json"
#: Characters of a text that are encoded at once.
SEGMENT = 1 << 18
# The pattern that byte-level vocabularies split words by, and Unicode's white space.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_CUT = re.compile(f"(?<=[^{WHITE}]) (?!\\Z)")
#: White space that the fast encoder's pattern runs out of stack on.
_LONG = re.compile(f"[{WHITE}]{{1000}}")


def segments(text: str, size: int = SEGMENT) -> Iterator[str]:
    """The text in stretches of about ``size`` characters, all but the first beginning with a space after a visible character.

    No word of the pattern reaches over such a place, so the stretches' ids, end to end, are the text's.
    """
    at = 0
    while len(text) - at > size and (m := _CUT.search(text, at + size)):
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


def alphabet() -> dict[str, int]:
    """Byte that each character of a byte-level vocabulary stands for: visible Latin-1 ones for themselves, the rest counted on from 256."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = (b for b in range(256) if b not in visible)
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteBpe:
    """Encoder of one tokenizer file; ``pieces`` has the bytes of every id."""

    def __init__(self, file: bytes):
        import tiktoken

        spec = json.loads(file)
        kind, before = spec["model"]["type"], spec["pre_tokenizer"]
        if kind != "BPE" or before["type"] != "ByteLevel" or before["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("a byte-level BPE without normaliser and prefix is needed")
        vocab, specials = spec["model"]["vocab"], {t["content"]: t["id"] for t in spec["added_tokens"]}
        merged = ("".join(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"])
        if any(vocab[t] != 256 + k for k, t in enumerate(merged)):
            raise ValueError("ids must follow the order of the merges")
        byte = alphabet()
        ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in specials}
        self.pieces = [b""] * (1 + max([*vocab.values(), *specials.values()]))
        for t, i in [*ranks.items(), *((s.encode(), i) for s, i in specials.items())]:
            self.pieces[i] = t
        self.lengths = np.array([len(p) for p in self.pieces], np.int64)
        self._file = file
        self._bpe = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=specials)

    @functools.cached_property
    def _library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_buffer(self._file)

    def _segment(self, text: str, specials: bool) -> np.ndarray:
        if _LONG.search(text):
            self._library.encode_special_tokens = not specials
            return np.array(self._library.encode(text, add_special_tokens=False).ids, np.uint32)
        return self._bpe.encode_to_numpy(text, allowed_special=self._bpe.special_tokens_set if specials else set(), disallowed_special=())

    def ids(self, text: str, specials: bool = True) -> np.ndarray:
        """Ids (unsigned 32-bit) of a whole text; ``specials`` says whether strings of special tokens become those tokens."""
        got = [self._segment(s, specials) for s in segments(text)]
        return got[0] if len(got) == 1 else np.concatenate(got)


@functools.lru_cache(maxsize=4)
def byte_bpe(file: bytes) -> ByteBpe:
    return ByteBpe(file)


def read_file(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()
