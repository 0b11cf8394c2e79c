"""Token ids of a byte-level BPE vocabulary file (``tokenizers`` JSON).

The vocabulary is read from the file; the merging itself is done by ``tiktoken``,
whose ranks are the file's merge order, at several times the speed of the
``tokenizers`` library.  Loading checks that order, and that the file asks for the
byte-level split that ``PATTERN`` states.  The tests hold the ids against that library.

The split's look-ahead (a run of blanks leaves its last one to what follows) is
applied here: runs are cut out, so the pattern left to ``tiktoken`` needs none, which is
faster and cannot recurse once per blank.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from functools import lru_cache

import numpy as np

#: Fixed value: the split pattern of byte-level BPE vocabularies, but for the
#: look-ahead behind its runs of blanks.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"""
#: Fixed value: the white space of the split pattern's ``\s``.
BLANKS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: ``array`` takes texts in parts of about this length.
PART_CHARS = 1 << 20


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in such vocabularies:
    itself where printable, else the next letter from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class ByteBpe:
    def __init__(self, path: str):
        import tiktoken
        if sys.byteorder != "little" or array("I").itemsize != 4:
            raise RuntimeError("ids are kept as little-endian words of four bytes")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = spec["model"]["vocab"]
        ranks = {bytes(letters[c] for c in token): i for token, i in vocab.items() if token not in special}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        ids = [vocab[a + b] for a, b in pairs]
        if ids != sorted(ids):
            raise ValueError("merge order and id order differ")
        split = spec["pre_tokenizer"] or {}
        if (spec["normalizer"] or split.get("type") != "ByteLevel" or not split.get("use_regex")
                or split.get("add_prefix_space")):
            raise ValueError("the file asks for another split than the byte-level pattern")
        self.special = special
        self.largest = max([*vocab.values(), *special.values()])
        self.cut = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.part_end = re.compile(f"(?<![{BLANKS}])[{BLANKS}]")
        self.run = re.compile(f"[{BLANKS}]{{2,}}")
        self.encoding = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self._bytes(text), dtype="<u4").tolist()

    def _bytes(self, text: str) -> bytes:
        """Little-endian ids of a text."""
        if not any(s in text for s in self.special):
            return self._ordinary(text)
        return b"".join(little_endian([self.special[part]]).tobytes() if part in self.special else self._ordinary(part)
                        for part in self.cut.split(text))

    def array(self, text: str, end_id: int | None = None) -> np.ndarray:
        """``encode`` as little-endian unsigned 32-bit ids, and the end id behind them.
        Texts are taken in parts, so that no list holds the ids of a very long one: a
        token never reaches from a letter, digit or sign into a blank behind it."""
        parts, at = [], 0
        while len(text) - at > PART_CHARS:
            found = self.part_end.search(text, at + PART_CHARS)
            if not found:
                break
            parts.append(self._bytes(text[at:found.start()]))
            at = found.start()
        parts.append(self._bytes(text[at:] if at else text))
        if end_id is not None:
            parts.append(little_endian([end_id]).tobytes())
        return np.frombuffer(b"".join(parts), dtype="<u4")

    def _ordinary(self, text: str) -> bytes:
        """Ids of a text without special tokens.  A run of blanks is one word of the
        split, but for its last blank where something follows."""
        parts, at = [], 0
        for run in self.run.finditer(text):
            stop = run.end() - (run.end() < len(text))
            parts += self.encoding.encode_ordinary(text[at:run.start()])
            parts += self.encoding._encode_single_piece(text[run.start():stop])
            at = stop
        rest = self.encoding.encode_ordinary(text[at:] if at else text)
        return array("I", parts + rest if parts else rest).tobytes()


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    """One vocabulary per worker process and file."""
    return ByteBpe(path)


def little_endian(ids: list[int]) -> np.ndarray:
    return np.array(ids, dtype="<u4")
