"""SentencePiece BPE encoding and decoding by a merge-type prefix table.

A BPE encoding is determined by its prefixes: every prefix of a segment has one
last token, and tokens ``a, b`` may stand side by side exactly when merging the
text of ``a + b`` on its own gives ``[a, b]`` again.  So a segment is encoded by

1. an Aho-Corasick automaton over all pieces, which lists the pieces that end at
   each position;
2. a table with one entry per prefix: its unique last token, the one match whose
   left neighbour (the last token of the shorter prefix) is compatible with it;
3. walking the table backwards from the end to recover the ids.

Segments are runs between which no piece reaches (checked against the model when
it is loaded): a white-space run with the letters, or the other characters, that
follow it.  Results per segment are memoised in each task, so the cost per word
of a large corpus is one dictionary lookup.  White-space pieces of several marks
share one score, so pure mark runs are merged leftmost first on their own.

Defined results: NULL counts as the empty text; the empty text has the end id
only; characters outside the vocabulary become their UTF-8 byte pieces; repeated
rows give repeated rows; texts of any length are encoded whole.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from sys import getsizeof

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, sha_hex, text_list

MARK = "▁"   # stands for a blank
#: Entries of a task's pair memo (of fixed size each).
MEMO_LIMIT = 1_200_000
#: Bytes of a task's segment memos; a segment that takes over 1/64 of them is not kept.
MEMO_BYTES = 384 << 20
#: Bytes of the two table entries of a memoised segment.
ENTRY_BYTES = 200


class PrefixTableCodec:
    """Encoder and decoder over one BPE model with byte fallback."""

    def __init__(self, model_path: str, memo_limit: int = MEMO_LIMIT, memo_bytes: int = MEMO_BYTES):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.eos = sp.eos_id()
        self.byte_id = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.id_byte = {i: b for b, i in enumerate(self.byte_id)}
        self.pieces = {}
        for i in range(sp.get_piece_size()):
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)):
                self.pieces[sp.id_to_piece(i)] = i
        self.text_of = {i: p for p, i in self.pieces.items()}
        self.priority = {p: -sp.get_score(i) for p, i in self.pieces.items()}
        # letters: word characters less digits and the vocabulary's other numerals
        odd = {ch for p in self.pieces for ch in p if not ch.isalpha() and re.match(r"[^\W\d_]", ch)}
        letter = f"[^\\W\\d_{''.join(map(re.escape, sorted(odd)))}]"
        rest = f"(?:[^\\w {MARK}]|[\\d_{''.join(map(re.escape, sorted(odd)))}])+"
        inner = re.compile(f"{MARK}?(?:{letter}+|{rest}|)")
        for p in self.pieces:
            if p.strip(MARK) and not inner.fullmatch(p):
                raise ValueError(f"piece {p!r} crosses a segment boundary")
        self.segment = re.compile(f"[ {MARK}]*{letter}+|[ {MARK}]*{rest}|[ {MARK}]+")
        self.automaton = ahocorasick.Automaton()
        for p, i in self.pieces.items():
            if p.strip(MARK) or p == MARK:
                self.automaton.add_word(p, (i, len(p)))
        self.automaton.make_automaton()
        self.pairs = Memo(self._pair_holds, memo_limit)
        self.memo_bytes, self.held = memo_bytes, 0
        self.ids_text: dict[str, str] = {}      # segment -> its ids
        self.ids_decoded: dict[str, str] = {}   # ids of a segment -> decoded text

    # -- merging, used on the text of two tokens and on runs of marks only

    def merge(self, text: str) -> list[str]:
        """Best score first, leftmost among equals: the library's own order."""
        parts, nxt, prv = list(text), list(range(1, len(text) + 1)), list(range(-1, len(text) - 1))
        heap = []

        def offer(i: int) -> None:
            if i >= 0 and nxt[i] < len(parts):
                both = parts[i] + parts[nxt[i]]
                if both in self.priority:
                    heapq.heappush(heap, (self.priority[both], i, both))
        for i in range(len(parts)):
            offer(i)
        while heap:
            _, i, both = heapq.heappop(heap)
            if not parts[i] or nxt[i] >= len(parts) or parts[i] + parts[nxt[i]] != both:
                continue
            j = nxt[i]
            parts[i], parts[j], nxt[i] = both, "", nxt[j]
            if nxt[i] < len(parts):
                prv[nxt[i]] = i
            offer(prv[i])
            offer(i)
        return [p for p in parts if p]

    def _token_text(self, token: int) -> str:
        return self.text_of[token] if token >= 0 else chr(-token - 1)

    def _pair_holds(self, pair: int) -> bool:
        """May the two tokens of ``left << 20 | right`` stand side by side?"""
        a, b = self._token_text(pair >> 20), self._token_text(pair & 0xFFFFF)
        return self.merge(a + b) == [a, b]

    # -- one segment

    def last_tokens(self, seg: str) -> tuple[list[int], list[int]]:
        """The table: for every prefix its unique last token and that token's
        length.  A character without a piece is the token ``-1 - code point``."""
        last: list[int | None] = [None] * len(seg)
        length = [1] * len(seg)
        pairs = self.pairs
        for end, (token, n) in self.automaton.iter(seg):   # by end, longest first
            if last[end] is None:
                start = end - n
                if start >= 0:
                    left = last[start]
                    if left is None:
                        left = last[start] = -1 - ord(seg[start])
                    if not pairs[(left << 20) + token]:
                        continue
                last[end] = token
                length[end] = n
        return [-1 - ord(ch) if t is None else t for t, ch in zip(last, seg)] if None in last else last, length

    def _marks(self, n: int) -> list[int]:
        return [self.pieces[p] for p in self.merge(MARK * n)]

    def encode_segment(self, seg: str) -> list[int]:
        body = seg.lstrip(MARK)
        marks = len(seg) - len(body)
        if not body:
            return self._marks(marks)
        seg = MARK + body if marks else body
        last, length = self.last_tokens(seg)
        ids, at = [], len(seg) - 1
        while at >= 0:
            ids.append(last[at])
            at -= length[at]
        ids.reverse()
        if min(ids) < 0:
            ids = [i for t in ids for i in ([t] if t >= 0 else [self.byte_id[b] for b in chr(-t - 1).encode()])]
        if marks > 1:   # marks merge among themselves after all other merges
            alone = ids[0] == self.pieces[MARK]
            ids = self._marks(marks if alone else marks - 1) + ids[alone:]
        return ids

    # -- whole texts

    def encode_parts(self, text: str) -> list[str]:
        """Ids of the text as strings, one per segment, without the end id."""
        if not text:
            return []
        segs = self.segment.findall(" " + text)
        parts = list(map(self.ids_text.get, segs))
        if None in parts:
            parts = [self._learn(seg) if ids is None else ids for seg, ids in zip(segs, parts)]
        return parts

    def _learn(self, seg: str) -> str:
        ids = self.ids_text.get(seg)
        if ids is None:
            tokens = self.encode_segment(seg.replace(" ", MARK))
            ids = " ".join(map(str, tokens))
            text = self.decode_ids(tokens)
            text = seg if text == seg else text   # share the string
            cost = ENTRY_BYTES + getsizeof(seg) + getsizeof(ids) + (0 if text is seg else getsizeof(text))
            if cost > self.memo_bytes // 64:
                return ids
            if self.held + cost > self.memo_bytes:   # bounds the memory; costs relearning
                self.ids_text.clear()
                self.ids_decoded.clear()
                self.held = 0
            self.held += cost
            self.ids_text[seg], self.ids_decoded[ids] = ids, text
        return ids

    def _decoded(self, ids: str) -> str:
        text = self.ids_decoded.get(ids)
        return self.decode_ids(map(int, ids.split())) if text is None else text

    def encode(self, text: str) -> list[int]:
        return [int(i) for part in self.encode_parts(text) for i in part.split()]

    def decode_ids(self, ids) -> str:
        """Pieces joined, byte pieces read as UTF-8; marks become blanks."""
        out, run = [], bytearray()
        for i in ids:
            if i in self.id_byte:
                run.append(self.id_byte[i])
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run.clear()
            out.append(self.text_of.get(i, ""))
        if run:
            out.append(run.decode("utf-8", "replace"))
        return "".join(out).replace(MARK, " ")

    def decode_parts(self, parts: list[str]) -> str:
        """Decodes the ids of ``encode_parts`` (end id left out)."""
        texts = list(map(self.ids_decoded.get, parts))
        if None in texts:
            texts = [self._decoded(p) if t is None else t for p, t in zip(parts, texts)]
        return "".join(texts)[1:]   # the first blank is the dummy prefix


@lru_cache(maxsize=2)
def codec(model_path: str) -> PrefixTableCodec:
    """One codec per worker process and model."""
    return PrefixTableCodec(model_path)


def encode_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                  with_ids: bool = False) -> DataFrame:
    """One row per input row: id, n_tokens, ids_sha256, decoded_sha256; with
    ``with_ids`` also ``ids`` (array<int>, end id included) and ``decoded``.

    One pass over the text without a shuffle; a task's memory is one batch, the
    bounded memos and the model."""
    id_type = docs.schema[id_col].dataType.simpleString()
    extra = ", ids array<int>, decoded string" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        end = str(c.eos)
        for batch in batches:
            n, ids_sha, dec_sha, ids_out, dec_out = [], [], [], [], []
            for text in text_list(batch.column(1)):
                parts = c.encode_parts(text)
                decoded = c.decode_parts(parts)
                ids = " ".join([*parts, end])
                n.append(ids.count(" ") + 1)
                ids_sha.append(sha_hex(ids.encode()))
                dec_sha.append(sha_hex(decoded.encode()))
                if with_ids:
                    ids_out.append([int(i) for i in ids.split()])
                    dec_out.append(decoded)
            cols = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                    pa.array(dec_sha, pa.string())]
            names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols += [pa.array(ids_out, pa.list_(pa.int32())), pa.array(dec_out, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(cols, names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(
        run, f"{id_col} {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string{extra}")
