"""Re-Pair grammars of id sequences: numpy code that runs inside one task.

A grammar replaces frequent pairs of neighbouring ids by new symbols
(nonterminals), again and again, and stores per nonterminal its pair and the
number of ids it expands to.  The pairs of a round are all those whose count
reaches the round's threshold, most frequent first where two overlap; thresholds
fall by ``STEP`` from the largest count to ``least``.

Every ``SAMPLE``-th symbol's position in the expanded sequence is stored, so any
range of ids is decoded from the few symbols that cover it.
"""

from __future__ import annotations

import struct

import numpy as np

#: Fixed value: first bytes of an encoded sequence.
MAGIC = b"RPG1"
HEADER = struct.Struct("<4sBIIQQ")
#: Ratio of the thresholds of two rounds.
STEP = 16
#: A pair is replaced if it stands this often: a rule takes eight bytes.
LEAST = 12
#: Rounds at the lowest threshold go on while they shorten by one part in so many.
GAIN = 8
#: Symbols between two stored positions.
SAMPLE = 1024
#: Symbols of two bytes as long as they are fewer than this, else of four.
NARROW = 1 << 16
_BITS = 16


def _chosen(rank: np.ndarray, none: int) -> np.ndarray:
    """Places whose pair is replaced, none of which overlap: of neighbouring
    candidates the better rank, in a run of the same pair every other one."""
    at = np.flatnonzero(rank < none)
    here = rank[at]
    if not len(at):
        return at
    near = np.append(np.diff(at) == 1, False)          # the next place is a candidate too
    after = np.where(near, np.append(here[1:], none), none)
    before = np.append(none, after[:-1] * 0 + none)
    before[1:] = np.where(near[:-1], here[:-1], none)
    good = (before > here) & (after > here)
    same = (before == here) | (after == here)
    if same.any():   # runs of one pair that overlaps itself
        idx = np.flatnonzero(same)
        starts = idx[before[idx] != here[idx]]
        ends = idx[after[idx] != here[idx]]
        run = np.searchsorted(starts, idx, side="right") - 1
        free = (before[starts] > here[starts])[run] | (idx > starts[run])
        free &= (after[ends] > here[ends])[run] | (idx < ends[run])
        good[idx] = free & ((idx - starts[run]) % 2 == 0)
    return at[good]


def compress(ids: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, rules, terminals): symbol ``k`` is the id ``terminals[k]`` or, from
    ``len(terminals)`` on, the pair ``rules[k - len(terminals)]`` of smaller symbols."""
    terminals = np.unique(ids).astype(np.uint32)
    narrow = len(terminals) < NARROW
    symbol, key, bits = (np.uint16, np.uint32, 16) if narrow else (np.uint32, np.uint64, 32)
    multiplier = key(0x9E3779B1) if narrow else key(0x9E3779B97F4A7C15)
    shift = key(2 * bits - _BITS)
    place = np.zeros(int(terminals[-1]) + 1 if len(terminals) else 0, dtype=symbol)
    place[terminals] = np.arange(len(terminals))
    seq = place[ids]
    rules: list[np.ndarray] = []
    made, threshold = len(terminals), None
    while len(seq) > 1:
        keys = (seq[:-1].astype(key) << key(bits)) | seq[1:]
        ordered = np.sort(keys)
        ends = np.append(np.flatnonzero(ordered[1:] != ordered[:-1]), len(ordered) - 1)
        counts = np.diff(ends, prepend=-1)
        top = int(counts.max())
        if top < least:
            break
        threshold = max(least, min(top, threshold or top) // STEP)
        many = np.flatnonzero(counts >= threshold)
        many = many[np.argsort(-counts[many], kind="stable")]
        if narrow:
            many = many[:NARROW - made]
        wanted = ordered[ends[many]]
        # Rank of each place's pair by a table of hashes; of two pairs with one hash
        # the more frequent stays, the other has its turn in a later round.
        table = np.full(1 << _BITS, len(wanted), dtype=np.int32)
        table[((wanted * multiplier) >> shift)[::-1]] = np.arange(len(wanted) - 1, -1, -1, dtype=np.int32)
        rank = table[(keys * multiplier) >> shift]
        rank[np.append(wanted, key(0))[rank] != keys] = len(wanted)
        at = _chosen(rank, len(wanted))
        ranks = rank[at]
        good = np.bincount(ranks, minlength=len(wanted)) >= least
        keep = good[ranks]
        at, ranks, chosen = at[keep], ranks[keep], wanted[good]
        if len(at):
            rules.append(np.stack([chosen >> key(bits), chosen & key((1 << bits) - 1)], axis=1).astype(symbol))
            seq[at] = (made + np.cumsum(good) - 1).astype(symbol)[ranks]
            left = np.ones(len(seq), bool)
            left[at + 1] = False
            seq = seq[left]
            made += len(chosen)
        if threshold == least and len(at) * GAIN < len(seq) or narrow and made >= NARROW:
            break
    return seq, np.concatenate(rules) if rules else np.zeros((0, 2), symbol), terminals


# -- encoded form


def encode(ids: np.ndarray, least: int = LEAST) -> bytes:
    """Header, terminals, rules, expansion lengths of the rules, stored positions and
    symbols of ``ids``."""
    seq, rules, terminals = compress(ids, least)
    lengths = expansion_lengths(rules, len(terminals))
    ends = np.cumsum(np.append(np.ones(len(terminals), np.int64), lengths)[seq])
    starts = np.append(0, ends)[:-1][::SAMPLE] if len(seq) else np.zeros(0, np.int64)
    head = HEADER.pack(MAGIC, seq.dtype.itemsize, len(terminals), len(rules), len(seq), len(ids))
    return b"".join([head, terminals.astype("<u4").tobytes(), rules.astype(f"<u{rules.dtype.itemsize}").tobytes(),
                     lengths.astype("<u4").tobytes(), starts.astype("<u8").tobytes(),
                     seq.astype(f"<u{seq.dtype.itemsize}").tobytes()])


def expansion_lengths(rules: np.ndarray, terminals: int) -> np.ndarray:
    """Ids that each rule expands to.  Rules hold smaller symbols only, so they are
    solved a level at a time: those whose two symbols are known."""
    known = np.ones(terminals + len(rules), np.int64)
    known[terminals:] = 0
    todo = np.arange(len(rules))
    while len(todo):
        both = known[rules[todo]]
        ready = (both > 0).all(axis=1)
        known[terminals + todo[ready]] = both[ready].sum(axis=1)
        todo = todo[~ready]
    return known[terminals:]


class Encoded:
    """Reader of ``encode``'s bytes: all ids, or any range of them."""

    def __init__(self, data: bytes):
        magic, width, n_terminals, n_rules, n_symbols, self.n_ids = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not an encoded sequence")
        at = HEADER.size

        def take(dtype: str, count: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(data, dtype=dtype, count=count, offset=at)
            at += got.nbytes
            return got

        self.terminals = take("<u4", n_terminals)
        self.rules = take(f"<u{width}", 2 * n_rules).reshape(n_rules, 2)
        self.lengths = np.append(np.ones(n_terminals, np.int64), take("<u4", n_rules).astype(np.int64))
        self.positions = take("<u8", -(-n_symbols // SAMPLE)).astype(np.int64)
        self.symbols = take(f"<u{width}", n_symbols)

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        """Ids of ``symbols``: nonterminals open into their pairs, a level at a time,
        each at its place in the output."""
        size = self.lengths[symbols]
        at = np.cumsum(size) - size
        out = np.empty(int(size.sum()), np.uint32)
        n = len(self.terminals)
        while len(symbols):
            plain = symbols < n
            out[at[plain]] = self.terminals[symbols[plain]]
            pair = self.rules[symbols[~plain].astype(np.int64) - n]
            left = at[~plain]
            right = left + self.lengths[pair[:, 0]]
            symbols = np.concatenate([pair[:, 0], pair[:, 1]])
            at = np.concatenate([left, right])
        return out

    def ids(self) -> np.ndarray:
        """All ids, copied from the expansions of all symbols laid end to end (a rule
        stands ``least`` times, so those are not many more than the ids)."""
        laid = self._expand(np.arange(len(self.lengths)))
        begin = np.cumsum(self.lengths) - self.lengths
        size = self.lengths[self.symbols]
        shift = begin[self.symbols] - (np.cumsum(size) - size)
        return laid[np.arange(self.n_ids) + np.repeat(shift, size)]

    def range(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop``, from the symbols between the stored positions around them."""
        if not 0 <= start <= stop <= self.n_ids:
            raise IndexError("range outside the sequence")
        if start == stop:
            return np.zeros(0, np.uint32)
        lo = int(np.searchsorted(self.positions, start, side="right")) - 1
        hi = int(np.searchsorted(self.positions, stop, side="left"))
        part = self.symbols[lo * SAMPLE:hi * SAMPLE]
        ends = self.positions[lo] + np.cumsum(self.lengths[part])
        first = int(np.searchsorted(ends, start, side="right"))
        last = int(np.searchsorted(ends, stop, side="left"))
        begin = int(ends[first - 1]) if first else int(self.positions[lo])
        return self._expand(part[first:last + 1])[start - begin:stop - begin]
