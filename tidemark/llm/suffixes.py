"""External induced sorting: suffixes of a text in order, with the lengths of the prefixes that neighbours share.

A text is an array of numbers that ends in one that is smaller than all others. Positions fall into runs of equal numbers. A suffix whose
run is followed by a smaller number is falling, else it is rising; a rising run behind a falling one starts at a seed. The pieces of text
from seed to seed are named in order; where names repeat, the text of names is sorted in the same way (a short one by ranks of prefixes), which
gives the order of the seeds. The falling suffixes are induced from the seeds, from the least number up; the rising ones from the falling, from the greatest down.

What is induced goes through a queue by numbers: a place for each tuple (position, steps to the next run, rank of the suffix there), so that what
is taken out together comes in the order of those ranks. Numbers of which none induces another are taken out together. The prefix that two
neighbours share is their steps and the least of what the suffixes between the two behind them share. Shared prefixes are told up to a cap.

Arrays of more than ``MEMORY`` bytes are mapped files without a name, which go with the process, so that a shard may be larger than memory.
"""

from __future__ import annotations

import tempfile

import numpy as np

#: Bytes of an array beyond which it lives on disk.
MEMORY = 256 << 20
#: Names that are sorted by ranks of doubled length, at the end of the recursion.
FEW = 1 << 18
_BLOCK = 16


def room(n: int, kind: type, memory: int = MEMORY) -> np.ndarray:
    """Zeros, on disk if there are many."""
    if n * np.dtype(kind).itemsize <= memory:
        return np.zeros(n, kind)
    with tempfile.TemporaryFile() as held:
        held.truncate(n * np.dtype(kind).itemsize)
        return np.memmap(held, kind, "r+", shape=(n,))


class Minima:
    """An array that grows, and the least of any stretch of what it holds. Blocks have minima from either end, and tables over blocks look back."""

    def __init__(self, n: int, memory: int = MEMORY):
        self.n, self.values = 0, room(n, np.uint16, memory)
        self.ahead, self.behind = room(n + _BLOCK, np.uint16, memory), room(n + _BLOCK, np.uint16, memory)
        blocks = n // _BLOCK + 1
        self.tables = [room(blocks, np.uint16, memory) for _ in range(max(1, blocks.bit_length()))]

    def append(self, values: np.ndarray) -> None:
        lo, self.n = self.n, self.n + len(values)
        self.values[lo : self.n] = values
        first, done = lo // _BLOCK, self.n // _BLOCK
        at = first * _BLOCK
        part = np.full(-(-(self.n - at) // _BLOCK) * _BLOCK, 65535, np.uint16)
        part[: self.n - at] = self.values[at : self.n]
        rows = part.reshape(-1, _BLOCK)
        self.ahead[at : at + len(part)] = np.minimum.accumulate(rows, axis=1).ravel()
        self.behind[at : at + len(part)] = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        if done > first:
            self.tables[0][first:done] = rows[: done - first].min(axis=1)
            for k in range(1, len(self.tables)):
                half = 1 << (k - 1)
                if half >= done:
                    break
                begin = max(first, half)
                self.tables[k][first:begin] = self.tables[k - 1][first:begin]
                self.tables[k][begin:done] = np.minimum(self.tables[k - 1][begin:done], self.tables[k - 1][begin - half : done - half])

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The least from lo to hi, both included; lo <= hi."""
        a, b = lo // _BLOCK, hi // _BLOCK
        out = np.minimum(self.behind[lo], self.ahead[hi])
        same = np.flatnonzero(a == b)
        if len(same):
            at, end = lo[same], hi[same]
            found = self.values[at]
            live = np.flatnonzero(at < end)
            while len(live):
                at[live] += 1
                found[live] = np.minimum(found[live], self.values[at[live]])
                live = live[at[live] < end[live]]
            out[same] = found
        far = np.flatnonzero(b - a > 1)
        if len(far):
            width = b[far] - a[far] - 1
            level = np.frexp(width.astype(np.float64))[1] - 1
            last, found = b[far] - 1, out[far]
            for k in np.unique(level).tolist():
                at = np.flatnonzero(level == k)
                table = self.tables[k]
                found[at] = np.minimum(found[at], np.minimum(table[last[at]], table[a[far[at]] + (1 << k)]))
            out[far] = found
        return out


def _groups(low: np.ndarray, high: np.ndarray, n: int) -> np.ndarray:
    """Ends of ranges of the numbers below n such that no pair (low, high) lies within one."""
    reach = np.full(n + 1, n, np.int64)
    np.minimum.at(reach, low.astype(np.int64), high.astype(np.int64))
    reach = np.minimum.accumulate(reach[::-1])[::-1].tolist()
    ends, at = [], 0
    while at < n:
        at = reach[at]
        ends.append(at)
    return np.array(ends, np.int64)


def _induce(text: np.ndarray, n_symbols: int, start: np.ndarray, end: np.ndarray, seeds: np.ndarray, shared: np.ndarray, n_items: int, cap: int, memory: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of seeds and of all that they induce, in order, and what each shares with the one before it.

    shared has that of each seed with the seed before it. Of equal numbers those induced come first. start and end are those of each position's run.
    """
    total = n_items + len(seeds)
    order, prefix = room(total, np.int32, memory), Minima(total, memory)
    heads = np.flatnonzero(start == np.arange(len(text), dtype=start.dtype))[1:]
    heads = heads[text[heads - 1] > text[heads]]
    ends = _groups(text[heads], text[heads - 1], n_symbols)
    # The queue: a place for each tuple, by the group of its number.
    of_symbol = np.repeat(np.arange(len(ends), dtype=np.uint16 if len(ends) <= 1 << 16 else np.int32), np.diff(ends, prepend=0))
    induces = np.zeros(len(text), bool)
    induces[heads] = True
    sizes = np.bincount(of_symbol[text[heads - 1]], weights=(heads - start[heads - 1]).astype(np.float64), minlength=len(ends)).astype(np.int64)
    first = np.concatenate(([0], np.cumsum(sizes)))
    filled = first[:-1].copy()
    where, steps, ranks = room(n_items, np.int32, memory), room(n_items, np.int32, memory), room(n_items, np.int32, memory)
    seed_symbols = text[seeds]
    seed_ends = np.searchsorted(seed_symbols, ends)
    base = seed_at = 0
    for g in range(len(ends)):
        lo, hi = first[g], first[g + 1]
        position, step, rank = where[lo:hi], steps[lo:hi], ranks[lo:hi]
        symbol = text[position]
        single = ends[g] - (ends[g - 1] if g else 0) == 1
        longest = int(step.max()) if hi > lo else 1
        if not single or longest > 1:
            key = (symbol.astype(np.int64) - (ends[g - 1] if g else 0)) * (longest + 1) + step
            if hi > lo and key.max() < 1 << 16:
                key = key.astype(np.uint16)
            by = np.argsort(key, kind="stable")
            position, step, rank, symbol = position[by], step[by], rank[by], symbol[by]
        common = np.zeros(hi - lo, np.uint16)
        if hi - lo > 1:
            if single and longest == 1:
                common[1:] = prefix.least(rank[:-1] + 1, rank[1:]) + np.uint16(1)
            else:
                alike = symbol[1:] == symbol[:-1]
                at = np.flatnonzero(alike & (step[1:] == step[:-1]))
                common[1:] = np.where(alike, np.minimum(np.minimum(step[1:], step[:-1]), cap), 0)
                common[at + 1] = np.minimum(step[at] + prefix.least(rank[at] + 1, rank[at + 1]).astype(np.int32), cap)
        own, merged = seeds[seed_at : seed_ends[g]], position
        if len(own):
            merged, common = np.concatenate((position, own)), np.concatenate((common, shared[seed_at : seed_ends[g]].astype(np.uint16)))
            if single:
                edge = np.array([len(position)])
            else:
                by = np.argsort(np.concatenate((symbol.astype(np.int64) * 2, seed_symbols[seed_at : seed_ends[g]].astype(np.int64) * 2 + 1)), kind="stable")
                seed = by >= len(position)
                merged, common = merged[by], common[by]
                edge = np.flatnonzero(seed & np.concatenate(([True], ~seed[:-1])))
            # The seam between what is induced and the seeds of a number, or the first seed of a number without anything before it.
            before = np.maximum(edge - 1, 0)
            run = lambda at: end[merged[at]] - merged[at]  # noqa: B023, E731
            common[edge] = np.where((edge > 0) & (text[merged[before]] == text[merged[edge]]), np.minimum(np.minimum(run(before), run(edge)), cap), 0)
            seed_at = seed_ends[g]
        if len(merged):
            common[0] = 0  # Another group has other numbers.
        order[base : base + len(merged)] = merged
        prefix.append(np.minimum(common, np.uint16(cap)))
        # What these induce: all of the run before, if its number is greater.
        head = np.flatnonzero(induces[merged])
        if len(head):
            source = merged[head]
            count = source - start[source - 1]
            if count.max() > 1:
                rank = np.repeat(base + head, count)
                step = np.arange(len(rank)) - np.repeat(np.cumsum(count) - count, count) + 1
                position = np.repeat(source, count) - step
            else:
                rank, step, position = base + head, count, source - 1
            to = of_symbol[text[position]]
            by = np.argsort(to, kind="stable")
            to = to[by]
            edge = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1])))
            size = np.diff(np.append(edge, len(to)))
            place = np.arange(len(to)) + np.repeat(filled[to[edge]] - edge, size)
            filled[to[edge]] += size
            where[place], steps[place], ranks[place] = position[by], step[by], rank[by]
        base += len(merged)
    return order, prefix.values


class _Pieces:
    """The pieces of a text from seed to seed, with the run of the next seed and one number more, as rows of numbers with their directions.

    The last number goes without one. So what two unlike pieces share ends within both, and no piece begins another.
    """

    def __init__(self, text: np.ndarray, rising: np.ndarray, n_symbols: int, starts: np.ndarray, end: np.ndarray):
        self.text, self.starts = text, starts.astype(np.int64)
        self.lengths = np.minimum(end[np.append(self.starts[1:], len(text) - 1)] + 1, len(text)) - self.starts
        self.bits = int(2 * n_symbols + 3).bit_length()
        self.a_word = 63 // self.bits
        # So many numbers from each position on, packed; no number is 0.
        symbols = np.concatenate((text.astype(np.uint64) * np.uint64(2) + np.uint64(2) + rising, np.zeros(self.a_word, np.uint64)))
        self.packed = np.zeros(len(text) + 1, np.uint64)
        for k in range(self.a_word):
            self.packed[:-1] <<= np.uint64(self.bits)
            self.packed[:-1] |= symbols[k : len(text) + k]
        # By the numbers left of a piece: zeros behind its end, and its last number without a direction.
        width = self.bits * self.a_word
        masks = [((1 << width) - 1) & ~((1 << self.bits * (self.a_word - left)) - 1) & ~(1 << self.bits * (self.a_word - left)) for left in range(1, self.a_word + 1)]
        self.masks = np.array([0, *masks, (1 << width) - 1], np.uint64)

    def word(self, which: np.ndarray, at: int) -> np.ndarray:
        """So many numbers of each piece from there, packed; zeros behind its end."""
        left = np.clip(self.lengths[which] - at, 0, self.a_word + 1)
        return self.packed[np.minimum(self.starts[which] + at, len(self.text))] & self.masks[left]

    def named(self) -> tuple[np.ndarray, np.ndarray]:
        """The rank of each piece, that of equal pieces the same, counted from 0 without gaps; and a piece of each rank."""
        everything = np.arange(len(self.starts))
        key = self.word(everything, 0)
        by = np.argsort(key, kind="stable")
        new = np.concatenate(([True], key[by][1:] != key[by][:-1]))
        rank = np.empty(len(by), np.int64)
        rank[by] = np.maximum.accumulate(np.where(new, everything, 0))
        at = self.a_word
        live = np.flatnonzero(self.lengths > at)
        while len(live):
            # All pieces of a rank go on here or none, for no piece begins another.
            key = self.word(live, at)
            by = np.lexsort((key, rank[live]))
            live, key = live[by], key[by]
            group = rank[live]
            fresh = np.concatenate(([True], group[1:] != group[:-1]))
            new = fresh | np.concatenate(([True], key[1:] != key[:-1]))
            index = np.arange(len(live))
            rank[live] = group + np.maximum.accumulate(np.where(new, index, 0)) - np.maximum.accumulate(np.where(fresh, index, 0))
            # Those alone in their rank are done.
            edge = np.flatnonzero(new)
            alone = np.repeat(np.diff(np.append(edge, len(live))) == 1, np.diff(np.append(edge, len(live))))
            at += self.a_word
            live = live[~alone]
            live = live[self.lengths[live] > at]
        # Without gaps.
        there = np.zeros(len(rank), bool)
        there[rank] = True
        name = (np.cumsum(there) - 1)[rank]
        sample = np.empty(int(there.sum()), np.int64)
        sample[name] = everything
        return name, sample

    def shared(self, left: np.ndarray, right: np.ndarray, run: np.ndarray, cap: int) -> np.ndarray:
        """Numbers that unlike pieces have in common at their start. run: steps from each position to the end of its run."""
        out, live, at = np.zeros(len(left), np.int64), np.arange(len(left)), 0
        while len(live) and at < cap:
            a, b = self.word(left[live], at), self.word(right[live], at)
            apart = np.flatnonzero(a != b)
            differ = a[apart] ^ b[apart]
            # The first number that differs in the word.
            first = np.full(len(apart), self.a_word - 1, np.int64)
            for k in range(self.a_word - 1, -1, -1):
                first[(differ >> np.uint64(self.bits * (self.a_word - 1 - k))) != 0] = k
            which = live[apart]
            p, q = self.starts[left[which]] + at + first, self.starts[right[which]] + at + first
            # The same number in another direction: runs of unlike lengths.
            p, q = np.minimum(p, len(run) - 1), np.minimum(q, len(run) - 1)
            turned = (self.text[p] == self.text[q]) & (at + first < self.lengths[left[which]]) & (at + first < self.lengths[right[which]])
            out[which] = at + first + np.where(turned, np.minimum(run[p], run[q]), 0)
            live = live[a == b]
            at += self.a_word
        out[live] = cap
        return np.minimum(out, cap)


def _by_doubling(text: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """As suffix_order(), for a text of few names at the end of the recursion: ranks of prefixes of 1, 2, 4 ... numbers until all are told apart."""
    n = len(text)
    ranks, step = [text.astype(np.int64)], 1
    while True:
        rank = ranks[-1]
        behind = np.zeros(n, np.int64)
        behind[: max(n - step, 0)] = rank[step:] + 1
        key = rank * (int(behind.max()) + 1) + behind
        order = np.argsort(key, kind="stable")
        number = np.concatenate(([0], np.cumsum(key[order][1:] != key[order][:-1])))
        if number[-1] == n - 1:
            break
        rank = np.empty(n, np.int64)
        rank[order] = number
        ranks.append(rank)
        step *= 2
    a, b = order[1:], order[:-1]
    shared = np.zeros(n - 1, np.int64)
    # What two share is less than twice the longest prefix that was ranked: by the last that tells them apart, then by halves.
    for k in range(len(ranks) - 1, -1, -1):
        at, to = a + shared, b + shared
        live = np.flatnonzero((at < n) & (to < n))
        shared[live[ranks[k][at[live]] == ranks[k][to[live]]]] += 1 << k
    return order.astype(np.int32), np.minimum(np.concatenate(([0], shared)), cap).astype(np.uint16)


def suffix_order(text: np.ndarray, n_symbols: int, cap: int, memory: int = MEMORY, few: int = FEW) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the order of their suffixes, and the prefix (up to the cap) that each shares with the one before it.

    text: numbers below n_symbols; the last is 0, and no other is. cap: 65,000 at most. few: names up to which the recursion ends.
    """
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int32), np.zeros(1, np.uint16)
    edge = np.flatnonzero(text[1:] != text[:-1]) + 1
    starts = np.concatenate(([0], edge))
    ends = np.append(edge, n)
    rises = np.append(text[ends[:-1]] > text[starts[:-1]], True)
    length = ends - starts
    start, end = room(n, np.int32, memory), room(n, np.int32, memory)
    start[:], end[:] = np.repeat(starts, length), np.repeat(ends, length)
    rising = np.repeat(rises, length)
    seeds = starts[1:][rises[1:] & ~rises[:-1]]
    pieces = _Pieces(text, rising, n_symbols, seeds, end)
    name, sample = pieces.named()
    run = end - np.arange(n, dtype=np.int32)
    between = np.concatenate(([0], pieces.shared(sample[:-1], sample[1:], run, cap)))
    if len(sample) == len(seeds):
        by, common = sample, between
    else:
        by, names_shared = _by_doubling(name, cap) if len(name) <= few else suffix_order(name.astype(np.int32), len(sample), cap, memory, few)
        by, h = by.astype(np.int64), names_shared.astype(np.int64)
        # So many whole pieces, and what the first unlike pieces share: the least between their names.
        a, b = np.minimum(by[1:] + h[1:], len(seeds) - 1), np.minimum(by[:-1] + h[1:], len(seeds) - 1)
        minima = Minima(len(between), memory)
        minima.append(np.minimum(between, cap).astype(np.uint16))
        low, high = np.minimum(name[a], name[b]), np.maximum(name[a], name[b])
        rest = np.where(low == high, 0, minima.least(np.minimum(low + 1, high), high).astype(np.int64))
        common = np.concatenate(([0], np.where(h[1:] >= cap, cap, np.minimum(seeds[a] - seeds[by[1:]] + rest, cap))))
    del pieces, name
    sorted_seeds = seeds[by].astype(np.int32)
    n_falling = int(length[~rises].sum())
    listed, shared = _induce(text, n_symbols, start, end, sorted_seeds, common, n_falling, cap, memory)
    # The falling ones now induce the rising ones, from the greatest number down.
    falling = ~rising[listed]
    falling[0] = True  # the end, which nothing induces
    seeds, shared = listed[falling][::-1], shared[falling]
    shared = np.concatenate(([0], shared[1:][::-1]))
    listed, shared = _induce((n_symbols - 1 - text).astype(text.dtype), n_symbols, start, end, seeds, shared, n - 1 - n_falling, cap, memory)
    return listed[::-1], np.concatenate((np.zeros(1, np.uint16), shared[1:][::-1]))
