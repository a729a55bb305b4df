"""Byte pair merges replayed over many words at once."""

from __future__ import annotations

import heapq

import numpy as np

NO_RANK = np.iinfo(np.int32).max
SHIFT = 20


class MergeTable:
    """Ranks and results of all pairs of symbols that can be merged, from the vocabulary."""

    def __init__(self, pairs: np.ndarray, ranks: np.ndarray, results: np.ndarray):
        keys = (pairs[:, 0].astype(np.int64) << SHIFT) | pairs[:, 1]
        bits = max(4, int(2 * len(keys) - 1).bit_length() + 1)
        self.shift = np.uint64(64 - bits)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, NO_RANK, np.int32)
        self.mask = (1 << bits) - 1
        self.known: dict[int, int] = {}
        self.results = np.zeros(int(ranks.max()) + 1 if len(ranks) else 1, np.int32)
        self.results[ranks] = results
        waiting, place = np.arange(len(keys)), self.slot(keys)
        self.probes = 0
        while len(waiting):
            free = self.keys[place] < 0
            taken, first = np.unique(place[free], return_index=True)
            won = waiting[free][first]
            self.keys[taken], self.ranks[taken] = keys[won], ranks[won]
            lost = np.ones(len(waiting), bool)
            lost[np.flatnonzero(free)[first]] = False
            waiting, place = waiting[lost], (place[lost] + 1) & self.mask
            self.probes += 1

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NO_RANK`` where it cannot be merged."""
        keys = (left.astype(np.int64) << SHIFT) | right
        place = self.slot(keys)
        held = self.keys[place]
        same = held == keys
        found = np.where(same, self.ranks[place], NO_RANK)
        open_rows = np.flatnonzero(~same & (held >= 0))
        while len(open_rows):
            place[open_rows] = (place[open_rows] + 1) & self.mask
            held = self.keys[place[open_rows]]
            same = held == keys[open_rows]
            found[open_rows[same]] = self.ranks[place[open_rows[same]]]
            open_rows = open_rows[~same & (held >= 0)]
        return found


    def merge_in_turn(self, symbols: list[int]) -> list[int]:
        """The symbols of one word merged pair by pair: the lowest rank first, and of equal ones the first."""
        if not self.known:
            held = np.flatnonzero(self.keys >= 0)
            self.known = dict(zip(self.keys[held].tolist(), self.ranks[held].tolist()))
        known, results = self.known, self.results
        token, count = list(symbols), len(symbols)
        following, before = list(range(1, count + 1)), list(range(-1, count - 1))
        waiting = []
        for place in range(count - 1):
            rank = known.get(token[place] << SHIFT | token[place + 1])
            if rank is not None:
                waiting.append((rank, place))
        heapq.heapify(waiting)
        while waiting:
            rank, left = heapq.heappop(waiting)
            right = following[left]
            # a pair that was there when it was put in may be gone
            if token[left] < 0 or right == count or known.get(token[left] << SHIFT | token[right]) != rank:
                continue
            token[left], token[right] = int(results[rank]), -1
            after = following[left] = following[right]
            if after < count:
                before[after] = left
            for first, second in ((before[left], left), (left, after)):
                if first >= 0 and second < count:
                    rank = known.get(token[first] << SHIFT | token[second])
                    if rank is not None:
                        heapq.heappush(waiting, (rank, first))
        return [symbol for symbol in token if symbol >= 0]


class PairIndex:
    """Inverted index from the rank of a pair to the positions where the pair begins."""

    def __init__(self):
        self.positions: dict[int, list[np.ndarray]] = {}
        self.order: list[int] = []

    def add(self, positions: np.ndarray, ranks: np.ndarray) -> None:
        mergeable = ranks != NO_RANK
        positions, ranks = positions[mergeable], ranks[mergeable]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        positions, ranks = positions[order], ranks[order]
        edges = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
        for rank, low, high in zip(ranks[edges[:-1]].tolist(), edges, edges[1:]):
            found = self.positions.get(rank)
            if found is None:
                self.positions[rank] = [positions[low:high]]
                heapq.heappush(self.order, rank)
            else:
                found.append(positions[low:high])

    def pop(self) -> tuple[int, np.ndarray]:
        """The lowest rank, and its positions in order."""
        rank = heapq.heappop(self.order)
        parts = self.positions.pop(rank)
        return rank, np.sort(parts[0]) if len(parts) == 1 else np.unique(np.concatenate(parts))


def apart(left: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Of positions in order, those that are merged where pairs overlap: every other one from the first of a row on."""
    overlaps = np.zeros(len(left), bool)
    overlaps[1:] = following[left[:-1]] == left[1:]
    if not overlaps.any():
        return left
    number = np.arange(len(left))
    return left[(number - np.maximum.accumulate(np.where(overlaps, 0, number))) % 2 == 0]


def replay(symbols: np.ndarray, lengths: np.ndarray, table: MergeTable) -> tuple[np.ndarray, np.ndarray]:
    """Merge the symbols of words (one after another, with their lengths) until no pair can be merged.

    Every merge is applied in rank order at all positions that hold its pair; only the neighbours of
    a merged pair are looked up again. All positions of a pair in a word go at once, unless one of
    them brings about a lower rank, which would go before the others: such a word, which vocabularies
    hardly ever have, is merged pair by pair instead. So the time is about in proportion to the symbols however
    long a word is. Returns the symbols left, and their number in each word.
    """
    count = len(symbols)
    token = symbols.astype(np.int32)
    word = np.repeat(np.arange(len(lengths)), lengths)
    following, before = np.arange(1, count + 1), np.arange(-1, count - 1)
    edges = np.concatenate([[0], np.cumsum(lengths)])
    ends = edges[1:][lengths > 0]
    following[ends - 1] = -1
    before[np.concatenate([[0], ends[:-1]])[: len(ends)]] = -1
    ranks, alive = np.full(count, NO_RANK, np.int32), np.ones(count, bool)
    chosen = np.zeros(count, bool)
    in_turn: list[int] = []
    inner = np.flatnonzero(following >= 0)
    ranks[inner] = table.rank(token[inner], token[inner + 1])
    index = PairIndex()
    index.add(inner, ranks[inner])
    while index.order:
        rank, left = index.pop()
        left = left[ranks[left] == rank]
        if not len(left):
            continue
        result = table.results[rank]
        if len(left) > 1:
            left = apart(left, following)
            owners = word[left]
            same = owners[1:] == owners[:-1]
            if same.any():
                together = left[np.append(same, False) | np.insert(same, 0, False)]
                chosen[left] = True
                early = lower_ranks(together, chosen, token, following, before, int(result), rank, table)
                chosen[left] = False
                if early.any():
                    for number in np.unique(word[together[early]]).tolist():
                        in_turn.append(number)
                        ranks[edges[number] : edges[number + 1]] = NO_RANK
                    left = left[ranks[left] == rank]
                    if not len(left):
                        continue
        right = following[left]
        after = following[right]
        token[left] = result
        alive[right] = False
        ranks[right] = NO_RANK
        ranks[left] = NO_RANK
        following[left] = after
        has_after = after >= 0
        linked, after = left[has_after], after[has_after]
        before[after] = linked
        # of pairs side by side, the second has the first before it now
        ahead = before[left]
        has_ahead = ahead >= 0
        chosen[left] = True
        has_ahead[has_ahead] = ~chosen[ahead[has_ahead]]
        chosen[left] = False
        earlier = ahead[has_ahead]
        touched = np.concatenate([linked, earlier])
        fresh = table.rank(token[touched], token[np.concatenate([after, left[has_ahead]])])
        ranks[touched] = fresh
        index.add(touched, fresh)
    for number in in_turn:
        low, high = edges[number], edges[number + 1]
        merged = table.merge_in_turn(symbols[low:high].tolist())
        token[low : low + len(merged)] = merged
        alive[low:high] = np.arange(high - low) < len(merged)
    return token[alive], np.bincount(word[alive], minlength=len(lengths))


def lower_ranks(
    left: np.ndarray, chosen: np.ndarray, token: np.ndarray, following: np.ndarray, before: np.ndarray, result: int, rank: int,
    table: MergeTable,
) -> np.ndarray:
    """Which of the merges at ``left`` may make a pair of a lower rank, if those before them in the word are done first."""
    early = np.zeros(len(left), bool)
    after, ahead = following[following[left]], before[left]
    has_after, has_ahead = np.flatnonzero(after >= 0), np.flatnonzero(ahead >= 0)
    made = np.full(len(left), result, np.int32)
    early[has_after] = table.rank(made[has_after], token[after[has_after]]) < rank
    own = ahead[has_ahead]
    merged = (before[own] >= 0) & chosen[np.maximum(before[own], 0)]
    early[has_ahead] |= table.rank(np.where(merged, result, token[own]).astype(np.int32), made[has_ahead]) < rank
    return early


def merged_words(
    words: list[bytes], single: np.ndarray, table: MergeTable, last: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words, one after another, and how many each has; ``single`` has the symbols of bytes, ``last`` those of the last byte of a word."""
    lengths = np.array([len(word) for word in words], np.int64)
    codes = np.frombuffer(b"".join(words), np.uint8)
    symbols = single[codes]
    if last is not None and len(codes):
        ends = np.cumsum(lengths)[lengths > 0] - 1
        symbols[ends] = last[codes[ends]]
    return replay(symbols, lengths, table)


def merge_words(words: list[bytes], single: np.ndarray, table: MergeTable, last: np.ndarray | None = None) -> list[bytes]:
    """Packed 32-bit ids of each word."""
    tokens, counts = merged_words(words, single, table, last)
    edges = (np.concatenate([[0], np.cumsum(counts)]) * 4).tolist()
    body = tokens.astype("<i4").tobytes()
    return [body[low:high] for low, high in zip(edges, edges[1:])]
