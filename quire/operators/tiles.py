"""Best scores of many queries in a bundle of chunks, in tasks, tile by tile.

A tile is some queries by some chunks.  Words that many of both have are multiplied as dense
matrices in single precision, the postings of the others are added.  Only what may be among
the k best of its query then is scored again, exactly.  Chunks of like words lie together, so
a tile has fewer frequent words, and queries that can't reach their bar in it are left out.
"""

from __future__ import annotations

import numpy as np

# Queries and chunks of a tile, and the words its queries have together.
HEIGHT, WIDTH, TILE_WORDS = 1024, 1024, 60_000
# A word is multiplied if it is in this share of the pairs of a tile at least, up to so many words; adding a posting costs as much as hundreds of products.
DENSE_SHARE, MOST_DENSE = 0.002, 1024
# Postings added at once.
ADDED = 500_000
# Chunks are grouped by the most frequent words of their bundle.
GROUPS, GROUP_WORDS, ROUNDS = 12, 64, 5
# Bounds are compared with this much room, more than sums of doubles differ by.
MARGIN = 1e-6
# Exact scores worked out at once: words of queries, over all hits.
SCORED = 500_000
# The error of a single-precision sum of positive numbers, for each number.
EPSILON = 1.2e-7


def _spans(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers from each ``first`` on, so many as ``length`` says, one span after another."""
    ends = np.cumsum(length)
    return np.repeat(first - ends + length, length) + np.arange(ends[-1] if len(ends) else 0)


class Bundle:
    """Postings of a bundle, its chunks put in an order in which like ones are neighbours."""

    def __init__(self, number: np.ndarray, place: np.ndarray, impact: np.ndarray):
        cut = np.append(np.flatnonzero(np.diff(number, prepend=-1)), len(number))
        self.vocabulary, self.df = number[cut[:-1]], np.diff(cut)
        word = np.repeat(np.arange(len(self.df)), self.df)
        rows, position = np.unique(place, return_inverse=True)
        self.size = len(rows)
        order = self._grouped(cut, position)
        at = np.empty(self.size, np.int64)
        at[order] = np.arange(self.size)
        self.rows, position = rows[order].astype(np.int64), at[position]
        key = word * self.size + position
        order = np.argsort(key)
        self.key, self.impact = key[order], impact[order]
        tile = position[order] // WIDTH
        by_tile = np.argsort(tile.astype(np.int32), kind="stable")
        self.cuts = np.searchsorted(tile[by_tile], np.arange(-(-self.size // WIDTH) + 1))
        order = order[by_tile]
        self.word, self.column = word[order].astype(np.int32), (position[order] % WIDTH).astype(np.int32)
        self.single = impact[order].astype(np.float32)

    def _grouped(self, cut: np.ndarray, position: np.ndarray) -> np.ndarray:
        """The chunks by group, and by how many words they have; groups come from a few rounds of k-means."""
        self.frequent = np.argsort(-self.df, kind="stable")[:GROUP_WORDS]
        has = np.zeros((len(self.frequent), self.size), np.float32)
        for i, w in enumerate(self.frequent.tolist()):
            has[i, position[cut[w] : cut[w + 1]]] = np.log1p(self.size / self.df[w])
        has /= np.maximum(np.sqrt((has * has).sum(0)), 1e-9)
        chosen = np.random.default_rng(0).choice(self.size, min(GROUPS, self.size), replace=False)
        self.centres = has[:, np.sort(chosen)].T.copy()
        for _ in range(ROUNDS):
            group = (self.centres @ has).argmax(0)
            for g in range(len(self.centres)):
                total = has[:, group == g].sum(1)
                self.centres[g] = total / max(1e-9, float(np.sqrt((total * total).sum())))
        group = (self.centres @ has).argmax(0)
        return np.lexsort((np.bincount(position, minlength=self.size), group))


class Bars:
    """Of each query of a block, its k best scores so far, from below."""

    def __init__(self, k: int, n_queries: int):
        self.k = k
        self.values = np.full((n_queries, k), -np.inf, np.float32)
        self.floor = np.full(n_queries, -np.inf)

    def meet(self, query: np.ndarray, score: np.ndarray) -> None:
        """Take in scores (from below) of rows not met before, sorted by query."""
        order = np.lexsort((-score, query))
        query, score = query[order], score[order]
        first = np.flatnonzero(np.diff(query, prepend=-1))
        nth = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
        line = np.cumsum(nth == 0) - 1
        good, own = nth < self.k, query[first]
        more = np.full((len(own), self.k), -np.inf, np.float32)
        more[line[good], nth[good]] = score[good]
        both = np.partition(np.concatenate([self.values[own], more], 1), self.k, axis=1)[:, self.k :]
        self.values[own] = both
        self.floor[own] = np.maximum(self.floor[own], both.min(1))


def best_in(bundle: Bundle, words: np.ndarray, term: np.ndarray, weight: np.ndarray, bars: Bars) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``query, place, score``: the rows of the bundle that are among the k best of their query of all rows met so far, and equal ones.

    Query by query ``words`` has how many of ``term`` (each once) and ``weight`` are its own.  All weights are above 0.
    """
    k, n_words = bars.k, len(bundle.df)
    # The queries' words that occur here, the queries in the order of the chunks' groups.
    query = np.repeat(np.arange(len(words)), words)
    own = np.minimum(np.searchsorted(bundle.vocabulary, term), n_words - 1)
    found = bundle.vocabulary[own] == term
    query, own, weight = query[found], own[found], weight[found]
    slot = np.full(n_words, -1)
    slot[bundle.frequent] = np.arange(len(bundle.frequent))
    known = np.flatnonzero(slot[own] >= 0)
    profile = np.zeros((len(words), len(bundle.frequent)), np.float32)
    profile[query[known], slot[own[known]]] = weight[known]
    order = np.argsort((profile @ bundle.centres.T).argmax(1), kind="stable")
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    by_rank = np.argsort(rank[query], kind="stable")
    line, own, weight = rank[query][by_rank], own[by_rank], weight[by_rank]
    cuts = np.searchsorted(line, np.arange(len(words) + 1))
    single = weight.astype(np.float32)
    room = EPSILON * (int(np.diff(cuts).max(initial=0)) + 8)
    least = np.nextafter(np.float32(0), np.float32(1))

    def bar(lines: np.ndarray) -> np.ndarray:
        return np.maximum((bars.floor[order[lines]] * (1 - room) - MARGIN).astype(np.float32), least)

    tiles = len(bundle.cuts) - 1
    # All tiles are as wide as the first; what is beyond the last chunk has no postings.
    width = WIDTH if tiles > 1 else max(64, 1 << (bundle.size - 1).bit_length())
    parts = min(width, max(64, 1 << (4 * k - 1).bit_length()))
    sums = np.empty((HEIGHT, width), np.float32)
    held: list[tuple] = []
    here, begin, most = np.zeros(n_words, np.int64), np.zeros(n_words, np.int64), np.zeros(n_words, np.float32)
    for t in range(tiles):
        part = slice(bundle.cuts[t], bundle.cuts[t + 1])
        word, column, impact = bundle.word[part], bundle.column[part], bundle.single[part]
        first = np.flatnonzero(np.diff(word, prepend=-1))
        ids = word[first]
        here[:], most[:] = 0, 0
        here[ids], begin[ids] = np.diff(np.append(first, len(word))), first
        most[ids] = np.maximum.reduceat(impact, first)
        upper = np.bincount(line, single * most[own], len(words))
        live = np.flatnonzero((upper > 0) & (upper * (1 + room) >= bar(np.arange(len(words)))))
        if not len(live):
            continue
        # The rows of the words that may be multiplied.
        wide = np.flatnonzero(here >= max(1, DENSE_SHARE * width))
        if len(wide) > MOST_DENSE:
            wide = np.sort(wide[np.argsort(-here[wide], kind="stable")[:MOST_DENSE]])
        slot[:] = -1
        slot[wide] = np.arange(len(wide))
        matrix = np.zeros((len(wide), width), np.float32)
        of = slot[word]
        chosen = np.flatnonzero(of >= 0)
        matrix[of[chosen], column[chosen]] = impact[chosen]
        lengths = np.cumsum(np.diff(cuts)[live])
        at = 0
        while at < len(live):
            before = lengths[at - 1] if at else 0
            to = min(at + HEIGHT, max(at + 1, int(np.searchsorted(lengths, before + TILE_WORDS, "right"))))
            lines, at = live[at:to], to
            n = len(lines)
            e = _spans(cuts[lines], cuts[lines + 1] - cuts[lines])
            row, w, value = np.repeat(np.arange(n), cuts[lines + 1] - cuts[lines]), own[e], single[e]
            there = np.flatnonzero(here[w])
            row, w, value = row[there], w[there], value[there]
            dense = (slot >= 0) & (np.bincount(w, minlength=n_words) * here >= DENSE_SHARE * n * width)
            chosen = np.flatnonzero(dense)
            left = np.zeros((n, len(chosen)), np.float32)
            number = np.cumsum(dense) - 1
            mine = dense[w]
            left[row[mine], number[w[mine]]] = value[mine]
            out = np.matmul(left, matrix[slot[chosen]], out=sums[:n])
            rest = ~mine
            row, w, value = row[rest], w[rest], value[rest]
            ends = np.cumsum(here[w])
            i = 0
            while i < len(w):
                j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + ADDED, "right")))
                some = here[w[i:j]]
                e = _spans(begin[w[i:j]], some)
                np.add.at(out.reshape(-1), np.repeat(row[i:j] * width, some) + column[e], np.repeat(value[i:j], some) * impact[e])
                i = j
            needed = bar(lines)
            hot = np.flatnonzero(out.max(1) >= needed)
            if not len(hot):
                continue
            out, needed, lines = out[hot], needed[hot], lines[hot]
            good = out >= needed[:, None]
            crowded = np.flatnonzero(good.sum(1) > 4 * k)
            if len(crowded) and parts >= k:
                # So many chunks score as much at least.
                tops = out[crowded].reshape(len(crowded), width // parts, parts).max(1)
                kth = np.partition(tops, parts - k, axis=1)[:, parts - k] * (1 - room)
                own_floor = bars.floor[order[lines[crowded]]]
                bars.floor[order[lines[crowded]]] = np.maximum(own_floor, np.where(kth > 0, kth, -np.inf))
                needed = bar(lines)
                good[crowded] = out[crowded] >= needed[crowded][:, None]
            # Few of many are true: eight at once.
            eight = np.flatnonzero(good.view(np.uint64))
            byte, nth = np.nonzero(good.reshape(-1, 8)[eight])
            near, place = np.divmod(eight[byte] * 8 + nth, width)
            score, near = out[near, place], lines[near]
            bars.meet(order[near], score * np.float32(1 - room))
            held.append((near, place + t * WIDTH, score))
    if not held:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    near, place, score = map(np.concatenate, zip(*held))
    good = np.flatnonzero(score >= bar(near))
    near, place = near[good], place[good]
    exact = np.zeros(len(near))
    many = cuts[near + 1] - cuts[near]
    ends = np.cumsum(many)
    i = 0
    while i < len(near):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + SCORED, "right")))
        e = _spans(cuts[near[i:j]], many[i:j])
        key = own[e] * bundle.size + np.repeat(place[i:j], many[i:j])
        # In order, which keeps what is searched in the caches.
        by_key = np.argsort(key)
        to = np.empty(len(key), np.int64)
        to[by_key] = np.minimum(np.searchsorted(bundle.key, key[by_key]), len(bundle.key) - 1)
        parts_of = np.where(bundle.key[to] == key, bundle.impact[to] * weight[e], 0.0)
        exact[i:j] = np.bincount(np.repeat(np.arange(j - i), many[i:j]), parts_of, j - i)
        i = j
    return order[near], bundle.rows[place], exact
