"""Small numpy helper that scores Arrow batches of names inside tasks.

The similarity of two texts is ``200 * LCS / (len a + len b)``, LCS being the
longest common subsequence. The LCS is counted with the published bit-vector
recurrence (Hyyro 2004), one machine word per 64 characters, over many pairs
at a time.
"""

from __future__ import annotations

import zlib

import numpy as np

CELLS = 1 << 19  # (name, candidate) cells looked at in one go
PAIRS = 1 << 14  # pairs compared in one go; their bit vectors fit a core's cache
MASK_BYTES = 1 << 26
SLACK = 1e-3
WALKED = 64  # characters of a text that walks a tree: one machine word
LEVELS = (97.0, 94.0, 91.0, 88.0, 85.0, 82.0, 79.0, 76.0)  # similarities that a walk of the tree asks for, one after the other
BATCHES = (256, 32)  # texts that walk the tree together; those that hold too many nodes go again with fewer others
NODES = 1 << 20  # nodes that a batch may hold at one depth
FILLED = 1 << 15  # rows of a matrix of characters that are filled at once


def _points(texts) -> tuple[np.ndarray, np.ndarray]:
    """All code points of the texts in one array, and the length of each text."""
    joined = "".join(texts).encode("utf-32-le", "surrogatepass")
    lens = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    return np.frombuffer(joined, dtype="<u4"), lens


def _alphabet(texts) -> np.ndarray:
    """The code points of the texts, in ascending order."""
    return np.array(sorted(map(ord, set().union(*texts))), dtype="<u4")


def _places(lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each code point of ``_points``: its text, and its position there."""
    owner = np.repeat(np.arange(len(lens)), lens)
    return owner, np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens)


class Candidates:
    """Candidate texts prepared for scoring; row numbers are those of ``texts``."""

    def __init__(self, texts):
        points, self.lens = _points(texts)
        self.alphabet = np.unique(points)
        self.words = max(1, -(-int(self.lens.max(initial=0)) // 64))
        owner, place = _places(self.lens)
        code = np.searchsorted(self.alphabet, points) + 1
        shape = (len(self.alphabet) + 1, len(texts))  # row 0: characters no candidate has
        self.masks = np.zeros((self.words, *shape), dtype=np.uint64)
        np.bitwise_or.at(self.masks, (place // 64, code, owner), np.uint64(1) << (place % 64).astype(np.uint64))
        small = self.words <= 3  # then no count, and no sum of counts, exceeds 192
        self.counts = np.zeros(shape, dtype=np.uint8 if small else np.int32)
        np.add.at(self.counts, (code, owner), 1)

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Texts -> (texts, longest) matrix of alphabet rows, padded with 0; and the lengths."""
        points, lens = _points(texts)
        code = np.searchsorted(self.alphabet, points)
        known = code < len(self.alphabet)
        known[known] = self.alphabet[code[known]] == points[known]
        matrix = np.zeros((len(texts), int(lens.max(initial=0))), dtype=np.int32)
        matrix[_places(lens)] = np.where(known, code + 1, 0)
        return matrix, lens

    def lcs(self, matrix: np.ndarray, texts: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """LCS of each pair (row of ``matrix``, candidate) in ``texts`` and ``rows``."""
        steps = np.ascontiguousarray(matrix.T) * len(self.lens)  # where each character's masks start
        masks = [word.ravel() for word in self.masks]
        found = np.empty(len(rows), dtype=np.int64)
        for at in range(0, len(rows), PAIRS):
            text, row = texts[at : at + PAIRS], rows[at : at + PAIRS]
            state = [np.full(len(row), ~np.uint64(0)) for _ in masks]
            for starts in steps:
                place, carry = starts[text] + row, None
                for word, v in enumerate(state):
                    hit = masks[word][place]
                    hit &= v
                    total = v + hit
                    if self.words > 1:
                        over = total < v
                        if carry is not None:
                            total += carry
                            over |= total < carry
                        carry = over.astype(np.uint64)
                    v ^= hit  # takes the hits out: they are all set in v
                    v |= total
            found[at : at + PAIRS] = sum(np.bitwise_count(~v).astype(np.int64) for v in state)
        return found

    def common(self, matrix: np.ndarray) -> np.ndarray:
        """Characters each text shares with each candidate, order ignored: LCS is never more."""
        shared = np.zeros((len(matrix), self.counts.shape[1]), dtype=self.counts.dtype)
        top = np.iinfo(self.counts.dtype).max
        for code in np.unique(matrix):
            if code:
                have = np.minimum((matrix == code).sum(axis=1), top).astype(self.counts.dtype)
                shared += np.minimum(have[:, None], self.counts[code][None, :])
        return shared


def _share(common, total):
    return 200.0 * common / np.maximum(total, 1)


def _batches(lens: np.ndarray, most: int):
    """Text numbers, alike in length, in batches of bounded count and bounded matrix size."""
    order = np.argsort(lens, kind="stable")
    at = 0
    while at < len(order):
        size = min(most, len(order) - at)
        while size > 1 and size * int(lens[order[at + size - 1]]) > 8 * CELLS:
            size //= 2
        yield order[at : at + size]
        at += size


def pair_similarity(left, right) -> np.ndarray:
    """Similarity (0 to 100, not rounded) of the texts at the same places."""
    out = np.zeros(len(left))
    longest = np.array([max(len(a), len(b)) for a, b in zip(left, right)], dtype=np.int64)
    for batch in _batches(longest, 4096):
        texts = sorted({right[i] for i in batch}, key=len)
        place = {text: i for i, text in enumerate(texts)}
        row = np.array([place[right[i]] for i in batch])
        for run in _pieces(texts):
            here = np.flatnonzero((row >= run.start) & (row < run.stop))
            cand = Candidates(texts[run.start : run.stop])
            matrix, lens = cand.encode([left[i] for i in batch[here]])
            local = row[here] - run.start
            total = lens + cand.lens[local]
            out[batch[here]] = _share(cand.lcs(matrix, np.arange(len(here)), local), total)
    return out


def _pieces(texts, rows: int = 4096) -> list[range]:
    """Runs of texts whose masks together stay within ``MASK_BYTES``."""
    todo, done = [range(0, len(texts))], []
    while todo:
        run = todo.pop()
        width = max((len(texts[i]) for i in run), default=0) // 64 + 1
        letters = len(set().union(*(texts[i] for i in run))) + 1
        if len(run) > 1 and (len(run) > rows or letters * len(run) * width * 8 > MASK_BYTES):
            half = run.start + len(run) // 2
            todo += [range(half, run.stop), range(run.start, half)]
        elif len(run):
            done.append(run)
    return done


class BestMatch:
    """Arg-max over a list of candidate texts; the smaller ``ords`` wins a tie.

    Nothing is approximated. The shared-character count bounds the similarity
    from above, so only candidates whose bound reaches the best score found so
    far are compared.
    """

    def __init__(self, texts, ords):
        order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
        texts = [texts[i] for i in order]
        self.pick = np.array(order, dtype=np.int64)
        self.ords = np.asarray(ords, dtype=np.int64)[self.pick]
        self.parts = [(run.start, Candidates([texts[i] for i in run])) for run in _pieces(texts)]

    def find(self, texts, floor=None) -> tuple[np.ndarray, np.ndarray]:
        """Per text: row of the best candidate (-1: none reaches ``floor``) and its similarity."""
        score = np.full(len(texts), -1.0) if floor is None else np.array(floor, dtype=float)
        row = np.full(len(texts), -1, dtype=np.int64)
        lens = np.array([len(t) for t in texts], dtype=np.int64)
        most = max(1, CELLS // max((len(c.lens) for _, c in self.parts), default=1))
        for batch in _batches(lens, most):
            near = int(np.median(lens[batch]))
            for start, cand in sorted(self.parts, key=lambda part: abs(int(np.median(part[1].lens)) - near)):
                # The closest length bounds the similarity: texts it keeps below their score skip the part.
                closest = np.clip(lens[batch], cand.lens.min(), cand.lens.max())
                reach = _share(np.minimum(lens[batch], closest), lens[batch] + closest)
                left = batch[reach >= score[batch]]
                if len(left):
                    self._visit(cand, start, [texts[i] for i in left], left, score, row)
        return np.where(row < 0, -1, self.pick[row]), score

    def _visit(self, cand, start, texts, batch, score, row):
        matrix, lens = cand.encode(texts)
        # Bounds in single precision, for speed; SLACK exceeds their rounding error.
        bound = cand.common(matrix).astype(np.float32)
        bound *= np.float32(200)
        bound /= np.maximum(lens[:, None].astype(np.float32) + cand.lens.astype(np.float32), np.float32(1))
        # The most promising candidate first: its score thins out the others.
        names = np.arange(len(texts))
        first = bound.argmax(axis=1)
        probe = bound[names, first] >= score[batch] - SLACK
        self._compare(cand, start, matrix, lens, batch, names[probe], first[probe], score, row)
        bound[names, first] = -1.0
        floor = np.maximum(score[batch] - SLACK, 0.0).astype(np.float32)
        left, right = np.nonzero(bound >= floor[:, None])
        self._compare(cand, start, matrix, lens, batch, left, right, score, row)

    def _compare(self, cand, start, matrix, lens, batch, left, right, score, row):
        if len(left):
            found = _share(cand.lcs(matrix, left, right), lens[left] + cand.lens[right])
            self._keep_best(batch, left, right + start, found, score, row)

    def _keep_best(self, batch, left, cand_row, found, score, row):
        """``left`` comes in ascending order: one run of pairs per text."""
        begin = np.flatnonzero(np.r_[True, left[1:] != left[:-1]])
        top = np.maximum.reduceat(found, begin)
        size = np.diff(np.r_[begin, len(left)])
        last = np.iinfo(np.int64).max
        ords = np.where(found == np.repeat(top, size), self.ords[cand_row], last)
        low = np.minimum.reduceat(ords, begin)
        winner = np.flatnonzero(ords == np.repeat(low, size))
        name, best = batch[left[begin]], cand_row[winner]
        held = row[name]
        tie = (top == score[name]) & ((held < 0) | (low < self.ords[held]))
        win = (top > score[name]) | tie
        score[name[win]], row[name[win]] = top[win], best[win]


def _prefixes(texts, ties, back, alphabet):
    """Rows in the order of their (reversed) texts, code matrix, characters shared with the row in front; nodes."""
    turned = [t[::-1] if back else t for t in texts]
    order = sorted(range(len(texts)), key=lambda i: (turned[i], ties[i]))
    lens = np.fromiter((len(turned[i]) for i in order), dtype=np.int64, count=len(order))
    kind = np.uint8 if len(alphabet) < 255 else np.int32
    matrix = np.zeros((len(order), int(lens.max(initial=0)) + 1), dtype=kind)
    for at in range(0, len(order), FILLED):  # few at a time: places of characters are wide numbers
        points, some = _points([turned[i] for i in order[at : at + FILLED]])
        matrix[at : at + FILLED][_places(some)] = np.searchsorted(alphabet, points) + 1
    shared = np.zeros(len(order), dtype=np.int64)
    if len(order) > 1:
        differ = matrix[1:] != matrix[:-1]
        shared[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), lens[1:])
    return np.array(order, dtype=np.int64), matrix, shared, int((lens - shared).sum())


class _Walked:
    """A prefix tree by depth; texts of up to 64 characters walk it, and branches that cannot reach their floor end."""

    def _build(self, matrix, shared, least, most):
        """For each depth its nodes: first row, character, children, ending row (-1: none), least and greatest length below."""
        self.levels, lens = [], (matrix > 0).sum(axis=1)
        starts = np.zeros(min(1, len(matrix)), dtype=np.int64)
        for depth in range(matrix.shape[1]):
            if not len(starts):
                break
            below = np.flatnonzero((shared <= depth) & (lens > depth))
            stop = np.r_[starts[1:], len(matrix)]
            self.levels.append((
                matrix[starts, depth - 1].astype(np.int32) if depth else np.zeros(len(starts), dtype=np.int32),
                np.searchsorted(below, starts).astype(np.int32),
                np.searchsorted(below, stop).astype(np.int32),
                np.where(lens[starts] == depth, starts, -1).astype(np.int32),
                np.minimum.reduceat(least, starts).clip(depth).astype(np.int16),
                np.maximum.reduceat(most, starts).astype(np.int16),
            ))
            starts = below

    def _alike(self, todo, lens, asked, most):
        """Batches of up to ``most`` texts of one length, alike in what they ask for."""
        order = np.lexsort((asked, lens[todo]))
        cuts = np.flatnonzero(np.diff(lens[todo][order])) + 1
        for run in np.split(order, cuts):
            for at in range(0, len(run), most):
                yield todo[run[at : at + most]], asked[run[at : at + most]]

    def _descend(self, texts, size, floor, left):
        """``(depth, texts, nodes, states, edits)`` of what is open, depth by depth; ``left`` gets the texts that hold too many nodes."""
        n, width = len(texts), len(self.alphabet) + 1
        points = np.frombuffer("".join(t[::-1] if self.back else t for t in texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        code = np.searchsorted(self.alphabet, points)
        known = code < len(self.alphabet)
        known[known] = self.alphabet[code[known]] == points[known]
        masks = np.zeros(n * width, dtype=np.uint64)
        at = np.repeat(np.arange(n) * width, size) + np.where(known, code + 1, 0)
        np.bitwise_or.at(masks, at[known], np.uint64(1) << np.tile(np.arange(size), n).astype(np.uint64)[known])
        # A candidate of this similarity takes at most so many characters in and out.
        edits = int(2 * size * (100 - floor.min()) / floor.min() + SLACK)
        need = _need(floor)
        key = np.arange(n, dtype=np.int32)
        node = np.zeros(n if self.levels else 0, dtype=np.int32)
        state = np.full(len(node), ~np.uint64(0))
        for depth, (_, first, stop, _, _, _) in enumerate(self.levels[:-1], 1):
            if not len(node):
                break
            fan = stop[node] - first[node]
            if fan.sum() > NODES:
                # The texts that hold the most leave the walk.
                held = np.bincount(key, fan, minlength=n)
                order = np.argsort(held)
                left[order[np.cumsum(held[order]) > NODES // 2]] = True
                stay = ~left[key]
                key, node, state, fan = key[stay], node[stay], state[stay], fan[stay]
            ahead = (np.cumsum(fan) - fan).astype(np.int32)
            node = np.repeat(first[node] - ahead, fan) + np.arange(fan.sum(), dtype=np.int32)
            key, state = np.repeat(key, fan), np.repeat(state, fan)
            char, _, _, _, least, most = self.levels[depth]
            hit = masks[key * width + char[node]]
            hit &= state
            total = state + hit
            state ^= hit
            state |= total
            # What a prefix has beside its common characters is lost; most branches end here.
            here, over, reach = need[key], most[node], min(size, depth + edits)
            lost = depth - reach + np.bitwise_count(state & _LOW[reach]).astype(np.int16)
            some = np.flatnonzero(lost <= over - here * (over + np.int16(size)))
            key, node, state, here, over = key[some], node[some], state[some], here[some], over[some]
            open_ = _may_reach(state, size, depth, edits, least[node], over, here)
            key, node, state = key[open_], node[open_], state[open_]
            yield depth, key, node, state, edits


_LOW = [np.uint64((1 << i) - 1) for i in range(WALKED + 1)]


def _need(floor):
    """What share of both lengths the common characters must have, as a bound that rounding cannot miss."""
    return (floor * 0.005 - SLACK / 100).astype(np.float32)


def _may_reach(state, size, depth, edits, under, over, need):
    """Whether a candidate of ``under`` to ``over`` characters behind these states, ``depth`` characters in, may share what is needed."""
    open_ = np.zeros(len(state), dtype=bool)
    for i in range(max(0, depth - edits), min(size, depth + edits) + 1):
        rest = size - i
        length = np.clip(np.int16(min(depth + rest, 32000)), under, over)
        common = np.minimum(length - np.int16(depth), np.int16(rest)) + (np.int16(i) - np.bitwise_count(state & _LOW[i]))
        open_ |= common >= need * (length + np.int16(size))
    return open_


class Tree(_Walked):
    """Arg-max over many candidate texts: a prefix tree is walked, and what it leaves open is compared by ``BestMatch``.

    A walk asks for all candidates of at least some similarity. The bit vector of a text against a prefix bounds every
    candidate that begins so, and a bound below the similarity ends the branch. Walks ask for less and less, until
    something is found or the text's floor is reached. Texts of over 64 characters, and those that would hold too many
    nodes, are compared with ``rows`` candidates at a time. Nothing is approximated.
    """

    def __init__(self, texts, ords, rows: int = 5000, chars: int = 500_000):
        self.texts, self.ords, self.rows, self.chars = list(texts), np.asarray(ords, dtype=np.int64), rows, chars
        self.alphabet = _alphabet(self.texts)
        lens = np.array([len(t) for t in self.texts], dtype=np.int64)
        short = np.flatnonzero(lens <= 255)  # a longer one is more than three times as long as any text that walks
        picked = [self.texts[i] for i in short]
        ways = [_prefixes(picked, self.ords[short], back, self.alphabet) for back in (False, True)]
        self.back = ways[1][3] < ways[0][3]
        order, matrix, shared, _ = ways[self.back]
        self.row, lens = short[order], lens[short[order]]
        self._build(matrix, shared, lens, lens)

    def find(self, texts, floor=None, levels=None) -> tuple[np.ndarray, np.ndarray]:
        """Per text: row of the best candidate (-1: none reaches ``floor``) and its similarity; walks ask for ``levels``."""
        score = np.full(len(texts), -1.0) if floor is None else np.array(floor, dtype=float)
        row = np.full(len(texts), -1, dtype=np.int64)
        lens = np.array([len(t) for t in texts], dtype=np.int64)
        open_ = np.arange(len(texts))
        wide = open_[(lens > WALKED) | (lens == 0)]
        todo = open_[(lens <= WALKED) & (lens > 0)]
        for level in (*(LEVELS if levels is None else levels), None):
            asked = score[todo] if level is None else np.maximum(score[todo], level)
            if level is None:
                wide = np.r_[wide, todo]
                break
            more = []
            for most in BATCHES:
                over, over_at = [todo[:0]], [asked[:0]]
                for batch, at in self._alike(todo, lens, asked, most):
                    found, sim, left = self._walk([texts[i] for i in batch], int(lens[batch[0]]), at)
                    hit = found >= 0
                    more.append(batch[~hit & ~left & (at > score[batch])])
                    score[batch[hit]], row[batch[hit]] = sim[hit], found[hit]
                    over.append(batch[left])
                    over_at.append(at[left])
                todo, asked = np.concatenate(over), np.concatenate(over_at)
            wide = np.r_[wide, todo]
            todo = np.concatenate(more) if more else todo[:0]
            if not len(todo):
                break
        self._compare(texts, np.sort(wide.astype(np.int64)), score, row)
        return row, score

    def _walk(self, texts, size, floor):
        """Best row of ``floor`` or more (-1: none), its similarity, and which texts hold too many nodes; all are ``size`` long."""
        found, sim = np.full(len(texts), -1, dtype=np.int64), np.array(floor)
        left = np.zeros(len(texts), dtype=bool)
        for depth, key, node, state, _ in self._descend(texts, size, floor, left):
            ends = self.levels[depth][3]
            end = np.flatnonzero(ends[node] >= 0)
            if len(end):
                whose, rows = key[end], self.row[ends[node[end]]]
                got = _share(size - np.bitwise_count(state[end] & _LOW[size]).astype(np.int64), size + depth)
                self._keep(whose, rows, got, found, sim)
        found[left] = -1
        return found, sim, left

    def _keep(self, whose, rows, got, found, sim):
        """The best row per text; the smaller ``ords`` wins a tie."""
        order = np.lexsort((self.ords[rows], -got, whose))
        whose, rows, got = whose[order], rows[order], got[order]
        one = np.r_[True, whose[1:] != whose[:-1]]
        whose, rows, got = whose[one], rows[one], got[one]
        held = found[whose]
        win = (got > sim[whose]) | ((got == sim[whose]) & ((held < 0) | (self.ords[rows] < self.ords[held])))
        found[whose[win]], sim[whose[win]] = rows[win], got[win]

    def _compare(self, texts, which, score, row):
        """The rest against all candidates, alike in length and few at a time."""
        if not len(which):
            return
        names = [texts[i] for i in which]
        lens = np.array([len(t) for t in self.texts], dtype=np.int64)
        order = np.argsort(lens, kind="stable")
        # A part's letters are those of ``rows`` candidates and ``chars`` characters at most, or of one candidate.
        part_of = np.maximum(np.arange(len(order)) // self.rows, np.cumsum(lens[order]) // self.chars)
        for part in np.split(order, np.flatnonzero(np.diff(part_of)) + 1):
            got, sim = BestMatch([self.texts[i] for i in part], self.ords[part]).find(names, score[which])
            hit = got >= 0
            here, rows, sim = which[hit], part[got[hit]], sim[hit]
            held = row[here]
            win = (sim > score[here]) | (held < 0) | (self.ords[rows] < self.ords[held])
            score[here[win]], row[here[win]] = sim[win], rows[win]


COVER = 64  # prefixes that stand for one block
WALK_FLOOR = 30.0  # texts that ask for less are routed by lengths alone


def cover(texts, back, most: int = COVER):
    """``(prefix, least length, greatest length)`` of up to ``most`` groups that hold all ``texts`` (reversed if ``back``)."""
    turned = sorted(t[::-1] if back else t for t in texts)
    lens = np.array([len(t) for t in turned], dtype=np.int64)
    _, _, shared, _ = _prefixes(turned, range(len(turned)), False, _alphabet(turned))
    # The deepest cut that leaves few enough prefixes; a cut at ``depth`` parts texts that share less.
    apart = np.sort(shared[1:])
    depth = int(apart[most - 1]) if len(apart) >= most else int(lens.max(initial=0))
    first = np.flatnonzero(np.r_[True, shared[1:] < depth])
    least, greatest = np.minimum.reduceat(lens, first), np.maximum.reduceat(lens, first)
    return [(turned[i][:depth], int(a), int(b)) for i, a, b in zip(first, least, greatest)]


class Routes(_Walked):
    """Which blocks of candidates may hold one that is similar enough? Asked before texts and blocks meet.

    A block is known by the prefixes that cover it and the lengths below each of them. Texts walk a tree of all prefixes;
    those of over 64 characters, or that ask for little, and blocks of long candidates go by lengths alone. A block
    that is left out holds no candidate of the similarity asked for.
    """

    def __init__(self, blocks, prefixes, least, most, back):
        blocks, least, most = (np.asarray(x, dtype=np.int64) for x in (blocks, least, most))
        self.back = back
        self.blocks, at = np.unique(blocks, return_inverse=True)
        self.least, self.most = np.full(len(self.blocks), 1 << 62), np.zeros(len(self.blocks), dtype=np.int64)
        np.minimum.at(self.least, at, least)
        np.maximum.at(self.most, at, most)
        self.long = self.most > 255  # as in ``Tree``
        which = np.flatnonzero(~self.long[at])
        texts = sorted({prefixes[i] for i in which})
        place = {text: i for i, text in enumerate(texts)}
        rows = np.array([place[prefixes[i]] for i in which], dtype=np.int64)
        order = np.argsort(rows, kind="stable")
        self.entry = at[which[order]], least[which[order]], most[which[order]]  # those of one prefix follow each other
        self.start = np.searchsorted(rows[order], np.arange(len(texts) + 1))
        self.alphabet = _alphabet(texts)
        _, matrix, shared, _ = _prefixes(texts, range(len(texts)), False, self.alphabet)
        under = np.minimum.reduceat(self.entry[1], self.start[:-1]) if texts else least[:0]
        over = np.maximum.reduceat(self.entry[2], self.start[:-1]) if texts else least[:0]
        self._build(matrix, shared, under, over)

    def first(self, texts) -> np.ndarray:
        """One block for each text: of those whose lengths fit best, any."""
        out = []
        for text in texts:
            closest = np.clip(len(text), self.least, self.most)
            fit = _share(np.minimum(len(text), closest), len(text) + closest)
            best = np.flatnonzero(fit == fit.max())
            out.append(self.blocks[best[zlib.crc32(text.encode("utf-8", "surrogatepass")) % len(best)]])
        return np.array(out, dtype=np.int64)

    def find(self, texts, floor) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row of ``texts``, block), in ascending order."""
        floor = np.asarray(floor, dtype=float)
        lens = np.array([len(t) for t in texts], dtype=np.int64)
        whose, where = [lens[:0]], [lens[:0]]

        def by_length(rows, among):
            closest = np.clip(lens[rows, None], self.least[among], self.most[among])
            bound = _share(np.minimum(lens[rows, None], closest), lens[rows, None] + closest)
            text, block = np.nonzero(bound >= floor[rows, None] - SLACK)
            whose.append(rows[text])
            where.append(among[block])

        walks = (lens <= WALKED) & (lens > 0) & (floor >= WALK_FLOOR)
        todo, every = np.flatnonzero(walks), np.arange(len(self.blocks))
        for most in BATCHES:
            over = [todo[:0]]
            for batch, at in self._alike(todo, lens, floor[todo], most):
                text, block, left = self._walk([texts[i] for i in batch], int(lens[batch[0]]), at)
                whose.append(batch[text])
                where.append(block)
                over.append(batch[left])
            todo = np.concatenate(over)
        few = max(1, CELLS // max(1, len(every)))
        for rows, among in ((np.flatnonzero(walks), every[self.long]), (np.r_[np.flatnonzero(~walks), todo], every)):
            for at in range(0, len(rows) if len(among) else 0, few):
                by_length(rows[at : at + few], among)
        pairs = np.unique(np.concatenate(whose) * len(every) + np.concatenate(where))
        return pairs // len(every), self.blocks[pairs % len(every)]

    def _walk(self, texts, size, floor):
        left, need = np.zeros(len(texts), dtype=bool), _need(floor)
        whose, where = [np.empty(0, np.int64)], [np.empty(0, np.int64)]

        def meet(depth, key, rows, state, edits):
            count = self.start[rows + 1] - self.start[rows]
            key, state = np.repeat(key, count).astype(np.int64), np.repeat(state, count)
            entry = np.repeat(self.start[rows] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            block, under, over = (x[entry] for x in self.entry)
            open_ = _may_reach(state, size, depth, edits, under.astype(np.int16), over.astype(np.int16), need[key])
            whose.append(key[open_])
            where.append(block[open_])

        if self.levels and self.levels[0][3][0] >= 0:  # the empty prefix
            every = np.arange(len(texts))
            meet(0, every, np.zeros(len(texts), dtype=np.int64), np.full(len(texts), ~np.uint64(0)), 2 * size * 100)
        for depth, key, node, state, edits in self._descend(texts, size, floor, left):
            ends = self.levels[depth][3][node]
            end = np.flatnonzero(ends >= 0)
            meet(depth, key[end], ends[end].astype(np.int64), state[end], edits)
        whose, where = np.concatenate(whose), np.concatenate(where)
        stay = ~left[whose]
        return whose[stay], where[stay], left
