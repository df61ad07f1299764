"""The operators' results in plain Python, text by text."""

import collections
import math
import re
import zlib

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words(text):
    return re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().translate(LOWER))


def normal(text):
    return re.sub(r"[\x20\x09-\x0d]+", " ", text or "")


def shingles(text):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def near_groups(texts):
    """texts: {id: text} -> {id: (set size, smallest id reachable)}"""
    sets = {i: shingles(t) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    for i, s in sets.items():
        shared = collections.Counter(j for g in s for j in holders[g] if j < i)
        for j, n in shared.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in texts}


def _discounts(counts, most=5):
    n = collections.Counter(counts.values())
    out = collections.defaultdict(lambda: 1.0)
    absolute = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
    high = (most + 1) * n[most + 1] / n[1] if n[1] else 1.0
    for r in range(1, most + 1):
        turing = (r + 1) * n[r + 1] / (r * n[r]) if n[r] else 0.0
        d = (turing - high) / (1 - high) if high < 1 else 0.0
        out[r] = d if 0 < d < 1 else 1 - min(absolute, 0.9) / r
    return out


class Katz:
    def __init__(self, texts):
        """texts: {id: text}"""
        self.tokens = {i: [*words(t), None] for i, t in texts.items()}
        self.train = {i for i in texts if zlib.crc32(str(i).encode()) % 5 != 1}
        self.single, pairs, self.history = collections.Counter(), collections.Counter(), collections.Counter()
        for i in self.train:
            before = "begin"
            for w in self.tokens[i]:
                self.single[w] += 1
                pairs[before, w] += 1
                self.history[before] += 1
                before = w
        self.total = sum(self.single.values())
        one, self.two = _discounts(self.single), _discounts(pairs)
        self.lower = {w: one[c] * c / self.total for w, c in self.single.items()}
        self.unknown = 1 - sum(self.lower.values())
        self.follow = collections.defaultdict(dict)
        for (h, w), c in pairs.items():
            self.follow[h][w] = c

    def after(self, h):
        """Probabilities of seen words after h, and the factor of the others."""
        seen = {w: self.two[c] * c / self.history[h] for w, c in self.follow.get(h, {}).items()}
        if not seen:
            return {}, 1.0
        if sum(seen.values()) > 1 - 1e-9:
            seen = {w: p * self.history[h] / (self.history[h] + 1) for w, p in seen.items()}
        return seen, (1 - sum(seen.values())) / (1 - sum(self.lower[w] for w in seen))

    def score(self, i):
        base = score = 0.0
        before = "begin"
        for w in self.tokens[i]:
            seen, other = self.after(before)
            score += math.log10(seen[w] if w in seen else other * self.lower.get(w, self.unknown))
            base += math.log10((self.single[w] + 0.5) / (self.total + 0.5 * (len(self.single) + 1)))
            before = w
        return base, score


def text_counts(text):
    w = re.findall(r"[^\x20\x09-\x0d]+", text or "")
    windows = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), len(lines)
    )


def best_cut(pieces, text):
    """Viterbi over the whole text at once: the ids of a SentencePiece table."""
    if not text:
        return []
    text = ("▁" if pieces.prefix else "") + text.replace(" ", "▁")
    best = [(0.0, None, None)] + [None] * len(text)
    for i in range(len(text)):
        for j in range(i + 1, min(len(text), i + pieces.longest) + 1):
            piece = pieces.ids.get(text[i:j])
            if piece is not None and (best[j] is None or best[i][0] + pieces.scores[piece] > best[j][0]):
                best[j] = (best[i][0] + pieces.scores[piece], i, piece)
        if text[i] not in pieces.ids and (best[i + 1] is None or best[i][0] + pieces.unknown_score > best[i + 1][0]):
            best[i + 1] = (best[i][0] + pieces.unknown_score, i, None)
    out, at = [], len(text)
    while at:
        _, start, piece = best[at]
        out = ([piece] if piece is not None else pieces.spell(text[start])) + out
        at = start
    return out
