"""Plain single-machine forms of the corpus operators, for comparison on small tables."""

import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0D]+")


def fold(doc_id, parts):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % parts


def ascii_lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


class KneserNey:
    """Interpolated modified Kneser-Ney over dictionaries."""

    def __init__(self, texts, order):
        self.order, top, self.words = order, Counter(), Counter()
        for t in texts:
            tokens = self.tokens(t)
            self.words.update(tokens[order - 1 :])
            top.update(tuple(tokens[i - order + 1 : i + 1]) for i in range(order - 1, len(tokens)))
        self.counts = {order: top}
        for k in range(order - 1, 0, -1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.cut, self.sums = {}, {}
        for k, counts in self.counts.items():
            n = [sum(c == i for c in counts.values()) for i in (1, 2, 3, 4)]
            y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0
            self.cut[k] = [min(max((i + 1) - (i + 2) * y * n[i + 1] / n[i] if i else 1 - 2 * y * n[1] / n[0], 0), i + 1) for i in range(3)] if all(n) else [0.5, 1, 1.5]
            self.sums[k] = defaultdict(lambda: [0, 0, 0, 0])
            for g, c in counts.items():
                s = self.sums[k][g[:-1]]
                s[0] += c
                s[min(c, 3)] += 1

    def tokens(self, text):
        return ["<s>"] * (self.order - 1) + WORD.findall(ascii_lower(text or "")) + ["</s>"]

    def probability(self, k, gram):
        if k == 0:
            return 1 / (len(self.words) + 1)
        lower = self.probability(k - 1, gram[1:])
        s = self.sums[k].get(gram[:-1])
        if not s:
            return lower
        c = self.counts[k].get(gram, 0)
        own = (c - self.cut[k][min(c, 3) - 1]) / s[0] if c else 0
        return own + sum(d * n for d, n in zip(self.cut[k], s[1:])) / s[0] * lower

    def score(self, text):
        t, k = self.tokens(text), self.order
        return sum(math.log10(self.probability(k, tuple(t[i - k + 1 : i + 1]))) for i in range(k - 1, len(t)))
