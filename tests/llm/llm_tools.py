"""Plain helpers of the brute-force versions."""

import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORDS.findall(text or "")


class Union:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def top(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.top(a), self.top(b)
        self.up[max(a, b)] = min(a, b)
