"""Brute force that several modules of tests compare with."""

import re


def brute_near(texts, size, percent):
    sets = []
    for text in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    parent = list(range(len(texts)))

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [(len(s), find(i), find(i) == i) for i, s in enumerate(sets)]
