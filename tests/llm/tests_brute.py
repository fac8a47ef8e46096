"""Brute-force near-duplicate groups."""
import re


def brute_groups(rows, percent=90, n=3):
    """doc_id -> smallest doc_id of its group."""
    sets = {}
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets[d] = {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {d: find(d) for d in ids}
