"""Edit distance with transpositions, and the deletion neighbourhoods that find it by equality."""

from __future__ import annotations


def osa(a: str, b: str, most: int) -> int:
    """Optimal string alignment distance (insert, delete, replace, swap neighbours), or ``most`` + 1 beyond it."""
    la, lb = len(a), len(b)
    if abs(la - lb) > most:
        return most + 1
    if a == b:
        return 0
    before: list[int] = []
    row = list(range(lb + 1))
    for i in range(1, la + 1):
        x = a[i - 1]
        new = [i] + [most + 1] * lb
        lo, hi = max(1, i - most), min(lb, i + most)
        least = new[0]
        for j in range(lo, hi + 1):
            y = b[j - 1]
            d = row[j - 1] + (x != y)
            if row[j] + 1 < d:
                d = row[j] + 1
            if new[j - 1] + 1 < d:
                d = new[j - 1] + 1
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y and before[j - 2] + 1 < d:
                d = before[j - 2] + 1
            new[j] = d
            if d < least:
                least = d
        if least > most and min(row[max(0, lo - 1) : hi + 1], default=0) > most:
            return most + 1
        before, row = row, new
    return min(row[lb], most + 1)


def deletions(s: str, k: int) -> set[str]:
    """``s`` and all strings left when up to ``k`` characters are deleted.

    Two strings within OSA distance k always share one of these: each edit is undone by at most one
    deletion on either side (a swap by deleting one of the pair on both).
    """
    out = {s}
    last = {s}
    for _ in range(k):
        last = {t[:i] + t[i + 1 :] for t in last for i in range(len(t))}
        out |= last
    return out


def allowed(length: int) -> int:
    """Edits granted to a token of this length."""
    return 0 if length < 3 else 1 if length < 8 else 2
