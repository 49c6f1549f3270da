"""Suffix array in linear time by grouping, without recursive renaming of the text."""

from __future__ import annotations


def suffix_array(text: list[int]) -> list[int]:
    """The suffixes of `text` (positive symbols) in order.

    First suffixes are grouped by their Lyndon prefix. Groups begin as the suffixes of one first symbol and are taken in
    descending order. Each suffix of the group points to the nearest suffix before it of a smaller group; those pointed
    at are split off their group towards its end, more pointers making a higher group, since the prefix of the group
    taken repeats more often behind them. Then the order inside groups is emitted: going up the order, the suffix before
    the one just placed and all that its pointers lead to are next in their groups.
    """
    s = [*text, 0]
    n = len(s)
    count: dict[int, int] = {}
    for c in s:
        count[c] = count.get(c, 0) + 1
    start, at = {}, 0
    for c in sorted(count):
        start[c] = at
        at += count[c]
    group = [start[c] for c in s]
    size = {start[c]: k for c, k in count.items()}
    order, place, fill = [0] * n, [0] * n, dict(start)
    for i, c in enumerate(s):
        k = fill[c]
        order[k], place[i] = i, k
        fill[c] = k + 1
    before = [-1] * n
    end = n - 1
    while end > 0:
        low = group[order[end]]
        if end == low:
            i = order[end]
            p = i - 1
            while p >= 0 and group[p] >= low:
                p = before[p]
            before[i] = p
            if p >= 0:
                g = group[p]
                last = g + size[g] - 1
                if last != g:
                    k, j = place[p], order[last]
                    order[k], order[last], place[j], place[p] = j, p, k, last
                    size[g] = last - g
                    group[p] = last
                    size[last] = 1
            end = low - 1
            continue
        pointed: dict[int, int] = {}
        for i in sorted(order[low : end + 1]):
            p = i - 1
            while p >= 0 and group[p] >= low:
                p = before[p]
            before[i] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        by_count: dict[int, list[int]] = {}
        for p, k in pointed.items():
            by_count.setdefault(k, []).append(p)
        for k in sorted(by_count, reverse=True):
            moved: dict[int, list[int]] = {}
            for p in by_count[k]:
                g = group[p]
                last = g + size[g] - 1
                a, j = place[p], order[last]
                order[a], order[last], place[j], place[p] = j, p, a, last
                size[g] -= 1
                moved.setdefault(g, []).append(p)
            for g, members in moved.items():
                new = g + size[g]
                size[new] = len(members)
                for p in members:
                    group[p] = new
        end = low - 1
    out = [-1] * n
    out[0] = n - 1
    head = list(range(n))
    placed = [False] * n
    placed[n - 1] = True
    for k in range(n):
        i = out[k] - 1
        while i >= 0 and not placed[i]:
            g = group[i]
            out[head[g]] = i
            head[g] += 1
            placed[i] = True
            i = before[i]
    return out[1:]
