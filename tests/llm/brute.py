"""Plain versions of the corpus operators, for small inputs."""

import re

WHITE = " \t\n\x0b\x0c\r"


def ascii_lower(text):
    return text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def gram_set(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def closed(nodes, links):
    """The smallest node that each node reaches."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def jaccard_links(rows, width=5, percent=80):
    """Pairs of positions among the rows with an id."""
    sets = [(i, gram_set(t, width)) for i, t in rows if i is not None]
    by_gram = {}
    for k, (_, s) in enumerate(sets):
        for g in s:
            by_gram.setdefault(g, []).append(k)
    shared = {}
    for ks in by_gram.values():
        for x in range(len(ks)):
            for y in range(x):
                pair = (ks[y], ks[x])
                shared[pair] = shared.get(pair, 0) + 1
    return sets, [(a, b) for (a, b), o in shared.items() if 100 * o >= percent * (len(sets[a][1]) + len(sets[b][1]) - o)]


def jaccard_components(rows, width=5, percent=80):
    sets, links = jaccard_links(rows, width, percent)
    return closed({i for i, _ in sets}, [(sets[a][0], sets[b][0]) for a, b in links])


def jaccard_link_counts(rows, width=5, percent=80):
    """Of each id: the other ids linked to it directly."""
    sets, links = jaccard_links(rows, width, percent)
    near = {i: set() for i, _ in sets}
    for a, b in links:
        a, b = sets[a][0], sets[b][0]
        near[a] |= {b} - {a}
        near[b] |= {a} - {b}
    return {i: len(n) for i, n in near.items()}


def dedup_lines(rows, min_chars=10):
    owner = {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        for line in (t or "").split("\n"):
            key = ascii_lower(line.strip(WHITE))
            if len(key) >= min_chars:
                owner.setdefault(key, i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or owner.get(ascii_lower(x.strip(WHITE)), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def best_fit_decreasing(sizes, capacity):
    """The number of bins that best fit takes, from large to small."""
    gaps, bins = [0] * (capacity + 1), 0
    for s in sorted(sizes, reverse=True):
        g = next((g for g in range(s, capacity) if gaps[g]), None)
        if g is None:
            bins, g = bins + 1, capacity
        else:
            gaps[g] -= 1
        gaps[g - s] += 1
    return bins
