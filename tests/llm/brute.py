"""Plain Python versions of the operators that SQL cannot express."""

from collections import Counter

from .conftest import WORD


def base_measures(text):
    w = WORD.findall(text or "")
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = set()
    for i in range(len(w) - 7):
        if windows[tuple(w[i:i + 8])] > 1:
            covered.update(range(i, i + 8))
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered))


_LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text, k):
    w = [x.translate(_LOWER) for x in WORD.findall(text or "")]
    return frozenset(tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()


def roots(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def jaccard(rows, k, percent):
    """(doc_id, n_shingles, component_id) by comparing every pair that shares a shingle."""
    sets = {i: shingles(t, k) for i, t in rows}
    having = {}
    for i, s in sets.items():
        for g in s:
            having.setdefault(g, []).append(i)
    links = []
    for i, s in sets.items():
        for j, n in Counter(x for g in s for x in having[g] if x > i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                links.append((i, j))
    root = roots(sets, links)
    return sorted((i, len(s), root[i]) for i, s in sets.items())


def line_dedup(rows):
    """(doc_id, text) after removing later occurrences of three-line windows."""
    first, cover = {}, {}
    for i, text in sorted(rows):
        lines = (text or "").split("\n")
        solid = [k for k, x in enumerate(lines) if WORD.search(x)]
        for j in range(len(solid) - 2):
            window = tuple(lines[solid[j + k]] for k in range(3))
            if first.setdefault(window, (i, j)) != (i, j):
                cover.setdefault(i, set()).update(solid[j:j + 3])
    return [(i, t if i not in cover else
             "\n".join(x for k, x in enumerate(t.split("\n")) if k not in cover[i]), len(cover.get(i, ())))
            for i, t in rows]
