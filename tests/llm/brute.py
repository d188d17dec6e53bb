"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from itertools import combinations

LAST = 1 << 63

CLASHING = ["row", "size", "shard", "node", "label", "kept", "n_words", "block", "__id", "start", "piece", "place", "part", "odd name.x"]
"""Names that operators use themselves."""


def words(text):
    return (text or "").encode().split()


def substring_dedup(rows, width=13):
    """``rows`` of (doc_id, text); a null id comes last."""
    first = {}
    for doc, text in rows:
        w = words(text)
        for s in range(len(w) - width + 1):
            key = tuple(w[s : s + width])
            first[key] = min(first.get(key, LAST), LAST if doc is None else doc)
    result = []
    for doc, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for s in range(len(w) - width + 1):
            if first[tuple(w[s : s + width])] < (LAST if doc is None else doc):
                gone[s : s + width] = [True] * width
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        result.append((doc, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return result


def shingles(text, width):
    w = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if len(w) >= width:
        return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def near_duplicates(rows, width=4, percent=80):
    sets = [shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * len(sets[i] | sets[j]):
            parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), LAST), doc)
    result = []
    for i, (doc, _) in enumerate(rows):
        component = least.get(root(i), doc)
        result.append((doc, len(sets[i]), component, component == doc))
    return result


def repeats(w):
    """For each word, the longest run from there that is found elsewhere too."""
    longest = [0] * len(w)
    for i in range(len(w)):
        for j in range(len(w)):
            size = 0
            while i != j and max(i, j) + size < len(w) and w[i + size] == w[j + size]:
                size += 1
            longest[i] = max(longest[i], size)
    return longest


def quality(text, min_repeat=10):
    w = words(text)
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    repeated = set()
    for i in range(len(w) - 2):
        if windows[tuple(w[i : i + 3])] > 1:
            repeated |= {i, i + 1, i + 2}
    seen, duplicates = set(), 0
    for line in (text or "").encode().split(b"\n"):
        if line.split():
            duplicates += line in seen
            seen.add(line)
    longest = repeats(w)
    covered = {k for i, size in enumerate(longest) if size >= min_repeat for k in range(i, i + size)}
    return {
        "n_words": len(w),
        "word_chars": sum(len(x.decode()) for x in w),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": duplicates,
        "n_repeat_words": len(repeated),
        "base_failed": len(w) < 50 or 100 * len(repeated) > 50 * len(w),
        "n_covered": len(covered),
        "longest_repeat": max(longest, default=0),
    }


def sainte_lague(votes, seats):
    """Seats by highest quotients, one at a time; ties to the smaller key."""
    won = dict.fromkeys(votes, 0)
    for _ in range(seats):
        best = min(votes, key=lambda k: (-votes[k] / (2 * won[k] + 1), k))
        won[best] += 1
    return won


def water_filled(sizes, weights, most=3):
    """Targets by weight, at most ``most`` times the size, the excess shared again."""
    total, capped = sum(sizes.values()), {}
    while True:
        left = {s: w for s, w in weights.items() if s not in capped}
        if not left:
            return capped
        level = (total - sum(capped.values())) / sum(left.values())
        over = [s for s in left if level * left[s] >= most * sizes[s]]
        if not over:
            return capped | {s: level * w for s, w in left.items()}
        capped |= {s: most * sizes[s] for s in over}


def nearest(codes, queries, top):
    """``codes`` of (id, code), each id's distinct codes once."""
    result = []
    for query, own in sorted(set(queries)):
        found = sorted((bin((own ^ code) & (2**64 - 1)).count("1"), i) for i, code in set(codes) if i != query)
        result += [(query, rank, i, d) for rank, (d, i) in enumerate(found[:top], 1)]
    return result


def by_text(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        if text is not None:
            groups[text].append(doc)
    return groups
