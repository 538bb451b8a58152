"""Plain versions of the operators for small tables."""

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, k):
    words = WORD.findall((text or "").translate(LOWER))
    if 0 < len(words) < k:
        return {tuple(words)}
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def jaccard_components(rows, k, num, den):
    """``(doc_id, n_shingles, component_id)`` by comparing every two rows."""
    sets = [shingle_set(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for t in s:
            holders[t].append(i)
    for i, s in enumerate(sets):
        for j in {j for t in s for j in holders[t] if j > i}:
            shared = len(s & sets[j])
            if den * shared >= num * len(s | sets[j]):
                root[find(j)] = find(i)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(
        ((doc, len(sets[i]), least.get(find(i))) for i, (doc, _) in enumerate(rows)), key=lambda r: tuple(map(str, r))
    )
