"""Plain versions of the operators, for small inputs."""

import re
from collections import Counter, defaultdict


def words(text):
    return re.findall("[^ \t-\r]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def shingle_set(text, width):
    own = words(text)
    if len(own) < width:
        return frozenset([tuple(own)] if own else [])
    return frozenset(tuple(own[i:i + width]) for i in range(len(own) - width + 1))


def groups(rows, width, percent):
    """``(id, set size, smallest id of the group)`` per row ``(id, text)``."""
    sets = [shingle_set(text, width) for _, text in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, own in enumerate(sets):
        shared = Counter(j for x in own for j in holders[x])
        for j, n in shared.items():
            if 100 * n >= percent * (len(own) + len(sets[j]) - n):
                parent[root(i)] = root(j)
        for x in own:
            holders[x].append(i)
    members = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        if key is not None:
            members[root(i)].append(key)
    return [(key, len(sets[i]), min(members[root(i)], default=None)) for i, (key, _) in enumerate(rows)]


def base_counts(text):
    """Words, their characters, symbols, repeated lines, words in repeated 8-word windows."""
    text = text or ""
    own = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [tuple(own[i:i + 8]) for i in range(len(own) - 7)]
    often, covered = Counter(runs), set()
    for i, run in enumerate(runs):
        if often[run] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def greedy_tiles(doc, item, least):
    doc_free, item_free, found = [True] * len(doc), [True] * len(item), []
    while True:
        best = None
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while (i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n]
                       and item_free[i + n] and doc_free[j + n]):
                    n += 1
                if n >= least and (best is None or (-n, i, j) < best):
                    best = (-n, i, j)
        if best is None:
            return found
        n, i, j = best
        found.append((i, j, -n))
        for k in range(-n):
            item_free[i + k] = doc_free[j + k] = False


def segmentations(vocabulary, text, n):
    """The ``n`` best of all segmentations of escaped ``text``: (score, ids)."""
    known = {piece: i for i, piece in enumerate(vocabulary.text) if i > 2 and i not in vocabulary.byte_of}
    found = []

    def back(end, starts, ids, score):
        if end == 0:
            found.append((-score, starts, ids[::-1]))
        for start in range(max(0, end - vocabulary.longest), end):
            part = text[start:end]
            if part in known:
                back(start, (*starts, start), [*ids, known[part]], score + float(vocabulary.score[known[part]]))
            elif end - start == 1:
                spelled = [int(vocabulary.byte_ids[b]) for b in part.encode()][::-1]
                back(start, (*starts, start), [*ids, *spelled], score + vocabulary.unknown)

    back(len(text), (), [], 0.0)
    return [(-score, ids) for score, _, ids in sorted(found, key=lambda x: x[:2])[:n]]
