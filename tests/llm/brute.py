"""Plain Python versions of the operators, for small inputs."""

import collections
import hashlib
import math
import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def contamination(docs, items, k=10):
    """[(id, n_words, n_hit, n_items, items_sha256, contaminated)]"""
    windows = collections.defaultdict(set)
    for name, text in items:
        words = WORDS.findall(lower(text))
        for j in range(max(1, len(words) - k + 1) if words else 0):
            windows[tuple(words[j : j + k])].add("" if name is None else str(name))
    out = []
    for id_, text in docs:
        words = WORDS.findall(lower(text))
        hit, names = set(), set()
        for size in {len(w) for w in windows}:
            for j in range(len(words) - size + 1):
                found = windows.get(tuple(words[j : j + size]))
                if found:
                    names |= found
                    hit |= set(range(j, j + size))
        out.append((id_, len(words), len(hit), len(names), sha(",".join(sorted(names))), bool(hit)))
    return out


def linked(docs, k=4, percent=85):
    """[(id, n_shingles, component)] with ids that differ."""
    sets, owners, parent = {}, collections.defaultdict(list), {}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for id_, text in docs:
        words = SPACED.findall(lower(text))
        sets[id_] = {tuple(words[j : j + k]) for j in range(max(1, len(words) - k + 1))} if words else set()
        parent[id_] = id_
    for id_ in sorted(sets):
        common = collections.Counter(o for s in sets[id_] for o in owners[s])
        for other, n in common.items():
            if 100 * n >= percent * (len(sets[id_]) + len(sets[other]) - n):
                a, b = sorted((root(id_), root(other)))
                parent[b] = a
        for s in sets[id_]:
            owners[s].append(id_)
    return [(id_, len(sets[id_]), root(id_)) for id_ in sets]


def without_repeats(docs, k=13):
    """[(id, n_words, n_removed, kept_sha256)]; a NULL id comes last."""
    rank = lambda id_: math.inf if id_ is None else id_
    split = [(rank(id_), SPACED.findall(text or "")) for id_, text in docs]
    first = {}
    for id_, words in split:
        for j in range(len(words) - k + 1):
            w = tuple(words[j : j + k])
            first[w] = min(first.get(w, math.inf), id_)
    out = []
    for (shown, _), (id_, words) in zip(docs, split):
        gone = set()
        for j in range(len(words) - k + 1):
            if first[tuple(words[j : j + k])] < id_:
                gone |= set(range(j, j + k))
        out.append((shown, len(words), len(gone), sha(" ".join(w for i, w in enumerate(words) if i not in gone))))
    return out


def poisson(seed, id_, text, rate):
    """Copies of a document, by inversion at the number the md5 of its id and text gives."""
    who = f"{'' if id_ is None else id_}:{hashlib.md5((text or '').encode()).hexdigest()}"
    pieces = max(1, math.ceil(rate / 256.0))
    mean, total = rate / pieces, 0
    for j in range(1, pieces + 1):
        u = (int(hashlib.md5(f"{seed}:{who}:{j}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        k, p, c = 0, math.exp(-mean), math.exp(-mean)
        while c < u and k < 10_000:
            k += 1
            p *= mean / k
            c += p
        total += k
    return total
