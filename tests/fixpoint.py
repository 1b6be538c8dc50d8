"""What a merge result must fulfil, checked on the finished labels."""

from collections import namedtuple

# the raw texts, their match keys (None: none) and the repository
Record = namedtuple("Record", "ord url doi title repo url_key doi_key title_key")


def record(order, url=None, doi=None, title=None, repo=None, keys=(None, None, None)):
    return Record(order, url, doi, title, repo, *keys)


def violations(records, labels):
    """Records whose label does not follow from the labels of all others.

    A cluster holds, per field, the value of its first member that has one, and from then on
    the key of that value, unless another cluster came to hold the key before.
    """
    held = {}  # (cluster, field) -> (since, key)
    for r in sorted(records):
        for field in ("url", "doi", "title", "repo"):
            if getattr(r, field) is not None:
                key = r.repo if field == "repo" else getattr(r, f"{field}_key")
                held.setdefault((labels[r.ord], field), (r.ord, key))
    owner = {}  # key -> (since, cluster)

    def claim(key, since, cluster):
        owner[key] = min(owner.get(key, (since, cluster)), (since, cluster))

    for cluster in set(labels.values()):
        for field in ("url", "doi"):
            since, key = held.get((cluster, field), (None, None))
            if key is not None:
                claim((field, key), since, cluster)
        title, repo = held.get((cluster, "title")), held.get((cluster, "repo"))
        if title and repo and title[1] is not None:
            claim(("title", title[1], repo[1]), max(title[0], repo[0]), cluster)
    wrong = []
    for r in records:
        asked = [("url", r.url_key), ("doi", r.doi_key), ("title", r.title_key, r.repo)]
        found = [owner[k] for k in asked if None not in k and k in owner and owner[k][0] < r.ord]
        if labels[r.ord] != (found[0][1] if found else r.ord):
            wrong.append((r, labels[r.ord], found))
    return wrong


def closure(records):
    """Transitive closure over shared keys -> {ord: smallest ord of the component}."""
    parent = {r.ord: r.ord for r in records}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    seen = {}
    for r in records:
        for k in (("url", r.url_key), ("doi", r.doi_key), ("title", r.title_key, r.repo)):
            if None not in k:
                a, b = sorted((root(seen.setdefault(k, r.ord)), root(r.ord)))
                parent[b] = a
    return {o: root(o) for o in parent}
