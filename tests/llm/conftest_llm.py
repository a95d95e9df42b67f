"""Brute-force versions that several tests use."""


def shingle_set(text):
    words = (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).split()
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def brute_classes(rows):
    """(doc_id, n_shingles, component_id, kept) per row; rows of one id are one node."""
    sets = [shingle_set(t) for _, t in rows]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    live = [i for i, (d, _) in enumerate(rows) if d is not None and sets[i]]
    for n, i in enumerate(live):
        for j in live[:n]:
            common = len(sets[i] & sets[j])
            if 100 * common >= 75 * len(sets[i] | sets[j]):
                a, b = find(rows[i][0]), find(rows[j][0])
                parent[max(a, b)] = min(a, b)
    return [(d, len(s), find(d) if d is not None else None, d is None or find(d) == d) for (d, _), s in zip(rows, sets)]
