"""Plain forms that the tests compare with."""


def words_of(text):
    """Words by the rule of the contracts: bytes split at space and 0x09-0x0D, A-Z lower-cased."""
    return [] if text is None else text.encode().lower().split()


def components_of(nodes, links):
    """Smallest node that links reach, per node."""
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}
