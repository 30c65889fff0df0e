"""Brute-force versions that the operators are held against."""

from collections import Counter, defaultdict

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def documents(spark, rows):
    """(doc_id, text) rows with the other columns of the table."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def shingles(text, n=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def near_classes(rows, percent=80):
    """{row index: (set size, smallest doc_id reachable)} by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        ids[find(i)].append(doc_id)
    return [(len(s), min(x for x in ids[find(i)] if x is not None) if s else rows[i][0]) for i, s in enumerate(sets)]


def counted(rows):
    return Counter(map(tuple, rows))
