"""Small odd tables and brute-force versions shared by these tests."""

import collections
import re

_LOWER = {c: c + 32 for c in range(65, 91)}
#: Names that operators use inside; none may clash with a column of the input.
EXTRA = ("key", "h", "t", "pos", "rep", "bucket", "tokens", "rate", "__gone", "__draw", "digest", "lang2", "id", "a", "b")


def words(text):
    return re.findall("[0-9a-z\x80-\U0010ffff]+", (text or "").translate(_LOWER))


def documents(spark, rows, extra=True):
    """(doc_id, text, lang, source, n_chars) and columns with clashing names."""
    names = EXTRA if extra else ()
    full = [(i, t, lang, None, None if t is None else len(t), *["x"] * len(names)) for i, t, lang in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", `{n}` string" for n in names))


def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, rows without an id."""
    long = " ".join(f"w{k % 997} of the" for k in range(30_000))
    rows = [(1, "one two three\nfour", "en"), (1, "one two three\nfour", "en"), (2, None, "en"), (3, "", None), (None, "no id here\nat all", "en"), (None, "other text\nat all\nmore\nlines\nthan that", None), (None, None, None), (4, long, "en"), (5, long, "en"), (6, "\n \n\t", "de"), (7, "....", "en"), (8, "one", "en"), (9, "ONE", "en")]
    return documents(spark, rows)


def bag(text, n=2):
    w = words(text)
    return collections.Counter(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else collections.Counter([tuple(w)] if w else [])


def weighted_jaccard(x, y):
    both = sum(min(c, y[g]) for g, c in x.items() if g in y)
    return both / max(sum(x.values()) + sum(y.values()) - both, 1)


def near_groups(texts, threshold):
    """{doc_id: smallest id of its group} by all pairs."""
    bags = {i: b for i, t in texts.items() if (b := bag(t))}
    by = collections.defaultdict(set)
    for i, b in bags.items():
        for g in b:
            by[g].add(i)
    root = {i: i for i in bags}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, b in bags.items():
        for j in {j for g in b for j in by[g] if j > i}:
            if weighted_jaccard(b, bags[j]) >= threshold:
                a, c = sorted((find(i), find(j)))
                root[c] = a
    size = collections.Counter(find(i) for i in bags)
    return {i: find(i) for i in bags if size[find(i)] > 1}


def longest_match(doc, item):
    """(words, doc place, item place) of the longest common run; ties to the earliest in the document, then the item."""
    best = (0, 0, 0)
    row = [0] * (len(item) + 1)
    for i, x in enumerate(doc):
        new = [0] * (len(item) + 1)
        for j, y in enumerate(item):
            if x == y:
                n = new[j + 1] = row[j] + 1
                at = (-n, i - n + 1, j - n + 1)
                if at < (-best[0], best[1], best[2]) or not best[0]:
                    best = (n, i - n + 1, j - n + 1)
        row = new
    return best
