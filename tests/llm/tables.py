"""Small tables with everything odd in them, and plain counterparts of words and lines."""

import random
import re

BLANK = "[\x20\x09-\x0d]+"
COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long, id long, label string, node long, h1 long, pos int, "
    "size string, shard string, component_id string, score string, predicted string, times int, nth int, epoch string, `a.b` int"
)
EXTRA = (5, "x", 7, 8, 9, "s", "t", "u", "v", "w", 3, 4, "e", 1)


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split(BLANK, lowered) if w]


def plain_words(text):
    """Runs of ASCII letters, digits and non-ASCII characters."""
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[0-9a-z\u0080-\U0010ffff]+", lowered)


def frame(spark, rows):
    """rows of (doc_id, text, lang, source) with extra columns of clashing names."""
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), *EXTRA) for r in rows], COLUMNS)


def sentence(rng, n, vocabulary=400):
    return " ".join(f"{rng.choice('abcdefghij')}{rng.randrange(vocabulary)}w" for _ in range(n))


def odd_rows(seed=1, groups=6, copies=6):
    """Chains of near copies, exact copies, nulls, empties, blanks, long texts, repeated rows."""
    rng = random.Random(seed)
    rows, i = [], 100
    for _ in range(groups):
        text = sentence(rng, rng.choice([3, 8, 30, 120])).split()
        for _ in range(copies):
            rows.append((i, " ".join(text), rng.choice(["en", "de", None]), rng.choice(["src0", "src1", None])))
            i += rng.choice([1, 3, -2])
            if rng.random() < 0.7:
                text = list(text)
                text[rng.randrange(len(text))] = f"Z{rng.randrange(9)}"
    i = max(r[0] for r in rows) + 1
    rows += [
        (i, None, "en", "src0"), (i + 1, "", None, None), (i + 2, " \n\t ", "de", "src3"), (i + 3, "one", "en", "src1"),
        (i + 4, "\n\n\n", "en", "src2"), (i + 5, sentence(rng, 30000), "en", "src0"), (i + 6, "Ä ö ü 中文 é 🙂 ÄÖ", "fr", "src9"),
    ]
    rows += [rows[0], rows[0], (rows[1][0], rows[1][1], "xx", "src5")]
    return rows


class Forest:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def root(self, n):
        while self.up[n] != n:
            n = self.up[n]
        return n

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def shingles(text, k):
    w = words(text)
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def jaccard_brute(rows, k, percent):
    """{(doc_id, text): (n, component)} by all pairs."""
    sets = [(r[0], shingles(r[1], k)) for r in rows]
    forest = Forest({i for i, _ in sets if i is not None})
    for x, (a, s) in enumerate(sets):
        for b, t in sets[:x]:
            if s and t and a is not None and b is not None and 100 * len(s & t) >= percent * len(s | t):
                forest.join(a, b)
    return [(i, len(s), None if i is None else forest.root(i)) for i, s in sets]
