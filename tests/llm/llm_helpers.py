"""Small tables with the awkward rows that every operator must take."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
AWKWARD = [
    None,
    "",
    " \n\t ",
    "one",
    "Two words",
    "▁ ▁▁ mark",
    "a\x00b c\x00",
    "日本語 テキスト 🎉 é̀ ß",
    "line one\nline one\n\nline one\r\n",
    "x" * 3000,
    "same same same same " * 2000,
    "1234 5678 !!! ???",
]


def prose(seed, n, vocabulary=4000):
    """Made words; those of one seed are the same each time."""
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(vocabulary)}{pick.choice('abcdef')}" for _ in range(n))


def edit(text, seed, changes):
    pick, words = random.Random(seed), text.split(" ")
    for _ in range(changes):
        words[pick.randrange(len(words))] = f"new{pick.randrange(10**6)}"
    return " ".join(words)


def scattered():
    """Texts 2, 5, 8 and 11 share a passage of 100 words with the two that follow each, edited at every 15th; 0, 1 and the last two have its parts apart."""
    wholes = [prose(9000 + k, 100).split() for k in range(4)]
    parts = [" ".join(w[n : n + 24]) for w in wholes for n in range(0, 100, 10)]
    texts = [" ".join(f"{part} {prose(9100 + 100 * d + n, 100)}" for n, part in enumerate(parts)) for d in range(4)]
    inner = []
    for k, whole in enumerate(wholes):
        for n in range(3):
            words = [f"new{k}{n}{i}" if n and i % 15 == 7 * n - 4 else w for i, w in enumerate(whole)]
            inner.append(f"{prose(9600 + 3 * k + n, 40)} {' '.join(words)} {prose(9700 + 3 * k + n, 40)}")
    return [*texts[:2], *inner, *texts[2:]]


def documents(spark, texts, langs=None, ids=None):
    """``documents`` with extra columns whose names the operators use inside."""
    ids = ids or list(range(len(texts)))
    langs = langs or ["en"] * len(texts)
    rows = [(i, t, g, None if i is None or i % 3 else "s", None, 1, "x", 2, 3.0, "y") for i, t, g in zip(ids, texts, langs, strict=True)]
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, "
        "node long, value string, row int, score double, packed string"
    )
    return spark.createDataFrame(rows, schema).repartition(3)


def by_id(frame):
    return {r["doc_id"]: r for r in frame.collect()}


def joined(pairs):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {x: root(x) for x in list(parent)}


def shingles(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def near(texts):
    sets = [shingles(t) for t in texts]
    pairs = [(k, k) for k in range(len(sets))]
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                pairs.append((a, b))
    return sets, joined(pairs)
