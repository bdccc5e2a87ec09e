"""Documents that operators must bear, and plain versions of what they compute."""

import random
import re

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Names that operators use for columns of their own.
CLASHES = ("row", "key", "run", "order", "id", "before", "inside", "start", "s1", "r1", "times", "shape", "k1", "k2", "__k1", "__k2", "__spans", "__uid", "__run", "spans", "uid", "at", "n_words", "hash", "a.b", "with `tick`")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def odd_rows():
    """Nulls, blanks, very long texts, ties and repeated rows."""
    rng = random.Random(5)
    vocab = ["the", "cat", "sät", "on", "a", "mat", "with", "日本語", "x1", "Über"]
    sentence = lambda n: " ".join(rng.choice(vocab) + rng.choice(["", "", str(rng.randint(0, 99))]) for _ in range(n))
    base = sentence(120)
    texts = [None, "", " \t\n", "one", "two words", "a b c", "A B C", "\x0b.\x0c", base, base, base + " tail", base.upper(), "x " + base, sentence(30_000), "z" * 300_000, "日本語。", "123 456", "\x1c\x1d", "é😀 ü", sentence(80) + "\n" + sentence(10)]
    rows = [(i, t, ["en", "de", None, "fr"][i % 4], ["s1", None, "s2"][i % 3], None if t is None else len(t)) for i, t in enumerate(texts)]
    return rows + [rows[8], rows[3], (None, base, None, None, 1), (None, None, None, None, None)]


def shingles(text, k):
    w = WORD.findall(lower(text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def similar_components(rows, k, percent=80):
    """{doc_id: least id reachable} by comparing all pairs."""
    sets = [(i, shingles(t, k)) for i, t, *_ in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[n + 1 :]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in parent}
