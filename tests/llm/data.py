"""Small inputs with every awkward case, and brute-force versions."""

import random
import re
from collections import Counter, defaultdict

FOLD = str.maketrans({c: c + 32 for c in range(65, 91)})
STEMS = ["tal", "mor", "vin", "ser", "pol", "gra", "lum", "der", "ka", "no", "ri", "ste"]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(STEMS) for _ in range(rng.randint(1, 3))) for _ in range(n))


def documents() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars, n_words, id, rk, bucket): the last four clash
    with names that operators compute or use inside."""
    a, b, shared = prose(1, 120), prose(2, 90), prose(3, 70)
    near = a.split()
    near[60] = "Changed,"
    texts = [(1, a), (2, a), (3, " ".join(near)), (4, None), (5, ""), (6, "  \n\t "), (7, b + " " + shared),
             (8, shared.upper() + "\n" + prose(4, 40)), (9, prose(5, 30) + "\n" + shared), (9, prose(5, 30) + "\n" + shared),
             (10, "one two three"), (11, "One, two; three!"), (12, prose(6, 60_000)), (None, a), (None, None),
             (13, "é ü \U0001F600 " * 30), (14, "x " * 400), (15, a.replace(" ", "  \n")), (16, "x " * 300),
             (17, prose(7, 55) + " " + " ".join(a.split()[20:110]) + " " + prose(8, 55))]
    return [(i, t, "en", "s", None if t is None else len(t), 1, 2, 3, 4) for i, t in texts]


SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "n_words int, id int, rk int, bucket int")


def folded(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def plain(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingle_set(text):
    w = folded(text)
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def similarity(rows):
    """Per row: (class id, links) by comparing every pair that shares a shingle."""
    sets, at = [shingle_set(r[1]) for r in rows], defaultdict(list)
    for k, s in enumerate(sets):
        for g in s:
            at[g].append(k)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * len(rows)
    for k, s in enumerate(sets):
        for m, common in Counter(m for g in s for m in at[g] if m > k).items():
            if common >= 0.8 * (len(s) + len(sets[m]) - common) - 1e-9:
                links[k], links[m] = links[k] + 1, links[m] + 1
                root[max(find(k), find(m))] = min(find(k), find(m))
    ids = defaultdict(list)
    for k, r in enumerate(rows):
        ids[find(k)].append(r[0])
    least = {k: min([i for i in x if i is not None], default=None) for k, x in ids.items()}
    return [(least[find(k)], links[k]) for k in range(len(rows))]


def repeats(rows, n=50):
    """Per row: the kept words."""
    first = {}
    for i, t in ((r[0], r[1]) for r in rows):
        w = plain(t)
        for k in range(len(w) - n + 1):
            x = tuple(w[k:k + n])
            if i is not None:
                first[x] = min(first.get(x, i), i)
    out = []
    for i, t in ((r[0], r[1]) for r in rows):
        w, gone = plain(t), set()
        for k in range(len(w) - n + 1):
            if i is not None and first[tuple(w[k:k + n])] < i:
                gone.update(range(k, k + n))
        out.append([x for k, x in enumerate(w) if k not in gone])
    return out


def leaks(rows, items, n=10):
    """Per row: (hit words, item ids)."""
    wins = defaultdict(set)
    for i, t in items:
        w = folded(t)
        for k in range(max(len(w) - n, 0) + 1 if w else 0):
            wins[tuple(w[k:k + n])].add(i)
    out = []
    for r in rows:
        w, hit, found = folded(r[1]), set(), set()
        for m in {len(x) for x in wins}:
            for k in range(len(w) - m + 1):
                if (x := tuple(w[k:k + m])) in wins:
                    hit.update(range(k, k + m))
                    found |= {i for i in wins[x] if i is not None}
        out.append((len(hit), sorted(map(str, found))))
    return out
