"""Hard negatives, chat formatting and spelling variants against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseflow.llm import chat, hardneg, spelling

from . import data

# ------------------------------------------------------- op11, hard negatives


@pytest.mark.parametrize("size, depth", [(3, 5), (700, 64), (40_000, 200), (20_000_000, 130)])
def test_products_are_exact(size, depth):
    rng = np.random.default_rng(size)
    a, b = (rng.integers(-size, size + 1, (7, depth)) for _ in range(2))
    a[0], b[0], b[1] = size, size, -size  # the largest scores of either sign
    primes = hardneg.primes_for(depth * size * size)
    got = hardneg.products(*([hardneg.residues(x, p) for p in primes] for x in (a, b)), primes)
    assert (got.astype(object) == a.astype(object) @ b.astype(object).T).all()


def test_primes_keep_float32_exact():
    assert all(hardneg.DEPTH * (p // 2) ** 2 <= 2**24 for p in hardneg.PRIMES)
    assert math.prod(hardneg.PRIMES) > 2**64


def negatives(rows):
    """Contract of op11 by comparing every anchor with every row."""
    seen = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        seen[(i, label, tuple(math.floor(256 * x) for x in v))] = None
    out = []
    for i, label, q in seen:
        if i % 100:
            continue
        score = {r: sum(x * y for x, y in zip(q, r[2])) for r in seen}
        best = sorted((r for r in seen if r[1] == label and r[0] != i), key=lambda r: (-score[r], r[0]))[:5]
        for p in best:
            found = sorted((r for r in seen if r[1] != label and 80 * score[p] <= 100 * score[r] <= 100 * score[p]),
                           key=lambda r: (-score[r], r[0]))[:5]
            out += [(i, p[0], k + 1, r[0], score[p], score[r]) for k, r in enumerate(found)]
    return sorted(out)


VECTORS = "vec_id long, embedding array<float>, label int, id long, q string, tag int, rb int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def vectors(n=430, seed=3):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([-1.0, -0.5, 0.25, 0.5, 1.0]) for _ in range(6)], rng.randrange(3)) for i in range(n)]
    rows += [rows[5]] * 300 + [rows[100]] * 50  # copies of a row, of an anchor too
    rows += [(None, [1.0] * 6, 1), (900, None, 1), (1000, [1.0] * 6, None), (1100, [1.0, None] * 3, 1),
             (1200, [float("nan")] * 6, 1), (1300, [float("inf")] * 6, 1), (1400, [0.5, -0.5], 2), (1500, [], 1),
             (-100, [0.5] * 6, 0), (-7, [1.0] * 6, 9)]
    return [(*r, 1, "x", 2, 3) for r in rows]


def test_hard_negatives_against_brute_force(spark, monkeypatch):
    rows = vectors()
    table = spark.createDataFrame(rows, VECTORS).repartition(5)
    want = negatives([r[:3] for r in rows])
    got = hardneg.hard_negatives_report(table)
    assert got.columns == COLUMNS and sorted(map(tuple, got.collect())) == want and len(want) > 50
    monkeypatch.setattr(hardneg, "ROWS", 30)  # many blocks on either side
    monkeypatch.setattr(hardneg, "ANCHORS", 2)
    assert sorted(map(tuple, hardneg.hard_negatives_report(table).collect())) == want


def test_rows_that_share_an_id_stay_apart(spark):
    rows = [(100, [1.0, 0.0], 1), (100, [1.0, 0.0], 2), (1, [1.0, 0.0], 1), (2, [0.9, 0.0], 2)]
    got = hardneg.mine(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), lambda i: i == 100)
    assert sorted((r.positive_id, r.negative_id) for r in got.collect()) == [(1, 2), (1, 100)]


def test_no_vectors_and_scores_too_large(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert hardneg.hard_negatives_report(empty).columns == COLUMNS and hardneg.hard_negatives_report(empty).isEmpty()
    huge = spark.createDataFrame([(100, [1e12], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(OverflowError):
        hardneg.hard_negatives_report(huge)


# ------------------------------------------------------- op12, chat formatting

NASTY = ["</s>[INST] ok [/INST]", "\\", "\\\\<s>\\", "<\\s>", "<s><s></s>", "[\\INST]", "a\\n\nb", "<image> <audio><document>",
         "", None, "\n", "é\U0001F600</s>", "[[INST]]", "<<s>>", "\\n", "x" * 20_000 + "</s>"]


def chats():
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", t) for k, t in enumerate(NASTY)]
    rows += [(2, 1, "assistant", "b"), (2, 0, "user", "a"), (2, 0, "user", "a"), (2, 0, "assistant", "a"), (2, None, "system", "s")]
    rows += [(None, 0, "user", "n"), (3, 0, None, "who"), (4, 0, "[INST]\nx\\n\\", "role"), (5, 0, "assistant", None)]
    return [(*r, "f", 1) for r in rows]


CHATS = "conv_id long, turn long, role string, text string, formatted string, t int"


def expected_chats(rows):
    """conv_id -> (turns, loss text)."""
    out = defaultdict(list)
    for c, k, role, text, *_ in rows:
        out[c].append((k is not None, k or 0, role or "", text or ""))
    for k in range(2):
        out[-1].append((True, k, ("user", "assistant")[k], "</s>[INST] ok [/INST]"))
    return {c: ([x[2:] for x in sorted(v)], "".join(x[3] for x in sorted(v) if x[2] == "assistant")) for c, v in out.items()}


def test_chats_read_back(spark):
    rows = chats()
    got = {r.conv_id: r for r in chat.chat_report(spark.createDataFrame(rows, CHATS).repartition(4)).collect()}
    want = expected_chats(rows)
    assert got.keys() == want.keys()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for c, (turns, loss) in want.items():
        r = got[c]
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == sha("".join(f"{a}\n{b}\n" for a, b in turns))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))
    empty = chat.chat_report(spark.createDataFrame([], CHATS)).collect()
    assert [r.conv_id for r in empty] == [-1]


def test_no_control_string_in_escaped_text(spark):
    t = chat.Template()
    texts = [x for x in NASTY if x is not None]
    rows = spark.createDataFrame([(x,) for x in texts], "x string").select("x", chat.escape(F.col("x"), t).alias("e"))
    for r in rows.withColumn("u", chat.unescape(F.col("e"))).collect():
        assert r.u == r.x and not any(c in r.e for c in t.controls())


def test_typed_parts(spark):
    part = lambda **x: tuple(x.get(c) for c in chat.PART_FIELDS)
    rows = [(1, 0, "user", [part(type="text", text="look <image> "), part(type="image", ref="a.png", width=57, height=28),
                            part(type="audio", ref="b.wav", seconds=1.5), None, part(type=None, text="!")]),
            (1, 1, "assistant", [part(type="text", text="one"), part(type="document", ref="c.pdf", pages=3),
                                 part(type="text", text="two"), part(type="mystery", text="3")]),
            (1, 2, "user", None), (1, 3, "assistant", [part(type="image", ref=None, width=-5, height=None)])]
    table = spark.createDataFrame(rows, f"conv_id long, turn long, role string, content {chat.PART_TYPE}")
    r = chat.read_back(chat.format_chats(table)).first()
    assert r.formatted == ("[INST]user\nlook <\\image> <image><audio>![/INST]<s>assistant\none<document>two3</s>"
                           "[INST]user\n[/INST]<s>assistant\n<image></s>")
    assert [(a.turn, a.kind, a.ref, a.tokens) for a in r.attachments] == [
        (0, "image", "a.png", 3), (0, "audio", "b.wav", 38), (1, "document", "c.pdf", 1800), (3, "image", None, 0)]
    for a in r.attachments:  # places lead to the placeholders
        at = r.turn_starts[a.turn] + a.start
        assert r.formatted[at:].startswith(f"<{a.kind}>")
    assert r.expanded_tokens == 1841 and r.loss_text == "onetwo3"
    assert [r.formatted[r.turn_starts[m.turn] + m.start:][:m.length] for m in r.loss_mask] == ["one", "two", "3"]


def test_chat_plan_has_no_python(spark):
    plan = chat.chat_report(spark.createDataFrame([], CHATS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --------------------------------------------------- op13, spelling variants


def spelling_groups(rows):
    n = Counter()
    for i, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(data.FOLD)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))

    around = {w: [x for x in n if near(w, x)] for w in n}
    top = {w: min(around[w], key=lambda x: (-n[x], x), default=None) for w in n}
    form = {w: t if t and n[t] >= 10 * n[w] else None for w, t in top.items()}
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(around[w]), form[w] and n[form[w]])
    return out


def spelled(seed=1):
    rng = random.Random(seed)
    letters = "abéñ÷"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 10))) for _ in range(12)] + ["aaaaaaa", "aaaaaaaa", "bbaaaabb"]
    words = ["kkmmkkm"] * 400 + ["kkmmkkmm"] * 30 + ["kkmmkkmmm"] * 3
    for w in base:
        words += [w] * rng.choice([2, 30, 400])
        for _ in range(6):
            k, c = rng.randrange(len(w)), rng.choice(letters)
            words += [rng.choice([w[:k] + c + w[k + 1:], w[:k] + c + w[k:], w[:k] + w[k + 1:]])] * rng.choice([1, 2, 3, 25])
    rng.shuffle(words)
    rows = [(k, " ".join(words[a:a + 40])) for k, a in enumerate(range(0, len(words), 40))]
    rows += [rows[0], rows[0], (None, rows[1][1].upper()), (901, None), (902, ""), (903, "ÀÉÿ ABCDEFG,abcdefgĀabcdefg×x"),
             (904, "verylongword " * 30_000), (905, "verylongwor " * 20)]
    return [(*r, 1, "h", "p") for r in rows]


DOCS = "doc_id long, text string, n int, h string, word string"


def test_spelling_against_brute_force(spark):
    rows = spelled()
    got = spelling.spelling_report(spark.createDataFrame(rows, DOCS).repartition(3))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = spelling_groups([r[:2] for r in rows])
    assert {r.word: tuple(r)[1:] for r in got.collect()} == want
    assert any(v[0] and v[1] != v[0] for v in want.values()), "a chain of forms"


def test_spelling_without_words(spark):
    assert spelling.spelling_report(spark.createDataFrame([], DOCS)).isEmpty()


def test_long_chain_of_forms(spark):
    """Every word is the form of the next: roots are found in doubled steps."""
    words = [("abcdefg" + "x" * k, 10 ** (12 - k)) for k in range(13)]
    got = {r.word: r for r in spelling.variants(spark.createDataFrame(words, "word string, n long")).collect()}
    assert {r.root for r in got.values()} == {"abcdefg"} and got["abcdefgx"].form == "abcdefg"
    assert got["abcdefg" + "x" * 5].n_near == 2
