import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from caseflow.llm import decontaminate, flat, jaccard, language, packing, quality, rules, substring, tokens, toxicity

from . import data

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(data.documents(), data.SCHEMA)


def test_words_are_the_same_as_by_pattern():
    texts = ["Aé b\x00c\x7fd", "", None, "x-Y_z 12€", "  ", "\x0b\x1c q"]
    for table, cut in ((flat.FOLDED, data.folded), (flat.PLAIN, data.plain)):
        w = flat.words(pa.array(texts), table)
        raw = (flat.FOLDED[w.raw] if table is flat.FOLDED else w.raw).tobytes()
        for i, t in enumerate(texts):
            own = [raw[s:e].decode() for s, e in zip(w.start[w.first[i]:w.first[i + 1]], w.end[w.first[i]:w.first[i + 1]])]
            assert own == cut(t)


def test_hash_index_finds_what_it_was_given():
    keys = np.unique(flat.mix(np.arange(50_000, dtype=np.uint64)))
    index = flat.HashIndex(4)
    index.add(keys[:30_000], np.arange(30_000, dtype=np.int32))
    index.add(keys[30_000:40_000], np.arange(30_000, 40_000, dtype=np.int32))
    got = index.get(keys)
    assert (got[:40_000] == np.arange(40_000)).all() and (got[40_000:] == -1).all()


def test_similarity_against_all_pairs(spark, docs):
    rows = data.documents()
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in jaccard.similarity_classes(docs).collect()), key=str)
    want = sorted(((r[0], *x) for r, x in zip(rows, data.similarity(rows))), key=str)
    assert got == want
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    assert kept.where("doc_id in (2, 3)").isEmpty() and kept.where("doc_id = 9").count() == 1
    assert kept.where("text is null").count() == 2


def test_large_buckets_and_blocks(spark, monkeypatch):
    """A group larger than a bucket, a block and a part: no link is lost."""
    base = data.prose(40, 150).split()
    rows = []
    for i in range(90):
        w = list(base)
        w[(i * 7) % 140] = f"w{i}"
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(jaccard, "SMALL", 8)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 2500)
    got = jaccard.similarity_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    want = {r[0]: x for r, x in zip(rows, data.similarity(rows))}
    assert {r.doc_id: (r.class_id, r.n_links) for r in got.collect()} == want


@pytest.mark.parametrize("change", [14, 60])
def test_candidate_groups_against_all_pairs(spark, monkeypatch, change):
    """Buckets of several blocks whose sets form one chain, several groups or none: blocks and strays
    tie what all pairs of a bucket tie."""
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rng = np.random.default_rng(change)
    marks = rng.integers(1, 256, (150, jaccard.SKETCH), dtype=np.uint8)
    for i in range(1, 120):
        if i % 40:  # three chains of 40 sets, the others are alone
            marks[i] = marks[i - 1]
            marks[i, rng.permutation(jaccard.SKETCH)[:change if i % 7 else 14]] = rng.integers(1, 256)
    uid = rng.permutation(1000)[:150]
    members = {b: sorted(rng.permutation(150)[:n].tolist()) for b, n in ((1, 150), (2, 60), (3, 10), (4, 2))}
    root = {int(u): int(u) for u in uid}

    def top(u):
        while root[u] != u:
            u = root[u]
        return u

    for inside in members.values():
        for x, i in enumerate(inside):
            for j in inside[x + 1:]:
                if jaccard._alike(marks[[i]], marks[[j]], jaccard.THRESHOLD - jaccard.MARGIN)[0]:
                    a, b = sorted((top(int(uid[i])), top(int(uid[j]))))
                    root[b] = a
    leaves = spark.createDataFrame([(b, int(uid[i]), len(inside), int(min(uid[inside]))) for b, inside in members.items()
                                    for i in inside], "bucket long, uid long, size long, least long")
    sets = spark.createDataFrame([(int(u), bytearray(m.tobytes())) for u, m in zip(uid, marks)], "uid long, sketch binary")
    got = {r.v: r.root for r in jaccard.candidate_groups(leaves, sets, jaccard.THRESHOLD).collect()}
    assert {u: got.get(u, u) for u in root} == {u: top(u) for u in root}
    assert len(set(map(top, root))) > 3


def test_runs_find_truncated_copies(spark):
    """Sets of 50 shingles and their first 40 (J = 0.8) that share a path of all three levels in no run."""
    assert (1 - (1 - np.exp(-1)) ** jaccard.LEVELS) ** jaccard.runs_for() <= 1 - jaccard.RECALL
    n = 20_000
    rows = spark.range(2 * n, numPartitions=16).selectExpr(
        "id", "array_join(transform(sequence(1, if(id % 2 = 0, 54, 44)), k -> concat('w', id div 2, 'x', k)), ' ') AS text")
    sets = jaccard.set_table(rows, "id", "text", jaccard.THRESHOLD, jaccard.runs_for())
    runs = [f"transform(array_intersect(a.c{k}, b.c{k}), x -> shiftright(x, 32))" for k in (1, 2, 3)]
    missed = sets.alias("a").join(sets.alias("b"), F.expr("a.id % 2 = 0 AND b.id = a.id + 1")) \
        .where(f"NOT arrays_overlap(array_intersect({runs[0]}, {runs[1]}), {runs[2]})").count()
    assert missed <= 2 * n * (1 - jaccard.RECALL)


def test_truncated_copies_in_a_large_bucket(spark, monkeypatch):
    base = data.prose(41, 104).split()
    rows = [(0, " ".join(base))] + [(i, " ".join(base[i % 21:i % 21 + 83 + i // 21])) for i in range(1, 63)]
    monkeypatch.setattr(jaccard, "SMALL", 8)
    got = jaccard.similarity_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    want = {r[0]: x for r, x in zip(rows, data.similarity(rows))}
    assert {r.doc_id: (r.class_id, r.n_links) for r in got.collect()} == want


def test_repeats_against_brute_force(docs):
    rows = data.documents()
    want = sorted(((r[0], len(data.plain(r[1])), " ".join(x)) for r, x in zip(rows, data.repeats(rows))), key=str)
    out = substring.remove_repeats(docs).collect()
    assert sorted(((r.doc_id, r.n_words, r.kept) for r in out), key=str) == want
    for r in out:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
    same = substring.remove_repeats(docs, keep=["doc_id", "source"], as_is=True)
    assert same.where("n_removed = 0 and doc_id = 13").first().kept == "é ü \U0001F600 " * 30


@pytest.mark.parametrize("per_pass", [1_000_000, 30])
def test_leaks_against_brute_force(spark, docs, per_pass):
    rows = data.documents()
    a = data.prose(1, 120).split()
    items = [(1, " ".join(a[5:30])), (2, "ONE two"), (3, None), (4, ""), (5, data.prose(99, 20)), (None, " ".join(a[70:85])),
             (6, " ".join(a[5:30]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.decontaminate(docs, bench, patterns_per_pass=per_pass).collect()
    assert sorted(((r.doc_id, r.n_hit, r["items"]) for r in got), key=str) == \
        sorted(((r[0], *x) for r, x in zip(rows, data.leaks(rows, items))), key=str)


def test_empty_tables(spark, docs):
    none, items = docs.limit(0), spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert jaccard.join_report(none).isEmpty()
    assert substring.dedup_report(none).isEmpty()
    assert decontaminate.contamination_report(none, items).isEmpty()
    assert decontaminate.contamination_report(docs, items).where("contaminated").isEmpty()
    assert rules.rules_report(none).isEmpty()
    assert packing.pack_report(none).isEmpty()
    assert toxicity.toxicity_report(none, labels).isEmpty()
    assert toxicity.toxicity_report(docs, labels).where("rejected").isEmpty()
    assert quality.quality_report(docs, labels).where("score != 0.5").isEmpty()
    assert language.language_report(none).isEmpty()
    assert language.language_report(docs.selectExpr("doc_id", "text", "cast(null as string) as lang")) \
        .where("lang_pred != 'und'").isEmpty()


def test_rules_counts(docs):
    rows = data.documents()
    want = []
    for r in rows:
        t, w = r[1] or "", data.plain(r[1])
        lines = [x for x in t.split("\n") if data.plain(x)]
        wins = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
        many = {x for x, n in Counter(wins).items() if n > 1}
        covered = {j for k, x in enumerate(wins) if x in many for j in range(k, k + 3)}
        want.append((r[0], len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)),
                     len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w)))
    got = rules.rules_report(docs).collect()
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                   for r in got), key=str) == sorted(want, key=str)
    assert not any(r.kept for r in got if r.base_failed)


def test_rules_agree_with_the_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{x}.parquet") for x in ("documents", "labels"))
    out = rules.rules_report(docs).withColumnRenamed("quality", "posterior").join(labels, "doc_id").toPandas()
    open_ = out[~out.base_failed]
    assert (open_.kept == (open_["quality"] == 1)).mean() > 0.98


def test_weak_supervision_recovers_rule_accuracy():
    rng = np.random.default_rng(3)
    good = rng.random(20_000) < 0.8
    votes = {}
    accuracy = [0.9, 0.8, 0.7, 0.95]
    for y in good:
        p = "".join("-" if rng.random() < 0.1 else "g" if (rng.random() < a) == y else "b" for a in accuracy)
        votes[p] = votes.get(p, 0) + 1
    share, odds = rules.estimate(votes, 4)
    assert abs(share - 0.8) < 0.05
    assert odds[3]["g"] > odds[0]["g"] > odds[1]["g"] > odds[2]["g"] > 0 > odds[3]["b"]


def test_chain_feeds_earlier_probabilities(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{x}.parquet") for x in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    assert [len(m["dense"]) for m in model["models"]] == [0, 1, 2, 3]
    out = toxicity.toxicity_report(docs, labels).join(labels, "doc_id").where("held_out")
    hit = out.where("toxic = 1 and rejected").count()
    assert hit >= 0.5 * out.where("toxic = 1").count()
    assert out.where("toxic = 0 and rejected").count() <= 0.02 * out.where("toxic = 0").count()


def test_factorisation_identity():
    rng = np.random.default_rng(1)
    model = {"bias": 0.1, "linear": rng.normal(size=quality.N_INPUTS) * 0.1,
             "factors": rng.normal(size=(quality.RANK, quality.N_INPUTS)) * 0.1}
    column, value = np.array([3, 77, 65_540]), np.array([0.5, 0.2, 1.0])
    z = 0.1 + sum(model["linear"][c] * v for c, v in zip(column, value))
    for i in range(3):
        for j in range(i + 1, 3):
            z += model["factors"][:, column[i]] @ model["factors"][:, column[j]] * value[i] * value[j]
    got = quality.scores(model, np.zeros(3, np.int64), column, value, 1)
    assert np.allclose(got, 1 / (1 + np.exp(-z)))


def test_quality_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{x}.parquet") for x in ("documents", "labels"))
    out = quality.quality_report(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (out.predicted == out["quality"]).mean() > 0.9
    assert out.score.between(0, 1).all()


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(5)
    log, move = rng.normal(size=(7, 3)), rng.normal(size=(3, 3))
    begin, size = np.array([0, 4]), np.array([4, 3])
    post, pairs = language.forward_backward(log, begin, size, move, pairs=True)
    want, want_pairs = np.zeros((7, 3)), np.zeros((3, 3))
    for b, n in zip(begin, size):
        total, own, own_pairs = 0.0, np.zeros((n, 3)), np.zeros((3, 3))
        for path in np.ndindex(*[3] * n):
            p = np.exp(sum(log[b + t, s] for t, s in enumerate(path)) + sum(move[i, j] for i, j in zip(path, path[1:])))
            total += p
            for t, s in enumerate(path):
                own[t, s] += p
            for i, j in zip(path, path[1:]):
                own_pairs[i, j] += p
        want[b:b + n] = own / total
        want_pairs += own_pairs / total
    assert np.allclose(post, want) and np.allclose(pairs, want_pairs)


def test_language_held_out_and_switches(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.train(docs)
    out = language.identify(docs, model, keep=["doc_id", "lang"]).withColumn("h", language.held_out()).where("h").toPandas()
    assert (out.lang == out.lang_pred).mean() > 0.95
    one = docs.where("lang = 'de'").first().text.split("\n")[-1]
    two = docs.where("lang = 'es'").first().text.split("\n")[-1]
    mixed = spark.createDataFrame([(1, one + " " + two), (2, "12 ... !"), (3, None), (4, "€€")], "doc_id long, text string")
    got = {r.doc_id: r for r in language.identify(mixed, model, with_words=True).collect()}
    assert {model["names"][k] for k in got[1].words} >= {"de", "es"}
    assert [(got[k].lang_pred, got[k].score) for k in (2, 3, 4)] == [("und", 0.0)] * 3


SPECIALS = ["a <|endoftext|> b", "a<|endoftext|>b", "<|ENDOFTEXT|>", "x<|startoftext|><|endoftext|>Y", "<|endoftext|", " <|endoftext|>",
            "ab<|EndOfText|>cd <|endoftext|>!\n<|startoftext|>", "<|endoftext|>" * 50]


def test_a_window_of_very_many_items(spark):
    """3,000 items share a window: as one number it fits any pass; the items come by a join."""
    shared = data.prose(70, 12)
    items = spark.range(3000).selectExpr("id AS item_id", f"concat('{shared} tail', id) AS text")
    docs = spark.createDataFrame([(1, shared), (2, "x " + shared), (3, shared + " tail7 end"), (4, "clean text"), (5, None), (1, shared)],
                                 "doc_id long, text string").selectExpr("*", "0 AS numbers", "1 AS number", "2 AS item")
    rows = [sorted(map(tuple, decontaminate.decontaminate(docs, items, keep=["doc_id", "item"], patterns_per_pass=p, pairs_along=a)
                       .select("doc_id", "item", "n_words", "n_hit", "spans", "items").collect()), key=str)
            for p, a in ((200_000, 400_000), (200_000, 0), (700, 0), (700, 400_000))]
    assert rows[0] == rows[1] == rows[2] == rows[3]
    got = {r[0]: r for r in rows[0]}
    assert [len(got[i][-1]) for i in (1, 2, 3, 4, 5)] == [3000, 3000, 3000, 0, 0] and got[3][3] == 13


def test_rows_that_repeat_id_and_text_are_compared_once(spark):
    base = data.prose(71, 60).split()
    near = list(base)
    near[30] = "other"
    rows = [(1, " ".join(base))] * 400 + [(2, " ".join(near))] * 300 + [(3, data.prose(72, 60))]
    got = jaccard.similarity_classes(spark.createDataFrame(rows, "doc_id long, text string")).distinct().collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == {1: (1, 699), 2: (1, 699), 3: (3, 0)}


@pytest.mark.parametrize("as_text", [False, True])
def test_tokens_are_the_tokenizers_own(as_text):
    tokenizers = pytest.importorskip("tokenizers")
    texts = [r[1] for r in data.documents()] + ["it's <|endoftext|> DON'T İ ΣΑΣ", "a\u0085b\x1cc", "café ½", *SPECIALS, *SPECIALS]
    plain = tokenizers.Tokenizer.from_file(tokens.default_path())
    plain.encode_special_tokens = as_text
    own = tokens.WordEncoder(tokens.default_path(), specials_as_text=as_text)
    for part in (texts, SPECIALS[::-1]):
        ids, at = own.encode(pa.array(part))
        for i, t in enumerate(part):
            assert ids[at[i]:at[i + 1]].tolist() == plain.encode(t or "", add_special_tokens=False).ids


def test_packed_ids_are_those_of_the_plain_tokenizer(spark):
    tokenizers = pytest.importorskip("tokenizers")
    plain = tokenizers.Tokenizer.from_file(tokens.default_path())
    docs = spark.createDataFrame(list(enumerate(SPECIALS)), "doc_id long, text string")
    got = {r.doc_id: r for r in packing.pack_report(docs).collect()}
    for i, t in enumerate(SPECIALS):
        ids = np.array(plain.encode(t, add_special_tokens=False).ids + [2], "<u4")
        assert (got[i].doc_tokens, got[i].length, got[i].ids_crc32) == (len(ids), len(ids), zlib.crc32(ids.tobytes()))


def test_short_texts_are_packed_with_little_padding(spark):
    docs = spark.range(12_000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN NULL ELSE repeat('a ', 2 + CAST(id % 6 AS INT)) END AS text")
    out = packing.pack_report(docs)
    r = out.agg(F.sum("length").alias("n"), F.countDistinct("sequence_id").alias("s"), F.count(F.lit(1)).alias("rows")).first()
    assert r.rows == 12_000 and r.n > 0.95 * 4096 * r.s
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").isEmpty()


def test_packing_round_trip(docs):
    out = packing.pack_documents(docs, with_ids=True).toPandas()
    encoder = tokens.WordEncoder(tokens.default_path())
    rows = data.documents()
    ids, at = encoder.encode(pa.array([r[1] for r in rows]))
    want = sorted((str(r[0]), tuple(ids[at[i]:at[i + 1]].tolist()) + (2,)) for i, r in enumerate(rows))
    got = []
    for _, x in out.sort_values("start").groupby([out.doc_id.astype(str), "doc_tokens"]):
        copies = int((x.start == 0).sum())
        for k in range(copies):
            parts = [p.iloc[k] for _, p in x.groupby("start")]
            name = "None" if parts[0].doc_id != parts[0].doc_id else str(int(parts[0].doc_id))
            got.append((name, tuple(i for p in parts for i in p.ids)))
    assert sorted(got) == want
    for p in out.itertuples():
        assert p.length == len(p.ids) and p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
    out = out.sort_values(["sequence_id", "offset"])
    total = out.groupby("sequence_id").length.cumsum()
    assert (out.offset == total - out.length).all() and total.max() <= 4096


def test_cutting_stock_covers_demand_with_little_padding():
    rng = np.random.default_rng(2)
    size, count = np.unique(rng.integers(1, 65, 3000), return_counts=True)
    plan = packing.solve(dict(zip(size.tolist(), count.tolist())), 64)
    covered = {}
    for pattern, times in plan:
        assert sum(c * n for c, n in pattern.items()) <= 64
        for c, n in pattern.items():
            covered[c] = covered.get(c, 0) + n * times
    assert all(covered[int(c)] >= n for c, n in zip(size, count))
    assert sum(t for _, t in plan) * 64 <= 1.02 * (size * count).sum()
    assert packing.solve({}, 64) == []


def test_digests(spark):
    docs = spark.createDataFrame([(1, "b  a")], "doc_id long, text string")
    assert substring.dedup_report(docs).first().kept_sha256 == hashlib.sha256(b"b a").hexdigest()


def test_components_thin_out_edges(spark, monkeypatch):
    """Many vertices that share their smallest neighbours keep few edges, and a chain its ends."""
    from caseflow.llm import components as module
    sizes, stored = [], module.stored

    def kept(df, path=None):
        rows = stored(df, path)
        if rows.columns == ["v", "u"]:
            sizes.append(rows.count())
        return rows

    monkeypatch.setattr(module, "stored", kept)
    pairs = [(a, 100 + b) for a in range(20) for b in range(300)] + [(1000 + i, 1001 + i) for i in range(30)]
    got = {r.v: r.root for r in module.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{v: 0 for v in [*range(20), *range(100, 400)]}, **{1000 + i: 1000 for i in range(31)}}
    assert sizes[-1] < 4 * len(got) < sizes[0]


def test_similarity_classes_leave_no_step_behind(spark):
    import os
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    rows = spark.createDataFrame([(i, f"a b c d e f g h i {i % 5}") for i in range(40)], "doc_id long, text string")
    before = set(os.listdir(folder))
    assert jaccard.similarity_classes(rows).count() == 40
    left = {name.split("-")[0] for name in set(os.listdir(folder)) - before}
    assert left and not left & {"base", "sets", "prints", "level1", "taken2", "level2", "leaves"}
