import glob
import random
import zlib

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from caseflow.llm import tokens

from . import data


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    top = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(data.documents(), data.SCHEMA).write.parquet(f"{top}/documents.parquet")
    item = " ".join(data.prose(2, 90).split()[10:30])
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{top}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{top}/labels.parquet")
    return top


def test_stages_take_effect_in_order(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen, columns = [], docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append(name)
        if k < 4:
            assert docs.columns == columns
        if name == "near_duplicates":
            assert sorted(r.doc_id for r in docs.collect() if r.doc_id) == [1, 4, 5, 6, 7, 8, 9, 10, 12, 13, 14, 17]
        if name == "repeated_passages":
            text = {r.doc_id: r.text for r in docs.collect()}
            rows = data.documents()
            assert text[9] == " ".join(data.plain(rows[8][1])[:30]) and text[1] == rows[0][1]
        if name == "benchmark_leaks":
            assert docs.where("doc_id = 7").isEmpty() and docs.count() == 12
    assert seen == ["toxicity", "near_duplicates", "repeated_passages", "benchmark_leaks", "packing"]
    assert docs.where("start = 0").count() == 12


def test_no_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).isEmpty()


def test_columns_of_any_name_stay_as_they_are(spark, folder):
    """Names that stages compute or use inside, with a dot, of other types."""
    names = ["n_words", "n_removed", "n_hit", "spans", "kept", "items", "rejected", "p_toxic", "p_mention", "__key", "__rest",
             "__row", "row", "id", "rk", "a.b", "whole", "at", "class_id", "__text", "bucket", "key", "uid"]
    base = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", F.col("n_chars").cast("int"), "lang")
    wide = base.select(*base.columns, *[F.concat(F.lit(f"{n} "), "doc_id").alias(n) for n in names],
                       F.array(F.struct(F.col("doc_id").alias("x.y"))).alias("nested"), F.lit(True).alias("c0"))
    before = {r["doc_id"]: r for r in wide.where("doc_id IS NOT NULL").collect()}
    docs = wide
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, folder)
        assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in wide.schema], name
        docs = spark.createDataFrame(out.collect(), wide.schema)
    rows = [r for r in docs.collect() if r["doc_id"] is not None]
    assert len(rows) > 8
    for r in rows:
        old = before[r["doc_id"]]
        assert all(r[c] == old[c] for c in wide.columns if c not in ("text", "n_chars"))
        assert r["text"] == old["text"] or r["n_chars"] == len(r["text"]) < old["n_chars"]


def test_run_leaves_only_its_result(spark, folder):
    before = set(glob.glob(f"{spark.sparkContext.getCheckpointDir().removeprefix('file:')}/pipeline-*"))
    assert corpus_pipeline.run(spark, folder).count() > 0
    after = glob.glob(f"{spark.sparkContext.getCheckpointDir().removeprefix('file:')}/pipeline-*")
    assert ["packing" in x for x in set(after) - before] == [True]


def corpus():
    """(rows, toxic ids, labels, benchmark items): the awkward rows of ``data`` and planted cases."""
    rng = random.Random(11)
    rude = ["zorgul", "brakken", "vexmort", "snarvig"]
    clean = {i: data.prose(1000 + i, rng.randint(60, 160)) for i in range(200, 400)}
    toxic = {}
    for i in range(100, 200):
        w = data.prose(1000 + i, 80).split()
        for _ in range(8):
            w.insert(rng.randrange(len(w)), rng.choice(rude))
        toxic[i] = " ".join(w)
    item = data.prose(5000, 25)
    more = {}
    for i in range(400, 420):  # one word of a clean text changed
        w = clean[i - 200].split()
        w[len(w) // 2] = "changed"
        more[i] = " ".join(w)
    for i in range(420, 440):  # 55 words of a clean text inside another one
        more[i] = f"{data.prose(1000 + i, 70)} {' '.join(clean[i - 200].split()[:55])} {data.prose(3000 + i, 70)}"
    for i in range(440, 450):  # a window of the benchmark
        more[i] = f"{data.prose(1000 + i, 60)} {' '.join(item.split()[i - 440:i - 430])} {data.prose(3000 + i, 30)}"
    more[450] = " ".join(clean[210].split()[:50])  # a text that is another's passage as a whole
    usual = data.documents()
    rows = usual + [(i, t, "en", "s", len(t), 1, 2, 3, 4) for i, t in {**clean, **toxic, **more}.items()]
    labels = [(i, 1, int(i in toxic)) for i in [*range(100, 190), *range(200, 380)]]
    return rows, set(toxic), labels, [(1, item), (2, None), (3, "")]


def wanted(rows, toxic, items):
    """The documents (id, text) that go into sequences, by plain Python."""
    rows = [r for r in rows if r[0] not in toxic]
    kept, seen = [], set()
    for r, (least, _) in zip(rows, data.similarity(rows)):
        name = ("class", least) if data.folded(r[1]) else r[:2]
        if name not in seen and (r[0] == least or not data.folded(r[1])):
            seen.add(name)
            kept.append(r)
    cut = []
    for r, words in zip(kept, data.repeats(kept)):
        n = len(data.plain(r[1]))
        if len(words) == n or words:
            cut.append((r[0], r[1] if len(words) == n else " ".join(words)))
    return [r for r, (hit, _) in zip(cut, data.leaks(cut, items)) if not hit]


def test_run_against_brute_force(spark, tmp_path):
    rows, toxic, labels, items = corpus()
    for name, part, schema in (("documents", rows, data.SCHEMA), ("labels", labels, "doc_id long, quality int, toxic int"),
                               ("benchmark", items, "item_id long, text string")):
        spark.createDataFrame(part, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    want = wanted(rows, toxic, items)
    ids = {i for i, _ in want}
    assert not ids & {*toxic, *range(400, 420), *range(440, 451)} and ids > {*range(220, 400), *range(420, 440)}
    tokenizer = pytest.importorskip("tokenizers").Tokenizer.from_file(tokens.default_path())
    full = [(i, np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4")) for i, t in want]
    got = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    pieces = [(None if p.doc_id != p.doc_id else int(p.doc_id), p.doc_tokens, p.start, p.length, p.ids_crc32)
              for p in got.itertuples()]
    starts = {i: sorted(p[2:4] for p in pieces if p[0] == i) for i, _ in full}
    assert sorted(pieces, key=str) == sorted(((i, len(x), a, n, zlib.crc32(x[a:a + n].tobytes()))
                                              for i, x in full for a, n in starts[i]), key=str)
    for i, x in full:
        assert starts[i][0][0] == 0 and sum(n for _, n in starts[i]) == len(x)
        assert all(a + n == b for (a, n), (b, _) in zip(starts[i], starts[i][1:]))
    got = got.sort_values(["sequence_id", "offset"])
    total = got.groupby("sequence_id").length.cumsum()
    assert (got.offset == total - got.length).all() and total.max() <= 4096
