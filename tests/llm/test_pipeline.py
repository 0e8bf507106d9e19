"""The pipeline's stages, each judged on what it was given."""

import numpy as np

import corpus_pipeline
from twintally.llm.exact_dedup import drop_exact_copies
from twintally.llm.scratch import SHARES, Scratch, components, with_least
from twintally.llm.simhash import drop_near_copies, fingerprint


def test_stages(spark, sf_dir, documents):
    scratch = Scratch(spark, "test")
    given, frames = documents, []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        given = scratch.keep(stage(spark, given, sf_dir), f"stage-{number}")
        frames.append(given)
    assert all(f.dtypes == documents.dtypes for f in frames[:4])
    rows = [{r.doc_id: r for r in f.collect()} for f in [documents, *frames[:4]]]
    for before, after in zip(rows, rows[1:]):
        assert all(before[i] == row for i, row in after.items()) and len(after) > 0.7 * len(before)

    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = [i in rows[1] for i, toxic in labels.items() if i in rows[0] and not toxic]
    assert sum(kept) >= 0.98 * len(kept)
    assert all(any(c.isalpha() for c in r.text) for r in rows[2].values())
    assert all(not any(c.isalpha() for c in rows[1][i].text) for i in rows[1].keys() - rows[2].keys())

    largest = {}
    for i, r in rows[2].items():
        largest[r.text] = max(i, largest.get(r.text, i))
    assert set(largest.values()) == rows[3].keys()

    ids = sorted(rows[3])
    prints = np.array([fingerprint(rows[3][i].text, 4) for i in ids], np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4
    root = np.arange(len(ids))
    while True:
        lower = np.where(near, root[None, :], len(root)).min(axis=1)
        if (lower == root).all():
            break
        root = lower
    assert {ids[r] for r in root} == rows[4].keys()
    assert {r.doc_id for r in frames[4].select("doc_id").distinct().collect()} == rows[4].keys()


def test_one_row_of_each_group_stays(spark):
    one, other, third = ("alpha beta gamma delta epsilon " * 9, "nu xi omicron pi rho sigma " * 9, "no one has numbered this text yet " * 9)
    rows = [(1, one), (2, one), (2, other), (5, other), (None, one), (None, third), (None, third), (7, "just twice " * 9), (7, "just twice " * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    wanted = sorted([(1, one), (2, other), (7, "just twice " * 9), (None, third)], key=str)
    assert sorted((tuple(r) for r in drop_near_copies(docs).collect()), key=str) == wanted
    assert sorted((tuple(r) for r in drop_exact_copies(docs).collect()), key=str) == wanted


def test_run_gives_the_last_stage(spark, small_dir):
    found = corpus_pipeline.run(spark, small_dir)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(found.columns) and found.count() > 0


def test_components(spark):
    rng = np.random.default_rng(0)
    pairs = rng.integers(0, 400, (300, 2)).tolist() + [[-i, -i - 1] for i in range(1, 300)] + [[7, 7], [5, None]]
    found = dict(map(tuple, components(spark.createDataFrame(pairs, "a long, b long"), Scratch(spark, "test")).collect()))
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if b is not None and a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    assert found == {x: root(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "test")).collect() == []


def test_stages_that_learnt_nothing_drop_nothing(spark, documents, tmp_path):
    texts = [(n, f"Some words of text number {n}." if n % 5 else None, None, "s", 9) for n in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long")
    for labels in ([], [(n, 0, 0) for n in range(20)], [(n, 0, 1) for n in range(20)], [(n, 0, None) for n in range(9)]):
        folder = str(tmp_path / f"labels-{len(labels)}-{labels[0][2] if labels else None}")
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        assert corpus_pipeline.toxicity(spark, docs, folder).count() == 40
    kept = corpus_pipeline.language(spark, docs, folder).collect()
    assert {r.doc_id for r in kept} == {n for n, text, *_ in texts if text}


def test_all_stages_over_odd_rows(spark, odd_documents, no_documents, tmp_path):
    spark.createDataFrame([(1, 0, 0), (6, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for given in (odd_documents, no_documents):
        docs = given.select("doc_id", "text", "lang", "digest", "run")
        scratch = Scratch(spark, "test")
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            before = docs
            docs = scratch.keep(stage(spark, docs, str(tmp_path)), f"stage-{number}")
            if number < 4:
                assert docs.dtypes == before.dtypes and docs.exceptAll(before).isEmpty()
        assert docs.isEmpty() == before.isEmpty()
    letters = {r.text for r in odd_documents.collect() if any(c.isalpha() for c in r.text or "")}
    kept = odd_documents
    for _, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, kept, str(tmp_path))
    assert sorted(r.text for r in kept.collect()) == sorted(letters)


def test_members_of_a_large_component_are_dealt_to_all_shares(spark):
    hot = [(n, 1000 + n if n % 3 else None, 0) for n in range(500)]
    rows = [*hot, (600, 7, 600), (601, None, 600), (700, None, 700), (701, None, 700), (800, 3, None), (801, None, None)]
    members = spark.createDataFrame(rows, "node long, value long, root long")
    found = with_least(members, "node", "value", "least")
    told = {r.node: (r.root, r.least) for r in found.collect()}
    assert told == {**{n: (0, 1001) for n, *_ in hot}, 600: (600, 7), 601: (600, 7), 700: (700, None), 701: (700, None), 800: (800, 3), 801: (801, None)}
    assert len(rows) == found.count() and SHARES > 1
    assert with_least(members.limit(0), "node", "value", "least").collect() == []
