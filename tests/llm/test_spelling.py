"""Spelling variants against all pairs."""

import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from twintally.llm.queries import QUERIES
from twintally.llm.spelling import count_words, group_variants, near_words, spelling_variants


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def slow_counts(rows, one_in):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if one_in and h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def slow_groups(counts):
    words = sorted(counts)
    deleted = {}
    for w in words:
        for key in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            deleted.setdefault(key, set()).add(w)
    near = {w: set() for w in words}
    for w in words:
        for key in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            near[w] |= {x for x in deleted[key] if one_edit(w, x)}
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    found = {}
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        found[w] = (counts[w], len(near[w]), form[w], counts.get(form[w]), root)
    return found


def as_found(frame):
    rows = frame.select("word", "n", "n_near", "form", "form_n", "root").collect()
    found = {r.word: tuple(r[1:]) for r in rows}
    assert len(found) == len(rows)
    return found


def test_query(spark, sf_dir, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    wanted = slow_groups(slow_counts(rows, 199))
    assert as_found(QUERIES["op11_spelling_variants"](spark, sf_dir)) == wanted
    assert any(form for _, _, form, _, _ in wanted.values())


def test_all_pairs_of_random_words(spark):
    rng = np.random.default_rng(3)
    words = sorted({"".join(rng.choice(list("abéß"), rng.integers(2, 9))) for _ in range(900)})
    frame = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    found = [tuple(sorted((r.a, r.b))) for r in near_words(frame).collect()]
    wanted = {(a, b) for i, a in enumerate(words) for b in words[i + 1 :] if one_edit(a, b)}
    assert len(found) == len(set(found)) and set(found) == wanted


def test_a_common_ending_gives_few_pairs_to_verify(spark):
    from twintally.llm.spelling import chunk_keys

    rng = np.random.default_rng(4)
    words = sorted({"".join(rng.choice(list("abcdefghijklmnop"), 5)) + "ation" for _ in range(3000)})
    keys = spark.createDataFrame([(w,) for w in words], "word string").select(F.explode(chunk_keys(F.col("word"))).alias("key"))
    assert keys.groupBy("key").count().agg(F.max("count")).first()[0] <= 300  # not all words


def test_forms_lead_to_a_root(spark):
    rows = [("colour", 2000), ("colou", 300), ("olou", 7), ("colouur", 20), ("colouuur", 3), ("kolour", 400), ("kolours", 80), ("separate", 9), (None, 4)]
    found = as_found(group_variants(spark.createDataFrame(rows, "word string, n long")))
    assert found["colouuur"] == (3, 1, "colouur", 20, "colour")
    assert found["kolours"] == (80, 1, "kolour", 400, "colour")
    assert found["separate"] == (9, 0, None, None, "separate")
    assert found["colour"][2:] == (None, None, "colour")


def test_ties_and_odd_rows(spark, odd_documents, no_documents):
    rows = [("abcdef", 1), ("abcdeg", 50), ("abcdez", 50), ("abcdee", 50)]
    assert as_found(group_variants(spark.createDataFrame(rows, "word string, n long")))["abcdef"] == (1, 3, "abcdee", 50, "abcdee")
    assert spelling_variants(no_documents).collect() == []
    counted = {r.word: r.n for r in count_words(odd_documents, least_length=4, least_count=1).collect()}
    assert counted["word"] == 40_000 and counted["identifier"] == 2 and "éß" not in counted
    texts = [(1, "Größe×ÄÖÜäöüÿ großŸe 日本語語語語語"), (None, "ÀÉ" * 3)]
    some = spark.createDataFrame(texts, "doc_id long, text string")
    assert {r.word for r in count_words(some, least_count=1).collect()} == {"größe×ÄÖÜäöüÿ", "ÀÉ" * 3}
    assert {r.word: r.n for r in count_words(some, least_count=1, least_length=1, misspell_one_in=1).collect()} == (
        {w: n for w, n in Counter(slow_changed(texts)).items() if w}
    )


def slow_changed(texts):
    for doc_id, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            yield run[: h % len(run)] + run[h % len(run) + 1 :]
