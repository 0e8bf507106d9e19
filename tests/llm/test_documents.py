"""Operators on documents: odd rows, empty tables and brute force on small data."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from twintally.llm import golay
from twintally.llm.bpe import TrieEncoder, decode_documents, encode_documents
from twintally.llm.exact_dedup import drop_exact_copies, exact_groups
from twintally.llm.language import LanguageModel, drop_unknown, fit_language, identify_languages
from twintally.llm.licenses import TEMPLATES, TemplateJoin, needed, scan_licenses
from twintally.llm.packing import ChunkEncoder, SumOfSquares, pack_documents
from twintally.llm.simhash import drop_near_copies, fuzzy_keys, near_links, simhash_groups
from twintally.llm.toxicity import drop_toxic, fit_toxicity, score_toxicity
from twintally.llm.words import ascii_words

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")

texts = st.lists(
    st.sampled_from(["a", "B", "é", " ", "  ", "\n", "\t", ".", "'", "'s", "ll", "1", "²", "_", "-", "\x1c", "́", "Σ", "日",
                     "\U0001f642", "<|endoftext|>", "<|startoftext|>", "!", "\xa0", " ", "क़", "İ", "the", "tion", "====", "\x00"]),
    max_size=24,
).map("".join)
texts = texts | st.text(max_size=30)


@pytest.fixture(scope="module")
def library():
    return {path: Tokenizer.from_file(path) for path in (WORDS, BYTES)}


@settings(max_examples=300, deadline=None)
@given(text=texts)
def test_encoders_agree_with_the_library(library, text):
    text = text.encode("utf-8", "ignore").decode()
    wanted = library[WORDS].encode(text, add_special_tokens=False).ids
    assert ENCODERS[0].encode([text])[0] == np.array(wanted, "<u4").tobytes()
    wanted = library[BYTES].encode(text, add_special_tokens=False).ids
    assert ENCODERS[1].encode([text])[0].tolist() == wanted
    assert ENCODERS[1].decode(wanted) == library[BYTES].decode(wanted, skip_special_tokens=False)


ENCODERS = ChunkEncoder(WORDS), TrieEncoder(BYTES)


def test_other_tokenizers_are_packed_with_their_own_ids(library):
    encoder = ChunkEncoder(BYTES)
    assert ENCODERS[0].known and not encoder.known
    for text in ("hello world", " Two  spaces\n", "", "\u00e9\u65e5<|endoftext|>"):
        assert encoder.encode([text])[0] == np.array(library[BYTES].encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_words_are_encoded_once_whatever_their_case_marks_and_text(library):
    encoder = ChunkEncoder(WORDS)
    texts = ["Straße, straße. STRAßE", "(word) Word word!", "word: straße;"]
    wanted = [np.array(library[WORDS].encode(text, add_special_tokens=False).ids, "<u4").tobytes() for text in texts]
    assert [encoder.encode([text])[0] for text in texts] == wanted
    assert sorted(encoder.words) == ["straße", "word"]
    for table in (encoder.chunks, encoder.words, encoder.marks):
        table.clear()
        table.older, table.most = {}, 2
    assert encoder.encode(texts * 2) == wanted * 2
    assert max(map(len, (encoder.chunks, encoder.words, encoder.marks))) <= 2


def test_decoding_of_broken_characters(library):
    for ids in ([447], [50256, 447, 220], [], [12520, 247]):
        assert ENCODERS[1].decode(ids) == library[BYTES].decode(ids, skip_special_tokens=False)


def test_bpe_odd_rows(odd_documents, no_documents):
    encoded = encode_documents(odd_documents, BYTES)
    decoded = decode_documents(encoded, BYTES).collect()
    assert Counter((r.doc_id, r.text) for r in decoded) == Counter((r.doc_id, r.text or "") for r in odd_documents.collect())
    assert encode_documents(no_documents, BYTES).collect() == []


def level_squares(packer):
    return int((packer.level[1:-1] ** 2).sum())


def test_every_piece_goes_where_the_sum_of_squares_is_smallest():
    rng, packer = random.Random(1), SumOfSquares(50)
    for _ in range(500):
        size = rng.choice([3, 7, 12, 20, 26, 33])
        found = {}
        for level in [0, *np.nonzero(packer.level)[0].tolist()]:
            if level + size <= 50:
                change = packer.level.copy()
                change[level] -= level > 0
                change[level + size] += level + size < 50
                found[level] = int((change[1:-1] ** 2).sum())
        assert found[packer.choose(size)] == min(found.values())
        packer.place(None, size)
        assert packer.n_open() == sum(map(len, packer.open))


@pytest.mark.parametrize("most_open", [1, 2048])
def test_packing_odd_rows(odd_documents, no_documents, most_open):
    pieces = pack_documents(odd_documents, WORDS, window=64, most_open=most_open, with_ids=True).toPandas()
    assert pieces.groupby("doc_id", dropna=False).length.sum().to_dict()[3.0] == 1  # null: the closing id alone
    assert pieces.groupby(["doc_id"], dropna=False).size().sum() == len(pieces)
    rows = odd_documents.select("doc_id", "text").collect()
    sizes = Counter(len(ENCODERS[0].encode([r.text or ""])[0]) // 4 + 1 for r in rows)
    assert sum(k * v for k, v in sizes.items()) == pieces.length.sum() == pieces.token_ids.map(len).sum()
    for _, one in pieces.sort_values("offset").groupby("sequence_id"):
        assert one.offset.tolist() == [0, *one.length.cumsum()[:-1]] and one.length.sum() <= 64
    short = pieces.groupby("sequence_id").length.sum()
    assert (short < 64).sum() <= odd_documents.rdd.getNumPartitions() or most_open == 1
    assert pack_documents(no_documents, WORDS).collect() == []


def test_template_join_finds_every_block():
    rng = random.Random(2)
    texts = [ascii_words(t.encode()) for _, t in TEMPLATES]
    words = sorted(set().union(*texts)) + [b"other", b"words"]
    for threshold in (0.5, 0.8, 1.0):
        frequency = {w: rng.randint(0, 50) for w in words}
        join = TemplateJoin(TEMPLATES, threshold, frequency)
        for _ in range(400):
            text = rng.choices(words, k=rng.randint(0, 30))
            for _ in range(rng.randint(1, 3)):
                notice = list(rng.choice(texts))
                for _ in range(rng.randint(0, len(notice) // 3)):
                    notice[rng.randrange(len(notice))] = rng.choice(words)
                text += notice + rng.choices(words, k=rng.randint(0, 40))
            wanted: dict[int, dict[int, float]] = {}
            for t, template in enumerate(texts):
                least, size = needed(template, threshold)
                for start in range(len(text)):
                    n = len(set(template) & set(text[start : start + size]))
                    if text[start] in template and n >= least:
                        wanted.setdefault(t, {})[start] = n / len(set(template))
            found = join.matches(text)
            assert {t for _, _, t, _ in found} == set(wanted)
            for t, windows in wanted.items():
                blocks = [(first, first + n) for first, n, other, _ in found if other == t]
                assert max(share for _, _, other, share in found if other == t) == max(windows.values())
                assert all(any(first <= start < end for first, end in blocks) for start in windows)
                assert {first for first, _ in blocks} <= set(windows)


def test_license_scan_finds_wrapped_notices(spark):
    notices = {
        "bsd": ["Redistribution and use in source and binary forms, with or without", "modification, are permitted provided that the",
                "following conditions are met:"],
        "mpl": [" * This Source Code Form is subject to the terms of the Mozilla Public", " * License, v. 2.0."],
        "mit": ["# Permission is hereby granted, free of charge, to any person", "# obtaining a copy of this software and associated",
                "# documentation files (the \"Software\"), to deal in the Software", "# without restriction"],
        "apache": ["you may not use this file except in compliance", "with the License. You may obtain a copy of the License at"],
        "": ["This package was released under the BSD license.", "Released by the team under the same license"],
    }
    prose = " ".join(["the quick brown fox is subject to the terms of a copy and source or form"] * 500)
    rows = [(n, "\n".join([prose, *lines, prose])) for n, lines in enumerate(notices.values())]
    rows += [(10 + n, " ".join([prose, *lines, prose])) for n, lines in enumerate(notices.values())]
    found = {r.doc_id: r for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for n, label in enumerate(notices):
        assert found[n].labels == found[10 + n].labels == label
        assert found[n].score == found[10 + n].score and (found[n].score >= 0.8) == bool(label)
        assert found[n].blocks == found[10 + n].blocks and bool(found[n].blocks) == bool(label)


def test_license_scan_odd_rows(spark, odd_documents, no_documents):
    found = scan_licenses(odd_documents).collect()
    assert len(found) == odd_documents.count() and all(r.n_base == 0 and r.first_word is None for r in found)
    rows = [(1, "the mit LICENSE, mit license. MIT\nlicense"), (2, "Licensed under CC BY-NC 4.0."), (3, "general public public license")]
    found = {r.doc_id: r for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert tuple(found[1])[1:8] == (7, 3, 1, 5, "mit", "mit", 1.0)
    assert tuple(found[2])[1:8] == (7, 0, None, None, "", "cc", 1.0) and tuple(found[2].blocks[0])[:2] == (0, 7)
    assert tuple(found[3])[1:8] == (4, 0, None, None, "", "", 0.0)
    assert scan_licenses(no_documents).collect() == []


def test_exact_groups_odd_rows(odd_documents, no_documents):
    for runs, fan_in in ((64, 8), (5, 2), (1, 2)):
        found = exact_groups(odd_documents, keep="largest", runs=runs, fan_in=fan_in).collect()
        got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in found)
        assert got == Counter({
            (1, 2, 3, False): 1, (2, 2, 3, True): 2, (3, 4, 3, False): 1, (4, 4, 3, True): 1, (None, 4, 3, False): 1, (5, 5, 1, True): 1,
            (6, 6, 1, True): 1, (7, 7, 1, True): 1, (8, 8, 1, True): 1, (None, 9, 2, False): 1, (9, 9, 2, True): 1,
        })
    left = drop_exact_copies(odd_documents)
    assert left.columns == odd_documents.columns
    assert sorted(r.doc_id for r in left.collect()) == [1, 3, 5, 6, 7, 8, 9]
    assert exact_groups(no_documents).collect() == [] and drop_exact_copies(no_documents).collect() == []


def test_golay_keys_of_words_two_bits_apart():
    words = np.random.default_rng(0).integers(0, 1 << 23, 300).astype(np.uint32)
    one, n_one = golay.near_codewords(words)
    assert set(n_one.tolist()) <= {1, 6}
    for a in range(23):
        for b in range(a, 23):
            other, n_other = golay.near_codewords(words ^ np.uint32((1 << a) | (1 << b)))
            shared = one[:, :, None] == other[:, None, :]
            shared &= (np.arange(6) < n_one[:, None])[:, :, None] & (np.arange(6) < n_other[:, None])[:, None, :]
            assert shared.any(axis=(1, 2)).all()


def test_fuzzy_keys_meet_at_four_bits():
    rng = np.random.default_rng(1)
    one = rng.integers(0, 1 << 63, 4000, dtype=np.uint64) << np.uint64(1)
    other = one.copy()
    for row in range(len(other)):
        for bit in rng.choice(64, 4, replace=False):
            other[row] ^= np.uint64(1 << int(bit))
    meet = set(zip(*map(np.ndarray.tolist, fuzzy_keys(one)))) & set(zip(*map(np.ndarray.tolist, fuzzy_keys(other))))
    assert {row for _, row in meet} == set(range(len(one)))


def test_links_connect_what_is_within_four_bits(spark):
    rng = random.Random(4)
    values = [0, (1 << 64) - 1]
    for _ in range(20):
        chain = rng.getrandbits(64)
        for _ in range(rng.randint(1, 60)):
            values.append(chain)
            for bit in rng.sample(range(64), rng.randint(1, 6)):
                chain ^= 1 << bit
    prints = np.unique(np.array(values, np.uint64))
    frame = spark.createDataFrame([(int(v),) for v in prints.view(np.int64)], "fp long")
    place = {int(v): n for n, v in enumerate(prints.view(np.int64))}
    found = np.eye(len(prints), dtype=bool)
    for a, b in near_links(frame).collect():
        found[place[a], place[b]] = found[place[b], place[a]] = True
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4
    assert (found <= near).all()
    assert (reach(found) == reach(near)).all()


def reach(near):
    root = np.arange(len(near))
    while True:
        lower = np.where(near, root[None, :], len(root)).min(axis=1)
        if (lower == root).all():
            return root
        root = lower


def test_simhash_odd_rows(odd_documents, no_documents):
    found = Counter((r.doc_id, r.component_id) for r in simhash_groups(odd_documents).collect())
    assert found[(1, 1)] == 1 and found[(2, 1)] == 2 and found[(3, 3)] == found[(4, 3)] == found[(5, 3)] == 1
    assert found[(None, 3)] == 1 and found[(None, 9)] == 1 and sum(found.values()) == odd_documents.count()
    left = drop_near_copies(odd_documents)
    assert left.columns == odd_documents.columns
    assert sorted(r.doc_id for r in left.collect()) == [1, 3, 6, 7, 8, 9]
    assert simhash_groups(no_documents).collect() == [] and drop_near_copies(no_documents).collect() == []
    with pytest.raises(ValueError):
        simhash_groups(odd_documents, most_distance=5)


def test_toxicity_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    model = fit_toxicity(odd_documents, labels)
    found = score_toxicity(odd_documents, model).collect()
    assert Counter(r.doc_id for r in found) == Counter(r.doc_id for r in odd_documents.collect())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    assert score_toxicity(no_documents, fit_toxicity(no_documents, labels.limit(0))).collect() == []
    assert drop_toxic(odd_documents, model).columns == odd_documents.columns


def test_toxic_words_are_learnt(spark):
    rng = random.Random(6)
    plain = [f"{a}{b}" for a in "bdfglm" for b in ("an", "el", "ir", "os", "ut")]
    rows = []
    for n in range(600):
        words = rng.choices(plain, k=rng.randint(5, 200))
        if n % 3 == 0:
            for _ in range(1 + len(words) // 40):
                words.insert(rng.randrange(len(words)), rng.choice(["vile", "foul", "nasty"]))
        rows.append((n, " ".join(words), int(n % 3 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = fit_toxicity(docs, docs.where("doc_id < 400"))
    held = [r for r in score_toxicity(docs, model).collect() if r.doc_id >= 400]
    assert sum(r.predicted == (r.doc_id % 3 == 0) for r in held) >= 0.97 * len(held)
    left = {r.doc_id for r in drop_toxic(docs, model).collect()}
    assert left == {r.doc_id for r in score_toxicity(docs, model).collect() if not r.predicted}


def test_the_toxicity_scale_does_not_depend_on_how_many_are_sampled(spark):
    rng = random.Random(7)
    plain = [f"{a}{b}" for a in "bdfglm" for b in ("an", "el", "ir", "os", "ut")]
    vile = [f"vile{i}" for i in range(70)]
    rows = []
    for n in range(3600):
        words, toxic = rng.choices(plain, k=40), n % 9 == 0
        for _ in range(rng.randint(1, 6) if toxic else rng.randint(1, 3) if rng.random() < 0.3 else 0):
            words.insert(rng.randrange(len(words)), rng.choice(vile[:40] if toxic else vile[:30] * 3 + vile[30:]))
        rows.append((n, " ".join(words), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    whole, capped = fit_toxicity(docs, docs), fit_toxicity(docs, docs, most_per_class=400)
    assert capped.offset < -1.8 and whole.offset < -1.8
    clean = docs.where("toxic = 0")
    n_whole, n_capped = (score_toxicity(clean, m).where("predicted = 1").count() for m in (whole, capped))
    assert abs(n_whole - n_capped) < 100


def test_languages_odd_rows(odd_documents, no_documents):
    model = fit_language(odd_documents)
    found = identify_languages(odd_documents, model).collect()
    unknown = Counter(r.doc_id for r in found if r.lang_pred == "und")
    assert unknown == Counter([3, 4, 5, 8, None]) and all(r.score == 0 for r in found if r.lang_pred == "und")
    left = drop_unknown(odd_documents, model)
    assert left.columns == odd_documents.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == ["1", "2", "2", "6", "7", "9", "None"]
    empty = fit_language(no_documents)
    assert isinstance(empty, LanguageModel) and identify_languages(no_documents, empty).collect() == []
    assert {r.lang_pred for r in identify_languages(odd_documents, empty).collect()} == {"und"}


def test_scripts_of_many_characters_are_told_apart(spark):
    rng = random.Random(1)
    alphabets = {"one": [chr(0x4E00 + n) for n in range(600)], "two": [chr(0x20000 + n) for n in range(600)]}
    rows = [(n, "".join(rng.choices(alphabets[lang], k=300)), lang) for n in range(160) for lang in alphabets]
    model = fit_language(spark.createDataFrame([(n, *row[1:]) for n, row in enumerate(rows)], "doc_id long, text string, lang string"))
    short = [("".join(rng.choices(alphabets[lang], k=4)), lang) for lang in alphabets for _ in range(100)]
    names, _ = model.predict([text for text, _ in short])
    assert sum(name == lang for name, (_, lang) in zip(names, short)) >= 195


def test_kernel_values_against_sets_of_ngrams(spark):
    from twintally.llm.language import _landmark_tables

    texts = ["Abcab", "bca", "\U00020001\U00020002b", "", "zz top éè"]
    known, present = _landmark_tables(texts)
    model = LanguageModel([], known, present, np.empty(0))
    grams = lambda t: {t.lower()[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    every = set().union(*map(grams, texts))
    asked = ["abca", "bcb\U00020001", "unknown", "", "éè zz"]
    found = model.kernel(asked)
    for row, text in zip(found, asked):
        own = grams(text) & every
        wanted = [len(own & grams(mark)) / max(len(own), 1) ** 0.5 / max(len(grams(mark)), 1) ** 0.5 for mark in texts]
        assert np.allclose(row, wanted, atol=1e-5)


def test_toxicity_scores_against_plain_python(spark):
    import math
    from statistics import median

    import xxhash

    rng = random.Random(2)
    mild, bad = [f"mild{n}" for n in range(60)], [f"bad{n}" for n in range(6)]
    rows = [(n, " ".join(rng.choices(mild + bad * (3 if n % 4 == 0 else 0), k=30)), int(n % 4 == 0)) for n in range(200)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(n, toxic) for n, _, toxic in rows], "doc_id long, toxic int")
    model = fit_toxicity(docs, labels)
    # The same counts one by one: which half a label is for is taken from the operator.
    from twintally.llm.toxicity import DEAD_ZONE, DISCOUNT, LEAST_CONTEXTS, labelled_sample

    part = {r.doc_id: r.part for r in labelled_sample(labels, "toxic", 4000).collect()}
    contexts = {0: {}, 1: {}}
    for n, text, toxic in rows:
        words = text.split()
        if part[n] == 0:
            for before, word in zip([None, *words], words):
                contexts[toxic].setdefault(word, set()).add(before)
    documents = Counter(w for _, text, _ in rows for w in set(text.split()))
    all_words = sum(documents.values())
    total = {toxic: sum(map(len, c.values())) for toxic, c in contexts.items()}
    own = {t: {w: (len(c) - DISCOUNT) / total[t] for w, c in contexts[t].items() if len(c) >= LEAST_CONTEXTS} for t in (0, 1)}
    rest = {t: 1 - sum(own[t].values()) for t in (0, 1)}

    def ratio(word):
        if word not in own[0] and word not in own[1]:
            return math.log(rest[1] / rest[0])
        likelihood = [math.log(own[t].get(word, 0) + rest[t] * documents[word] / all_words) for t in (0, 1)]
        return likelihood[1] - likelihood[0]

    assert len(model.words) == len(own[0].keys() | own[1].keys())
    for _, text, _ in rows[:20] + [(0, "nothing known here bad1 bad1", 0)]:
        each = [ratio(w) for w in text.split()]
        each = [x - median(each) for x in each]
        mean = sum(math.copysign(max(abs(x) - DEAD_ZONE, 0), x) for x in each) / len(each)
        assert model.difference([text])[0] == pytest.approx(math.copysign(abs(mean) ** 0.5, mean), abs=1e-9)
    assert xxhash.xxh64_intdigest(b"bad1") in model.words.tolist()


def test_exact_runs_are_merged_in_order(spark):
    """Sorted once a round and merged by neighbours; no hash table, and hot texts are spread over the runs."""
    docs = spark.createDataFrame([(n, "hot" if n % 3 == 0 else f"text {n % 50}") for n in range(300)], "doc_id long, text string")
    groups = exact_groups(docs, runs=8, fan_in=2)
    plan = groups._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan and plan.count("SortAggregate") == 2 * 4  # a partial and a final one in each of four steps
    for runs, fan_in in ((1, 2), (5, 2), (64, 8), (27, 3)):
        for keep, best in (("smallest", min), ("largest", max)):
            found = {r.doc_id: (r.keep_id, r.group_size) for r in exact_groups(docs, keep=keep, runs=runs, fan_in=fan_in).collect()}
            ids = {}
            for n, text in (tuple(r) for r in docs.collect()):
                ids.setdefault(text, []).append(n)
            assert found == {n: (best(group), len(group)) for group in ids.values() for n in group}
