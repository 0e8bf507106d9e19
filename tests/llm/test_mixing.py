"""Context mixing against plain Python, its probabilities, and odd rows."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from twintally.llm import mixing
from twintally.llm.queries import QUERIES

TEXTS = [
    "the cat sat on the mat", "The cat ate the fish", "a dog sat on a cat", "el gato come el pez", "el perro y el gato",
    "zyx the cat unseenword unseenword", None, "", " \t", "x" * 300, "the  the\nthe", "el gato the dog",
]


def slow_tokens(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in text.translate({c: " " for c in range(9, 14)}).split(" ") if w]
    return [w.encode() for w in words] + [b"\n"]


def test_base_scores(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    found = {r.doc_id: r for r in QUERIES["op12_lm_scoring"](spark, sf_dir).collect()}
    learnt = Counter(w for r in rows if zlib.crc32(str(r.doc_id).encode()) % 7 != 2 for w in slow_tokens(r.text))
    n, v = sum(learnt.values()), len(learnt)
    assert len(found) == len(rows)
    for row in rows:
        words, got = slow_tokens(row.text), found[row.doc_id]
        assert got.held_out == (zlib.crc32(str(row.doc_id).encode()) % 7 == 2)
        assert (got.n_tokens, got.n_known, got.train_tokens) == (len(words), sum(w in learnt for w in words), n)
        assert got.base_score == pytest.approx(sum(math.log10((learnt[w] + 1) / (n + v + 1)) for w in words), rel=1e-9)
        assert got.score < 0


def test_held_out_texts_are_likelier_than_by_single_words(spark, sf_dir):
    found = QUERIES["op12_lm_scoring"](spark, sf_dir.replace("sf0.01", "sf0.1")).where("held_out")
    total = found.agg(F.sum("base_score").alias("base"), F.sum("score").alias("score")).first()
    assert total.score > 0.98 * total.base


def slow_score(text, kinds, log_odds, whole, head):
    """One text's decisions, one after another; ``whole`` gives a word's score in a kind."""
    words, said, recent = slow_tokens(text), Counter(), []
    weights = [[0.4] * 4 for _ in range(mixing._GATES)]
    steps = [[0.0] * 4 for _ in weights]
    evidence = kinds.prior.copy()
    total, mix, mask = 0.0, int(mixing._MIX), (1 << 64) - 1
    for t, word in enumerate(words):
        kind = int(np.argmax(evidence))
        hit = said[word] > 0
        if t:
            one, two = zlib.crc32(words[t - 1]), zlib.crc32(words[t - 2]) if t > 1 else 0
            history = sum(1 << n for n, h in enumerate(reversed(recent[-mixing._RECENT :])) if h)
            length = int(min(np.log2(t) * 2, mixing._LENGTHS - 1))
            slots = 1 << mixing.TABLE_BITS
            entries = [
                (one * mix & mask) >> (64 - mixing.TABLE_BITS),
                slots + (((((one * mix & mask) + two) & mask) * mix & mask) >> (64 - mixing.TABLE_BITS)),
                2 * slots + history * mixing._LENGTHS + length,
                2 * slots + (mixing._LENGTHS << mixing._RECENT) + (31 * len(said) // t) * mixing._LENGTHS + length,
            ]
            odds = [float(log_odds[e]) for e in entries]
            gate = min(bin(history).count("1") * mixing._GATES // (mixing._RECENT + 1), mixing._GATES - 1)
            p = 1 / (1 + math.exp(-sum(w * o for w, o in zip(weights[gate], odds))))
            total += math.log10(p if hit else 1 - p)
            for k in range(4):
                steps[gate][k] += mixing._TEXT_RATE * (hit - p) * odds[k]
            if t % mixing._BLOCK == 0:
                weights = [[w + s for w, s in zip(*both)] for both in zip(weights, steps)]
                steps = [[0.0] * 4 for _ in weights]
        if hit:
            total += math.log10(said[word] / t)
        else:
            total += whole(word, kind) - math.log10(1 - sum(10 ** whole(w, kind) for w in said if w in head))
            if len(word) <= mixing.SHORT:
                evidence = evidence + kinds.marks[mixing._Marks()[word]]
        said[word] += 1
        recent.append(hit)
    return total


def test_scores_against_plain_python(spark, tmp_path):
    docs = spark.createDataFrame([(n, t) for n, t in enumerate(TEXTS * 3)], "doc_id long, text string").repartition(3)
    learn = F.col("doc_id") < 2 * len(TEXTS)
    found = {r.doc_id: r for r in mixing.score_texts(docs, learn).collect()}
    learnt = [t for t in TEXTS * 2]

    class Shared:
        def __init__(self, value):
            self.value = value

    kinds = mixing.fit_kinds(spark.createDataFrame([(t,) for t in learnt], "text string"))
    batch = pa.RecordBatch.from_pydict({"text": pa.array(TEXTS * 3), "learn": [n < 2 * len(TEXTS) for n in range(3 * len(TEXTS))]})
    counted = [row for b in mixing._count_batches(Shared(kinds))(iter([batch])) for row in b.to_pylist()]
    entries, by_kind = np.zeros((mixing.N_ENTRIES, 2)), {}
    for row in counted:
        if row["token"] is None:
            entries[row["entry"]] += row["n0"], row["n1"]
        elif any(k := [row[f"k{n}"] for n in range(mixing.KINDS)]):
            by_kind[row["token"]] = by_kind.get(row["token"], 0) + np.array(k)
    assert {w: int(k.sum()) for w, k in by_kind.items()} == Counter(w for t in learnt for w in slow_tokens(t))
    log_odds = mixing._odds(entries[:, 0], entries[:, 1])

    counts = np.zeros((mixing.ORDERS, 1 << mixing.TABLE_BITS, 2))
    for word in by_kind:  # one bit after another
        padded = bytes(mixing.ORDERS) + word + b" "
        for at in range(mixing.ORDERS, len(padded)):
            window = np.array([int.from_bytes(padded[at - mixing.ORDERS : at + 1], "big")], np.uint64)
            slots, bits = mixing.window_bits(window)
            for order in range(mixing.ORDERS):
                for slot, bit in zip(slots[order], bits):
                    counts[order, slot, bit] += 1
    weights, passed = mixing._weights_of_shard(counts.astype(np.float32), sorted(w for w, k in by_kind.items() if k.sum() == 1))
    spelling = mixing.spelling_of(counts, np.round(weights, 6) * (passed > 0)[:, None] + 0.3 * (passed == 0)[:, None])
    columns = [*np.array(list(by_kind.values())).T, np.array([k.sum() for k in by_kind.values()])]
    totals = []
    for c in columns:
        once, twice = (c == 1).sum(), (c == 2).sum()
        totals.append(mixing.Totals(int(c.sum()), int((c > 0).sum()), once / (once + 2 * twice) if once else 0.5))

    def whole(word, kind):
        c = by_kind.get(word, np.zeros(mixing.KINDS))
        p = math.exp(spelling.score([word])[0])
        for n, of in ((c.sum(), totals[-1]), (c[kind], totals[kind])):
            p = (max(n - of.discount, 0) + (of.discount * of.v + 1) * p) / (of.n + 1)
        return math.log10(p)

    head = {w for w in by_kind if len(w) <= mixing.LONGEST_HEAD}
    for n, text in enumerate(TEXTS * 3):
        assert found[n].score == pytest.approx(slow_score(text, kinds, log_odds, whole, head), rel=1e-4), text


def test_spelling_is_a_distribution():
    words = [b"ab", b"ba", b"abba"]
    windows, times = np.unique(mixing.spelling_windows(words)[0], return_counts=True)
    counts = np.zeros((mixing.ORDERS, 1 << mixing.TABLE_BITS, 2))
    entries, bits = mixing.window_bits(windows)
    for order in range(mixing.ORDERS):
        np.add.at(counts[order], (entries[order], bits), np.repeat(times, 8))
    spelling = mixing.spelling_of(counts, np.full((mixing.ORDERS + 1, mixing.ORDERS), 0.3))
    # Of all single bytes, the space ends the empty word; words of one byte hold what follows the others.
    ends = spelling.score([b""])
    first = [np.array([b], np.uint64) for b in range(256)]
    odds = mixing._odds(counts[:, :, 0], counts[:, :, 1])
    known = counts.sum(axis=2) > 1
    total = 0
    for window in first:
        e, b = mixing.window_bits(window)
        gate = sum(known[o][e[o]].astype(int) for o in range(mixing.ORDERS))
        logit = sum(odds[o][e[o]] * spelling.weights[gate, o] for o in range(mixing.ORDERS))
        total += np.exp(mixing._likelihood(logit, b).sum())
    assert total == pytest.approx(1) and ends[0] < 0


def test_odd_rows(spark, odd_documents, no_documents):
    found = mixing.score_texts(odd_documents, F.col("doc_id") != 3).collect()
    assert len(found) == odd_documents.count()
    assert {(r.doc_id, r.n_tokens) for r in found if r.doc_id in (3, 4, 5)} == {(3, 1), (4, 1), (5, 1)}
    assert all(r.held_out == (r.doc_id in (None, 3)) and r.score <= 0 and math.isfinite(r.score) for r in found)
    same = [r.score for r in found if r.doc_id in (1, 2)]
    assert max(same) == pytest.approx(min(same))
    assert mixing.score_texts(no_documents, F.lit(True)).collect() == []
    alone = mixing.score_texts(odd_documents, F.lit(None).cast("boolean")).collect()
    assert {(r.train_tokens, r.base_score, r.n_known) for r in alone} == {(0, 0.0, 0)}


def test_parts_do_not_matter(spark, monkeypatch):
    docs = spark.createDataFrame([(n, t) for n, t in enumerate(TEXTS)], "doc_id long, text string")
    one = {r.doc_id: r.score for r in mixing.score_texts(docs.coalesce(1), F.lit(True)).collect()}
    other = {r.doc_id: r.score for r in mixing.score_texts(docs.repartition(7), F.lit(True)).collect()}
    assert one == pytest.approx(other, rel=1e-9)
    assert list(itertools.chain(*mixing._in_parts([b"a" * 10] * 5))) == [b"a" * 10] * 5


def test_numbered_tokens_are_those_of_each_text():
    rng = random.Random(3)
    signs = [*map(chr, range(256)), *" \t\n\x0b\x0c\r" * 12, "\u2028", "\u3000", "\u65e5", "\u0130", "\u212a", "a", "A", "b"]
    for _ in range(300):
        texts = [None if rng.random() < 0.1 else "".join(rng.choices(signs, k=rng.choice([0, 1, 3, 20]))) for _ in range(rng.choice([1, 2, 5]))]
        wanted = [mixing.tokens(text) for text in texts]
        own, words, lengths = mixing._numbered_tokens(pa.array(["before", *texts], pa.string()).slice(1))
        assert [words[n] for n in own] == [w for some in wanted for w in some]
        assert lengths.tolist() == list(map(len, wanted)) and words == list(dict.fromkeys(w for some in wanted for w in some))
    own, words, lengths = mixing._numbered_tokens(pa.array([], pa.string()))
    assert len(own) == len(lengths) == 0


def slow_spelling(words, spelling):
    """Natural logarithm of each word's bytes, bit by bit; weights change after each ``_SPELT`` words."""
    weights, found = spelling.weights.copy(), {}
    for at in range(0, len(words), mixing._SPELT):
        steps, seen = np.zeros_like(weights), np.zeros(len(weights))
        for word in words[at : at + mixing._SPELT]:
            padded, found[word] = bytes(mixing.ORDERS) + word + b" ", 0.0
            for end in range(mixing.ORDERS, len(padded)):
                window = np.array([int.from_bytes(padded[end - mixing.ORDERS : end + 1], "big")], np.uint64)
                entries, bits = mixing.window_bits(window)
                for way in range(8):
                    odds = np.array([spelling.odds[k, entries[k, way]] for k in range(mixing.ORDERS)], float)
                    gate = sum(bool(spelling.known[k, entries[k, way]]) for k in range(mixing.ORDERS))
                    p = 1 / (1 + math.exp(-odds @ weights[gate]))
                    found[word] += math.log(p if bits[way] else 1 - p)
                    steps[gate] += (int(bits[way]) - p) * odds
                    seen[gate] += 1
        weights += mixing._SPELLING_RATE * steps / (seen + mixing._PRIOR)[:, None]
    return found


@pytest.mark.parametrize("part,piece", [(mixing._MOST_BYTES, mixing._PIECE), (500, 64)])
def test_words_are_spelt_anew_in_each_text(monkeypatch, part, piece):
    rng = random.Random(7)
    made = ["".join(rng.choices("abcdeéz", k=rng.choice([1, 3, 5, 9, 90]))) for _ in range(400)]
    texts = [None, " ".join(made[:150] * 2), "a b", " ".join(reversed(made)), " ".join(made[50:200]), "z" * 700]
    counts = np.zeros((mixing.ORDERS, 1 << mixing.TABLE_BITS, 2))
    entries, bits = mixing.window_bits(mixing.spelling_windows([w.encode() for w in made[:120]])[0])
    for order in range(mixing.ORDERS):
        np.add.at(counts[order], (entries[order], bits), 1)
    spelling = mixing.spelling_of(counts, np.random.default_rng(0).uniform(0.1, 0.5, (mixing.ORDERS + 1, mixing.ORDERS)))
    kinds = mixing.Kinds(np.zeros(mixing.KINDS, np.int64), np.zeros((mixing._MARKS, mixing.KINDS), np.int64))
    monkeypatch.setattr(mixing, "_MOST_BYTES", part)
    monkeypatch.setattr(mixing, "_PIECE", piece)
    block = mixing.Texts(texts, kinds)
    got = mixing.spell(block, spelling)
    wanted = [p for text in texts for p in slow_spelling(list(dict.fromkeys(slow_tokens(text))), spelling).values()]
    assert got == pytest.approx(wanted, rel=1e-4)
    alone = spelling.score([block.words[w] for w in block.own[~block.hit]])
    first = np.concatenate([np.arange(len(dict.fromkeys(slow_tokens(t)))) < mixing._SPELT for t in texts])
    assert got[first] == pytest.approx(alone[first], rel=1e-4) and np.abs(got - alone)[~first].min() > 0


def test_scores_follow_a_texts_own_spelling(spark):
    rng = random.Random(5)
    made = ["".join(rng.choices("abcdez", k=7)) for _ in range(420)]
    rows = [(0, " ".join(made[:120])), (1, " ".join(made[120:])), (2, " ".join(reversed(made[120:])))]
    found = {r.doc_id: r.score for r in mixing.score_texts(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") == 0).collect()}
    # The same unknown words: all that tells the two apart is what the weights have learnt of the words before.
    assert abs(found[1] - found[2]) > 0.01
