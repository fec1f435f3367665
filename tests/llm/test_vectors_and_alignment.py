"""Neighbours, hard negatives and tokenizer alignment against brute force, with nulls, ties, repeats and odd rows."""

import hashlib
import math
import random
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import numpy as np
import pytest
from pyspark.sql import functions as F

from firstprint.llm import alignment, forest, negatives
from firstprint.llm.queries.alignment import tokenizer_files

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, v string, score string, rank string, block string"
EVERY = lambda i: i % 3 == 0


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], SCHEMA)


def odd_rows():
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)], rng.randint(0, 3)) for i in range(400)]
    rows += [(1000 + i, rows[6][1], 1) for i in range(60)]  # copies of one vector
    rows += [(2000 + i, [x + rng.gauss(0, 1e-3) for x in rows[9][1]], 2) for i in range(120)]  # a crowd of near copies
    rows += [rows[3], rows[3]]  # repeated rows
    return rows + [(None, [1.0] * 8, 1), (501, None, 1), (502, [1.0, None] * 4, 1), (504, [math.nan] * 8, 1), (507, [math.inf] + [0.0] * 7, 1),
                   (510, [0.0] * 8, 1), (513, [], 1), (516, [1.0, 2.0], 1), (519, [1.0] * 8, None)]


def as_floats(rows):
    return {i: np.array(v, np.float32).astype(float) for i, v, _ in rows
            if i is not None and v is not None and len(v) == 8 and None not in v and np.isfinite(v).all()}


def test_neighbours_equal_brute_force(spark):
    rows = odd_rows()
    held = {i: v for i, v in as_floats(rows).items() if v.any()}
    got = {}
    for r in forest.nearest(vectors(spark, rows), EVERY, leaf_rows=16).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {i for i in held if i % 3 == 0}
    right = total = 0
    for query, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5] and query not in [i for _, i, _ in found]
        score = {i: float(forest.cosines(held[query][None], v[None])[0]) for i, v in held.items() if i != query}
        for _, i, s in found:
            assert s == score[i]
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        best = sorted(score, key=lambda i: (-score[i], i))[:5]
        right, total = right + len(set(best) & {i for _, i, _ in found}), total + 5
    assert right >= 0.95 * total
    assert [i for _, i, _ in got[6]] == [1000, 1001, 1002, 1003, 1004]  # copies: ties to the smaller ids


def shifted(rng):
    return 5 + rng.normal(size=(4_000, 48))


def in_unequal_clusters(rng):
    centres, of = rng.normal(size=(200, 48)), np.minimum(rng.zipf(1.3, 4_000) - 1, 199)
    return centres[of] + 0.3 * rng.normal(size=(4_000, 48)) * rng.lognormal(size=(4_000, 1))


def few_dimensions(rng):
    return np.tanh(rng.normal(size=(4_000, 4)) @ rng.normal(size=(4, 48)))


@pytest.mark.parametrize("shape", [shifted, in_unequal_clusters, few_dimensions])
def test_neighbours_are_found_however_the_rows_lie(spark, shape):
    rows = shape(np.random.default_rng(1)).astype(np.float32)
    table = vectors(spark, [(i, v.tolist(), 0) for i, v in enumerate(rows)])
    found = {}
    for r in forest.nearest(table, lambda i: i % 10 == 0, leaf_rows=16).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    unit = forest.units(rows.astype(float))
    score = unit[::10] @ unit.T
    score[np.arange(400), np.arange(0, 4_000, 10)] = -2
    best = np.argsort(-score, axis=1, kind="stable")[:, :5]
    assert set(found) == set(range(0, 4_000, 10))
    assert sum(len(found[10 * i] & set(near.tolist())) for i, near in enumerate(best)) >= 0.95 * 2_000


@pytest.mark.parametrize("step, missed", [(3, 0.0), (60, 0.02)])  # nothing may be missed, or too little to measure by
def test_every_row_is_read_once_if_nothing_less_will_do(spark, step, missed):
    rows = np.random.default_rng(2).normal(size=(600, 64)).astype(np.float32)  # no structure: an index does not help
    table = vectors(spark, [(i, v.tolist(), 0) for i, v in enumerate(rows)])
    found = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in forest.nearest(table, lambda i: i % step == 0, leaf_rows=2, missed=missed).collect()}
    for query in range(0, 600, step):
        score = forest.cosines(np.broadcast_to(rows[query].astype(float), rows.shape), rows.astype(float))
        best = [i for i in sorted(range(600), key=lambda i: (-score[i], i)) if i != query][:5]
        assert [found[query, k + 1] for k in range(5)] == [(i, score[i]) for i in best]


def test_few_or_no_neighbours(spark):
    two = vectors(spark, [(3, [1.0, 0.0], 1), (4, [1.0, 1.0], 2)])
    assert [tuple(r) for r in forest.nearest(two, EVERY).collect()] == [(3, 1, 4, pytest.approx(math.sqrt(0.5)))]
    assert forest.nearest(two.where("vec_id = 3"), EVERY).count() == 0
    assert forest.nearest(two.where("false"), EVERY).count() == 0
    huge = vectors(spark, [(3, [3e38, 3e38], 1), (4, [3e38, 0.0], 2), (5, [1e-40, 1e-40], 2)])
    assert [(r["vec_id"], round(r["score"], 6)) for r in forest.nearest(huge, EVERY).orderBy("rank").collect()] == [(5, 1.0), (4, 0.707107)]


def test_a_forest_holds_every_row_once_and_searches_by_likelihood():
    rng = np.random.default_rng(3)
    rows = forest.units(rng.normal(size=(4_000, 16)))
    made = forest.fit(rows[:1_000], 5, trees=4)
    leaves = made.leaves(rows)
    assert leaves.shape == (4_000, 4) and leaves.min() >= 0 and leaves.max() < 32
    assert np.bincount(leaves[:1_000, 0], minlength=32).max() <= 33  # split at medians
    read = made.search(rows[0], 0.95, 0.02)
    assert any(leaves[0, t] in read[t] for t in range(4)) and sum(map(len, read)) < 64
    everywhere = made.search(rows[0], 0.05, 0.0)
    assert all(sorted(r) == list(range(32)) for r in everywhere)


def brute_negatives(rows, positives=5, n=3):
    whole = {i: ([math.floor(256 * float(x)) for x in v], label) for i, v, label in rows}
    out = set()
    for anchor in (i for i in whole if i % 3 == 0):
        vector, label = whole[anchor]
        score = {i: sum(a * b for a, b in zip(vector, v)) for i, (v, _) in whole.items() if i != anchor}
        order = sorted(score, key=lambda i: (-score[i], i))
        for positive in [i for i in order if whole[i][1] == label][:positives]:
            p = score[positive]
            good = [i for i in order if whole[i][1] != label and 50 * p <= 100 * score[i] <= 95 * p][:n]
            out |= {(anchor, positive, k + 1, i, p, score[i]) for k, i in enumerate(good)}
    return out


@pytest.mark.parametrize("block", [16, 4096])
def test_hard_negatives_equal_brute_force(spark, block):
    rows = odd_rows()
    labels = {i: l for i, _, l in rows}
    usable = [(i, v, labels[i]) for i, v in as_floats(rows).items() if labels[i] is not None]
    got = negatives.hard_negatives(vectors(spark, rows), EVERY, sample_rows=50, block_rows=block).collect()
    assert {tuple(r) for r in got} == brute_negatives(usable) and len(got) == len(set(got))


def test_hard_negatives_without_answers(spark):
    alone = vectors(spark, [(i, [1.0, float(i)], 1) for i in range(9)])
    assert negatives.hard_negatives(alone, EVERY).count() == 0  # a single label
    assert negatives.hard_negatives(alone.where("false"), EVERY).count() == 0
    below = vectors(spark, [(0, [1.0, 0.0], 1), (1, [-1.0, 0.0], 1), (2, [-0.6, 0.0], 2)])
    assert negatives.hard_negatives(below, EVERY).count() == 0  # a positive below zero
    large = [(0, [3e15, 1.0], 1), (1, [3e15, 5.0], 1), (2, [2e15, 7.0], 2)]
    assert negatives.hard_negatives(vectors(spark, large), EVERY).count() == 0  # beyond 64 bits all count as the largest number


def test_coordinate_ranges_lose_no_row():
    rng = np.random.default_rng(8)
    rows = np.floor(256 * rng.normal(size=(800, 6)) * rng.uniform(0.1, 3, size=(800, 1)))
    bucket = negatives.Bucket(rows)
    skipped = 0
    for asked in rows[:40]:
        score = negatives.scores(rows, asked)
        for least in (int(np.quantile(score, 0.99)), int(score.max()), int(score.max()) + 1):
            found = set(bucket.candidates(asked, least).tolist())
            assert set(np.flatnonzero(score >= least).tolist()) <= found
            skipped += len(found) < len(rows) / 2
    assert skipped > 40


# --- Alignment -----------------------------------------------------------------------------

def plain_alignment(text, a, b, spelled_a, spelled_b):
    """By whole texts and a search for overlaps, without remembered words."""
    if not text:
        return None
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    if b"".join(spelled_a[i] for i in ids_a) != (" " + text).encode() or b"".join(spelled_b[i] for i in ids_b) != (" " + text).encode():
        return None
    ends_a, ends_b = list(accumulate(len(spelled_a[i]) for i in ids_a)), list(accumulate(len(spelled_b[i]) for i in ids_b))
    starts_a, starts_b = [0, *ends_a[:-1]], [0, *ends_b[:-1]]
    links = []
    for i in range(len(ids_a)):
        for j in range(max(0, bisect_left(ends_b, starts_a[i] + 1)), len(ids_b)):
            if starts_b[j] >= ends_a[i]:
                break
            links.append((ids_a[i], ids_b[j]))
    cuts = sorted(set(ends_a) & set(ends_b))
    sides = [[[], []] for _ in cuts]
    for ends, ids, side in ((ends_a, ids_a, 0), (ends_b, ids_b, 1)):
        for end, token in zip(ends, ids):
            sides[bisect_left(cuts, end)][side].append(str(token))
    shown = ";".join(",".join(x) + "|" + ",".join(y) for x, y in sides)
    return len(ids_a), len(ids_b), len(cuts), links, hashlib.sha256(shown.encode()).hexdigest()


def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer
    files = tokenizer_files()
    a, b = Tokenizer.from_file(files[0]), sentencepiece.SentencePieceProcessor(model_file=files[1])
    a.encode_special_tokens = True
    values = alignment.byte_values()
    spelled_a = {i: bytes(values[c] for c in s) if set(s) <= values.keys() else s.encode() for s, i in a.get_vocab().items()}
    spelled_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in range(b.get_piece_size())]
    return a, b, spelled_a, spelled_b


TEXTS = ["The quick (brown) fox, isn't it?", "Grüße aus Köln!!! ### 42 1,000.50", "  two  spaces  and\ttabs\n\nlines ", "漢字 and 😀 emoji​ zero", "a ▁ sign",
         "<|endoftext|> </s> <0x0A>", " ", "\n", "x", "", None, "don't we'll ÿ× word,word --- 'quoted' \x00\x1c \x85 end", "palabra " * 3000 + "fin"]


def test_alignment_equals_plain_alignment(spark):
    rows = list(enumerate(TEXTS)) + [(100, TEXTS[0]), (101, TEXTS[0]), (101, TEXTS[0]), (None, TEXTS[1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").select("*", *[F.lit(7).alias(c) for c in ("pairs", "times", "copies", "links", "text_key")])
    tools = tokenizers()
    plain = {text: plain_alignment(text, *tools) for text in TEXTS}
    assert plain["a ▁ sign"] is None and plain[" "] is not None
    counts = Counter(link for _, text in rows if plain[text] for link in plain[text][3])
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(highest.get(b, 0), n)

    def expected(text):
        if plain[text] is None:
            return (0, 0, 0, 0, 0, 0, "")
        n_a, n_b, n_groups, links, digest = plain[text]
        return (n_a, n_b, n_groups, len(links), sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links), digest)

    for common in (alignment.COMMON_PAIRS, 5):  # all pairs sent to the tasks, or most of them joined
        got = alignment.alignment(docs, *tokenizer_files(), common_pairs=common).collect()
        assert Counter(tuple(r) for r in got) == Counter((i, *expected(text)) for i, text in rows)
    assert alignment.alignment(docs.where("false"), *tokenizer_files()).count() == 0


def test_words_are_aligned_as_in_whole_texts():
    tools, known = tokenizers(), alignment.alignments(*tokenizer_files())
    rng = random.Random(4)
    parts = ["a", "word", "Köln", " ", "  ", "\n", "'s", "'", "</s>", "12", ".", "!!", " the", ",", "漢", "😀", "\xa0", "\x85", "́", "ﬁ", "##", " x,y"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 12)))
        plain = plain_alignment(text, *tools)
        got = alignment.align_text(text, known)
        assert got[4] == (plain[4] if plain else "") and got[3] == (len(plain[3]) if plain else 0), repr(text)
        assert Counter(dict(zip(got[5].tolist(), got[6].tolist()))) == Counter(b << 32 | a for a, b in (plain[3] if plain else []))
