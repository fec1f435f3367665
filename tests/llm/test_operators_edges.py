"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import hashlib
import random
import time
import zlib
from collections import Counter, defaultdict
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from firstprint.llm import chat, decontaminate, extraction, language, licenses, neardup, packing, quality, token_counts, toxicity
from firstprint.llm.caching import Remembered
from firstprint.llm.queries.packing import tokenizer_file
from firstprint.llm.queries.token_counts import vocabulary

PLAIN = " ".join(f"word{i % 37} runs over the hill number {i}" for i in range(40))
LONG = " ".join(f"token{i}" for i in range(60_000))
ROWS = [(1, PLAIN), (2, None), (3, ""), (4, " \n\t "), (5, LONG), (6, PLAIN), (6, PLAIN), (7, PLAIN + " and one more"),
        (8, "three short words"), (9, "Three short WORDS"), (None, PLAIN), (10, "</s>[INST] ok \\ [/INST]"), (11, "... 123 !!!")]
CLASHING = "n_words string, kept string, score string, node string, key string, text_hash string, lang string, label string"


@pytest.fixture(scope="module")
def docs(spark):
    plain = spark.createDataFrame(ROWS, "doc_id bigint, text string")
    return plain.select("*", *[F.lit("x").alias(c.split()[0]) for c in CLASHING.split(", ")])


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (6, 1, 0), (6, 1, 1), (8, 0, 1), (None, 1, 0), (7, None, None)],
                                 "doc_id bigint, quality int, toxic int")


def ids(rows, name="doc_id"):
    return sorted(-1 if r[name] is None else r[name] for r in rows)


ALL = sorted(-1 if i is None else i for i, _ in ROWS)


def test_packing_is_the_same_however_tied_rows_arrive(spark):
    rows = [(1 if i % 3 else None, " ".join(f"word{i}x{j}" for j in range(6 + i % 4))) for i in range(60)]
    shown = []
    for given in (rows, rows[::-1]):
        df = spark.createDataFrame(given, "doc_id bigint, text string").repartition(3)
        shown.append(sorted(map(str, packing.packed(df, tokenizer_file(), with_ids=False).collect())))
    assert shown[0] == shown[1] and len(shown[0]) == 60


def test_packing_cuts_every_text_whole(docs, none):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokenizer_file())
    rows = packing.packed(docs, tokenizer_file()).collect()
    pieces = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
    for doc_id, text in {k: v for k, v in ROWS}.items():
        expected = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        copies = sum(1 for i, _ in ROWS if i == doc_id)
        mine = sorted(pieces[doc_id], key=lambda r: r["start"])[::copies]
        assert [x for r in mine for x in r["ids"]] == expected
        assert all(r["doc_tokens"] == len(expected) for r in mine)
        assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in mine)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= packing.WINDOW
    assert packing.packed(none, tokenizer_file()).count() == 0


def test_plan_uses_up_any_histogram():
    rng = np.random.default_rng(3)
    for total in (1, 4, 16):
        for _ in range(30):
            histogram = rng.integers(0, 50, total) * rng.integers(0, 2, total)
            used = Counter()
            for way, n in packing.plan(histogram):
                assert sum(way) <= total and n > 0
                for size in way:
                    used[size] += n
            assert all(used[i + 1] == histogram[i] for i in range(total))


def test_nnls_meets_the_optimality_conditions():
    rng = np.random.default_rng(1)
    for _ in range(20):
        a, b = rng.random((6, 12)), rng.random(6)
        x = packing.nnls(a, b)
        slope = a.T @ (b - a @ x)
        assert (x >= 0).all() and (slope < 1e-6).all() and np.abs(slope[x > 1e-9]).max(initial=0) < 1e-6


def test_words_encode_as_the_tokenizer_does():
    from hypothesis import given, settings, strategies as st
    from tokenizers import Tokenizer
    tokenizer, ids_of = Tokenizer.from_file(tokenizer_file()), Remembered(packing.WordIds(tokenizer_file()))
    signs = st.sampled_from([*"aZ é Ñß'sİΣς中́\xa0\x85\x1c\n\t.,!*&$#<|", "<|endoftext|>", " the "])

    @settings(max_examples=200, deadline=None)
    @given(st.lists(signs, max_size=25).map("".join))
    def same(text):
        expected = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert packing.encoded(text, ids_of, b"") == expected
    same()


def test_quality_counts_and_verdicts(docs, none, labels):
    found = quality.quality_rules(docs, docs, labels).select("doc.doc_id", "n_words", "n_repeat_words", "base_failed", "kept", "ratio").collect()
    assert ids(found) == ALL
    by = {r["doc_id"]: r for r in found}
    assert by[2]["n_words"] == by[3]["n_words"] == by[4]["n_words"] == 0 and by[2]["base_failed"] and by[2]["ratio"] is None
    assert by[5]["n_words"] == 60_000 and by[5]["n_repeat_words"] == 0
    assert by[1]["n_words"] == by[6]["n_words"] == 280 and by[1]["ratio"] == by[6]["ratio"]
    assert quality.quality_rules(none, none, labels).count() == 0
    unlabelled = quality.quality_rules(docs, docs, labels.where("false")).select("ratio").where("ratio is not null").distinct().collect()
    assert [r["ratio"] for r in unlabelled] == [0.0]


def test_quality_counts_every_trusted_row(spark):
    n = 12_000
    df = spark.range(n).selectExpr("id as doc_id", "concat('w', id % 50, ' common') as text").unionAll(
        spark.createDataFrame([(None, "w1 common"), (None, "w2 common")], "doc_id bigint, text string"))
    labels = spark.range(n).selectExpr("id as doc_id", "1 as quality")
    counts = quality.gram_counts(df, quality.trusted_ids(labels)).agg({"trusted": "sum", "raw": "sum"}).first()
    assert (counts["sum(trusted)"], counts["sum(raw)"]) == (3 * n, 3 * (n + 2))


def test_repeat_words_against_brute_force(spark):
    texts = ["a b c d a b c", "x x x x x", "a b c x a b c y b c x", "one two", "p q r p q r p q"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r["doc_id"]: r["n_repeat_words"] for r in quality.verdicts(df, [0] * quality.BUCKETS).select("doc.doc_id", "n_repeat_words").collect()}
    for i, text in enumerate(texts):
        words = text.split()
        grams = [tuple(words[j:j + 3]) for j in range(len(words) - 2)]
        hit = {j + k for j, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
        assert got[i] == len(hit), text


def test_language_edges(docs, none):
    model = language.fit(docs.withColumn("lang", F.when(F.col("doc_id") == 5, "fr").when(F.col("doc_id") == 1, "en")), F.lit(True))
    assert model["languages"] == ["en", "fr"]
    found = language.identified(docs, model).select("doc.doc_id", "lang_pred", "score").collect()
    by = {r["doc_id"]: r for r in found}
    assert ids(found) == ALL
    assert all((by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0) for i in (2, 3, 4, 11))
    assert by[1]["lang_pred"] == "en" and by[5]["lang_pred"] == "fr" and 0.5 <= by[8]["score"] <= 1
    empty = language.fit(none, F.lit(True))
    assert {r["lang_pred"] for r in language.identified(docs, empty).collect()} == {"und"}
    assert language.identified(none, model).count() == 0


def test_language_scores_are_those_of_plain_naive_bayes():
    rng = np.random.default_rng(0)
    matrix = np.log(rng.dirichlet(np.ones(language.BUCKETS), 3).T + 1e-12).astype(np.float32)
    texts = ["ab c", "zzz", None, "x" * 300, "..", "é à ü"]
    names, scores = language.score_texts(texts, {"languages": ["a", "b", "c"], "matrix": matrix})
    for text, name, score in zip(texts, names, scores):
        grams = language.buckets_of(text)
        if not len(grams):
            assert (name, score) == ("und", 0.0)
            continue
        sums = matrix[grams].sum(axis=0, dtype=np.float64)
        chances = np.exp(sums - sums.max()) / np.exp(sums - sums.max()).sum()
        assert name == "abc"[sums.argmax()] and score == pytest.approx(chances.max())


def test_language_sample_against_brute_force(spark):
    rows = [(i, ("en", "de", "fr", "xx", None)[min(i % 11, 4)]) for i in range(2_000)] + [(7, "en"), (7, "en"), (None, "en")] * 50
    df = spark.createDataFrame(rows, "doc_id bigint, lang string")
    found = sorted(map(tuple, language.sample_ids(df, F.expr("doc_id % 3 != 1"), 20, 3).collect()))
    known = {(i, x) for i, x in rows if i is not None and x and i % 3 != 1}
    sizes = Counter(x for _, x in known)
    common = sorted(sizes, key=lambda x: (-sizes[x], x))[:3]
    assert found == sorted(pair for x in common for pair in sorted(
        (p for p in known if p[1] == x), key=lambda p: (hashlib.md5(str(p[0]).encode()).hexdigest(), p[0]))[:20])


def test_language_counts_a_repeated_row_once(spark):
    rows = [(1, "en", "the hill"), (2, "de", "der berg")]
    once, often = (language.fit(spark.createDataFrame(x, "doc_id int, lang string, text string"), F.lit(True)) for x in (rows, rows + rows[:1] * 9))
    assert once["languages"] == often["languages"] and (once["matrix"] == often["matrix"]).all()


def test_toxicity_edges(docs, none, labels):
    for model in (toxicity.fit(docs, labels, F.lit(True)), toxicity.fit(docs, labels.where("false"), F.lit(True))):
        found = toxicity.toxicity(docs, model).collect()
        assert ids(found) == ALL and all(0 <= r["score"] <= 1 for r in found)
        assert toxicity.toxicity(none, model).count() == 0


def test_toxicity_finds_words_that_mark_toxic_texts(spark):
    rng = np.random.default_rng(5)
    syllables = ["ka", "ro", "mi", "ten", "sal", "ver", "dun", "pil"]
    rows = []
    for i in range(600):
        words = ["".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(60)]
        if i % 4 == 0:
            for _ in range(3):
                words.insert(rng.integers(0, 60), str(rng.choice(["blockhead", "nitwit", "rubbish"])))
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    df = spark.createDataFrame(rows, "doc_id int, text string, toxic int")
    model = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"), F.col("doc_id") < 400)
    held = toxicity.toxicity(df.select("doc_id", "text"), model).join(df, "doc_id").where("doc_id >= 400").collect()
    assert np.mean([(r["score"] >= 0.5) == bool(r["toxic"]) for r in held]) > 0.95


def test_licenses_edges(docs, none, spark):
    assert licenses.license_spans(docs).count() == 0 and licenses.license_spans(none).count() == 0
    mit = licenses.TEMPLATES["MIT"]
    texts = [(1, "Intro. " + mit.replace("without restriction", "with no restriction at all") + " End."), (2, mit[:300]), (3, None),
             (4, "Released under the MIT License. Released under the MIT License."), (None, "licensed under cc by-nc 4.0")]
    found = licenses.license_spans(spark.createDataFrame(texts, "doc_id int, text string")).collect()
    assert [(r["license"], r["start"]) for r in found if r["doc_id"] == 1] == [("MIT", 1)] and not [r for r in found if r["doc_id"] == 2]
    assert [(r["start"], r["end"]) for r in found if r["doc_id"] == 4] == [(0, 5), (5, 10)]
    assert [r["license"] for r in found if r["doc_id"] is None] == ["CC-BY-NC-4.0-notice"]


def scanned(words):
    return licenses.scan(words, licenses.gram_hashes(words, Remembered(licenses.xxhash.xxh64_intdigest)), licenses.standard_index())


def test_licenses_with_inserted_blocks():
    whole = ["MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0-header", "GPL-3.0-header", "MPL-2.0-header", "Unlicense"]
    for name in whole:
        template = licenses.words_of(licenses.TEMPLATES[name])
        for size in (10, 25, 40):
            for share in (0.35, 0.5, 0.65):
                cut = int(share * len(template))
                words = [b"pre"] * 3 + template[:cut] + [b"put%d" % i for i in range(size)] + template[cut:] + [b"post"] * 3
                assert scanned(words) == [(name, 3, 3 + len(template) + size, len(template), 1.0)], (name, size, share)
        far = template[:len(template) // 2] + [b"x"] * (len(template) + 1) + template[len(template) // 2:]
        assert name not in [x[0] for x in scanned(far)]  # the gap is bounded
    mit = licenses.words_of(licenses.TEMPLATES["MIT"])
    twice = mit[:80] + [b"x"] * 20 + mit[80:] + mit[:60] + [b"y"] * 30 + mit[60:]
    assert [(x[0], x[1], x[2], x[3]) for x in scanned(twice)] == [
        ("MIT", 0, len(mit) + 20, len(mit)), ("MIT", len(mit) + 20, 2 * len(mit) + 50, len(mit))]


def test_license_openings_and_whole_texts():
    for name in licenses.TEMPLATES:
        template = licenses.words_of(licenses.TEMPLATES[name])
        assert scanned(template) == [(name, 0, len(template), len(template), 1.0)]


def test_banded_alignment_equals_the_whole_one():
    """A band as wide as both texts is the plain local alignment; the band of the scan finds the same."""
    index, rng = licenses.standard_index(), np.random.default_rng(2)
    hashes = Remembered(lambda w: zlib.crc32(w) + (len(w) << 40))
    hashes = Remembered(licenses.xxhash.xxh64_intdigest)
    for number, template in enumerate(index.words):
        words = [b"pre"] * 3 + list(template) + [b"post"] * 3
        for _ in range(len(template) // 12):
            at = int(rng.integers(3, len(words) - 3))
            words[at:at + 1] = [[b"changed"], [], [words[at], b"added"]][rng.integers(0, 3)]
        covered, start, end = licenses.align(template, words, -len(template), len(words), 0, len(words))
        if covered >= licenses.LEAST_COVERAGE * len(template):
            found = [x for x in licenses.scan(words, licenses.gram_hashes(words, hashes), index) if x[0] == index.names[number]]
            assert found == [(index.names[number], start, end, covered, covered / len(template))]


def test_token_counts(docs, none):
    initial, continuing = map(set, vocabulary())

    def pieces(word):
        at, n = 0, 0
        while at < len(word):
            stop = next((j for j in range(len(word), at, -1) if word[at:j] in (initial if at == 0 else continuing)), None)
            if stop is None:
                return 0
            at, n = stop, n + 1
        return n
    found = token_counts.token_counts(docs, vocabulary).collect()
    assert ids(found) == ALL
    by = {r["doc_id"]: r for r in found}
    for doc_id, text in ROWS:
        if doc_id != 5:
            counts = [pieces(w) for w in (text or "").split()]
            assert by[doc_id]["n_tokens"] == sum(counts) + counts.count(0) and by[doc_id]["n_unknown"] == counts.count(0)
    assert by[5]["n_words"] == 60_000
    assert token_counts.token_counts(none, vocabulary).count() == 0


def test_automaton_equals_greedy_matching():
    import random
    rng = random.Random(4)
    some = lambda: {"".join(rng.choices("abc", k=rng.randint(1, 4))) for _ in range(rng.randint(0, 9))}
    for _ in range(200):
        initial, continuing = some(), some()
        automaton = token_counts.Automaton(initial, continuing)
        for _ in range(60):
            word, at, n = "".join(rng.choices("abc", k=rng.randint(1, 12))), 0, 0
            while at < len(word):
                stop = next((j for j in range(len(word), at, -1) if word[at:j] in (initial if at == 0 else continuing)), None)
                if stop is None:
                    n = 0
                    break
                at, n = stop, n + 1
            assert automaton.count(word) == n


def test_chat_round_trip(spark):
    odd = "a\\<b[c]</s>[/INST] [INST] \\\\ <s>"
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", odd), (1, 2, "assistant", ""), (2, None, None, None), (2, 0, "tool:[x]", "t"),
             (3, 0, "assistant", "z" * 5000), (3, 0, "assistant", "z" * 5000), (None, 0, "system", "s")]
    df = spark.createDataFrame(turns, "conv_id int, turn int, role string, text string").withColumn("chunk", F.lit("x"))
    for size in (16, 1 << 20):
        chunks = chat.format_conversations(df, chunk_chars=size)
        found = {r["conv_id"]: r for r in chat.digests(chunks).collect()}
        assert set(found) == {1, 2, 3, None}
        for conv_id in found:
            mine = sorted([(-1 if t is None else t, r or "", x or "") for c, t, r, x in turns if c == conv_id])
            spoken = "".join(f"{r}\n{x}\n" for _, r, x in mine)
            loss = "".join(x for _, r, x in mine if r == "assistant")
            assert found[conv_id]["turns_sha256"] == hashlib.sha256(spoken.encode()).hexdigest()
            assert found[conv_id]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
            assert (found[conv_id]["n_turns"], found[conv_id]["loss_chars"]) == (len(mine), len(loss))
    assert chat.digests(chat.format_conversations(df.where("false"))).count() == 0


def test_template_language():
    def shown(source, messages=()):
        return "".join(text for text, _ in chat.compile_template(source)(messages))
    assert shown("{{ 'a' + 'b' | upper }}{# no #}{% if 1 == 2 %}x{% elif not 0 %}y{% else %}z{% endif %}") == "aBy"
    assert shown("{% for m in messages %}{{ loop.index }}{{ m['role'] }}{% if not loop.last %}, {% endif %}{% endfor %}",
                 [{"role": "u"}, {"role": "v"}]) == "1u, 2v"
    assert shown("a  {%- set x = 'q' -%}  b{{ x }}") == "abq"
    assert chat.fold_body(chat.parse("a{{ 'b' }}{% if false %}c{% endif %}d")) == [("out", ("value", "abd"))]
    assert list(chat.compile_template("x{% generation %}y{% endgeneration %}")(())) == [("x", False), ("y", True)]
    for bad in ("{{ open('x') }}", "{{ x.__class__() }}", "{% for %}", "{% if 1 %}", "{{ 'a' | exec }}", "{% import os %}"):
        with pytest.raises(chat.TemplateError):
            shown(bad)
    with pytest.raises(chat.TemplateError):
        shown("{{ 'a'.__class__ }}")


def test_extraction_edges(spark):
    pages = [(1, "u", "<nav><a href=/>Menu</a></nav><article><h1>A  title</h1><p>One &amp; two<b>!</b><p>Three<br>four<script>x</script></article>"
                           "<footer>&copy; us</footer>"), (2, None, None), (3, "u", ""), (4, "u", "<<<>>> & <p"), (None, "u", "<article><p>Lone text stands here."),
             (1, "u", "<article><p>Again.</p></article>")]
    df = spark.createDataFrame(pages, "page_id int, url string, html string").withColumn("text", F.lit("x")).withColumn("n_chars", F.lit("x"))
    model = extraction.fit(df)
    found = extraction.main_texts(df, model).collect()
    assert len(found) == len(pages) and all(r["n_chars"] == len(r["text"]) for r in found)
    assert "A title One & two! Three four" in {r["text"] for r in found if r["page_id"] == 1}
    assert {r["text"] for r in found if r["page_id"] in (2, 3)} == {""}
    assert extraction.main_texts(df.where("false"), model).count() == 0


def test_blocks_after_elements_left_open():
    texts = lambda page: [x[0] for x in extraction.blocks_of(page)]
    for page in ("<html><head><title>t</title><body><p>One.</p><p>Two.</p></body></html>",
                 "<html><head><meta charset=x><link href=y><style>s</style><script>z</script><p>One.</p><p>Two.</p>",
                 "<head><title>t</title><div><p>One.</p></div><p>Two.", "<head><title>t</title>One.<p>Two.</p>",
                 "<head></head><body><head><p>One.</p><p>Two.</p>",
                 "<body><svg><path d=m><text>drawn</text><p>One.</p><p>Two.</p>",
                 "<body><p>One.</p><div><svg><g><text>drawn</text><div>Two.</div></div>"):
        assert texts(page) == ["One.", "Two."], page
    assert texts("<svg><foreignObject><p>held</p></foreignObject><text>drawn</text></svg><p>One.</p>") == ["One."]


def test_blocks_keep_math_and_object_text():
    texts = lambda page: [x[0] for x in extraction.blocks_of(page)]
    assert texts("<p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p>") == ["So x=2 holds."]
    assert texts("<object data=a><param name=b>Seen <b>instead</b>.</object><p>One.</p>") == ["Seen instead.", "One."]
    assert texts("<div><object data=a><p>One.</p><p>Two.</p></div>") == ["One.", "Two."]


def test_blocks_after_stray_quotes_and_odd_comments():
    texts = lambda page: [x[0] for x in extraction.blocks_of(page)]
    assert texts("<p title=it's>First words here.</p><p>We don't go.</p><p>Third.</p>") == ["First words here.", "We don't go.", "Third."]
    assert texts("<!--><p>One.</p><!-- x --><p>Two.</p>") == texts("<!---><p>One.<!-- a > b --!><p>Two.<!-- gone <p>x") == ["One.", "Two."]
    assert texts("<p a='x>One.</p><p>Two.") == texts('<p a = "q>r" b/>One.</p><p/ =x>Two.') == ["One.", "Two."]
    assert texts("x<y and z <b") == ["x<y and z <b"] and texts("a > b <c <d <!e") == ["a > b <c <d"]


def test_blocks_of_deep_and_broken_pages_take_time_in_proportion():
    vectors = extraction.Vectors()
    for page, n in (("<div>w" * 20_000, 20_000), ("<div>" * 20_000 + "</span>" * 20_000 + "w", 1), ("a<b " * 100_000, 1),
                    ("<i>" * 4_000 + "<div><p>w</p></div>" * 4_000, 4_000), (f"<div class='{'ab ' * 4_000}'>" + "<p>w</p>" * 4_000, 4_000),
                    ("<canvas>" + "<i>" * 20_000, 0)):
        began = time.process_time()
        blocks = extraction.blocks_of(page)
        assert len(blocks) == n and all(np.isfinite(extraction.rows_of([x], vectors)).all() for x in blocks[-3:])
        extraction.rows_of(blocks, vectors)
        assert time.process_time() - began < 20


def test_path_vectors_are_sums_over_the_whole_path():
    page = "".join(f"<div class='a{chr(97 + i % 26)} Bc{i % 7}'>" for i in range(60)) + "word"
    [(_, path, _)] = extraction.blocks_of(page)
    names, step = [], path
    while step:
        names, step = [*step.names, *names], step.above
    plain = np.zeros(extraction.PATH_SIZE)
    for depth, name in enumerate(reversed(names)):
        place, sign = extraction._place(name, extraction.PATH_SIZE, "path ")
        plain[place] += sign * extraction.FADE ** depth
    assert np.allclose(extraction.Vectors().of_path(path), plain, atol=1e-4)


class PlainReader(HTMLParser):
    """Blocks of well-formed pages by the standard library's parser: text between tags that are not inline."""

    def __init__(self, page):
        super().__init__()
        self.blocks, self.hidden, self.text = [], 0, ""
        self.feed(page)
        self.close()
        self.cut()

    def cut(self):
        self.blocks += [" ".join(self.text.split())] if self.text.strip() else []
        self.text = ""

    def handle_starttag(self, tag, attrs):
        if tag not in extraction.INLINE:
            self.cut()
        self.hidden += tag in extraction.UNSEEN

    def handle_endtag(self, tag):
        if tag not in extraction.INLINE:
            self.cut()
        self.hidden -= tag in extraction.UNSEEN

    def handle_data(self, data):
        self.text += "" if self.hidden else data


def test_blocks_against_a_plain_reader():
    rng = random.Random(3)
    sentences = ["Birds sing &amp; fly.", "Nobody <b>minds</b> it.", "The river&#39;s wide, <i>and</i> slow.", "1 &lt; 2, he said."]
    pages = [extraction._layout(sentences, rng)[0] for _ in range(150)]
    assert all([x[0] for x in extraction.blocks_of(page)] == PlainReader(page).blocks for page in pages)


def test_extraction_learns_its_layouts():
    rows, marks = extraction.training_pages(["<p>Birds sing early. Nobody minds. The river runs on, wide and slow.</p>"])
    cut = len(rows) * 4 // 5
    model = extraction.train(rows[:cut], marks[:cut])
    right = [((extraction.label([x], model)[0] >= 0.5) == (y > 0.5)).mean() for x, y in zip(rows[cut:], marks[cut:])]
    assert np.mean(right) > 0.97


def test_lstm_gradients_match_differences():
    rng = np.random.default_rng(0)
    x, mask = rng.standard_normal((2, 4, 3)), np.array([[1, 1, 1, 1], [1, 1, 0, 0.0]])
    w, u, b = rng.standard_normal((3, 8)), rng.standard_normal((2, 8)), rng.standard_normal(8)
    aim = rng.standard_normal((2, 4, 2))
    loss = lambda: float((extraction._scan(x, mask, w, u, b)[0] * aim).sum())
    states, kept = extraction._scan(x, mask, w, u, b)
    for array, slope in zip((w, u, b), extraction._unscan(x, aim.astype(np.float32), kept, u)):
        at = tuple(int(rng.integers(0, n)) for n in array.shape)
        old, step = array[at], 1e-2
        array[at] = old + step
        high = loss()
        array[at] = old - step
        low = loss()
        array[at] = old
        assert slope[at] == pytest.approx((high - low) / (2 * step), rel=0.02, abs=0.01)


def test_decontamination_edges(docs, none, spark):
    items = spark.createDataFrame([(1, "short words"), (2, None), (3, "... !"), (None, "three"), (4, " ".join(f"token{i}" for i in range(100, 112))),
                                   (40, "Token500 token501 token502 token503 token504 token505 token506 token507 token508 token509"), (5, "a a a a a a a a a a")],
                                  "item_id int, text string").withColumn("spoken", F.lit("x"))
    docs = docs.select("doc_id", "text").union(spark.createDataFrame([(20, "b " + "a " * 30 + "c")], "doc_id bigint, text string"))
    found = decontaminate.contamination(docs, items).collect()
    assert ids(found) == sorted(ALL + [20])
    by = {r["doc_id"]: r for r in found}
    assert (by[5]["n_hit"], by[5]["item_ids"]) == (22, ["4", "40"])
    assert (by[8]["n_hit"], by[9]["n_hit"], by[8]["item_ids"]) == (2, 2, ["1"])
    assert (by[20]["n_hit"], by[20]["n_words"]) == (30, 32)
    assert all(by[i]["n_hit"] == 0 and by[i]["item_ids"] == [] for i in (1, 2, 3, 4, 6, None))
    assert decontaminate.contamination(none, items).count() == 0
    assert {r["n_hit"] for r in decontaminate.contamination(docs, items.where("false")).collect()} == {0}


def test_near_duplicates_against_brute_force(spark):
    rng = np.random.default_rng(8)
    rows = [(i, t) for i, t in ROWS if i != 5]
    for family in range(6):
        base = [f"w{rng.integers(0, 400)}" for _ in range(int(rng.integers(7, 160)))]
        for copy in range(25):
            words = list(base)
            for _ in range(int(rng.integers(0, 4))):
                words[rng.integers(0, len(words))] = f"e{rng.integers(0, 9999)}"
            rows.append((100 * (family + 1) + copy, " ".join(words)))
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("node", F.lit("x"))).collect()

    def shingles(text):
        words = (text or "").lower().split()
        return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()
    sets = [(i, shingles(t)) for i, t in rows]
    top = list(range(len(rows)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i
    for i, (_, a) in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j][1])
            if both and 100 * both >= 85 * len(a | sets[j][1]):
                top[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (doc_id, _) in enumerate(sets):
        least[root(i)] = min(least.get(root(i), 1 << 60), 1 << 60 if doc_id is None else doc_id)
    expected = Counter((doc_id, len(s), doc_id if not s else least[root(i)]) for i, (doc_id, s) in enumerate(sets))
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == expected


def test_blocks_of_a_group_give_the_same_components(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 3)
    test_near_duplicates_against_brute_force(spark)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 200), (300, 300)]
    found = dict(map(tuple, neardup.components(spark.createDataFrame(edges, "a int, b int")).collect()))
    assert {found[i] for i in range(41)} == {0} and {found[i] for i in range(100, 140)} == {100} and found[201] == found[200] == 200


def test_register_estimates_are_close():
    rng = np.random.default_rng(6)
    for n, shared in ((3000, 2700), (400, 340), (60, 52), (9, 8)):
        off = []
        for _ in range(30):
            both = rng.integers(0, 1 << 63, 2 * n - shared, dtype=np.uint64)
            a, b = np.unique(both[:n]), np.unique(both[n - shared:])
            got = neardup.estimate(neardup.registers(a)[None], neardup.registers(b)[None], np.array([n]), np.array([n]))[0]
            off.append(got - shared / (2 * n - shared))
        assert max(map(abs, off)) < neardup.ESTIMATE_SLACK and abs(np.mean(off)) < 0.03


def test_words_in_use_outlive_a_full_memory():
    from firstprint.llm.caching import RememberedOften

    asked = []
    memory = RememberedOften(lambda k: asked.append(k) or k.encode(), most=8, longest=5)
    for i in range(200):
        assert (memory["often"], memory[str(i)], memory[""], memory["long" * 3]) == (b"often", str(i).encode(), b"", b"long" * 3)
        assert len(memory) + len(memory.older) <= 8
    assert asked.count("often") == asked.count("") == 1 and asked.count("long" * 3) == 200
