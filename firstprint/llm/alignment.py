"""Alignment of two tokenizers over a corpus, each distinct text once.

Texts are shuffled by their full text, so that copies meet and every distinct text is tokenised and aligned once, whatever
number of documents share it. How often two ids are linked in the corpus is then counted with each text's links weighted
by its number of copies, and what is measured on a text is joined back to all doc_ids that have it.

Words come again and again, so the alignments of the stretches between places where both tokenizers start anew are
remembered in each Python worker, within a bound.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain, groupby
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from firstprint.llm.frames import frame
from firstprint.session import materialize

# Pairs of ids that are sent to every task: the commonest ones. All other pairs are counted by a join.
COMMON_PAIRS = 65_536
TOGETHER = 500_000  # characters of text whose words are looked up together

SPACE = "▁"
LETTER, SIGN = "[A-Za-zÀ-ÖØ-öø-ÿ]", r"[!-&(-/:-@\[-`{-~]"  # the apostrophe starts words of its own, so it is no sign here
ONE_WORD = re.compile(f" ?(?:{LETTER}+|{SIGN}+)")
WORD_AND_SIGNS = re.compile(f"( {LETTER}+)({SIGN}+)")
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


class Aligned(NamedTuple):
    """The alignment of one stretch of text: sizes, groups as text, and the pairs of all links as 64-bit numbers (B's id high)."""
    n_a: int
    n_b: int
    n_groups: int
    groups: bytes
    pairs: bytes


def byte_values() -> dict[str, int]:
    """Byte-level BPE writes a byte that prints as itself, and the others as the characters from U+0100 on, in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = (b for b in range(256) if b not in shown)
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


def spaced_words(text: str) -> list[str]:
    """A space and the text, cut in front of every single space between visible characters."""
    words = text.split(" ")
    if all(words) and list(map(str.strip, words)) == words:
        return [" " + w for w in words]
    cut = [" " + words[0]]
    for last, word in zip(words, words[1:]):
        if last and word and not last[-1].isspace() and not word[0].isspace():
            cut.append(" " + word)
        else:
            cut[-1] += " " + word
    return cut


class Aligner:
    """Both tokenizers with the bytes of their tokens. A is a byte-level BPE, B a sentencepiece model that adds a space.

    Both start anew in front of a single space between visible characters, and between a letter and a sign: A splits there
    before it merges, and whether no piece of B crosses such a place is checked here.
    """

    def __init__(self, byte_bpe_file: str, piece_file: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        self.a, self.b = Tokenizer.from_file(byte_bpe_file), SentencePieceProcessor(model_file=piece_file)
        self.a.encode_special_tokens = True  # their strings are plain text
        values = byte_values()
        self.a_bytes = {i: bytes(map(values.__getitem__, entry)) if values.keys() >= set(entry) else entry.encode()
                        for entry, i in self.a.get_vocab().items()}
        self.one_word = merging(byte_bpe_file, self.a_bytes) or (lambda word: self.a.encode(word, add_special_tokens=False).ids)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_sizes = np.array([len(self.a_bytes[i]) for i in range(len(self.a_bytes))])
        self.b_sizes = np.array([len(b) for b in self.b_bytes])
        plain = [p for i, p in enumerate(pieces) if not self.b.is_byte(i) and not self.b.is_control(i) and not self.b.is_unknown(i)]
        self.cut_at_spaces = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in plain)
        self.cut_at_signs = not any(re.search(f"{LETTER}{SIGN}", p) for p in plain)
        self.ahead = len(self.b.encode("a"))

    def words(self, text: str) -> list[str]:
        """A space and the text, cut into what can be aligned by itself."""
        return spaced_words(text) if self.cut_at_spaces else [" " + text]

    def ids_a(self, stretch: str) -> list[int]:
        if ONE_WORD.fullmatch(stretch):  # nothing to split: on to the merges
            return self.one_word(stretch)
        return self.a.encode(stretch, add_special_tokens=False).ids

    def align(self, stretches: list[str]) -> list[Aligned | None]:
        """The alignment of each; None where the tokens of one side spell something else.

        A stretch begins with a space, which B adds by itself, or with signs behind a letter.
        """
        all_a = list(map(self.ids_a, stretches))
        all_b = self.b.encode([s[1:] if s[0] == " " else "a" + s for s in stretches], num_threads=1)
        all_b = [ids if s[0] == " " else ids[self.ahead:] for s, ids in zip(stretches, all_b)]
        spoken = [s.encode("utf-8", "surrogatepass") for s in stretches]
        spelled_a, spelled_b = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        joined = lambda spelled, lists: b"".join(map(spelled, chain.from_iterable(lists)))
        if all(all_a) and all(all_b) and joined(spelled_a, all_a) == b"".join(spoken) == joined(spelled_b, all_b):
            ends = np.cumsum(list(map(len, spoken)))  # nearly always all are good, and seen to be so at once
            if all(np.array_equal(ends_of(lists, sizes), ends) for lists, sizes in ((all_a, self.a_sizes), (all_b, self.b_sizes))):
                return self._aligned(all_a, all_b)
        good = [b"".join(map(spelled_a, a)) == s == b"".join(map(spelled_b, b)) for s, a, b in zip(spoken, all_a, all_b)]
        aligned = iter(self._aligned([a for a, ok in zip(all_a, good) if ok], [b for b, ok in zip(all_b, good) if ok]))
        return [next(aligned) if ok else None for ok in good]

    def _aligned(self, all_a: list[list[int]], all_b: list[list[int]]) -> list[Aligned]:
        """Stretches one behind the other: every end of a token on either side ends a link, ends on both sides end groups."""
        a, b = list(chain.from_iterable(all_a)), list(chain.from_iterable(all_b))
        if not a:
            return []
        numbers_a, numbers_b = np.array(a), np.array(b)
        ends_a, ends_b = np.cumsum(self.a_sizes[numbers_a]), np.cumsum(self.b_sizes[numbers_b])
        both = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
        again = np.r_[both[1:] == both[:-1], False]
        ends, cuts = both[~again], both[again]
        pairs = numbers_b[np.searchsorted(ends_b, ends)] << 32 | numbers_a[np.searchsorted(ends_a, ends)]
        till_a, till_b, till = (np.searchsorted(x, cuts) + 1 for x in (ends_a, ends_b, ends))
        shown_a, shown_b = list(map(str, a)), list(map(str, b))
        groups, last_a, last_b = [], 0, 0
        for next_a, next_b in zip(till_a.tolist(), till_b.tolist()):
            of_a = shown_a[last_a] if next_a == last_a + 1 else ",".join(shown_a[last_a:next_a])
            of_b = shown_b[last_b] if next_b == last_b + 1 else ",".join(shown_b[last_b:next_b])
            groups.append(f"{of_a}|{of_b}")
            last_a, last_b = next_a, next_b
        last = np.searchsorted(till_a, np.cumsum([len(ids) for ids in all_a])) + 1  # groups till the end of each stretch
        found, done, packed, at = [], 0, pairs.astype("<i8").tobytes(), 0
        for ids_a, ids_b, upto, links in zip(all_a, all_b, last.tolist(), till[last - 1].tolist()):
            found.append(Aligned(len(ids_a), len(ids_b), upto - done, ";".join(groups[done:upto]).encode(), packed[8 * at:8 * links]))
            done, at = upto, links
        return found


def ends_of(lists: list[list[int]], sizes: np.ndarray) -> np.ndarray:
    """Where each list of ids ends, in bytes."""
    ends = np.cumsum(sizes[list(chain.from_iterable(lists))])
    return ends[np.cumsum(list(map(len, lists))) - 1]


def merging(byte_bpe_file: str, spelled: dict[int, bytes]) -> Callable[[str], list[int]] | None:
    """The file's merges for a text that is one word to it, without splitting; None if its ids are not in order of merging."""
    import tiktoken
    with open(byte_bpe_file, encoding="utf-8") as file:
        model = json.load(file)["model"]
    merged = [model["vocab"].get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    if merged != list(range(256, 256 + len(merged))):
        return None
    ranks = {spelled[i]: i for i in range(256 + len(merged))}
    return tiktoken.Encoding("one word", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class Remembering:
    """f(list of keys) as a table, remembered in two generations: a full one becomes the older, and its hits move up again."""

    def __init__(self, f: Callable[[list[str]], list], most: int, longest: int = 64):
        self.f, self.most, self.longest = f, most, longest
        self.young: dict = {}
        self.old: dict = {}

    def of(self, keys: Iterable[str]) -> dict:
        """One entry for each of different keys."""
        found, new, young, old = {}, [], self.young, self.old
        for key in keys:
            if value := young.get(key):
                found[key] = value
            elif value := old.get(key):
                found[key] = young[key] = value
            else:  # new, or without a value: worked out again
                new.append(key)
        for key, value in zip(new, self.f(new) if new else ()):
            found[key] = value
            if len(key) <= self.longest:  # long ones hardly come again
                young[key] = value
        if len(young) >= self.most:
            self.young, self.old = {}, young
        return found


class Alignments:
    """The alignments of words, and of the letters and the signs that they are made of."""

    def __init__(self, aligner: Aligner, most: int = 150_000):
        self.aligner = aligner
        self.stretches = Remembering(aligner.align, most)
        self.words = Remembering(self._words, most)

    def _words(self, words: list[str]) -> list[Aligned | None]:
        split = WORD_AND_SIGNS.fullmatch if self.aligner.cut_at_signs else lambda word: None
        halves = [m.groups() if (m := split(word)) else (word,) for word in words]
        found = self.stretches.of({half for both in halves for half in both})
        joined = []
        for both in halves:
            one = found[both[0]]
            if len(both) == 2 and one is not None:
                signs = found[both[1]]
                one = signs and Aligned(one[0] + signs[0], one[1] + signs[1], one[2] + signs[2], one[3] + b";" + signs[3], one[4] + signs[4])
            joined.append(one)
        return joined


@lru_cache(maxsize=1)
def alignments(byte_bpe_file: str, piece_file: str) -> Alignments:
    """One for each Python worker, whatever number of tasks it runs."""
    return Alignments(Aligner(byte_bpe_file, piece_file))


NOTHING = (0, 0, 0, 0, "", np.empty(0, np.int64), np.empty(0, np.int64))


def align_texts(texts: list[str | None], known: Alignments) -> list[tuple[int, int, int, int, str, np.ndarray, np.ndarray]]:
    """For each text n_a, n_b, n_groups, n_links, the digest of the groups, the linked pairs and how often each is linked.

    The words of all the texts are looked up together. B takes SPACE for a space, so a text with that sign has no tokens.
    """
    cut = [known.aligner.words(text) if text and SPACE not in text else [] for text in texts]
    found = known.words.of(set().union(*cut))
    return [measured(words, found) if words else NOTHING for words in cut]


def align_text(text: str | None, known: Alignments) -> tuple[int, int, int, int, str, np.ndarray, np.ndarray]:
    return align_texts([text], known)[0]


def measured(words: list[str], found: dict[str, Aligned | None]) -> tuple[int, int, int, int, str, np.ndarray, np.ndarray]:
    """The measures of a text from the alignments of its words."""
    times = Counter(words)
    different = [found[word] for word in times]
    if None in different:
        return NOTHING
    n = np.fromiter(times.values(), np.int64, len(times))
    sizes = np.array([one[:3] for one in different], np.int64)
    a, b, together = (n @ sizes).tolist()
    pairs, nth = np.unique(np.frombuffer(b"".join([one[4] for one in different]), "<i8"), return_inverse=True)
    links = sizes[:, 0] + sizes[:, 1] - sizes[:, 2]  # each token but a group's first adds one
    often = np.bincount(nth, np.repeat(n, links), len(pairs)).astype(np.int64)
    digest = hashlib.sha256(b";".join([found[word][3] for word in words])).hexdigest()
    return a, b, together, a + b - together, digest, pairs, often


def aligned_texts(texts: DataFrame, byte_bpe_file: str, piece_file: str) -> DataFrame:
    """Each row of `texts` (text, copies) aligned: text_key, copies, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = alignments(byte_bpe_file, piece_file)
        for batch in batches:
            texts = batch["text"].tolist()
            piece = (np.cumsum([len(text) for text in texts]) // TOGETHER).tolist()  # long texts go alone
            aligned = [one for _, group in groupby(zip(piece, texts), lambda x: x[0]) for one in align_texts([text for _, text in group], known)]
            rows = [(key, copies, *one) for key, copies, one in zip(batch["text_key"], batch["copies"], aligned)]
            yield frame("text_key copies n_a n_b n_groups n_links groups_sha256 pairs times", rows)

    kinds = ("text_key binary, copies bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string,"
             " pairs array<bigint>, times array<bigint>")
    return texts.select(text_key("text"), "text", "copies").mapInPandas(run, kinds)


def text_key(text: str):
    return F.unhex(F.sha2(F.col(text), 256)).alias("text_key")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """How often every pair is linked in the corpus, copies included, and whether no other A id meets its B id more often."""
    each = aligned.select("copies", F.inline(F.arrays_zip("pairs", "times")))
    counts = each.groupBy(F.col("pairs").alias("pair")).agg(F.sum(F.col("copies") * F.col("times")).alias("links"))
    highest = F.max("links").over(Window.partitionBy(F.shiftright("pair", 32)))
    return counts.select("pair", "links", (F.col("links") == highest).alias("best"))


def alignment(docs: DataFrame, byte_bpe_file: str, piece_file: str, common_pairs: int = COMMON_PAIRS) -> DataFrame:
    """One row per row of `docs`: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Byte offsets where a token of A and one of B both end cut a space and the text into groups; tokens whose byte ranges
    overlap are linked. n_best counts the links whose pair is the commonest of its B id in the corpus, ties included, and
    count_sum adds up how often their pairs are linked in the corpus. A null or empty text, and one that either side's
    tokens do not spell exactly, has zeros and an empty digest and adds nothing to the corpus. Texts of any length are
    aligned whole; repeated rows and copies count as often as they come and get equal rows; a null doc_id is carried;
    other columns are not read; an empty table gives no rows.

    The commonest pairs, `common_pairs` at most, are sent to every task; all others meet their counts in a join.
    """
    texts = docs.where("text != ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    aligned, _ = materialize(aligned_texts(texts, byte_bpe_file, piece_file), "aligned-texts")
    counts, _ = materialize(pair_counts(aligned), "pair-counts")
    common = F.broadcast(counts.orderBy(F.desc("links"), "pair").limit(common_pairs))
    links = aligned.select("text_key", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    often = links.join(common, "pair")
    seldom = links.join(common.select("pair"), "pair", "left_anti").join(counts, "pair")
    sums = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("links")).alias("count_sum")]
    scored = often.unionByName(seldom).groupBy("text_key").agg(*sums)
    measured, _ = materialize(aligned.drop("pairs", "times", "copies").join(scored, "text_key", "left"), "text-measures")
    return docs.select("doc_id", text_key("text")).join(measured, "text_key", "left").select(
        "doc_id", *[F.coalesce(m, F.lit(0)).alias(m) for m in MEASURES], F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
