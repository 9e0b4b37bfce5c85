"""Language identification by cross-parsing.

For each language a suffix automaton of labelled text is built. A text is parsed against it from left to
right into phrases, each the longest run of characters that occurs in the labelled text (one
character at least). The fewer phrases a language needs, the closer the text is to it. With c phrases for n
characters and N characters of labelled text, c * log2(N) / n estimates the cross entropy in bits
per character; the language with the smallest estimate wins. N is that of the largest sample for every
language: with its own, a sample of a few characters would make every phrase cheap and win any text.

Spark spreads the texts; inside a task all segments of a batch step through the automata together.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamfuse.llm.common import neutral, original

UNKNOWN = "und"
# The labelled sample the automata are built from: documents and characters of each language.
SAMPLE_DOCS = 600
DOC_CHARS = 65
SAMPLE_CHARS = 20_000
# Letters of a language, its most frequent ones, that have a column in its table; transitions by others are looked up.
DENSE = 126
# Long texts are parsed in segments of this length side by side; no phrase crosses a boundary.
SEGMENT = 1024
# Characters and texts handled at a time in a task.
BLOCK_CHARS = 1_000_000
BLOCK_TEXTS = 1_000
# A text with phrases above this share of its characters is not in any learned language: nearly all of
# its phrases are single characters, which any text falls into.
REJECT_SHARE = 0.8
# What a language may cost is learned from its own sample: one half is parsed against the other in pieces of
# PIECE characters, and SPREADS deviations above their mean are allowed, more on shorter texts. The deviation is
# the median of all languages, LEAST_SPREAD at least: texts half in one language and half in another stay.
# A sample with fewer pieces has the mean of the most lenient other language.
PIECE = 130
SPREADS = 6
LEAST_SPREAD = 0.025
MIN_PIECES = 8
# Numbers, hashes and codes are in no language: words with a digit count neither for nor against it.
DIGITS = re.compile(r"\S*\d\S*")


def crc32_text(column: str):
    """crc32 of the number as text."""
    return F.crc32(F.col(column).cast("string"))


def is_held_out():
    return F.coalesce(crc32_text("doc_id") % 4 == 2, F.lit(False))


def labelled_sample(
    docs: DataFrame, docs_each: int = SAMPLE_DOCS, chars: int = DOC_CHARS
) -> dict[str, str]:
    """Sample text for each language of ``lang``: about ``docs_each`` documents each, excerpts of ``chars``.

    Rows are drawn by hash at a rate that follows from the counts of each language, so the driver gets about that
    many short excerpts, whatever the size of the table. Equal excerpts count once.
    """
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_003)) / 1_000_003.0
    rates = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, docs_each / n))])
    rate = F.try_element_at(rates, F.col("lang"))
    # From the middle of the text, where openings that many texts share are over.
    start = F.greatest(F.floor((F.char_length("text") - chars) / 2) + 1, F.lit(1)).cast("int")
    excerpt = F.substring("text", start, F.lit(chars))
    drawn = known.filter(draw < rate).select("lang", F.lower(excerpt).alias("t")).distinct()
    drawn = drawn.withColumn("h", F.xxhash64("t"))
    found: dict[str, list[str]] = {lang: [] for lang in counts}
    # By hash, so that what is cut off is drawn by chance too.
    for lang, _, text in sorted((r["lang"], r["h"], r["t"]) for r in drawn.collect()):
        found[lang].append(text)
    size = min(SAMPLE_CHARS, max((sum(map(len, v)) for v in found.values()), default=0))
    out = {}
    for lang, texts in sorted(found.items()):
        joined = "\n".join(texts)
        if joined:
            out[lang] = joined[:size]
    return out


def suffix_automaton(text: str) -> list[dict[str, int]]:
    """Transitions of the smallest automaton that reads exactly the substrings of the text."""
    step: list[dict[str, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in text:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return step


class Table:
    """An automaton's steps: next state for (state, code), twice the state plus one where a phrase begins.

    Codes are those of the language's own letters, the frequent ones first. These have a column each; the few steps by others
    are kept as a sorted list, so a language of many letters takes no more room than another.
    """

    def __init__(self, sample: str, letters: list[str]):
        step = suffix_automaton(sample)
        ranked = [c for c, _ in sorted(Counter(sample).items(), key=lambda x: (-x[1], x[0]))]
        number = {c: i + 2 for i, c in enumerate(ranked)}
        self.own = np.array([0, 1, *(number.get(c, 1) for c in letters)], dtype=np.int32)
        self.width = min(len(ranked), DENSE) + 2
        self.letters = len(ranked) + 2
        # Samples of the default size have fewer than 2^15 states, and small tables stay in cache.
        small = 2 * len(step) < 1 << 16
        # An unknown character is a phrase, then the root again; padding stays there and costs nothing.
        start = np.ones(self.letters, dtype=np.uint16 if small else np.uint32)
        for c, to in step[0].items():
            start[number[c]] = to * 2 + 1
        start[0] = 0
        self.start = start
        table = np.tile(start[: self.width], (len(step), 1))
        rare: dict[int, int] = {}
        for state, row in enumerate(step[1:], 1):
            for c, to in row.items():
                code = number[c]
                if code < self.width:
                    table[state, code] = to * 2
                else:
                    rare[state * self.letters + code] = to * 2
        self.table = table.ravel()
        self.keys = np.array(sorted(rare), dtype=np.int64)
        self.next = np.array([rare[k] for k in sorted(rare)], dtype=start.dtype)

    def after(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        if self.letters == self.width:
            return self.table[state * self.width + code]
        dense = code < self.width
        out = self.table[state * self.width + np.where(dense, code, 1)]
        at = np.flatnonzero(~dense)
        if len(at):
            wanted = state[at] * self.letters + code[at]
            found = np.minimum(np.searchsorted(self.keys, wanted), max(len(self.keys) - 1, 0))
            goes_on = self.keys[found] == wanted if len(self.keys) else np.zeros(len(at), dtype=bool)
            out[at] = np.where(goes_on, self.next[found] if len(self.keys) else 0, self.start[code[at]])
        return out

    def nbytes(self) -> int:
        return self.table.nbytes + self.keys.nbytes + self.next.nbytes + self.start.nbytes + self.own.nbytes


class CrossParser:
    """Counts phrases of many texts against every language at once."""

    def __init__(self, samples: dict[str, str], limits: bool = True):
        self.names = sorted(samples)
        self.bits = [math.log2(max(2, *map(len, samples.values())))] * len(self.names)
        letters = sorted(set("".join(samples.values())))
        # Code 0 pads, 1 is any character that no sample has.
        self.codes = np.ones(0x110000, dtype=np.int32)
        self.codes[[ord(c) for c in letters]] = np.arange(2, len(letters) + 2)
        self.tables = [Table(samples[n], letters) for n in self.names]
        if limits:
            self._learn_limits(samples)

    def _learn_limits(self, samples: dict[str, str]) -> None:
        """Mean phrases per character of each language's own text, and their deviation."""
        means: dict[str, float] = {}
        spreads = []
        for name in self.names:
            sample = samples[name]
            half = len(sample) // 2
            text = DIGITS.sub("", sample[half:])
            pieces = [text[i : i + PIECE] for i in range(0, len(text) - PIECE + 1, PIECE)]
            if len(pieces) < MIN_PIECES:
                continue
            total, _ = CrossParser({name: sample[:half]}, limits=False).phrases(pieces)
            shares = total[:, 0] / PIECE
            means[name] = float(shares.mean())
            spreads.append(float(shares.std()))
        widest = max(means.values(), default=REJECT_SHARE)
        self.means = [means.get(n, widest) for n in self.names]
        self.spread = max(LEAST_SPREAD, float(np.median(spreads))) if spreads else 0.0

    def limit(self, language: int, chars: int) -> float:
        """Bits per character that a text of so many characters in the language may need."""
        allowed = self.means[language] + SPREADS * self.spread * max(1.0, math.sqrt(PIECE / max(chars, 1)))
        return min(allowed, REJECT_SHARE) * self.bits[language]

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(phrases for each text and language, characters for each text)."""
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        total = np.zeros((len(texts), len(self.names)), dtype=np.int64)
        if lengths.sum() == 0:
            return total, lengths
        raw = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        shared = self.codes[raw]
        coded = [table.own[shared] for table in self.tables]
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        pieces = -(-lengths // SEGMENT)
        owner = np.repeat(np.arange(len(texts)), pieces)
        index = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = starts[owner] + index * SEGMENT
        size = np.minimum(SEGMENT, lengths[owner] - index * SEGMENT)
        order = np.argsort(-size, kind="stable")  # the long ones first: the live ones are a prefix
        begin, size, owner = begin[order], size[order], owner[order]
        # live[t]: segments longer than t.
        live = np.searchsorted(-size, -np.arange(SEGMENT), side="left")
        states = [np.zeros(len(owner), dtype=np.int64) for _ in self.names]
        counts = [np.zeros(len(owner), dtype=np.int32) for _ in self.names]
        for t in range(int(size[0])):
            n = live[t]
            for table, own, state, count in zip(self.tables, coded, states, counts, strict=True):
                to = table.after(state[:n], own[begin[:n] + t])
                count[:n] += to & 1
                state[:n] = to >> 1
        for k, count in enumerate(counts):
            total[:, k] = np.bincount(owner, weights=count, minlength=len(texts)).astype(np.int64)
        return total, lengths

    def entropies(self, texts: list[str]) -> np.ndarray:
        """Bits per character for each text and language; infinite for empty texts."""
        total, lengths = self.phrases(texts)
        with np.errstate(divide="ignore", invalid="ignore"):
            rates = total * np.array(self.bits)[None, :] / lengths[:, None]
        return np.where(lengths[:, None] > 0, rates, np.inf)


def judge(parser: CrossParser | None, texts: list[str | None]) -> tuple[list, list, list]:
    """Language, score and whether the language is rejected, for each text."""
    usual = re.compile("[A-Za-z]")  # nearly always answers at once
    names, scores, rejected = [], [], []
    speaks = [
        t is not None and (usual.search(t) is not None or any(map(str.isalpha, t))) for t in texts
    ]
    if parser is None:
        return [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
    rates = np.empty((len(texts), len(parser.names)))
    low = [t.lower() if s else "" for t, s in zip(texts, speaks, strict=True)]
    at = 0
    while at < len(low):
        upto, chars = at, 0
        while upto < len(low) and (upto == at or chars + len(low[upto]) <= BLOCK_CHARS):
            chars += len(low[upto])
            upto += 1
        rates[at:upto] = parser.entropies(low[at:upto])
        at = upto
    doubtful = []
    for i, (row, s) in enumerate(zip(rates, speaks, strict=True)):
        if not s:
            names.append(UNKNOWN)
            scores.append(0.0)
            rejected.append(True)
            continue
        best = int(np.argmin(row))  # names are sorted: a tie goes to the first
        others = np.delete(row, best)
        names.append(parser.names[best])
        scores.append(float(1 - row[best] / others.min()) if len(others) and others.min() > 0 else 1.0)
        rejected.append(bool(row[best] > parser.limit(best, len(low[i]))))
        if rejected[-1]:
            doubtful.append(i)
    # A second look at these, usually few: without what belongs to no language, and each piece in its own one.
    for i in doubtful:
        words = " ".join(DIGITS.sub(" ", low[i]).split())
        if not any(map(str.isalpha, words)):
            continue
        pieces = [words[at : at + PIECE] for at in range(0, len(words), PIECE)]
        rows = parser.entropies(pieces)
        sizes = np.array([len(p) for p in pieces])
        need = float((rows.min(axis=1) * sizes).sum() / len(words))
        best = int(np.argmin((rows * sizes[:, None]).sum(axis=0)))
        rejected[i] = need > parser.limit(best, len(words))
    return names, scores, rejected


def with_language(docs: DataFrame, samples: dict[str, str]) -> DataFrame:
    """Add ``lang_pred``, ``lang_score`` and ``lang_rejected`` from the whole text.

    ``und`` with score 0 for null texts and texts without a letter, and for every text if there is no
    sample at all. The score is how far the best language is ahead of the second, 0 to 1; with a single language it
    is 1. Rejected are ``und`` and texts that cost more in their language than its own labelled texts of that length do.
    """

    def of_batches(batches):
        parser = CrossParser(samples) if samples else None
        for texts in batches:
            found: tuple[list, list, list] = ([], [], [])
            for at in range(0, len(texts), BLOCK_TEXTS):
                part = judge(parser, texts.slice(at, BLOCK_TEXTS).to_pylist())
                for column, values in zip(found, part, strict=True):
                    column.extend(values)
            names, scores, rejected = found
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                ["name", "score", "rejected"],
            )

    of_batches.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    told = F.arrow_udf(of_batches, "name string, score double, rejected boolean")
    judged = neutral(docs, ["text"]).withColumn("_told", told(F.col("text")))
    return judged.select(
        *original(docs),
        F.col("_told.name").alias("lang_pred"),
        F.col("_told.score").alias("lang_score"),
        F.col("_told.rejected").alias("lang_rejected"),
    )


def identify(docs: DataFrame) -> DataFrame:
    """Language of every text, learned from the documents that are not held out.

    Null languages and null texts teach nothing. Repeated rows get equal answers; an empty table gives an
    empty one. Columns other than doc_id, text and lang are not looked at.
    """
    docs = docs.select("doc_id", "text", "lang").withColumn("held_out", is_held_out())
    samples = labelled_sample(docs.filter(~F.col("held_out")))
    told = with_language(docs.select("doc_id", "held_out", "text"), samples)
    return told.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents in a language that the table's own labels teach; the others go."""
    samples = labelled_sample(docs.select("doc_id", "text", "lang"))
    clear = neutral(docs, ["text"])
    kept = with_language(clear, samples).filter(~F.col("lang_rejected"))
    return kept.select(*original(docs))
