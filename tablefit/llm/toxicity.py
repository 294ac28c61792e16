"""Toxicity by a weighted lexicon (operator 7).

``learn`` builds the lexicon and its calibration from labelled rows:

1. A bounded sample: per class the ``SAMPLE`` labelled documents outside the
   held-out fold with the smallest hashed ids. Near copies count once (one
   document per smallest shingle hash and class).
2. Entries are whole words and beginnings of words (``PREFIXES`` letters),
   counted per document and class. An entry stays if it is far more frequent in
   toxic documents (``LEAST_WEIGHT``) and its G-test passes the Bonferroni level ``LEVEL`` over
   all entries; its weight is the log ratio of the smoothed shares. All such
   entries make the lexicon. Each is in several toxic documents of the sample,
   so the sample bounds the lexicon, however many documents there are.
3. A logistic regression over four numbers of a text turns hits into a score.

``scores`` folds each whole text (letters of other scripts that look Latin,
full-width forms, zero-width characters, digits and signs that stand for
letters inside a word, single letters held apart by dots or dashes), finds
the entries with an Aho-Corasick automaton, keeps those at word boundaries
and outside exception phrases, takes the largest weight at each place, and
normalises the sum by the number of words.

Null texts count as empty and are scored as a text without hits. Null labels
and null ids teach nothing; without labels of both classes the score is 0.5
everywhere (predicted 1) for want of any evidence. Repeated rows get equal
scores. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefit.llm.common import materialize, shingles_of, table
from tablefit.llm.quality import fold_of

FOLDS, HELD_OUT = 5, 0
SAMPLE = 20_000
PREFIXES = (3, 4, 5, 6, 7)
LEVEL = 0.01
#: An entry is at least exp(LEAST_WEIGHT), some seven times, as frequent in toxic documents.
LEAST_WEIGHT = 2.0
#: Phrases in which an entry is harmless, already folded.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "class clown", "sore loser", "stupid mistake of mine")

# Letters of other scripts and the Latin letters they look like.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w",
    "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "α": "a", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "κ": "k", "τ": "t", "υ": "u", "ε": "e",
}
# Digits and signs that stand for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}

_FOLD = {ord(k): v for k, v in HOMOGLYPHS.items()}
_FOLD |= {c: chr(c - 0xFEE0) for c in range(0xFF10, 0xFF5B)}  # full-width digits and letters
_FOLD |= dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])
_STANDS = re.compile(r"(?<=[a-z])[013457@$!]{1,2}(?=[a-z])|(?<![a-z0-9])[013457@$!](?=[a-z][a-z013457@$!])")
_APART = re.compile(r"(?<!\w)(?:[a-z][.\-_*]){3,}[a-z](?!\w)")
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str | None) -> str:
    text = (text or "").lower()
    if not text.isascii():
        text = text.translate(_FOLD)
    text = _APART.sub(lambda m: re.sub(r"[.\-_*]", "", m[0]), text)
    return _STANDS.sub(lambda m: "".join(SUBSTITUTES[c] for c in m[0]), text)


def entries_of(text: str) -> set[str]:
    """Whole words, written with a last ``$``, and their beginnings."""
    words = set(_WORD.findall(text))
    return {w + "$" for w in words} | {w[:k] for w in words for k in PREFIXES if len(w) > k}


@dataclass(frozen=True)
class Lexicon:
    weights: dict[str, float]
    exceptions: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float


class Matcher:
    def __init__(self, lexicon: Lexicon) -> None:
        self.automaton = ahocorasick.Automaton()
        forms = defaultdict(list)
        for entry, weight in lexicon.weights.items():
            forms[entry.rstrip("$")].append((entry.endswith("$"), weight))
        for phrase in lexicon.exceptions:
            forms.setdefault(phrase, [])
        for form, uses in forms.items():
            self.automaton.add_word(form, (len(form), uses, form in lexicon.exceptions))
        self.usable = len(self.automaton) > 0
        if self.usable:
            self.automaton.make_automaton()

    def numbers(self, text: str | None) -> list[float]:
        """Largest weight, log of the weights' sum, that sum per word, log of the words."""
        text = fold(text)
        best: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (size, uses, exception) in self.automaton.iter(text) if self.usable else ():
            start = end - size + 1
            if start and text[start - 1].isalpha():
                continue
            after = end + 1 < len(text) and text[end + 1].isalpha()
            if exception and not after:
                spared.append((start, end))
            for whole, weight in uses:
                if not (whole and after) and weight > best.get(start, 0.0):
                    best[start] = weight
        weights = [w for s, w in best.items() if not any(a <= s <= b for a, b in spared)]
        n, total = len(text.split()), sum(weights)
        return [max(weights, default=0.0), math.log1p(total), math.log1p(100 * total / max(n, 1)), math.log1p(n)]


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The smallest shingle hash of each text."""
    for batch in batches:
        sets = [shingles_of(t) for t in batch.column(1).to_pylist()]
        least = pa.array([int(s[0].view(np.int64)) if len(s) else 0 for s in sets], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), least], ["doc_id", "text", "y", "least"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per entry and class, summed per partition in portions."""
    counts: dict[str, list[int]] = {}

    def out() -> pa.RecordBatch:
        both = list(counts.values())
        batch = pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array([b[0] for b in both], pa.int64()), pa.array([b[1] for b in both], pa.int64())],
            ["entry", "clean", "toxic"],
        )
        counts.clear()
        return batch

    for batch in batches:
        for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for entry in entries_of(fold(text)):
                if entry in counts:
                    counts[entry][y] += 1
                else:
                    counts[entry] = [1 - y, y]
            if len(counts) > 300_000:
                yield out()
    yield out()


def _g_test(toxic: Column, clean: Column, n_toxic: int, n_clean: int) -> Column:
    def term(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    total, n = toxic + clean, n_toxic + n_clean
    cells = [(toxic, total * n_toxic / n), (clean, total * n_clean / n), (n_toxic - toxic, (n - total) * n_toxic / n), (n_clean - clean, (n - total) * n_clean / n)]
    return 2 * sum((term(a, b) for a, b in cells[1:]), term(*cells[0]))


def _numbers(lexicon: Lexicon, column: int, *names: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon)
        for batch in batches:
            numbers = [matcher.numbers(t) for t in batch.column(column).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1 - column), pa.array(numbers, pa.list_(pa.float64()))], list(names))

    return run


def learn(docs: DataFrame, labels: DataFrame, target: str = "toxic", folds: int = FOLDS, held_out: int = HELD_OUT, sample: int = SAMPLE,
          exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    nothing = Lexicon({}, exceptions, (0.0,) * 4, 0.0)
    marks = (
        labels.where(F.col(target).isNotNull() & F.col("doc_id").isNotNull() & (fold_of(F.col("doc_id"), folds) != held_out))
        .groupBy(F.col("doc_id").cast("long").alias("label_id"))
        .agg((F.avg(target) >= 0.5).cast("int").alias("y"))
    )
    chosen = [marks.where(F.col("y") == y).orderBy(F.xxhash64("label_id"), "label_id").limit(sample) for y in (0, 1)]
    chosen = materialize(chosen[0].union(chosen[1]))  # at most 2 * sample rows
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    read = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")).select("doc_id", "text", "y")
    rows = materialize(
        read.mapInArrow(_sampled, "doc_id long, text string, y int, least long").groupBy("y", "least").agg(F.min_by("text", "doc_id").alias("text"))
    )
    sizes = {r.y: r.n for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return nothing
    n_clean, n_toxic = sizes[0], sizes[1]
    counted = materialize(
        rows.select("text", "y").mapInArrow(_counted, "entry string, clean long, toxic long")
        .groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where("clean + toxic > 1")
    )
    tests = max(counted.count(), 1)
    # The chi-square tail with one degree of freedom at x is below exp(-x / 2).
    level = 2 * math.log(tests / LEVEL)
    weight = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    best = (
        counted.select("entry", _g_test(F.col("toxic"), F.col("clean"), n_toxic, n_clean).alias("g"), weight.alias("weight"))
        .where((F.col("weight") >= LEAST_WEIGHT) & (F.col("g") >= level))
        .orderBy("entry")
        .collect()  # bounded by the sample
    )
    lexicon = Lexicon({r.entry: r.weight for r in best}, exceptions, (0.0,) * 4, 0.0)
    numbers = materialize(rows.select("text", "y").mapInArrow(_numbers(lexicon, 0, "y", "numbers"), "y int, numbers array<double>"))
    points = numbers.select(array_to_vector("numbers").alias("features"), F.col("y").cast("double").alias("label"))
    fitted = LogisticRegression(regParam=1e-3, maxIter=100).fit(points)
    return Lexicon(lexicon.weights, exceptions, tuple(fitted.coefficients.toArray().tolist()), float(fitted.intercept))


def scores(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``doc_id, score`` of each row of ``docs(doc_id, text)``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = sent.value
        matcher = Matcher(lex)
        for batch in batches:
            numbers = np.array([matcher.numbers(t) for t in batch.column(1).to_pylist()]).reshape(-1, 4)
            z = numbers @ np.array(lex.coefficients) + lex.intercept
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))))], ["doc_id", "score"])

    return rows.mapInArrow(run, "doc_id long, score double")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lexicon = learn(docs, table(spark, sf_dir, "labels"))
    return scores(docs, lexicon).select(
        "doc_id",
        (fold_of(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
