"""Periodic runs of words in a text, by seed and extend (operator 11).

A run of period q is a longest stretch of words in which words q apart are
identical, q being the smallest such distance, and which holds at least
``min_length`` words and ``min_periods`` periods.

1. On the diagonal of lag q a run is a stretch of equal pairs ``(i, i + q)``.
   The periods fall into classes ``lo..hi``; every run of a class keeps at
   least k equal pairs in a row, the overlap guaranteed at ``lo``, and ``hi``
   is k. So the words at the run's start hold a k-gram that comes again q
   words later (5-grams for periods 1 to 5, 18-grams for 6 to 18, and so on).
2. The index of a class holds the places of the k-grams that occur more than
   once. Ranks of 2, 4, 8 ... words are exact (pairs of ranks, no hashes), and
   a gram that occurs once is not looked at in longer ones, so most texts end
   after the first class.
3. As k is no less than q, a run's k-gram does not come back before q words:
   only neighbouring occurrences of a gram are paired, and the lag of such a
   pair is the smallest period of what it lies in.
4. Each pair is extended both ways on its diagonal. A table holds for every
   lag the furthest place covered so far; pairs before it are passed over, so
   a stretch is walked once however many seeds it has.

The number of pairs is linear in the words of a class, and there are about
log3(words) classes. A text is one row of one task, as are its words.

Words lie between the bytes ``\\x20`` and ``\\x09-\\x0D`` and are compared as
they are. Null, empty and white-space texts have no words, no run, and the
empty collapsed text. Every row is answered on its own, so repeated rows, ties
and null ids need no care; other columns are not read. An empty table gives
an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefit.llm.byte_bpe import portions
from tablefit.llm.common import table

MIN_LENGTH = 6
MIN_PERIODS = 4

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def word_ids(words: list[bytes]) -> np.ndarray:
    """Equal numbers for equal words."""
    ids: dict[bytes, int] = {}
    return np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))


def guaranteed(lo: int, min_length: int, min_periods: int) -> int:
    """Equal pairs in a row that a run of any period from ``lo`` on has at least."""
    return min(max(min_length - q, (min_periods - 1) * q) for q in range(lo, max(lo, min_length) + 1))


class Grams:
    """Exact ranks of the grams of a text that occur more than once; -1 elsewhere."""

    def __init__(self, ids: np.ndarray) -> None:
        self.levels = [self._repeated(ids, np.arange(len(ids)), len(ids))]

    @staticmethod
    def _repeated(keys: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        ranks = np.full(n, -1, np.int64)
        if len(keys) > 1:
            order = np.argsort(keys, kind="stable")
            same = np.diff(keys[order]) == 0
            number = np.concatenate(([0], np.cumsum(~same)))
            again = np.concatenate((same, [False])) | np.concatenate(([False], same))
            ranks[at[order[again]]] = number[again]
        return ranks

    def _joined(self, ranks: np.ndarray, step: int) -> np.ndarray:
        n = len(ranks)
        if step >= n:
            return np.full(n, -1, np.int64)
        at = np.flatnonzero((ranks[:-step] >= 0) & (ranks[step:] >= 0))
        return self._repeated(ranks[at] * n + ranks[at + step], at, n)

    def of(self, k: int) -> np.ndarray:
        """Ranks of the k-grams by place: two grams of a power of two that cover k words."""
        level = k.bit_length() - 1
        while len(self.levels) <= level:
            self.levels.append(self._joined(self.levels[-1], 1 << len(self.levels) - 1))
        ranks = self.levels[level]
        return ranks if k == 1 << level else self._joined(ranks, k - (1 << level))


def _equal_after(ids: np.ndarray, at: int, lag: int) -> int:
    """First place from ``at`` on whose word differs from the one ``lag`` later."""
    block, last = 64, len(ids) - lag
    while at < last:
        end = min(at + block, last)
        other = np.flatnonzero(ids[at:end] != ids[at + lag : end + lag])
        if len(other):
            return at + int(other[0])
        at, block = end, block * 4
    return last


def _equal_before(ids: np.ndarray, at: int, lag: int, floor: int) -> int:
    """First place of the equal pairs that end before ``at``, not below ``floor``."""
    block = 64
    while at > floor:
        start = max(at - block, floor)
        other = np.flatnonzero(ids[start:at] != ids[start + lag : at + lag])
        if len(other):
            return start + int(other[-1]) + 1
        at, block = start, block * 4
    return floor


def find_runs(ids: np.ndarray, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run, by start, then period."""
    if min_periods < 2:
        raise ValueError("a run has two periods at least")
    n, grams, runs, lo = len(ids), Grams(ids), [], 1
    covered: dict[int, int] = {}  # by lag: places before it need no seed
    while min_periods * lo <= n:
        k = guaranteed(lo, min_length, min_periods)
        ranks = grams.of(k)
        places = np.flatnonzero(ranks >= 0)
        if not len(places):
            break  # longer grams don't repeat either
        order = places[np.argsort(ranks[places], kind="stable")]
        lags = np.diff(order)
        seed = (np.diff(ranks[order]) == 0) & (lags >= lo) & (lags <= k)
        starts, lags = order[:-1][seed], lags[seed]
        by_lag = np.lexsort((starts, lags))
        starts, lags = starts[by_lag], lags[by_lag]
        edges = np.flatnonzero(np.diff(lags, prepend=0, append=0))
        for first, last in zip(edges[:-1].tolist(), edges[1:].tolist()):
            lag, mine, j = int(lags[first]), starts[first:last], 0
            while j < len(mine):
                at = int(mine[j])
                end = _equal_after(ids, at + k, lag)
                start = _equal_before(ids, at, lag, covered.get(lag, 0))
                covered[lag] = end + 1
                length = end - start + lag
                if length >= max(min_length, min_periods * lag):
                    runs.append((start, length, lag))
                j = int(np.searchsorted(mine, end + 1))
        lo = max(k, lo) + 1
    runs.sort(key=lambda r: (r[0], r[2]))
    return runs


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay: none that a run holds after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def _runs(min_length: int, min_periods: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for first, last in portions(texts):
                sizes, found, collapsed = [], [], []
                for text in texts[first:last]:
                    words = text.encode("utf-8", "surrogatepass").split()
                    runs = find_runs(word_ids(words), min_length, min_periods)
                    sizes.append(len(words))
                    found.append([dict(zip(("start", "length", "period"), r)) for r in runs])
                    if runs:
                        words = [words[i] for i in np.flatnonzero(kept_words(len(words), runs)).tolist()]
                    collapsed.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(_RUN)),
                     pa.array(collapsed, pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return run


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> DataFrame:
    """``doc_id, n_words, runs array<struct<start, length, period>>, collapsed``
    of each row of ``docs(doc_id, text)``: every run by start, then period, in
    words numbered from 0; the collapsed text joins the words that no run holds
    after its first period."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_runs(min_length, min_periods), _SCHEMA)


def with_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with the repeats that the query's contract plants: where
    h, the CRC-32 of the id, is divisible by 10, the words from a on repeat the
    p words at a. A null id plants none."""
    words = docs.selectExpr(
        "doc_id", "text", "array_remove(split(text, '[\\\\x20\\\\x09-\\\\x0D]+'), '') AS words",
        "crc32(cast(cast(doc_id AS string) AS binary)) AS h",
    )
    placed = words.selectExpr("*", "cast(size(words) AS bigint) AS n", "h div 10 AS g").selectExpr(
        "*", "cast(g % greatest(n, 1) AS int) AS a"
    )
    placed = placed.selectExpr("*", "cast(1 + (n - a) div (3 + g % 8) AS int) AS p")
    tail = "slice(flatten(array_repeat(slice(words, a + 1, p), cast((n - a + p - 1) div p AS int))), 1, cast(n - a AS int))"
    return placed.selectExpr(
        "doc_id", f"CASE WHEN h % 10 = 0 AND n > 0 THEN array_join(concat(slice(words, 1, a), {tail}), ' ') ELSE text END AS text"
    )


def digests(found: DataFrame) -> DataFrame:
    """The number of runs, the longest one, and digests of all runs and of the collapsed text."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    best = found.withColumn("best", longest)
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.col2")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.col3")).alias("period"),
        F.expr("(1000 * best.length) div (-best.col3)").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(periodic_runs(with_repeats(table(spark, sf_dir, "documents"))))


# The runs by all pairs of equal words up to a quarter of a text apart, as
# islands on each lag. DuckDB has no CRC-32: ``crc`` computes it from its
# table of 256 entries, built from the polynomial.
OP11_SQL = """
WITH crc AS (
  SELECT list(list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY n) AS t
  FROM range(256) AS r(n)),
docs AS (
  SELECT row_number() OVER () AS row, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(cast(doc_id AS varchar), ''), lambda x: cast(ord(x) AS bigint))),
                         lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) AS h
  FROM documents, crc),
spot AS (SELECT *, len(words) AS n, h // 10 AS g, CASE WHEN len(words) > 0 THEN (h // 10) % len(words) END AS a FROM docs),
rule AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN 1 + (n - a) // (3 + g % 8) END AS p FROM spot),
w AS (
  SELECT row, n, i, words[1 + CASE WHEN p IS NULL OR i < a THEN i ELSE a + (i - a) % p END] AS word
  FROM (SELECT row, n, a, p, words, unnest(range(n)) AS i FROM rule)),
equal AS (
  SELECT x.row, y.i - x.i AS q, x.i FROM w x JOIN w y ON x.row = y.row AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
island AS (SELECT row, q, i, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS part FROM equal),
stretch AS (
  SELECT row, q, min(i) AS start, count(*) + q AS length FROM island GROUP BY row, q, part HAVING count(*) + q >= greatest(6, 4 * q)),
run AS (
  SELECT row, start, length, q AS period FROM stretch s
  WHERE NOT EXISTS (SELECT 1 FROM stretch o WHERE o.row = s.row AND o.q < s.q AND o.start <= s.start AND o.start + o.length >= s.start + s.length)),
by_row AS (
  SELECT row, count(*) AS n_runs, max({'length': length, 'start': -start, 'period': -period}) AS best,
         string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM run GROUP BY row),
gone AS (SELECT DISTINCT row, unnest(range(start + period, start + length)) AS i FROM run),
kept AS (
  SELECT row, string_agg(word, ' ' ORDER BY i) AS collapsed FROM w ANTI JOIN gone USING (row, i) GROUP BY row)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, -best.start AS start, best.length AS length, -best.period AS period,
       (1000 * best.length) // (-best.period) AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM rule LEFT JOIN by_row USING (row) LEFT JOIN kept USING (row)
"""
