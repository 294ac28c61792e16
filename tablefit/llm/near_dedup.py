"""Near-duplicate documents by b-bit MinHash (operator 8).

1. Each text becomes its set of word shingles, hashed. One pass keeps per
   document the size of the set, its 128-bit key, ``BANDS`` band keys made of
   ``ROWS`` minima each, and the b-bit signature: the low ``BITS`` bits of all
   minima, packed bit plane by bit plane into longs.
2. Documents with the same set form a class, named by its smallest id; only
   classes are compared.
3. Classes that share a band key are candidates. Star rounds compare the
   members of a bucket with its hub only: first its most central member, then
   the one with most links so far, and only members of other components than
   the hub's. Confirmed links are merged into components between the rounds.
   A last round compares, in buckets that still hold several components,
   members of different components. Pairs inside one component need no test:
   they can't change a component. Before that round the shingles are counted
   that no other open member has: they are in no intersection, so a member
   with c others can only link with n of a size that c allows, and whoever
   finds no such size in a bucket leaves it. What remains is compared by
   longer signatures made for these members alone. No link between components
   is lost. In a group of copies whose edits differ, members that stay
   apart do so by their own edits and leave the buckets; many texts that stay
   just below the threshold to each other without shingles of their own would
   still be compared with each other.
4. A candidate passes to the exact test if the sizes of its sets allow the
   link and its similarity is at least ``CUT``, as estimated from equal b-bit
   lanes and corrected for chance collisions (2**-BITS of unequal lanes agree).
   The estimate's standard error at 0.75 is about 0.04, so the cut lies some
   six of them below; for the longer signatures it is 0.011, and ``LONG_CUT``
   lies four below.
5. The exact test builds both full shingle sets again from the whole texts
   and compares ``100 * |A & B| >= 75 * |A | B|``.

A pair of similarity 0.75 misses all ``BANDS`` buckets with probability
(1 - 0.75**ROWS)**BANDS, about 5e-6.

Empty, null and white-space texts have no shingles and link with nothing.
Rows without a doc_id take no part in links (component null, kept). Repeated
rows fall into one class and get the same answer. Rows of one doc_id with
different texts are separate texts of that id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefit.llm.common import release, shingles_of, stored, table
from tablefit.llm.components import connected_components

WIDTH = 5
BANDS = 32
ROWS = 4
BITS = 4
#: Estimated similarity from which a candidate is tested exactly.
CUT = 0.5
THRESHOLD_PERCENT = 75
#: Rounds at most that compare a bucket's members with one member only; what
#: they leave unlinked the last round compares.
STAR_ROUNDS = 3
#: Minima, bits of each and cut of the longer signatures of the last round.
LONG_HASHES, LONG_BITS, LONG_CUT = 2048, 2, 0.704

_HASHES = BANDS * ROWS
_RNG = np.random.default_rng(8)
_MUL = _RNG.integers(0, 2**63, LONG_HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 2**63, LONG_HASHES, dtype=np.uint64)
_FOLD = _RNG.integers(0, 2**63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CHUNK = 512

_SIGNATURE_SCHEMA = "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>, sig array<long>"


def minima(shingles: np.ndarray, hashes: int = _HASHES) -> np.ndarray:
    """The first ``hashes`` MinHash values of a set."""
    out = np.full(hashes, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), _CHUNK):
        h = np.multiply.outer(shingles[i : i + _CHUNK], _MUL[:hashes])
        h += _ADD[:hashes]
        np.minimum(out, h.min(axis=0), out=out)
    return out >> np.uint64(20)


def band_keys(m: np.ndarray) -> np.ndarray:
    k = (m.reshape(BANDS, ROWS) * _FOLD).sum(axis=1, dtype=np.uint64)
    k ^= k >> np.uint64(31)
    k *= np.uint64(0xC4CEB9FE1A85EC53)
    k += np.arange(BANDS, dtype=np.uint64)
    k ^= k >> np.uint64(29)
    return k.view(np.int64)


def pack(m: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Low ``bits`` bits of the minima, one bit plane after the other."""
    planes = [np.packbits(((m >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)) for b in range(bits)]
    return np.concatenate(planes).view(np.int64)


def _signatures(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                n, k1, k2, bands, sigs = [], [], [], [], []
                for text in part.column(1).to_pylist():
                    s = shingles_of(text, width)
                    n.append(len(s))
                    if not len(s):
                        k1.append(0), k2.append(0), bands.append(None), sigs.append(None)
                        continue
                    key = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
                    m = minima(s)
                    k1.append(key[0]), k2.append(key[1]), bands.append(band_keys(m)), sigs.append(pack(m))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
                     pa.array(bands, pa.list_(pa.int64())), pa.array(sigs, pa.list_(pa.int64()))],
                    ["doc_id", "n_shingles", "k1", "k2", "bands", "sig"],
                )

    return run


def _long_signatures(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs = [pack(minima(shingles_of(t, width), LONG_HASHES), LONG_BITS) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sigs, pa.list_(pa.int64()))], ["id", "long_sig"])

    return run


def estimate(a: str, b: str, hashes: int = _HASHES, bits: int = BITS) -> Column:
    """Collision-corrected similarity of two packed signatures."""
    words, unequal = hashes // 64, F.lit(0)
    for w in range(words):
        lanes = reduce(
            lambda x, y: x.bitwiseOR(y),
            [F.get(a, F.lit(p * words + w)).bitwiseXOR(F.get(b, F.lit(p * words + w))) for p in range(bits)],
        )
        unequal = unequal + F.bit_count(lanes)
    equal = F.lit(1.0) - unequal / F.lit(float(hashes))
    chance = 2.0**-bits
    return (equal - F.lit(chance)) / F.lit(1 - chance)


def _sizes_allow(percent: int, a: str = "na", b: str = "nb") -> Column:
    """No link between sets of ``na`` and ``nb`` shingles, of which ``a`` and ``b`` can be common, can be without this."""
    return (100 + percent) * F.least(a, b) >= percent * (F.col("na") + F.col("nb"))


#: Shingles that one task counts at a time before it sends them on.
_COUNTED = 2_000_000


def _own_shingles(width: int):
    """``h, n, id``: every shingle of some texts once, with its texts (2: two or more)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(ids: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
            h, first, n = np.unique(np.concatenate(sets), return_index=True, return_counts=True)
            owner = np.repeat(np.array(ids, np.int64), [len(s) for s in sets])[first]
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.minimum(n, 2)), pa.array(owner)], ["h", "n", "id"])

        ids, sets, total = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(doc_id), sets.append(shingles_of(text, width))
                total += len(sets[-1])
                if total >= _COUNTED:
                    yield counted(ids, sets)
                    ids, sets, total = [], [], 0
        if sets:
            yield counted(ids, sets)

    return run


def _confirm(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, y = None, np.empty(0, np.uint64)
        for batch in batches:
            ta, tb = batch.column(2), batch.column(3)
            keep = []
            for i in range(batch.num_rows):
                text = tb[i].as_py()
                if text != last:  # rows of one b mostly follow each other
                    last, y = text, shingles_of(text, width)
                x = shingles_of(ta[i].as_py(), width)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def _met(left: DataFrame, right: DataFrame, on: str | Column, how: str = "inner") -> DataFrame:
    """A join whose sides grow with the documents: by sort and merge at every
    size, and so with its hot keys split."""
    return left.join(right.hint("merge"), on, how)


def _links(pairs: DataFrame, classes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that the exact test confirms."""
    named = lambda x: classes.select(F.col("rep").alias(x), F.col("n").alias(f"n{x}"), F.col("sig").alias(f"s{x}"))
    likely = stored(
        _met(_met(pairs, named("a"), "a"), named("b"), "b")
        .where(_sizes_allow(percent) & (estimate("sa", "sb") >= CUT))
        .select("a", "b")  # no distinct here: it would keep Spark from splitting the rows of a hot hub
    )
    text_of = lambda x: texts.select(F.col("id").alias(x), F.col("text").alias(f"t{x}"))
    both = _met(_met(likely, text_of("a"), "a"), text_of("b"), "b").select("a", "b", "ta", "tb")
    found = stored(both.mapInArrow(_confirm(width, percent), "a long, b long"))
    release(likely)
    return found


def _star(shared: DataFrame, labels: DataFrame | None, links: DataFrame | None, tested: DataFrame | None) -> DataFrame:
    """Pairs ``(a, b)`` of each bucket's members with its hub ``b``, the member
    with most links so far, then the most central one. Only members of other
    components than b's are paired, and no pair of an earlier round."""
    if links is None:
        named = shared.select("key", "rep", "meets", F.col("rep").alias("component"), F.lit(0).cast("long").alias("degree"))
    else:
        ends = links.select(F.col("a").alias("rep")).union(links.select("b"))
        known = labels.withColumnRenamed("node", "rep").join(ends.groupBy("rep").agg(F.count("*").alias("degree")), "rep", "left")
        named = _met(shared, stored(known), "rep", "left").select(
            "key", "rep", "meets", F.coalesce("component", "rep").alias("component"), F.coalesce("degree", F.lit(0)).alias("degree")
        )
    named = stored(named)
    rank = F.struct("degree", "meets", -F.col("rep"), "component")
    hubs = named.groupBy("key").agg(F.max(rank).alias("m")).select("key", (-F.col("m.col3")).alias("b"), F.col("m.component").alias("cb"))
    pairs = _met(named, stored(hubs), "key").where("component <> cb").select(F.col("rep").alias("a"), "b").distinct()
    if tested is not None:
        pairs = pairs.join(tested.union(tested.select("b", "a")).hint("merge"), ["a", "b"], "left_anti")
    pairs = stored(pairs)
    release(named)
    return pairs


def _mixed(members: DataFrame) -> DataFrame:
    """``members`` of buckets that hold several components."""
    mixed = members.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key")
    return _met(members, stored(mixed), "key")


def _open_pairs(shared: DataFrame, labels: DataFrame | None, classes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of different components in one bucket that may be linked."""
    if labels is None:
        labelled = shared.select("key", "rep", F.col("rep").alias("component"))
    else:
        labelled = _met(shared, labels.withColumnRenamed("node", "rep"), "rep", "left").select(
            "key", "rep", F.coalesce("component", "rep").alias("component")
        )
    members = stored(_mixed(stored(labelled)))
    texts_of = lambda rows: _met(texts, rows.select(F.col("rep").alias("id")).distinct(), "id", "left_semi")
    own = (
        texts_of(members).mapInArrow(_own_shingles(width), "h long, n long, id long")
        .groupBy("h").agg(F.sum("n").alias("n"), F.min("id").alias("id")).where("n = 1")
        .groupBy(F.col("id").alias("rep")).agg(F.count("*").alias("own"))
    )
    sized = (
        _met(_met(members, classes.select("rep", "n"), "rep"), stored(own), "rep", "left")
        .select("key", "rep", "component", "n", (F.col("n") - F.coalesce("own", F.lit(0))).alias("common"))
    )
    sized = stored(sized)
    span = sized.groupBy("key").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    # sizes of partners: at least percent of n, at most what the common shingles allow
    lowest = F.ceil(F.lit(percent) * F.col("n") / 100)
    highest = F.floor(F.lit(100 + percent) * F.col("common") / percent) - F.col("n")
    able = stored(_met(sized, stored(span), "key").where(F.greatest("least", lowest) <= F.least("most", highest)).drop("least", "most"))
    able = stored(_mixed(able))
    longer = stored(texts_of(able).mapInArrow(_long_signatures(width), "id long, long_sig array<long>"))
    able = (
        _met(_met(able, longer.withColumnRenamed("id", "rep"), "rep"),
             stored(able.groupBy("rep").agg(F.collect_set("key").alias("keys"))), "rep")  # at most BANDS keys
        .select("key", "rep", "component", "n", "common", "long_sig", "keys")
    )
    able = stored(able)
    x, y = (
        able.select(
            F.col("key").alias(f"key_{i}"), F.col("rep").alias(i), F.col("component").alias(f"c{i}"), F.col("n").alias(f"n{i}"),
            F.col("common").alias(f"m{i}"), F.col("long_sig").alias(f"s{i}"), F.col("keys").alias(f"keys_{i}"),
        )
        for i in ("a", "b")
    )
    similar = estimate("sa", "sb", LONG_HASHES, LONG_BITS) >= LONG_CUT
    first_met = F.array_min(F.array_intersect("keys_a", "keys_b")) == F.col("key_a")  # a pair comes out of one bucket only
    met = (F.col("key_a") == F.col("key_b")) & (F.col("ca") < F.col("cb"))
    pairs = stored(x.join(y, met & _sizes_allow(percent, "ma", "mb") & similar & first_met).select("a", "b").distinct())
    release(members, sized, longer, able)
    return pairs


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs(doc_id, text)``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stored(docs.mapInArrow(_signatures(width), _SIGNATURE_SCHEMA))
    classes = stored(
        signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("k1", "k2")
        .agg(
            F.min("doc_id").alias("rep"), F.any_value("n_shingles").alias("n"), F.any_value("bands").alias("bands"),
            F.any_value("sig").alias("sig"),
        )
    )
    ids = stored(signed.select("doc_id", "n_shingles", "k1", "k2"))
    release(signed)
    members = classes.select("rep", F.explode("bands").alias("key"))
    buckets = stored(members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    # Members of buckets with more than one class: all that can still be linked.
    met = stored(_met(members, buckets, "key").select("key", "rep", "n"))
    central = stored(met.groupBy("rep").agg(F.sum("n").alias("meets")))
    shared = stored(_met(met, central, "rep").select("key", "rep", "meets"))
    # Their texts, once: all later rounds read these.
    some = stored(_met(docs, central.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi"))
    texts = stored(some.select(F.col("doc_id").alias("id"), "text").distinct())
    release(buckets, met, central, some)
    links = tested = labels = None
    for _ in range(STAR_ROUNDS):
        pairs = _star(shared, labels, links, tested)
        if pairs.isEmpty():
            break
        found = _links(pairs, classes, texts, width, percent)
        tested = pairs if tested is None else tested.union(pairs)
        if found.isEmpty():
            break
        links = found if links is None else links.union(found)
        release(labels)
        labels = connected_components(links)

    pairs = _open_pairs(shared, labels, classes, texts, width, percent)
    if tested is not None:
        pairs = pairs.join(tested.union(tested.select("b", "a")), ["a", "b"], "left_anti")
    pairs = stored(pairs)
    if not pairs.isEmpty():
        more = _links(pairs, classes, texts, width, percent)
        if not more.isEmpty():
            links = more if links is None else links.union(more)
            release(labels)
            labels = connected_components(links)

    reps = classes.select("k1", "k2", "rep")
    if labels is not None:
        reps = _met(reps, labels.withColumnRenamed("node", "rep"), "rep", "left")
    else:
        reps = reps.withColumn("component", F.col("rep"))
    named = stored(reps.select(F.col("k1").alias("c1"), F.col("k2").alias("c2"), F.coalesce("component", "rep").alias("component")))
    release(classes, shared, labels, texts)
    linked = ids.join(
        named.hint("merge"),
        (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")) & (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(),
        "left",
    )
    component = F.coalesce("component", "doc_id")
    return linked.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
