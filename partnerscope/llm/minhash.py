"""Near copies by HyperMinHash, verified on full shingle sets.

* Sketch. A document's shingle hashes fall into 128 buckets; a register keeps the least hash of
  its bucket as a leading-zero count and ten mantissa bits. Documents of equal shingle sets are
  one class, and only one document of each class goes on.
* Bands. Registers are banded as they are. Sets whose members may differ by few shingles have
  few wide bands: more bands than shingles that can differ, so that some bands agree for sure. An
  empty band gives no key, so a set with so many empty bands that all of those may be empty also
  gives its least shingle hashes, one more than it can miss in a linked set: two linked sets whose
  agreeing bands are all empty both do, and share the least hash that they have in common.
  From some 60 shingles on (at 85 %) there are three independent sketches of 16 bands, and from
  some 180 on one of 32 bands with four registers; two linked sets agree in none of them with a
  probability below 1e-9 (1e-7 at 80 %).
* Candidates. The members of a band that agree are compared with its first member, in the order
  of ids, not with each other. Linked ones merge. Bands that still hold several components get
  another hub, while that leaves many pairs and finds links; in the end every member outside a
  band's largest component meets all members of other components.
* Bound. There, two sets differ in at least as many shingles as bitmaps of them differ in bits.
  Pairs that differ in more than the threshold allows are never made, which ends most bands and
  families of rather similar texts. No pair of different components that shares a band and may
  be linked is left out, and hardly any of equal ones is made.
* Estimate. Agreeing registers, less those that are expected to agree by chance at these sizes,
  estimate the similarity; pairs below by more than six standard errors are left.
* Verification. The others are compared on all shingles of both texts.
* Components of the links are labelled by their smallest document.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partnerscope.llm.common import Work
from partnerscope.llm.components import components

REGISTERS = 128
MANTISSA = 10
BANDS = 32
#: Sets that differ in so many shingles at least have three sketches, up to that of 32 bands.
MIDDLE, SKETCHES_THERE, MIDDLE_BANDS = 11, 3, 16
#: Bits of the bitmap that bounds how much two sets differ, and words of 64 bits in it.
BITS = 1024
WORDS = BITS // 64
#: How many standard errors the estimate may lie below the threshold.
ERRORS = 6.0
#: Another round of hubs pays while the pairs left are this many times the members, and the last
#: round has found links for one member in so many.
PAYS, FINDS = 4, 20

SKETCHES = "doc_id long, n long, h1 long, h2 long, registers binary, bits array<bigint>, least array<bigint>"
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the word runs; A-Z lowered; a shorter text is one run."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    h = mixed(np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words)))
    length = min(size, len(h))
    run = np.full(len(h) - length + 1, length, dtype=np.uint64)
    for k in range(length):
        run = (run ^ (run >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + h[k : k + len(run)]
    return np.unique(mixed(run))


def registers(shingles: np.ndarray) -> np.ndarray:
    """The least hash of each bucket, as exponent and mantissa; 0 where the bucket is empty.

    The hashes are sorted.
    """
    bucket = (shingles % np.uint64(REGISTERS)).astype(np.int64)
    least = np.zeros(REGISTERS)
    held = np.zeros(REGISTERS, dtype=bool)
    # Written backwards, the least of each bucket stays.
    least[bucket[::-1]] = (shingles[::-1] >> np.uint64(11)).astype(np.float64)
    held[bucket] = True
    fraction, exponent = np.frexp(least + 1.0)
    mantissa = ((fraction * 2 - 1) * (1 << MANTISSA)).astype(np.int64)
    return np.where(held, (exponent.astype(np.int64) << MANTISSA) + mantissa + 1, 0).astype("<u2")


def all_registers(shingles: np.ndarray, percent: int) -> np.ndarray:
    """One sketch, and two more where sets of this size, or smaller partners, are banded by three."""
    n, sketch = len(shingles), [registers(shingles)]
    if any(MIDDLE <= most_different(size, percent) < BANDS for size in (n, -(-n * percent // 100))):
        sketch += [registers(np.sort(mixed(shingles + np.uint64(k)))) for k in range(1, SKETCHES_THERE)]
    return np.concatenate(sketch)


def bitmap(shingles: np.ndarray) -> np.ndarray:
    bits = np.zeros(BITS, dtype=np.uint8)
    bits[((shingles >> np.uint64(32)) % np.uint64(BITS)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


def most_different(n: Column | int | np.ndarray, percent: int):
    """Shingles in which a linked set can differ from one of ``n`` shingles that is no larger."""
    return n * (100 - percent) // percent


LEVELS = ("2", "4", "8", "16", "middle", "32")


def band_levels(n: np.ndarray, percent: int) -> dict[str, np.ndarray]:
    """Which sets are banded in which way: in that of their size, and in that of a smaller partner's."""

    def level(size: np.ndarray) -> np.ndarray:
        different = most_different(size, percent)
        place = np.digitize(different, [1, 2, 4, 8, MIDDLE, BANDS]) - 1
        return np.where(different < 1, -1, place)

    own, smaller = level(n), level(-(-n * percent // 100))
    return {name: (own == k) | (smaller == k) for k, name in enumerate(LEVELS)}


#: Levels that must find all links: their bands, and the most shingles linked sets differ in there.
SURE = {"2": (2, 1), "4": (4, 3), "8": (8, 7), "16": (16, MIDDLE - 1)}


def least_keys(shingles: np.ndarray, regs: np.ndarray, percent: int) -> np.ndarray:
    """Keys of the least hashes, where all bands in which a linked set agrees may be empty.

    Bands without a differing shingle agree, which leaves out at most as many as shingles differ.
    A linked set lacks at most the given share of this one, so one more of the least hashes has
    one that both sets hold, and the least of those is among the other set's as well.
    """
    n, keys = len(shingles), [np.zeros(0, np.uint64)]
    if most_different(n, percent) < 1:
        return keys[0]
    least = shingles[: n * (100 - percent) // 100 + 1]
    chosen = band_levels(np.array([n]), percent)
    for level, (bands, most) in SURE.items():
        if chosen[level][0]:
            empty = bands - int(regs[:REGISTERS].reshape(bands, -1).any(axis=1).sum())
            if empty >= bands - min(most, most_different(n, percent)):
                keys.append(mixed(least + np.uint64(bands)) | np.uint64(1))
    return np.concatenate(keys)


def all_band_keys(regs: list[np.ndarray], level: str) -> np.ndarray:
    """Hashes of the bands of some sets, a row each; 0 where a band is empty."""
    first = np.stack([r[:REGISTERS] for r in regs])
    if level != "middle":
        return band_keys(first, int(level))
    sketches = [first, *(np.stack([r[k * REGISTERS : (k + 1) * REGISTERS] for r in regs]) for k in range(1, SKETCHES_THERE))]
    keys = [band_keys(sketch, MIDDLE_BANDS, 1 + k) for k, sketch in enumerate(sketches)]
    return np.concatenate(keys, axis=1)


def band_keys(regs: np.ndarray, bands: int, sketch: int = 0) -> np.ndarray:
    """A hash of each band's registers; 0 where all of them are empty."""
    rows = regs.reshape(len(regs), bands, REGISTERS // bands).astype(np.uint64)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64) + np.uint64((sketch << 16) + (bands << 8)), rows.shape[:2]).copy()
    for k in range(rows.shape[2]):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, k])
    return np.where(rows.any(axis=2), key | np.uint64(1), np.uint64(0))


@lru_cache(maxsize=4096)
def chance_agreement(log_n: int, log_m: int) -> float:
    """Expected share of registers that agree in two unrelated sets, sizes as eighths of log2.

    Sums, over all values of a register, the probability that both least hashes get it.
    """
    a, b = 2.0 ** (log_n / 8) / REGISTERS, 2.0 ** (log_m / 8) / REGISTERS
    exponent = np.arange(0, 54)[:, None]
    low = np.ldexp(1.0 + np.arange(1 << MANTISSA) / (1 << MANTISSA), exponent - 54)
    high = low + np.ldexp(1.0 / (1 << MANTISSA), exponent - 54)
    got = lambda s: np.exp(-s * low) - np.exp(-s * np.minimum(high, 1.0))
    return float((got(a) * got(b)).sum())


def similar_enough(one: np.ndarray, two: np.ndarray, n: int, m: int, percent: int) -> bool:
    """Whether sketches leave a similarity of the threshold possible."""
    held = (one > 0) | (two > 0)
    union, agree = int(held.sum()), int(((one == two) & held).sum())
    if min(n, m) * 100 < percent * max(n, m) or union == 0:
        return False
    if union - agree > most_different(min(n, m), percent):
        return False
    chance = chance_agreement(round(8 * math.log2(n)), round(8 * math.log2(m)))
    estimate = (agree - chance * union) / (union * (1.0 - chance))
    threshold = percent / 100
    return estimate >= threshold - ERRORS * math.sqrt(threshold * (1 - threshold) / union)


def linked(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    """Similarity of the full sets."""
    common = len(np.intersect1d(one, two, assume_unique=True))
    union = len(one) + len(two) - common
    return union > 0 and 100 * common >= percent * union


def sketches(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Set size, set hash, registers and keys of least hashes of every document."""

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, hashes, regs, bits, least = [], [], [], [], []
            for text in batch.column(1):
                own = shingle_set(text.as_py(), size)
                sizes.append(len(own))
                hashes.append(np.frombuffer(xxhash.xxh3_128_digest(own.tobytes()), "<i8"))
                sketch = all_registers(own, percent)
                regs.append(sketch.tobytes())
                bits.append(bitmap(own))
                least.append(least_keys(own, sketch, percent).view(np.int64))
            pair = np.array(hashes, dtype=np.int64).reshape(-1, 2)
            flat = pa.array(np.concatenate(bits) if bits else np.zeros(0, np.int64))
            words = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * WORDS), flat)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(pair[:, 0]), pa.array(pair[:, 1]), pa.array(regs, pa.binary()), words, pa.array(least, pa.list_(pa.int64()))],
                names=["doc_id", "n", "h1", "h2", "registers", "bits", "least"],
            )

    return docs.mapInArrow(made, SKETCHES)


def banded(classes: DataFrame, percent: int) -> DataFrame:
    """``key``, ``rep`` and ``n`` for every band that isn't empty, and for the keys of least hashes."""

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rep, n = (np.array(batch.column(k).to_pylist(), dtype=np.int64) for k in (0, 1))
            regs = [np.frombuffer(r, "<u2") for r in batch.column(2).to_pylist()]
            for level, chosen in band_levels(n, percent).items():
                if not chosen.any():
                    continue
                keys = all_band_keys([regs[k] for k in np.flatnonzero(chosen)], level)
                held = keys != 0
                of = np.nonzero(held)[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[held].view(np.int64)), pa.array(rep[chosen][of]), pa.array(n[chosen][of])],
                    names=["key", "rep", "n"],
                )
            least = batch.column(3)
            of = pa.compute.list_parent_indices(least)
            yield pa.RecordBatch.from_arrays(
                [pa.compute.list_flatten(least), batch.column(0).take(of), batch.column(1).take(of)], names=["key", "rep", "n"]
            )

    return classes.select("rep", "n", "registers", "least").mapInArrow(made, "key long, rep long, n long")


def plausible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sketches leave the threshold possible."""

    def side(name: str) -> DataFrame:
        return classes.select(F.col("rep").alias(name), F.col("n").alias(f"n_{name}"), F.col("registers").alias(f"r_{name}"))

    def kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.to_pydict()
            good = [
                similar_enough(np.frombuffer(r, "<u2", REGISTERS), np.frombuffer(s, "<u2", REGISTERS), n, m, percent)
                for r, s, n, m in zip(columns["r_a"], columns["r_b"], columns["n_a"], columns["n_b"], strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    size_fits = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    found = pairs.join(side("b"), "b").join(side("a"), "a").where(size_fits)
    return found.select("a", "b", "n_a", "n_b", "r_a", "r_b").mapInArrow(kept, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs that are linked on their full sets."""

    def kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, None
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            good = []
            for k, hub in enumerate(a):
                if hub != last:
                    last, own = hub, shingle_set(batch.column(2)[k].as_py(), size)
                good.append(linked(own, shingle_set(batch.column(3)[k].as_py(), size), percent))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, g in zip(c, good, strict=True) if g], pa.int64()) for c in (a, b)], names=["a", "b"]
            )

    side = lambda name: texts.select(F.col("rep").alias(name), F.col("text").alias(f"t_{name}"))
    found = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "t_a", "t_b")
    return found.mapInArrow(kept, "a long, b long")


class Linker:
    """Labels of the components of all linked classes."""

    def __init__(self, classes: DataFrame, docs: DataFrame, size: int, percent: int, work: Work):
        self.classes, self.size, self.percent, self.work = classes, size, percent, work
        every = work.keep(banded(classes, percent), "bands")
        members = self._in_open_bands(every, "rep")
        work.drop(every)
        needed = members.select("rep").distinct()
        self.texts = work.keep(docs.join(needed, F.col("doc_id") == F.col("rep")).select("rep", "text"), "texts")
        self.members = members
        self.found: DataFrame | None = None
        self.tested: DataFrame | None = None
        self.labels: DataFrame | None = None

    def _in_open_bands(self, rows: DataFrame, several: str) -> DataFrame:
        """Rows of bands that have several values of a column."""
        low, high = F.min(several).alias("low"), F.max(several).alias("high")
        keys = self.work.keep(rows.groupBy("key").agg(low, high).where("low <> high").select("key"), "open")
        return self.work.keep(rows.join(keys, "key"), "rows")

    def test(self, pairs: DataFrame) -> int:
        """Adds the links among the pairs, and finds the components anew; how many there were."""
        new = pairs.distinct()
        if self.tested is not None:
            new = new.join(self.tested, ["a", "b"], "left_anti")
        new = self.work.keep(new, "pairs")
        self.tested = new if self.tested is None else self.tested.unionAll(new)
        likely = self.work.keep(plausible(new, self.classes, self.percent), "likely")
        links, number = self.work.keep_summed(verified(likely, self.texts, self.size, self.percent), "links", F.lit(1))
        if number:
            self.found = links if self.found is None else self.found.unionAll(links)
            self.labels = components(self.found, self.work)
        return number

    def unsettled(self) -> tuple[DataFrame, int, int]:
        """Members of bands with several components, the pairs that are left there, and the members."""
        known = self.labels.select(F.col("node").alias("rep"), "label") if self.labels is not None else None
        if known is None:
            rows = self.members.withColumn("comp", F.col("rep"))
        else:
            rows = self.members.join(known, "rep", "left").withColumn("comp", F.coalesce("label", "rep")).drop("label")
        rows = self._in_open_bands(self.work.keep(rows, "placed"), "comp")
        counts = rows.groupBy("key", "comp").agg(F.count("*").alias("m"))
        by_key = counts.groupBy("key").agg(F.max(F.struct("m", "comp")).alias("top"), F.sum("m").alias("all"))
        tops = self.work.keep(by_key.select("key", F.col("top.comp").alias("main"), F.col("top.m").alias("most"), "all"), "tops")
        pairs, n = tops.agg(F.sum((F.col("all") - F.col("most")).cast("double") * F.col("all")), F.sum("all")).first()
        return rows.join(tops.select("key", "main"), "key"), int(pairs or 0), int(n or 0)

    def run(self) -> DataFrame | None:
        links = self.test(self._against_hubs(self.members.withColumn("comp", F.col("rep")), 0))
        number = 1
        while True:
            left, pairs, n = self.unsettled()
            if pairs <= PAYS * n or FINDS * links < n:
                if pairs:
                    self.test(self._all_that_may_be_linked(left))
                return self.labels
            links = self.test(self._against_hubs(left, number))
            number += 1

    def _against_hubs(self, rows: DataFrame, number: int) -> DataFrame:
        """Each member with the hub of its band: the smallest id, after the first round in another order."""
        turn = F.lit((0x5DEECE66D1CE4E5B * number) & 0x7FFFFFFFFFFFFFFF)
        hubs = rows.groupBy("key").agg(F.min(F.col("rep").bitwiseXOR(turn)).bitwiseXOR(turn).alias("rep"))
        return self._paired(rows, self.work.keep(hubs.join(rows, ["key", "rep"]), "hubs"))

    def _all_that_may_be_linked(self, left: DataFrame) -> DataFrame:
        """Members outside their band's largest component with all of others, by the bitmaps' bound."""
        bits = self.classes.select("rep", "bits")
        rows = self.work.keep(left.join(bits, "rep"), "with-bits")
        words = [F.bit_count(F.get("bits", F.lit(k)).bitwiseXOR(F.get("other_bits", F.lit(k)))) for k in range(WORDS)]
        p = self.percent
        few = sum(words[1:], words[0]) * (100 + p) <= (100 - p) * (F.col("n") + F.col("m"))
        return self._paired(rows.where("comp <> main"), rows, few)

    def _paired(self, rows: DataFrame, others: DataFrame, bound: Column | None = None) -> DataFrame:
        """Members of a band in different components, of fitting sizes and within a bound."""
        names = {"rep": "other", "comp": "beside", "n": "m", "bits": "other_bits"}
        side = others.select("key", *[F.col(a).alias(b) for a, b in names.items() if a in others.columns])
        fits = F.least("n", "m") * 100 >= F.greatest("n", "m") * self.percent
        fits = (F.col("comp") != F.col("beside")) & (fits if bound is None else fits & bound)
        joined = rows.join(side, "key").where(fits)
        return joined.select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b"))


def near_copies(
    docs: DataFrame, size: int, percent: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Set size, component and whether it is kept, of every document.

    Null and empty texts, and texts of blanks only, have no shingle and are linked with nothing.
    Rows of equal id count as one document. Rows without id are linked with nothing either, and
    have no component. Ties can't arise: a component is named by its smallest id. No rows give
    no rows; other columns are left out.
    """
    work = Work(docs.sparkSession, "minhash")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    own = work.keep(sketches(rows, size, percent), "sketches")
    full = own.where("n > 0 AND doc_id IS NOT NULL")
    reps = work.keep(full.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep")), "reps")
    placed = work.keep(
        own.select("doc_id", "n", "h1", "h2").join(reps, ["h1", "h2"], "left").select(
            "doc_id", "n", F.when(F.col("n") > 0, F.col("rep")).alias("rep"), "h1", "h2"
        ),
        "placed",
    )
    first = reps.select("h1", "h2", "rep")
    classes = work.keep(
        full.join(first, ["h1", "h2"]).where("doc_id = rep").select("rep", "n", "registers", "bits", "least", "h1", "h2").dropDuplicates(["rep", "h1", "h2"]),
        "classes",
    )
    labels = Linker(classes, rows, size, percent, work).run()
    result = placed
    if labels is not None:
        result = result.join(labels.select(F.col("node").alias("rep"), "label"), "rep", "left")
    else:
        result = result.withColumn("label", F.lit(None).cast("long"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "rep", "doc_id"))
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    return work.finish(result.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), kept))


def oracle_sql(size: int, percent: int) -> str:
    """``near_copies`` of the table documents in DuckDB's SQL: every pair that shares a shingle."""
    return f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t\n\x0B\x0C\r]+') AS ws FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + {size - 1}], ' ') AS shingle
  FROM (SELECT *, unnest(range(1, greatest(len(ws) - {size - 2}, 2))) AS i FROM docs WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_have FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * both_have >= {percent} * (x.n + y.n - both_have)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT doc_id AS node, doc_id AS label FROM docs UNION SELECT w.b, r.label FROM reached r JOIN ways w ON w.a = r.node),
components AS (SELECT node AS doc_id, min(label) AS component_id FROM reached GROUP BY node)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM components LEFT JOIN sizes USING (doc_id)
"""
