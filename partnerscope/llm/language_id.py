"""Language of web pages and documents, by Bayesian fusion of text, mark-up and address.

* Text: likelihoods of hashed letter runs under each language, learned from a bounded sample of
  labelled documents. Runs overlap and aren't independent, so their log likelihood is damped.
* Declared language of the mark-up: how often pages of each language declare it, from all pages,
  that declare one, weighted by what their texts alone say. A declaration that pages make at random is worth nothing.
* Address: priors of global, suffix, domain and host, each smoothed by the one above it, from sums
  over all pages. A host with few pages leans on its domain, a domain on its suffix.

A page's own text is taken out of every sum before it is used on that page. All sums are grouped
aggregations with map-side combining; the fusion is a few array expressions per page.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partnerscope.llm.common import Work, with_package
from partnerscope.llm.html_extract import read_page, site_of

#: Bounds of the fit: languages, beyond which it is an error; documents of each (about); classes of runs.
MAX_LANGUAGES = 500
SAMPLE_ROWS = 1_000
RUN_CLASSES = 1 << 15
RUN_LENGTHS = (2, 3, 4)
#: What a letter run's log likelihood counts, as runs overlap.
DAMPING = 0.2
#: Added to the count of each class of runs.
ADDED = 0.5
#: How many pages a level's own pages weigh as much as the level above.
LEVEL_WEIGHT = 5.0
#: How many pages the overall share of a declaration weighs.
DECLARED_WEIGHT = 5.0

NO_LETTERS = re.compile(r"[\W\d_]+")
HTML_LANG = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-zA-Z]{2,3})\b", re.IGNORECASE)
META_LANG = re.compile(
    r"<meta\b[^>]*?http-equiv\s*=\s*[\"']?content-language[\"']?[^>]*?content\s*=\s*[\"']?\s*([a-zA-Z]{2,3})\b", re.IGNORECASE
)


def run_classes(text: str) -> np.ndarray:
    """Classes of all letter runs of the text; words are bounded by blanks."""
    data = np.frombuffer(f" {NO_LETTERS.sub(' ', text.lower())} ".encode("utf-8", "surrogatepass"), np.uint8)
    data = data.astype(np.uint32)
    found = []
    for length in RUN_LENGTHS:
        n = len(data) - length + 1
        if n > 0:
            run = np.full(n, length, dtype=np.uint32)
            for k in range(length):
                run = run * np.uint32(0x01000193) ^ data[k : k + n]
            found.append((run ^ (run >> np.uint32(15))) % np.uint32(RUN_CLASSES))
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


@dataclass
class TextModel:
    languages: list[str]
    log_shares: np.ndarray  # [class, language]

    def log_likelihoods(self, text: str) -> np.ndarray:
        """Damped log likelihoods; all 0 for a text without letters."""
        if not NO_LETTERS.sub("", text):
            return np.zeros(len(self.languages))
        counts = np.bincount(run_classes(text), minlength=RUN_CLASSES)
        held = np.flatnonzero(counts)
        return DAMPING * (counts[held] @ self.log_shares[held])


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> TextModel:
    """Shares of letter runs in each language, from whole texts of a sample of the labelled documents.

    Labels are taken as they are written, apart from case. All are learned; more than
    ``MAX_LANGUAGES`` are an error, as a model without some of them would answer wrongly.
    """
    with_package(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.lower(F.col(lang_col).cast("string")).alias("lang"),
        F.col(text_col).cast("string").alias("text"),
    ).where("lang IS NOT NULL AND lang <> '' AND text IS NOT NULL")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1)
    known = {r["lang"]: r["n"] for r in sizes.collect()}
    if len(known) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in {lang_col}")
    languages = sorted(known)
    if not languages:
        return TextModel([], np.zeros((RUN_CLASSES, 0)))
    number = {lang: k for k, lang in enumerate(languages)}
    # A share of each language's documents, by a hash of the id, that gives the bound on average.
    share = F.create_map(*[x for lang in languages for x in (F.lit(lang), F.lit(min(1.0, SAMPLE_ROWS / known[lang])))])
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) / float(1 << 20)
    sample = rows.where(place < F.try_element_at(share, F.col("lang")))

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                own = sums.setdefault(number[lang], np.zeros(RUN_CLASSES, dtype=np.int64))
                own += np.bincount(run_classes(text.as_py()), minlength=RUN_CLASSES)
        for lang, own in sums.items():
            run = np.flatnonzero(own)
            arrays = [pa.array(np.full(len(run), lang), pa.int32()), pa.array(run, pa.int32()), pa.array(own[run])]
            yield pa.RecordBatch.from_arrays(arrays, names=["lang", "run", "n"])

    sums = np.full((RUN_CLASSES, len(languages)), ADDED)
    found = sample.mapInArrow(counted, "lang int, run int, n long").groupBy("lang", "run").agg(F.sum("n").alias("n"))
    for row in found.toLocalIterator():  # languages x classes at most
        sums[row["run"], row["lang"]] += row["n"]
    return TextModel(languages, np.log(sums / sums.sum(axis=0)).astype(np.float32))


def declared_language(html: str) -> str | None:
    """Main part of the language tag of the page, or of its meta element."""
    found = HTML_LANG.search(html) or META_LANG.search(html)
    return found[1].lower() if found else None


def address_parts(site: str) -> tuple[str | None, str | None, str | None]:
    """Host, its last two labels, and its last label; none for a host that is a number or missing."""
    labels = site.split(".")
    if not site or labels[-1].isdigit():
        return site or None, None, None
    return site, ".".join(labels[-2:]), labels[-1]


EVIDENCE = "host string, domain string, suffix string, declared string, text array<double>, alone array<double>"
_LISTS = pa.list_(pa.float64())
_EVIDENCE = (("host", pa.string()), ("domain", pa.string()), ("suffix", pa.string()), ("declared", pa.string()), ("text", _LISTS), ("alone", _LISTS))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max()) if len(x) else x
    return e / e.sum() if len(x) else e


def _evidence_batch(batch: pa.RecordBatch, names: list[str], rows: list[tuple], model: TextModel) -> pa.RecordBatch:
    """The batch's first columns, and host, domain, suffix, declaration and text of each row weighed."""
    columns: list[list] = [[], [], [], [], [], []]
    for *address, text in rows:
        likely = model.log_likelihoods(text)
        likely = likely - likely.max() if len(likely) else likely
        for column, value in zip(columns, (*address, likely.tolist(), _softmax(likely).tolist()), strict=True):
            column.append(value)
    arrays = [pa.array(c, kind) for c, (_, kind) in zip(columns, _EVIDENCE, strict=True)]
    return pa.RecordBatch.from_arrays(
        [*batch.columns[: len(names)], *arrays], names=[*names, *(name for name, _ in _EVIDENCE)]
    )


def page_evidence(
    pages: DataFrame, model: TextModel, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """What each page says of itself: log likelihoods of all its text outside of menus, adverts and
    the like, the languages it alone gives, its declaration, and the parts of its address."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for url, cell in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                html = cell.as_py() or ""
                blocks, _ = read_page("", html)
                rows.append((*address_parts(site_of(url)), declared_language(html), " ".join(t for _, t, _ in blocks)))
            yield _evidence_batch(batch, ["page_id", "url"], rows, model)

    return pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    ).mapInArrow(read, f"page_id long, url string, {EVIDENCE}")


def document_evidence(
    docs: DataFrame, model: TextModel, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """The same of plain documents: their text, and their source as host. Labels are no evidence."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = zip(batch.column(1).to_pylist(), batch.column(2), strict=True)
            yield _evidence_batch(batch, ["doc_id"], [(source, None, None, None, t.as_py() or "") for source, t in texts], model)

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.col(text_col).cast("string").alias("text"),
    ).mapInArrow(read, f"doc_id long, {EVIDENCE}")


def _sums(pages: DataFrame, keys: list[str], name: str, languages: int) -> DataFrame:
    """Pages and sums of their languages for each key."""
    sums = [F.sum(F.element_at("alone", k + 1)) for k in range(languages)]
    found = pages.where(" AND ".join(f"{k} IS NOT NULL" for k in keys) or "true").groupBy(*keys)
    return found.agg(F.array(*sums).alias(f"{name}_sums"))


def _smoothed(sums: Column, above: Column, weight: float) -> Column:
    """A level's shares without the page itself, smoothed by those of the level above."""
    own = F.zip_with(sums, F.col("alone"), lambda s, a: F.greatest(s - a, F.lit(0.0)))
    total = F.aggregate(own, F.lit(0.0), lambda t, x: t + x)
    shares = F.zip_with(own, above, lambda s, p: (s + weight * p) / (total + weight))
    return F.when(sums.isNull(), above).otherwise(shares)


def fused(pages: DataFrame, languages: list[str], work: Work) -> DataFrame:
    """Adds the posterior of every page."""
    n = len(languages)
    every = _sums(pages, [], "all", n).first()["all_sums"]  # one number for each language
    joined = pages.withColumn("all_sums", F.array(*[F.lit(x or 0.0) for x in every]))
    # A row for each declaration, suffix, domain and host: written, so that their size is known
    # when the joins are planned and a host with many pages can be split.
    for keys, name in ((["declared"], "declared"), (["suffix"], "suffix"), (["domain"], "domain"), (["host"], "host")):
        stats = work.keep(_sums(pages, keys, name, n), name)
        joined = joined.join(stats, keys, "left")
    uniform = F.array(*[F.lit(1.0 / n)] * n)
    prior = _smoothed(F.col("all_sums"), uniform, 1.0)
    joined = joined.withColumn("general", prior)
    chain = F.col("general")
    for name in ("suffix", "domain", "host"):
        joined = joined.withColumn(f"{name}_prior", _smoothed(F.col(f"{name}_sums"), chain, LEVEL_WEIGHT))
        chain = F.col(f"{name}_prior")
    declares = _sums(pages.where("declared IS NOT NULL"), [], "all", n).first()["all_sums"]
    joined = joined.withColumn("declares", F.array(*[F.lit(x or 0.0) for x in declares]))
    without = lambda sums: F.zip_with(sums, F.col("alone"), lambda s, a: F.greatest(s - a, F.lit(0.0)))
    joined = joined.withColumn("declaring", without(F.col("declared_sums"))).withColumn("pages", without(F.col("declares")))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda t, x: t + x)
    joined = joined.withColumn("share", (total(F.col("declaring")) + 0.5) / (total(F.col("pages")) + 1.0))
    says = F.zip_with(
        "declaring", "pages", lambda d, p: (d + DECLARED_WEIGHT * F.col("share")) / (p + DECLARED_WEIGHT)
    )
    joined = joined.withColumn("says", F.when(F.col("declared").isNull(), F.array(*[F.lit(1.0)] * n)).otherwise(says))
    logs = F.zip_with(F.zip_with("says", chain, lambda s, p: F.log(s) + F.log(p)), F.col("text"), lambda a, t: a + t)
    joined = joined.withColumn("logs", logs).withColumn("most", F.array_max("logs"))
    shares = F.transform("logs", lambda x: F.exp(x - F.col("most")))
    joined = joined.withColumn("shares", shares).withColumn("total", total(F.col("shares")))
    return joined.withColumn("posterior", F.transform("shares", lambda x: x / F.col("total")))


def identify(evidence: DataFrame, model: TextModel) -> DataFrame:
    """Language and probability of every page or document, with what text and host say alone.

    ``evidence`` comes from ``page_evidence`` or ``document_evidence`` or a union of both; its other
    columns are handed on. What has no text is decided by mark-up and address, what has neither by
    what all are in general. Ties go to the language that is first in the alphabet. Repeated ids
    keep all their rows; no rows give no rows; without any known language the columns are null.
    """
    work = Work(evidence.sparkSession, "language")
    read = work.keep(evidence, "evidence")
    others = [c for c in evidence.columns if c not in {name for name, _ in _EVIDENCE}]
    names = F.array(*[F.lit(x) for x in model.languages]).cast("array<string>")
    if not model.languages:
        nothing = F.lit(None).cast("string")
        return read.select(
            *others, nothing.alias("lang"), F.lit(None).cast("double").alias("probability"),
            nothing.alias("text_lang"), "declared", nothing.alias("host_lang"),
        )
    best = lambda a: F.element_at(names, F.array_position(a, F.array_max(a)).cast("int"))
    found = fused(read, model.languages, work).select(
        *others,
        best(F.col("posterior")).alias("lang"),
        F.array_max("posterior").alias("probability"),
        best(F.col("alone")).alias("text_lang"),
        "declared",
        best(F.col("host_prior")).alias("host_lang"),
    )
    return work.finish(found)


def identify_pages(pages: DataFrame, model: TextModel) -> DataFrame:
    return identify(page_evidence(pages, model), model)


def identify_all(pages: DataFrame, docs: DataFrame, model: TextModel) -> DataFrame:
    """Pages and documents together: a row has a ``page_id`` or a ``doc_id``."""
    of_pages = page_evidence(pages, model).withColumn("doc_id", F.lit(None).cast("long"))
    return identify(of_pages.unionByName(document_evidence(docs, model), allowMissingColumns=True), model)
