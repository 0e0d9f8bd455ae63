"""Language of web pages by fusion of four kinds of evidence.

The posterior of a language is the product of: the likelihood of the page's
text under byte 4-gram models learnt from labelled documents; how often pages
in that language declare the page's markup language; and a prior of its host,
which shrinks to the host's domain, the address suffix and all pages in turn.
The last two are counted by grouped aggregation of the text posteriors; a
page's own part is left out of every count that it is judged by.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwright.llm.bytesets import mix, text_batches, text_bytes
from loomwright.llm.common import materialise

BITS = 15
GRAM = 4
#: Neighbouring 4-grams share three bytes, so each counts for a quarter.
SHARE = 1 / GRAM
#: Rows of a wider level that a narrower one is smoothed with.
STRENGTH = 5.0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _grams(b: np.ndarray, bits: int) -> np.ndarray:
    words = np.ndarray((len(b) - GRAM + 1,), "<u4", _LOWER[b].tobytes(), strides=(1,))
    return (mix(words.astype(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def language_models(docs: DataFrame, bits: int = BITS) -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities (language, bucket)) counted over all whole texts with a language."""
    docs = docs.where("lang is not null")
    names = sorted(r["lang"] for r in docs.select("lang").distinct().collect())  # as many as there are languages
    if not names:
        return [], np.zeros((0, 1 << bits))
    known = {n: k for k, n in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(known) << bits, np.int64)
        for whole in batches:
            for batch in text_batches(whole, "text", 1 << 20):
                data, offsets = text_bytes(batch.column("text"))
                b = data[offsets[0] : offsets[-1]]
                if len(b) < GRAM:
                    continue
                ends = offsets[1:] - offsets[0]
                row = np.repeat(np.arange(len(ends)), np.diff(offsets))[: len(b) - GRAM + 1]
                inside = ends[row] - np.arange(len(row)) >= GRAM
                lang = np.array([known[x] for x in batch.column("lang").to_pylist()], np.int64)
                total += np.bincount(((lang[row] << bits) | _grams(b, bits))[inside], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["cell", "n"])

    counts = np.ones(len(names) << bits)
    for r in docs.select("text", "lang").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        counts[r["cell"]] += r["n"]  # one row for each language and bucket
    counts = counts.reshape(len(names), -1)
    return names, np.log(counts / counts.sum(1, keepdims=True))


_BLOCKS = {"script": r"<script\b", "style": r"<style\b", "nav": r"<nav\b", "!--": "<!--"}
_CLOSERS = {k: re.compile("-->" if k == "!--" else rf"</{k}\s*>", re.IGNORECASE | re.ASCII) for k in _BLOCKS}
_TAG = re.compile("<[^>]*>")
_ENTITY = re.compile(r"&#?\w{1,8};|\s+", re.ASCII)
_HTML = re.compile(r"<html\b", re.IGNORECASE | re.ASCII)
_LANG = re.compile(r"\blang\s*=\s*[\"']?([a-z]{2,3})", re.IGNORECASE | re.ASCII)
_openers: dict[tuple[str, ...], re.Pattern[str]] = {}


def _without_blocks(html: str) -> str:
    """Scripts, styles, menus and comments as blanks; what has no end stays. Once a kind's end is not found, it is not sought again."""
    kinds, out, kept, at = tuple(_BLOCKS), [], 0, 0
    while kinds:
        if kinds not in _openers:
            _openers[kinds] = re.compile("|".join(f"({_BLOCKS[k]})" for k in kinds), re.IGNORECASE | re.ASCII)
        m = _openers[kinds].search(html, at)
        if m is None:
            break
        kind = kinds[m.lastindex - 1]
        if end := _CLOSERS[kind].search(html, m.end()):
            out += [html[kept : m.start()], " "]
            kept = at = end.end()
        else:
            kinds, at = tuple(k for k in kinds if k != kind), m.start() + 1
    return "".join([*out, html[kept:]])


def visible_text(html: str) -> str:
    """The page's text without scripts, styles, menus, comments, tags and entities; time in proportion to the page, whatever is left open."""
    bare = _without_blocks(html)
    last = bare.rfind(">") + 1  # a tag ends by then: no search runs to the end in vain
    return _ENTITY.sub(" ", _TAG.sub(" ", bare[:last]) + bare[last:])


def declared_language(html: str) -> str:
    """Primary subtag of the lang attribute of the html element, lower-cased; empty where there is none."""
    at = 0
    while m := _HTML.search(html, at):
        end = html.find(">", m.end())
        end = len(html) if end < 0 else end
        found = _LANG.search(html, m.end())
        if found is None:
            break
        if found.start() < end:
            return found[1].lower()
        at = end  # another html element before it ends has no attribute either
    return ""


def host_of(url: Column) -> Column:
    """Host of an address, lower-cased, without user, port and a leading www; empty where there is none."""
    host = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.regexp_replace(host, r"^www\.", "")


def identify(pages: DataFrame, docs: DataFrame, bits: int = BITS, strength: float = STRENGTH) -> DataFrame:
    """One row per page: ``page_id, language, probability, text_language, declared, host``.

    ``docs`` (text, lang) teach the text models. A null or empty page has no
    text evidence and gets what its address and all pages suggest; a null
    address is a host of its own name (empty). Repeated rows stay. Without
    labelled documents there are no languages, and language is null.
    """
    names, logs = language_models(docs, bits)
    kind = pages.schema["page_id"].dataType.simpleString()
    sent = pages.sparkSession.sparkContext.broadcast(logs)
    n = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_batches(whole, "html", 1 << 20):
                html = [x or "" for x in batch.column("html").to_pylist()]
                data, offsets = text_bytes(pa.array([visible_text(x) for x in html], pa.large_string()))
                b = data[offsets[0] : offsets[-1]]
                sums = np.zeros((batch.num_rows, n))
                if len(b) >= GRAM and n:
                    ends = offsets[1:] - offsets[0]
                    row = np.repeat(np.arange(len(ends)), np.diff(offsets))[: len(b) - GRAM + 1]
                    grams = _grams(b, bits)
                    inside = ends[row] - np.arange(len(row)) >= GRAM
                    for k in range(n):
                        sums[:, k] = np.bincount(row[inside], sent.value[k][grams[inside]], batch.num_rows) * SHARE
                lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * n), pa.array(sums.ravel()))
                declared = pa.array([declared_language(x) for x in html], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("page_id"), declared, batch.column("host"), lists], ["page_id", "declared", "host", "logs"])

    read = pages.select("page_id", F.col("html").cast("string").alias("html"), host_of(F.col("url")).alias("host"))
    scored = read.mapInArrow(run, f"page_id {kind}, declared string, host string, logs array<double>")
    if not n:
        none = F.lit(None)
        return scored.select("page_id", none.cast("string").alias("language"), none.cast("double").alias("probability"), none.cast("string").alias("text_language"), "declared", "host")
    known = F.array(*(F.lit(x) for x in names))
    scored = scored.withColumn("declared_as", F.when(F.array_contains(known, F.col("declared")), F.col("declared")).when(F.col("declared") == "", "").otherwise("other"))
    rows = materialise(scored.withColumn("own", _posterior(F.col("logs"))))

    sums = F.array(*(F.sum(F.col("own")[k]) for k in range(n)))
    none = F.array(*(F.lit(0.0) for _ in range(n)))

    def doubles(values: list[float] | None) -> Column:
        return F.array(*(F.lit(float(x or 0.0)) for x in values)) if values else none

    def others(counts: str | Column) -> Column:
        """Counts without the page's own part."""
        return F.zip_with(counts, "own", lambda a, o: F.greatest(a - o, F.lit(0.0)))

    def shrunk(counts: Column, prior: Column) -> Column:
        whole = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(counts, prior, lambda c, p: (c + strength * p) / (whole + strength))

    # how pages of each language declare themselves: at most languages + 2 kinds
    kinds = n + 2
    everywhere = doubles(rows.agg(sums.alias("n")).first()["n"])
    declared = none
    for r in rows.groupBy("declared_as").agg(sums.alias("n")).collect():
        declared = F.when(F.col("declared_as") == r["declared_as"], doubles(r["n"])).otherwise(declared)
    evidence = F.zip_with(others(declared), others(everywhere), lambda c, a: F.log((c + 1.0) / (a + float(kinds))))
    world = F.transform(others(everywhere), lambda c: c + 1.0)
    world = F.transform(world, lambda c: c / F.aggregate(world, F.lit(0.0), lambda a, x: a + x))

    # host -> domain -> suffix -> all, each summed from the narrower one
    labels = F.split("host", r"\.")
    hosts = rows.groupBy("host").agg(sums.alias("at_host"))
    hosts = materialise(hosts.select("host", "at_host", F.array_join(F.slice(labels, F.greatest(F.lit(1), F.size(labels) - 1), 2), ".").alias("domain"), F.element_at(labels, -1).alias("suffix")))

    def level(key: str, name: str) -> DataFrame:
        return hosts.groupBy(key).agg(F.array(*(F.sum(F.col("at_host")[k]) for k in range(n))).alias(name))

    # written, so that the join of pages with it can split a host that holds many of them
    priors = materialise(hosts.join(level("domain", "at_domain"), "domain").join(level("suffix", "at_suffix"), "suffix").select("host", "at_host", "at_domain", "at_suffix"))
    prior = shrunk(others("at_host"), shrunk(others("at_domain"), shrunk(others("at_suffix"), world)))
    fused = rows.join(priors, "host").withColumn("evidence", evidence).withColumn("prior", prior)
    joint = F.zip_with(F.zip_with("logs", "evidence", lambda a, b: a + b), "prior", lambda a, p: a + F.log(p))
    fused = fused.withColumn("posterior", _posterior(joint))
    best = F.array_position("posterior", F.array_max("posterior")).cast("int")
    text_best = F.array_position("own", F.array_max("own")).cast("int")
    return fused.select(
        "page_id", F.element_at(known, best).alias("language"), F.array_max("posterior").alias("probability"), F.element_at(known, text_best).alias("text_language"), "declared", "host"
    )


def _posterior(logs: Column) -> Column:
    top = F.array_max(logs)
    shifted = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(shifted, lambda x: x / F.aggregate(shifted, F.lit(0.0), lambda a, y: a + y))
