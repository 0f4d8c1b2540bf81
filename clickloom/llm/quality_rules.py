"""Quality rules: exact counts, and the divergence of a document from its language's references.

For each language of the corpus, two reference histograms are added up over all its documents:
kinds of characters, and words by bucket of a hash, of which the ``COMMON`` fullest are that
language's common words and the others one rest class. A document fails if the Jensen-Shannon
distance of one of its histograms from the reference is above a limit; a histogram with too few
counts is not judged. The references of languages with under a thousandth of all words lie in a
table, which their documents are joined with. A document whose language is null adds to no reference
and is held against the nearest of those in memory; an empty name is a language like any other.

Null texts have no words. Repeated rows are judged each and counted each in the references; a
null ``doc_id`` stays null; extra columns are ignored; without documents there is nothing to judge.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.statistics import KINDS, Texts
from clickloom.llm.storage import small_batches, stored
from clickloom.llm.text import map_texts, slices

BUCKETS = 4096
COMMON = 64
#: The references of languages from this share of all words on are held in memory, a thousand at most.
LEAST_SHARE = 1000
#: Largest distances of a good document, and the counts from which a histogram is judged.
MAX_KIND_DISTANCE, MAX_WORD_DISTANCE = 0.315, 0.47
LEAST_CHARS, LEAST_WORDS = 200, 50
_HELD = 64  # languages that a task adds up before it passes its sums on

Reference = dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]


def _histograms(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Kinds of characters by text, and the bucket of each word."""
    kinds = texts.kinds()[:, : KINDS.index("inside")].astype(float)
    return kinds, (texts.plain_words() % np.uint64(BUCKETS)).astype(np.int64)


def reference_counts(docs: DataFrame) -> DataFrame:
    """``lang, item, n``: sums over all documents of a language; items are kinds, then word buckets."""
    width = KINDS.index("inside")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def passed() -> Iterator[pa.RecordBatch]:
            for lang, total in sums.items():
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(total[at], pa.int64())],
                    names=["lang", "item", "n"],
                )
            sums.clear()

        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for low, high, data, offsets in slices(batch.column("_text")):
                texts = Texts(data, offsets)
                kinds, buckets = _histograms(texts)
                names = sorted({x for x in langs[low:high] if x is not None})
                number = {x: k for k, x in enumerate(names)}
                which = np.array([number.get(x, len(names)) for x in langs[low:high]])  # the last: of no language
                found = np.bincount(which[texts.owner] * BUCKETS + buckets, minlength=(len(names) + 1) * BUCKETS).reshape(-1, BUCKETS)
                for k, name in enumerate(names):
                    total = sums.setdefault(name, np.zeros(width + BUCKETS, np.int64))
                    total[:width] += kinds[which == k].sum(0).astype(np.int64)
                    total[width:] += found[k]
                if len(sums) > _HELD:
                    yield from passed()
        yield from passed()

    return (
        small_batches(docs)
        .select("lang", F.col("text").alias("_text"))
        .mapInArrow(count, "lang string, item int, n long")
        .groupBy("lang", "item")
        .agg(F.sum("n").alias("n"))
    )


def _reference(counts: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shares of the kinds, the common word buckets, shares of the word classes."""
    width = KINDS.index("inside")
    sums = np.zeros(width + BUCKETS)
    for item, n in counts:
        sums[item] = n
    kinds, buckets = sums[:width], sums[width:]
    common = np.argsort(-buckets, kind="stable")[:COMMON]
    shares = np.append(buckets[common], buckets.sum() - buckets[common].sum())
    return kinds / kinds.sum(), common, shares / shares.sum()


def _classes(common: np.ndarray) -> np.ndarray:
    """The class of each word bucket."""
    classes = np.full(BUCKETS, COMMON)
    classes[common] = np.arange(COMMON)
    return classes


def references(docs: DataFrame) -> tuple[Reference, DataFrame]:
    """By language: shares of the kinds, the class of each word bucket, shares of the word classes.

    Those of small languages come as a table ``lang, reference``.
    """
    width = KINDS.index("inside")
    counts = stored(reference_counts(docs))
    words_of = F.sum(F.when(F.col("item") >= width, F.col("n")).otherwise(0))
    sizes = counts.groupBy("lang").agg(words_of.alias("size")).where("size > 0")
    whole = sizes.agg(F.sum("size")).first()[0] or 0
    large = F.col("size") * LEAST_SHARE >= whole

    def listed(sizes: DataFrame) -> DataFrame:
        return counts.join(sizes.select("lang"), "lang").groupBy("lang").agg(F.collect_list(F.struct("item", "n")).alias("counts"))

    found: Reference = {}
    for row in sorted(listed(sizes.where(large)).collect(), key=lambda r: r["lang"]):
        kinds, common, shares = _reference(row["counts"])
        found[row["lang"]] = (kinds, _classes(common), shares)

    @F.udf("kinds array<double>, common array<int>, shares array<double>")
    def made(counts: list) -> tuple:
        return tuple(x.tolist() for x in _reference(counts))

    return found, stored(listed(sizes.where(~large)).select("lang", made("counts").alias("reference")))


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (root of the divergence in bits) of the rows of ``p`` from ``q``."""
    m = (p + q) / 2

    def part(a: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(a > 0, a * np.log2(a / m), 0).sum(1)

    return np.sqrt(np.clip((part(p) + part(np.broadcast_to(q, p.shape))) / 2, 0, 1))


def judge_documents(docs: DataFrame) -> DataFrame:
    """Counts, ``base_failed``, the two distances (null: not judged) and ``kept`` of each document."""
    large, small = references(docs)
    schema = (
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, kind_distance double, word_distance double"
    )

    def judge(kept: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> dict:
        texts = Texts(data, offsets)
        repeated = texts.repeated_words()
        failed = (texts.n_words < 50) | (100 * repeated > 50 * texts.n_words)
        kinds, buckets = _histograms(texts)
        langs = kept.column("lang").to_pylist()
        known = large
        if "reference" in kept.schema.names:
            own_of = zip(langs, kept.column("reference").to_pylist(), strict=True)
            known = {
                x: (np.array(r["kinds"]), _classes(np.array(r["common"])), np.array(r["shares"]))
                for x, r in {x: r for x, r in own_of if r is not None}.items()
            }
        kind_distance, word_distance = np.full(texts.n, np.nan), np.full(texts.n, np.nan)
        far = np.full(texts.n, np.inf)
        size = kinds.sum(1)
        for name, (kind_share, classes, word_share) in known.items():
            own = np.array([x == name or x is None for x in langs])
            if not own.any():
                continue
            found = np.bincount(texts.owner * (COMMON + 1) + classes[buckets], minlength=texts.n * (COMMON + 1)).reshape(texts.n, -1)
            a = divergence(kinds / np.maximum(size, 1)[:, None], kind_share)
            b = divergence(found / np.maximum(texts.n_words, 1)[:, None], word_share)
            nearer = own & (a + b < far)
            far[nearer] = (a + b)[nearer]
            kind_distance[nearer], word_distance[nearer] = a[nearer], b[nearer]
        kind_distance[size < LEAST_CHARS] = np.nan
        word_distance[texts.n_words < LEAST_WORDS] = np.nan
        bad = (kind_distance > MAX_KIND_DISTANCE) | (word_distance > MAX_WORD_DISTANCE)
        return {
            "doc_id": kept.column("doc_id"),
            "n_words": texts.n_words,
            "word_chars": texts.word_chars,
            "n_symbols": texts.symbols(),
            "n_dup_lines": texts.lines()[1],
            "n_repeat_words": repeated,
            "base_failed": failed,
            "kept": ~failed & ~bad,
            "kind_distance": pa.array(kind_distance, from_pandas=True),
            "word_distance": pa.array(word_distance, from_pandas=True),
        }

    rows = docs.select("doc_id", "lang", "text")
    held = F.col("lang").isNull() | F.col("lang").isin(list(large))
    joined = rows.where(~held).join(small, "lang", "left")
    return map_texts(rows.where(held), ["doc_id", "lang"], schema, judge).unionByName(
        map_texts(joined, ["doc_id", "lang", "reference"], schema, judge)
    )
