"""Languages of a document as a mixture, by expectation-maximisation over its words.

Learning counts letter trigrams (with word boundaries) by language over all training documents,
in hash buckets; shares of the buckets, smoothed by those of all languages together, give each word a likelihood under each language,
the product over its trigrams. A document's language proportions maximise the likelihood of its
words as a mixture; expectation-maximisation finds them for a whole slice of documents at once.
Languages enter the set one by one, the largest proportion first, and the set with the best
likelihood less ``penalty * languages * log(words)`` is kept; past three, it grows as long as each
language improves it. ``lang_pred`` is its largest part.

A text that is null or has no letter is ``und`` with score 0, as is every text when nothing could
be learned. Rows without a language are not learned from; repeated rows count once each. All
other languages are learned; the model has 256 KB for each. Ties go to the name that sorts first. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.storage import small_batches, stored
from clickloom.llm.text import map_texts, slices

UNKNOWN = "und"
BUCKETS = 1 << 16
_HELD = 64  # languages that a task adds up before it passes its sums on
#: A part below this proportion of the words is not reported as a language of the document.
LEAST_PART = 0.02


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all trigrams in order, the first trigram of each word, and each word's text.

    A word of ``n`` letters has ``n`` trigrams: each letter between its neighbours, where
    anything but a letter counts as the boundary.
    """
    raw = data.tobytes()
    texts = [raw[a:b].decode(errors="replace").lower() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    points = np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    letter = _letters()[points]
    points[~letter] = 0
    at = np.flatnonzero(letter)
    code = points[at - 1] * np.uint64(0x9E3779B97F4A7C15) + points[at] * np.uint64(0xC2B2AE3D27D4EB4F) + points[at + 1] * np.uint64(0x165667B19E3779F9)
    code ^= code >> np.uint64(29)
    code *= np.uint64(0xBF58476D1CE4E5B9)
    first = np.flatnonzero(~letter[at - 1])
    ends = 1 + np.cumsum([len(t) + 1 for t in texts])  # where the next text begins
    return (code >> np.uint64(48)).astype(np.int64), first, np.searchsorted(ends, at[first], "right")


def learned_rows(doc_id: str = "doc_id") -> Column:
    """Documents that may be learned from."""
    return F.crc32(F.col(doc_id).cast("string")) % 4 != 2


def trigram_counts(docs: DataFrame) -> DataFrame:
    """``lang, bucket, n`` over all rows of ``docs``, added up in each task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def passed() -> Iterator[pa.RecordBatch]:
            for lang, total in sums.items():
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(total[at], pa.int64())],
                    names=["lang", "bucket", "n"],
                )
            sums.clear()

        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for low, high, data, offsets in slices(batch.column("_text")):
                buckets, first, owner = trigrams(data, offsets)
                names = sorted(set(langs[low:high]))
                which = np.array([names.index(x) for x in langs[low:high]])
                length = np.diff(np.append(first, len(buckets)))
                of = np.repeat(which[owner], length)
                for k, name in enumerate(names):
                    total = sums.setdefault(name, np.zeros(BUCKETS, np.int64))
                    total += np.bincount(buckets[of == k], minlength=BUCKETS)
                if len(sums) > _HELD:
                    yield from passed()
        yield from passed()

    return (
        small_batches(docs.where(F.col("lang").isNotNull()))
        .select("lang", F.col("text").alias("_text"))
        .mapInArrow(count, "lang string, bucket int, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )


@dataclass
class Languages:
    names: list[str]
    log_share: np.ndarray  # by bucket and language

    def mixtures(self, data: np.ndarray, offsets: np.ndarray, rounds: int = 8, penalty: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
        """Proportions by text and language (zero outside the chosen set), and the number of words."""
        n, width = len(offsets) - 1, len(self.names)
        buckets, first, owner = trigrams(data, offsets)
        n_words = np.bincount(owner, minlength=n)
        if not width or not len(first):
            return np.zeros((n, width)), n_words
        logs = np.add.reduceat(self.log_share[buckets], first, axis=0)
        top = logs.max(1)
        like = np.exp(logs - top[:, None])
        filled = np.flatnonzero(n_words)
        starts = np.searchsorted(owner, filled)
        base = np.add.reduceat(top, starts)
        row = np.searchsorted(filled, owner)
        count = n_words[filled]

        def expected(parts: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
            """Maximise from ``parts`` on; the log likelihood at the end."""
            for _ in range(rounds):
                joint = like * parts[row]
                joint /= np.maximum(joint.sum(1), 1e-300)[:, None]
                parts = np.add.reduceat(joint, starts, axis=0) / count[:, None]
            return parts, base + np.add.reduceat(np.log(np.maximum((like * parts[row]).sum(1), 1e-300)), starts)

        parts, _ = expected(np.full((len(filled), width), 1 / width), rounds)
        rank = np.argsort(np.argsort(-parts, axis=1, kind="stable"), axis=1, kind="stable")
        best, best_value = None, None
        growing = np.ones(len(filled), bool)
        for size in range(1, width + 1):
            chosen = np.where(rank < size, np.maximum(parts, 1e-6), 0)
            chosen, value = expected(chosen / chosen.sum(1, keepdims=True), 0 if size == 1 else rounds // 2)
            value = value - penalty * size * np.log(count + 1)
            if best is None:
                best, best_value = chosen, value
            else:
                better = growing & (value > best_value) & (np.where(rank == size - 1, chosen, 0).sum(1) >= LEAST_PART)
                best = np.where(better[:, None], chosen, best)
                best_value = np.where(better, value, best_value)
                if size >= 3:
                    growing = better
                    if not growing.any():
                        break
        out = np.zeros((n, width))
        out[filled] = best
        return out, n_words


def learn(docs: DataFrame, smoothing: float = 0.5) -> Languages:
    """Trigram shares of each language over all rows of ``docs`` that have one."""
    counts = stored(trigram_counts(docs))
    rows = counts.toPandas()
    names = sorted(set(rows["lang"]))
    table = np.zeros((BUCKETS, len(names)))
    table[rows["bucket"].to_numpy(), rows["lang"].map(names.index).to_numpy(np.int64)] = rows["n"].to_numpy()
    whole = table.sum(1, keepdims=True) + smoothing
    whole *= smoothing * BUCKETS / whole.sum()
    table = np.log((table + whole) / (table.sum(0) + smoothing * BUCKETS))
    return Languages(names, table.astype(np.float32))


def identify(docs: DataFrame, model: Languages, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default ``doc_id``), ``lang_pred``, ``score`` and the set ``languages``."""
    keep = keep or ["doc_id"]
    kept_schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages times BUCKETS numbers

    def predict(kept: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> dict:
        model = shared.value
        parts, n_words = model.mixtures(data, offsets)
        names = np.array([*model.names, UNKNOWN], object)
        known = (n_words > 0) & (len(model.names) > 0)
        best = np.where(known, parts.argmax(1) if len(model.names) else 0, len(model.names))
        score = np.where(known, parts.max(1, initial=0), 0.0)
        sets = [[model.names[k] for k in np.argsort(-p, kind="stable") if p[k] > 0] for p in parts]
        return {c: kept.column(c) for c in keep} | {
            "lang_pred": pa.array(names[best].tolist(), pa.string()),
            "score": np.clip(score, 0, 1),
            "languages": pa.array(sets, pa.list_(pa.string())),
        }

    return map_texts(docs, keep, f"{kept_schema}, lang_pred string, score double, languages array<string>", predict)


def identify_documents(docs: DataFrame) -> DataFrame:
    """Learn from the rows that are not held out, predict all: ``doc_id, held_out, lang_pred, score``."""
    model = learn(docs.where(learned_rows()))
    return identify(docs, model).select(
        "doc_id",
        F.coalesce(~learned_rows(), F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
        "languages",
    )


def share_of_best(model: Languages, text: str = "text") -> Column:
    """The largest proportion of a language in the text, as a column; 0 without letters."""

    @F.arrow_udf("double")
    def share(texts: pa.Array) -> pa.Array:
        parts = [model.mixtures(data, offsets)[0].max(1, initial=0) for _, _, data, offsets in slices(texts)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return share(F.col(text))


def lettered(text: str = "text") -> Column:
    """Whether the text has a letter, as a column; false for null."""

    @F.arrow_udf("boolean")
    def has(texts: pa.Array) -> pa.Array:
        parts = [np.bincount(trigrams(data, offsets)[2], minlength=len(offsets) - 1) > 0 for _, _, data, offsets in slices(texts)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0, bool))

    return has(F.col(text))
