"""Language identification by rank-order profiles.

Letters are lower-cased, everything else is a word border, and the 1- to
3-grams of letters (borders included at either end) are counted.  A language's
profile is its ``PROFILE`` most frequent n-grams over all training text.  A
document's ``PROFILE`` most frequent n-grams are compared to each profile by
out-of-place distance: the sum over its n-grams of how far their ranks differ,
``PROFILE`` for one that the profile lacks.  The nearest profile wins.

Training counts every training document; counts are summed per batch before
the shuffle.  What reaches the driver is languages x ``PROFILE`` rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from martforge.llm.common import lean_batches, pieces, read, text_buffers, with_fields

PROFILE = 300
ORDERS = 3
PIECE_BYTES = 1 << 21
BITS = np.uint64(21)  # a code point
BORDER = np.uint64(32)
MIN_SCORE = 0.2  # a text further than this from every profile is no prose of a known language
NONE = "und"

_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether each code point is a letter (made once per worker)."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram codes of all texts end to end, borders).  A text without letters has none."""
    points = np.frombuffer("".join(f"\n{t}\n" for t in map(str.lower, texts)).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter((len(t.lower()) + 2 for t in texts), np.int64, len(texts))
    letter = _letters()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1] & ~letter[1:]  # the first border after a word
    first = np.concatenate(([0], np.cumsum(sizes)))
    keep[first[:-1]] = True  # the border that opens a text
    code = np.where(letter, points, 32).astype(np.uint64)[keep]
    letter = letter[keep]
    kept = np.concatenate(([0], np.cumsum(keep)))
    at = kept[first]
    parts, where = [code[letter]], [np.flatnonzero(letter)]
    two = code[:-1] << BITS | code[1:]
    fine = letter[:-1] | letter[1:]
    parts.append(two[fine])
    where.append(np.flatnonzero(fine))
    three = two[:-1] << BITS | code[2:]
    fine = letter[1:-1]
    parts.append(three[fine])
    where.append(np.flatnonzero(fine))
    # a pair or triple never spans two texts: the last border of a text is followed by the first of the next
    out, borders = [], [np.searchsorted(w, at) for w in where]
    ends = sum(borders)
    flat = np.empty(int(ends[-1]), np.uint64)
    for i in range(len(texts)):
        lo = ends[i]
        for part, b in zip(parts, borders):
            n = b[i + 1] - b[i]
            flat[lo : lo + n] = part[b[i] : b[i + 1]]
            lo += n
    return flat, ends


def top(codes: np.ndarray) -> np.ndarray:
    """The PROFILE most frequent codes, most frequent first (ties: smaller code first)."""
    codes = np.sort(codes)
    cut = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    counts = np.diff(np.append(cut, len(codes)))
    order = np.argsort(-counts, kind="stable")[:PROFILE]
    return codes[cut[order]]


@dataclass
class Profiles:
    """Ranks of every profile n-gram in every language; PROFILE where a language lacks it."""

    langs: list[str]
    codes: np.ndarray
    ranks: np.ndarray  # codes x languages

    @staticmethod
    def of(rows: list[tuple[str, int, int]]) -> "Profiles":
        langs = sorted({lang for lang, _, _ in rows})
        codes = np.unique(np.array([code for _, code, _ in rows], np.uint64))
        ranks = np.full((len(codes) + 1, len(langs)), PROFILE, np.int64)
        for lang, code, rank in rows:
            ranks[np.searchsorted(codes, np.uint64(code)), langs.index(lang)] = rank
        return Profiles(langs, codes, ranks)

    def predict(self, codes: np.ndarray) -> tuple[str, float]:
        if not len(codes) or not self.langs:
            return NONE, 0.0
        mine = top(codes)
        at = np.searchsorted(self.codes, mine)
        at[at == len(self.codes)] = 0
        at = np.where(self.codes[at] == mine, at, len(self.codes))
        ranks = self.ranks[at]
        away = np.where(ranks == PROFILE, PROFILE, np.abs(ranks - np.arange(len(mine))[:, None])).sum(axis=0)
        nearest = int(np.argmin(away))
        return self.langs[nearest], float(1.0 - away[nearest] / (PROFILE * len(mine)))


def _batches(batch: pa.RecordBatch, text: int) -> Iterator[tuple[int, int, list[str]]]:
    column = batch.column(text)
    offsets, _ = text_buffers(column)
    for lo, hi in pieces(offsets, PIECE_BYTES):
        yield lo, hi, column.slice(lo, hi - lo).to_pylist()


def learn(docs: DataFrame, training) -> Profiles:
    """Profiles of every language among the documents where ``training`` (a column) holds; rows without lang or text are left out."""
    labelled = docs.filter(training & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for lo, hi, some in _batches(batch, 1):
                flat, ends = grams(some)
                for lang in sorted(set(langs[lo:hi])):
                    mine = np.concatenate([flat[ends[i] : ends[i + 1]] for i in np.flatnonzero(langs[lo:hi] == lang)])
                    codes, counts = np.unique(mine, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(codes), pa.string()), pa.array(codes.astype(np.int64)), pa.array(counts.astype(np.int64))],
                        names=["lang", "code", "n"])

    counted = labelled.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    rows = counted.withColumn("rank", F.row_number().over(best) - 1).filter(F.col("rank") < PROFILE).select("lang", "code", "rank")
    return Profiles.of([tuple(r) for r in rows.collect()])  # languages x PROFILE rows


def predict(docs: DataFrame, profiles: Profiles, pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """The documents with their predicted language and its score (0 to 1) added; every other column stays.

    A text that is null or has no letter is ``und`` with score 0, and so is
    every text if no language was learnt.  Equal distances go to the language
    that sorts first."""
    sent = docs.sparkSession.sparkContext.broadcast(profiles)
    kept = docs.drop(pred, score)
    schema = with_fields(kept.schema, (pred, T.StringType()), (score, T.DoubleType()))
    text = kept.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            filled = batch.set_column(text, "text", pa.compute.fill_null(batch.column(text), ""))
            for lo, hi, some in _batches(filled, text):
                flat, ends = grams(some)
                found = [sent.value.predict(flat[ends[i] : ends[i + 1]]) for i in range(hi - lo)]
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                    names=schema.names)

    return kept.mapInArrow(run, schema)


def split_of(doc_id: str = "doc_id"):
    """Whether a document is held out: crc32 of its id as text, modulo 4, is 2 (a null id is not)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), learnt from the documents that are not held out."""
    profiles = learn(docs, ~split_of())
    return predict(docs.select("doc_id", split_of().alias("held_out"), "text"), profiles).drop("text")


def _with_letters(docs: DataFrame) -> DataFrame:
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            filled = batch.set_column(text, "text", pa.compute.fill_null(batch.column(text), ""))
            for lo, hi, some in _batches(filled, text):
                _, ends = grams(some)
                yield batch.slice(lo, hi - lo).filter(pa.array(np.diff(ends) > 0))

    return docs.mapInArrow(run, docs.schema)


def keep_known(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents, without those of no language or too far from every profile; every column stays.

    If no language could be learnt (no training document has a lang), every
    document that holds a letter stays."""
    lean_batches(docs.sparkSession)
    profiles = learn(docs, ~split_of())
    if not profiles.langs:
        return _with_letters(docs)
    found = predict(docs, profiles, "__pred", "__score")
    return found.filter((F.col("__pred") != NONE) & (F.col("__score") >= min_score)).select(*docs.columns)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read(spark, sf_dir, "documents"))
