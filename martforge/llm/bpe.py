"""Byte-level BPE encoding and decoding with a pair occurrence index.

The distinct pre-tokens of a run of documents lie end to end in one symbol
array.  An index maps every mergeable pair to all its positions there.  Active
ranks are applied in ascending order, each to all its positions at once; a
merge retires the two symbols' neighbours' pairs and adds the new ones to the
affected lists.  A merge only ever creates pairs of higher rank, so one
ascending walk over the ranks gives what merging word by word gives.

The tokenizer file is read once on the driver and sent to the workers as
arrays (its size is fixed by the file: a few MB).
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from martforge.llm.common import read, with_fields

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BYTES = 1 << 22  # bytes of text encoded at a time: the more, the fewer walks over the ranks, and the more memory
SEGMENT_CHARS = 1 << 18  # a longer text is cut where no pre-token can cross
CACHE = 150_000  # text units a task remembers

#: fixed value: the pre-token pattern of byte-level BPE (white space as Unicode's property)
PATTERN = regex.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+""")
_SAFE_CUT = regex.compile(r"(?<=\P{White_Space}) (?=\P{White_Space})")


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of every byte: itself if printable, else the next free one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Model:
    """Arrays of a byte-level BPE tokenizer file."""

    byte_id: np.ndarray  # id of each byte's symbol
    pair_keys: np.ndarray  # left id << 32 | right id, sorted
    pair_ranks: np.ndarray  # rank of each key
    merged: np.ndarray  # id made by each rank
    token_bytes: list[bytes]  # bytes of each id
    special: dict[str, int]  # added tokens, matched before anything else

    @staticmethod
    def load(path: str = TOKENIZER) -> "Model":
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, symbols = spec["model"]["vocab"], byte_symbols()
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        table = [b""] * (max([*vocab.values(), *special.values()]) + 1)
        for token, i in vocab.items():
            table[i] = bytes(symbols[c] for c in token) if all(c in symbols for c in token) else token.encode()
        for token, i in special.items():
            table[i] = token.encode()
        byte_id = np.zeros(256, np.int64)
        for c, b in symbols.items():
            byte_id[b] = vocab[c]
        return Model(byte_id, keys[order], order.astype(np.int64), np.array([vocab[a + b] for a, b in pairs], np.int64), table, special)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of every pair, -1 where the pair is never merged."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], -1) if len(self.pair_keys) else np.full(len(key), -1)


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))] if len(values) else values


def merge_all(model: Model, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, borders): the ids of every pre-token, and where each one's begin (one more border at the end)."""
    sizes = np.array([len(t) for t in tokens], np.int64)
    n = int(sizes.sum())
    starts = np.concatenate(([0], np.cumsum(sizes)))
    # symbols with a gap between pre-tokens: a negative id pairs with nothing
    place = np.arange(n) + np.repeat(np.arange(len(tokens)), sizes) + 1
    sym = np.full(n + len(tokens) + 2, -1, np.int64)
    sym[place] = model.byte_id[np.frombuffer(b"".join(tokens), np.uint8)] if n else 0
    after, before = np.arange(1, len(sym) + 1), np.arange(-1, len(sym) - 1)
    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def add(positions: np.ndarray) -> None:
        """Enter the pairs that begin at these positions into the index."""
        left, right = sym[positions], sym[after[positions]]
        fine = (left >= 0) & (right >= 0)
        positions = positions[fine]
        rank = model.ranks(left[fine], right[fine])
        fine = rank >= 0
        positions, rank = positions[fine], rank[fine]
        order = np.argsort(rank, kind="stable")
        positions, rank = positions[order], rank[order]
        cuts = np.flatnonzero(np.concatenate(([True], rank[1:] != rank[:-1]))) if len(rank) else []
        for lo, hi in zip(cuts, [*cuts[1:], len(rank)]):
            r = int(rank[lo])
            if r not in index:
                index[r] = []
                heapq.heappush(active, r)
            index[r].append(positions[lo:hi])

    add(place)
    by_rank = np.empty_like(model.pair_keys)
    by_rank[model.pair_ranks] = model.pair_keys
    while active:
        r = heapq.heappop(active)
        lists = index.pop(r)
        at = lists[0] if len(lists) == 1 else _distinct(np.concatenate(lists))
        left, right = int(by_rank[r]) >> 32, int(by_rank[r]) & 0xFFFFFFFF
        at = at[(sym[at] == left) & (sym[after[at]] == right)]
        if left == right and len(at) > 1:  # in a run of equal symbols every second pair goes, from the left
            at = np.sort(at)
            chained = np.concatenate(([False], after[at[:-1]] == at[1:]))
            run = np.flatnonzero(~chained)
            within = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
            at = at[within % 2 == 0]
        if not len(at):
            continue
        gone = after[at]
        sym[at], sym[gone] = model.merged[r], -2
        after[at] = after[gone]
        before[after[at]] = at
        add(_distinct(np.concatenate((before[at], at))))
    alive = sym >= 0
    counts = np.concatenate(([0], np.cumsum(alive)))
    return sym[alive], counts[starts + np.arange(len(tokens) + 1)]


class _Units(dict):
    """Numbers of the text units seen; a new one is noted to be learnt, one that can't stand alone is -1."""

    def __init__(self, fresh: list[str], lead: str, limit: list[int]):
        self.fresh, self.lead, self.count = fresh, lead, limit

    def __missing__(self, unit: str) -> int:
        if self.lead and (not unit or unit[0].isspace() or unit[-1].isspace()):
            self[unit] = -1
            return -1
        self.fresh.append(self.lead + unit)
        number = self[unit] = self.count[0]
        self.count[0] += 1
        return number


class Encoder:
    """Ids of texts; remembers the units it has seen, up to about ``CACHE`` of them.

    A unit is a stretch between single spaces (with the space before it): no
    pre-token crosses a space that stands between two other characters.  A
    text with other spaces, or with a special token, is cut into pre-tokens."""

    def __init__(self, model: Model):
        self.model = model
        self.special = regex.compile("|".join(regex.escape(s) for s in sorted(model.special, key=len, reverse=True))) if model.special else None
        self._forget()

    def _forget(self) -> None:
        self.fresh: list[str] = []
        self.count = [0]
        self.led, self.bare = _Units(self.fresh, " ", self.count), _Units(self.fresh, "", self.count)
        self.ids, self.borders = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def _pre_tokens(self, text: str) -> Iterator[list[str]]:
        """Lists of pre-tokens; a special token comes as a list of its own."""
        at = 0
        for m in self.special.finditer(text) if self.special else ():
            yield from self._plain(text[at : m.start()])
            yield [m[0]]
            at = m.end()
        yield from self._plain(text[at:] if at else text)

    def _plain(self, text: str) -> Iterator[list[str]]:
        while len(text) > SEGMENT_CHARS:
            cut = _SAFE_CUT.search(text, SEGMENT_CHARS)
            if cut is None:
                break
            yield PATTERN.findall(text[: cut.start()])
            text = text[cut.start():]
        if text:
            yield PATTERN.findall(text)

    def _numbers(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int64)
        if not any(s in text for s in self.model.special):
            units = text.split(" ")
            if units[0] and not units[0][-1].isspace():
                out = np.fromiter(map(self.led.__getitem__, units), np.int64, len(units)) if len(units) > 1 else np.zeros(1, np.int64)
                out[0] = self.bare[units[0]]
                if out.min() >= 0:
                    return out
        parts = [np.fromiter(map(self.bare.__getitem__, tokens), np.int64, len(tokens)) for tokens in self._pre_tokens(text)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, their borders)."""
        if self.count[0] > CACHE:
            self._forget()
        places = [self._numbers(text) for text in texts]
        ends = np.concatenate(([0], np.cumsum([len(p) for p in places])))
        if self.fresh:
            self._learn()
        at = np.concatenate(places) if places else np.zeros(0, np.int64)
        lo, size = self.borders[at], self.borders[at + 1] - self.borders[at]
        upto = np.concatenate(([0], np.cumsum(size)))
        return _gather(self.ids, lo, size, upto), upto[ends]

    def _learn(self) -> None:
        """Ids of the fresh units: their distinct pre-tokens are merged together."""
        number: dict[str, int] = {}
        rows: list[int] = []
        counts = []
        for unit in self.fresh:
            tokens = [unit] if unit in self.model.special else PATTERN.findall(unit)
            counts.append(len(tokens))
            for t in tokens:
                rows.append(number.setdefault(t, len(number)))
        ids, borders = merge_all(self.model, [b"" if t in self.model.special else t.encode() for t in number])
        for special, i in self.model.special.items():
            if special in number:
                k = number[special]
                ids = np.insert(ids, borders[k], i)
                borders[k + 1:] += 1
        at = np.array(rows, np.int64)
        lo, size = borders[at], borders[at + 1] - borders[at]
        upto = np.concatenate(([0], np.cumsum(size)))
        ends = upto[np.concatenate(([0], np.cumsum(counts)))]
        self.borders = np.concatenate((self.borders, ends[1:] + self.borders[-1]))
        self.ids = np.concatenate((self.ids, _gather(ids, lo, size, upto)))
        self.fresh.clear()


def _gather(values: np.ndarray, lo: np.ndarray, size: np.ndarray, upto: np.ndarray) -> np.ndarray:
    """values[lo[i] : lo[i] + size[i]] for all i, end to end (upto: the running sizes)."""
    return values[np.arange(upto[-1]) + np.repeat(lo - upto[:-1], size)]


def _runs(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about PIECE_BYTES bytes of text."""
    sizes = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(column):
        stop = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + PIECE_BYTES, "right")))
        yield at, stop
        at = stop


def encode(docs: DataFrame, path: str = TOKENIZER, text: str = "text") -> DataFrame:
    """The documents with a column ``ids`` (array<int>) added; every other column stays.

    A null text is the empty text and has no ids; a special token's string in
    a text is that token.  A column already named ids is replaced."""
    model = docs.sparkSession.sparkContext.broadcast(Model.load(path))
    kept = docs.drop("ids")
    return kept.mapInArrow(_encoder(model, text), with_fields(kept.schema, ("ids", T.ArrayType(T.IntegerType()))))


def _encoder(model, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model.value)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for lo, hi in _runs(column):
                ids, borders = encoder.encode([t or "" for t in column.slice(lo, hi - lo).to_pylist()])
                lists = pa.ListArray.from_arrays(pa.array(borders.astype(np.int32)), pa.array(ids.astype(np.int32)))
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, "ids"])
    return run


def decode(rows: DataFrame, path: str = TOKENIZER, ids: str = "ids") -> DataFrame:
    """The rows with ``ids`` replaced by ``decoded`` (string): the bytes of all ids, special ones too.

    Bytes that are no UTF-8 become U+FFFD; null ids give the empty text; an id
    that the tokenizer lacks is an error."""
    model = rows.sparkSession.sparkContext.broadcast(Model.load(path))
    schema = with_fields(rows.drop(ids, "decoded").schema, ("decoded", T.StringType()))
    return rows.mapInArrow(_decoder(model, ids, schema.names), schema)


def _decoder(model, ids: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.value.token_bytes
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            texts = []
            for i in range(len(column)):
                value = column[i].values
                texts.append(b"".join(map(table.__getitem__, value.to_numpy().tolist())).decode("utf-8", "replace") if value is not None else "")
            part = batch.select([n for n in names if n != "decoded"])
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=names)
    return run


def round_trip(docs: DataFrame, path: str = TOKENIZER, text: str = "text") -> DataFrame:
    """``encode``, then ``decode`` of its ids, in one Python worker a task: the documents with ``ids`` and ``decoded`` added."""
    model = docs.sparkSession.sparkContext.broadcast(Model.load(path))
    kept = docs.drop("ids", "decoded")
    schema = with_fields(kept.schema, ("ids", T.ArrayType(T.IntegerType())), ("decoded", T.StringType()))
    encoded, decoded = _encoder(model, text), _decoder(model, "ids", schema.names)
    return kept.mapInArrow(lambda batches: decoded(encoded(batches)), schema)


def digests(docs: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document."""
    ids = encode(docs.select("doc_id", "text"), path).select("doc_id", "ids")
    marked = ids.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), "ids")
    return decode(marked, path).select("doc_id", "n_tokens", "ids_sha256", F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"))


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read(spark, sf_dir, "documents"))
