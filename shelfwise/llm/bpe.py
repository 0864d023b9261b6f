"""Byte-level BPE encoding and decoding with a rank file.

A text is cut into pieces by the split pattern, each piece's bytes are written
in the usual byte alphabet (printable bytes as themselves, the others moved
up to 256 and on), and the ``tokenizers`` library merges them. Pieces repeat,
so a worker keeps the ids of short ones; all new pieces of a batch go to the
library in one call. Offsets count characters: a token that holds part of a
character spans that whole character. Decoding looks ids up in the reversed
byte table and joins bytes before reading them as UTF-8, so characters split
over tokens come back whole.

Work is per row, without a shuffle. Memory is bounded by the Arrow batch (64
MB by default), the piece memo (emptied when full) and one slice of a long
text at a time; slices end where a piece ends for certain. A worker that only
decodes holds the byte table and neither the library's model nor a memo.

Nulls and edge cases: a null or empty text has no ids; ids outside the table
raise an error on decoding; a null list of ids decodes to null. Repeated rows
and ids are rows like any other; other columns pass through untouched, but
one named like an output column is replaced. An empty table gives an empty
result.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shelfwise.llm.common import ship_code, without

MEMO_PIECES = 150_000   # pieces kept by a worker, about 40 MB
MEMO_CHARS = 64         # longer pieces are not kept
SLICE_CHARS = 1 << 16   # of a long text at a time


def byte_alphabet() -> dict[int, str]:
    """Byte -> character: printable Latin-1 as it is, the rest from 256 on."""
    plain = [b for b in range(256) if chr(b).isprintable() and b not in (0x20,)]
    moved = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(moved)}


def rank_file(name: str) -> str:
    """A path as it is; a bare name is a file of the installed vocabularies."""
    if os.path.isabs(name):
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


def _ranges(prop: str) -> str:
    """The characters of a Unicode property up to U+FFFF as a class body for ``re``."""
    found = regex.findall(rf"\p{{{prop}}}+", "".join(chr(c) for c in range(0x10000)
                                                     if not 0xD800 <= c < 0xE000))
    runs = []
    for run in found:
        start = prev = ord(run[0])
        for c in map(ord, run[1:]):
            if c != prev + 1:
                runs.append((start, prev))
                start = c
            prev = c
        runs.append((start, prev))
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in runs)


class Splitter:
    """The split pattern, with faster equal forms for ASCII and for the basic plane."""

    def __init__(self, pattern: str):
        self.full = regex.compile(pattern)
        self.cut = regex.compile(r"(?<=\p{L})(?= \p{L})")
        space = "\\t-\\r " + "".join(f"\\u{ord(c):04x}" for c in map(chr, range(0x80, 0x3001))
                                     if regex.match(r"\s", c))
        self.basic = self._plain(pattern, _ranges("L"), _ranges("N"), space)
        self.ascii = self._plain(pattern, "A-Za-z", "0-9", "\\t-\\r ")

    @staticmethod
    def _plain(pattern: str, letters: str, numbers: str, space: str) -> re.Pattern | None:
        if "\\S" in pattern:
            pattern = pattern.replace("\\S", f"[^{space}]")
        head, *rest = re.split(r"(\[\^.*?\])", pattern)
        out = [head, *rest]
        for i, part in enumerate(out):  # a class inside brackets, or one of its own
            inside = part.startswith("[^")
            for name, body in (("\\p{L}", letters), ("\\p{N}", numbers), ("\\s", space)):
                part = part.replace(name, body if inside else f"[{body}]")
            out[i] = part
        return re.compile("".join(out))

    def pieces(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii.findall(text)
        if len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text):
            return self.basic.findall(text)
        return self.full.findall(text)

    def slices(self, text: str) -> Iterator[str]:
        """The text in parts that split into the same pieces as the whole: a
        part ends after a letter before a blank and another letter."""
        at = 0
        while len(text) - at > SLICE_CHARS:
            m = self.cut.search(text, at + SLICE_CHARS)
            if m is None:
                break
            yield text[at:m.start()]
            at = m.start()
        yield text[at:] if at else text


def _read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class ByteTable:
    """The bytes of each id of one rank file: all that decoding needs."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = {r: t for t, r in ranks.items()}
        size = max(tokens) + 1
        self.length = np.zeros(size, dtype=np.int64)   # of a token in bytes; 0: no such id
        for r, t in tokens.items():
            self.length[r] = len(t)
        self.first = np.concatenate([[0], np.cumsum(self.length)])[:size]
        self.blob = np.frombuffer(b"".join(tokens.get(r, b"") for r in range(size)), dtype=np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.length) or not self.length[ids].all()):
            raise ValueError("an id is not in the rank file")
        n = self.length[ids]
        before = np.cumsum(n) - n
        return self.blob[np.repeat(self.first[ids] - before, n) + np.arange(n.sum())].tobytes()


class Codec(ByteTable):
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str):
        from tokenizers import Tokenizer, models

        ranks = _read_ranks(path)
        super().__init__(ranks)
        self.shown = {b: ord(c) for b, c in byte_alphabet().items()}

        def show(token: bytes) -> str:
            return token.decode("latin-1").translate(self.shown)

        # Every way to put a token together from two earlier ones is a merge
        # with the token's own rank, in rank order.
        merges = [(show(t[:i]), show(t[i:])) for t, r in sorted(ranks.items(), key=lambda x: x[1])
                  for i in range(1, len(t))
                  if ranks.get(t[:i], r) < r and ranks.get(t[i:], r) < r]
        self.model = Tokenizer(models.BPE(vocab={show(t): r for t, r in ranks.items()}, merges=merges,
                                          ignore_merges=True, cache_capacity=0))
        self.splitter = Splitter(pattern)
        self.memo: dict[str, bytes] = {}  # piece -> its ids as packed int32

    def _learn(self, pieces: list[str]) -> None:
        shown = [p.encode("utf-8").decode("latin-1").translate(self.shown) for p in pieces]
        e = self.model.encode(shown, is_pretokenized=True, add_special_tokens=False)
        ids = np.array(e.ids, dtype=np.int32).tobytes()
        ends = np.searchsorted(np.array(e.word_ids, dtype=np.int64), np.arange(len(pieces)), side="right")
        ends = (4 * ends).tolist()
        self.memo.update(zip(pieces, (ids[a:b] for a, b in zip([0, *ends[:-1]], ends))))

    def _encode_parts(self, parts: list[str]) -> list[bytes]:
        split = [self.splitter.pieces(part) for part in parts]
        new = set().union(*split).difference(self.memo)
        if len(self.memo) + len(new) > MEMO_PIECES:
            self.memo.clear()
            new = set().union(*split)
        if new:
            self._learn(list(new))
        out = [b"".join(map(self.memo.__getitem__, pieces)) for pieces in split]
        for p in new:
            if len(p) > MEMO_CHARS:
                del self.memo[p]
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        packed: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, str]] = []
        chars = 0

        def flush() -> None:
            for (k, _), ids in zip(waiting, self._encode_parts([p for _, p in waiting])):
                packed[k].append(ids)
            waiting.clear()

        for k, text in enumerate(texts):
            for part in self.splitter.slices(text):
                waiting.append((k, part))
                chars += len(part)
                if chars >= 4 * SLICE_CHARS:
                    flush()
                    chars = 0
        flush()
        return [np.frombuffer(b"".join(p), dtype=np.int32) for p in packed]

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First character of each token, and the one after its last."""
        data = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
        char = np.cumsum((data & 0xC0) != 0x80) - 1
        ends = np.cumsum(self.length[ids])
        return char[ends - self.length[ids]].astype(np.int32), (char[ends - 1] + 1).astype(np.int32)


_CODECS: dict[tuple[str, str], Codec] = {}
_TABLES: dict[str, ByteTable] = {}


def codec(ranks: str, pattern: str | None = None) -> Codec:
    """This worker's codec for a rank file; built once."""
    if pattern is None:
        import public_tokenizers
        pattern = public_tokenizers.PATTERN
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has the cores
    key = (rank_file(ranks), pattern)
    if key not in _CODECS:
        _CODECS[key] = Codec(*key)
    return _CODECS[key]


def byte_table(ranks: str) -> ByteTable:
    """This worker's byte table of a rank file; built once."""
    path = rank_file(ranks)
    if path not in _TABLES:
        _TABLES[path] = ByteTable(_read_ranks(path))
    return _TABLES[path]


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)])
    values = np.concatenate([np.zeros(0, np.int32), *arrays])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))


def _parts(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    for i in range(0, batch.num_rows, rows):  # results are several times their texts
        yield batch.slice(i, rows)


def encode(docs: DataFrame, text_col: str = "text", ranks: str = "byte_bpe_multi_50k.tiktoken",
           pattern: str | None = None, ids_col: str = "ids", offsets: bool = False) -> DataFrame:
    """``docs`` with its ids (array of int); with ``offsets`` also ``starts`` and ``ends``."""
    ship_code(docs.sparkSession)
    ints = T.ArrayType(T.IntegerType(), False)
    new = [T.StructField(n, ints, False) for n in [ids_col, *(["starts", "ends"] if offsets else [])]]
    docs = without(docs, [f.name for f in new])
    schema = T.StructType([*docs.schema.fields, *new])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks, pattern)
        for whole in batches:
            for batch in _parts(whole):
                texts = [t.as_py() or "" for t in batch.column(at)]
                ids = c.encode(texts)
                made = [_lists(ids)]
                if offsets:
                    spans = [c.offsets(t, i) for t, i in zip(texts, ids)]
                    made += [_lists([s[k] for s in spans]) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=schema.names)

    return docs.mapInArrow(run, schema)


def decode(rows: DataFrame, ids_col: str = "ids", ranks: str = "byte_bpe_multi_50k.tiktoken",
           pattern: str | None = None, bytes_col: str = "decoded") -> DataFrame:
    """``rows`` with the bytes of its ids (binary; cast to string for the text)."""
    ship_code(rows.sparkSession)
    rows = without(rows, [bytes_col])
    schema = T.StructType([*rows.schema.fields, T.StructField(bytes_col, T.BinaryType())])
    at = rows.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = byte_table(ranks)
        for whole in batches:
            for batch in _parts(whole):
                out = [c.decode(ids.values.to_numpy(zero_copy_only=False)) if ids.is_valid else None
                       for ids in batch.column(at)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())],
                                                 names=schema.names)

    return rows.mapInArrow(run, schema)
