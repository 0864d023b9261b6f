"""Language identification: multinomial logistic regression on TF-IDF character n-grams.

Features: character 1-, 2- and 3-grams of the lower-cased text, everything
but letters and marks below U+3000 read as blanks, hashed to ``2**HASH_BITS`` buckets; sublinear
term frequency times inverse document frequency, scaled to unit length.
Document frequencies and label counts come from all training rows. The
weights are trained with follow-the-regularised-leader (FTRL-Proximal, with
both penalties of the elastic net, so most are exactly zero) on at most
``SAMPLE_ROWS`` training rows, dealt evenly over the labels by a hash of the
id; a fifth of them is held back to fit one temperature for the scores.

Scale: one pass counts frequencies (each task adds up its own texts and emits
one number for each bucket), one reads the sample, one predicts, row by row.
What the driver and every worker hold is the model: buckets times labels.
The sample is trained on in one task and is bounded by SAMPLE_ROWS rows of at
most 2**HASH_BITS features, however long the texts.

Nulls and edge cases: a text that is null or has no letter is ``und`` with
score 0. Rows with a null label or text are no training rows; a null id
counts as the text "null" for the sample. Without any training row every
text is ``und``. With one label, all texts with a letter get it. Repeated
rows are rows of their own. Other columns are not read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import col, ship_code, without

HASH_BITS = 15
SAMPLE_ROWS = 4000
EPOCHS = 3
# FTRL-Proximal: step size, its offset, and the two penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.05
UNKNOWN = "und"
_SLICE = 1 << 18  # characters counted at once
_LETTER = regex.compile(r"\p{L}")
# Multipliers of the rolling hash, one for each place in an n-gram.
_PLACES = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


def _blank_table() -> np.ndarray:
    """Code point -> itself if it may be part of a word, else a blank."""
    t = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x3000):
        if unicodedata.category(chr(c))[0] not in "LM":
            t[c] = 0x20
    return t


_TABLE: list[np.ndarray] = []


def features(text: str, bits: int = HASH_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's n-grams, ascending, and how often each occurs."""
    if not _TABLE:
        _TABLE.append(_blank_table())
    counts = np.zeros(1 << bits, dtype=np.int64)
    shift = np.uint32(32 - bits)
    tail = " "
    for at in range(0, len(text), _SLICE):
        part = tail + text[at:at + _SLICE].lower()
        last = at + _SLICE >= len(text)
        part += " " if last else ""
        c = _TABLE[0][np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype="<u4")]
        mixed = [(c + np.uint32(i + 1)) * _PLACES[i] for i in range(3)]
        two = mixed[0][:-1] ^ mixed[1][1:]
        three = two[:-1] ^ mixed[2][2:]
        grams = [mixed[0][len(tail):], two[len(tail) - 1:], three]  # those that end in this slice
        for n, g in enumerate(grams):
            h = (g * np.uint32(0x27D4EB2F) + np.uint32(n)) * np.uint32(0x165667B1)
            counts += np.bincount(h >> shift, minlength=len(counts))
        tail = part[-2:]
    found = np.flatnonzero(counts)
    return found, counts[found]


@dataclass
class Model:
    labels: list[str]
    idf: np.ndarray       # bucket
    weights: np.ndarray   # bucket x label
    bias: np.ndarray
    temperature: float = 1.0

    def vector(self, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        v = (1.0 + np.log(counts)) * self.idf[buckets]
        norm = np.sqrt(v @ v)
        return v / norm if norm else v

    def logits(self, buckets: np.ndarray, v: np.ndarray) -> np.ndarray:
        return v @ self.weights[buckets] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.labels or not text or not _LETTER.search(text):
            return UNKNOWN, 0.0
        buckets, counts = features(text, int(len(self.idf)).bit_length() - 1)
        p = softmax(self.logits(buckets, self.vector(buckets, counts)) / self.temperature)
        k = int(p.argmax())
        return self.labels[k], float(p[k])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], labels: list[str], idf: np.ndarray) -> Model:
    """FTRL on (label number, buckets, counts) in the given order; every fifth row calibrates."""
    k = len(labels)
    model = Model(labels, idf, np.zeros((len(idf), k)), np.zeros(k))
    z, n = np.zeros((len(idf) + 1, k)), np.zeros((len(idf) + 1, k))
    data = []
    for y, buckets, counts in rows:
        data.append((y, np.append(buckets, len(idf)), np.append(model.vector(buckets, counts), 1.0)))
    held = data[::5] if len(data) >= 50 else []
    fit = [x for i, x in enumerate(data) if i % 5] if held else data

    def weights(b: np.ndarray) -> np.ndarray:
        zb = z[b]
        w = -(zb - np.sign(zb) * L1) / ((BETA + np.sqrt(n[b])) / ALPHA + L2)
        w[np.abs(zb) <= L1] = 0.0
        return w

    for _ in range(EPOCHS):
        for y, b, v in fit:
            w = weights(b)
            g = softmax(v @ w)
            g[y] -= 1.0
            g = v[:, None] * g
            old = n[b]
            n[b] = old + g * g
            z[b] += g - (np.sqrt(n[b]) - np.sqrt(old)) / ALPHA * w
    every = weights(np.arange(len(idf) + 1))
    model.weights, model.bias = every[:-1], every[-1]
    if held and k > 1:  # the temperature with the least loss on rows held back
        logits = np.array([model.logits(b[:-1], v[:-1]) for _, b, v in held])
        y = np.array([y for y, _, _ in held])

        # Targets a little short of 1, as in Platt scaling: a perfect fit on
        # n rows is no proof of certainty.
        right = (len(y) + 1.0) / (len(y) + 2.0)

        def loss(t: float) -> float:
            logs = np.log(np.maximum(softmax(logits / t), 1e-300))
            own = logs[np.arange(len(y)), y]
            return -(right * own + (1.0 - right) * (logs.sum(axis=1) - own) / (k - 1)).mean()

        model.temperature = min(np.exp(np.linspace(np.log(0.02), np.log(20), 200)), key=loss)
    return model


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
        sample_rows: int = SAMPLE_ROWS, bits: int = HASH_BITS) -> Model:
    """Train on the rows of ``docs`` that have a label and a text."""
    spark = docs.sparkSession
    ship_code(spark)
    rows = docs.select(col(id_col).cast("string").alias("id"), col(text_col).cast("string").alias("text"),
                       col(label_col).cast("string").alias("label")).where("label is not null and text is not null")
    per_label = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not per_label:
        return Model([], np.zeros(1 << bits), np.zeros((1 << bits, 0)), np.zeros(0))
    labels = sorted(per_label)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, dtype=np.int64)
        for batch in batches:
            for t in batch.column(0):
                total[features(t.as_py(), bits)[0]] += 1
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["b", "n"])

    seen = np.zeros(1 << bits)
    for r in rows.select("text").mapInArrow(count, "b long, n long").groupBy("b").agg(F.sum("n").alias("n")).collect():
        seen[r["b"]] = r["n"]  # as many rows as there are buckets
    idf = np.log((1.0 + sum(per_label.values())) / (1.0 + seen)) + 1.0

    # Each label's share of the sample is taken by hash: its expected size is
    # nine tenths of the bound, and the trainer keeps to the bound itself.
    share = 0.9 * sample_rows / len(labels)
    rates = F.create_map(*[F.lit(v) for x, n in per_label.items() for v in (x, min(1.0, share / n))])
    draw = (F.conv(F.substring(F.md5(F.coalesce("id", F.lit("null"))), 1, 8), 16, 10).cast("double") / 2.0 ** 32)
    sample = rows.withColumn("draw", draw).where(F.col("draw") < rates[F.col("label")])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [features(t.as_py(), bits) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), batch.column(3),
                 pa.array([g[0].astype(np.int32) for g in got], pa.list_(pa.int32())),
                 pa.array([g[1] for g in got], pa.list_(pa.int64()))], names=["label", "draw", "id", "b", "c"])

    def fit_all(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [p for p in parts if len(p)]
        if not parts:
            return
        pdf = pd.concat(parts).sort_values(["draw", "id", "label"]).head(sample_rows)
        number = {x: i for i, x in enumerate(labels)}
        m = train([(number[y], np.asarray(b), np.asarray(c)) for y, b, c in zip(pdf["label"], pdf["b"], pdf["c"])],
                  labels, idf)
        yield pd.DataFrame({"w": [m.weights.ravel().tolist()], "bias": [m.bias.tolist()], "t": [m.temperature]})

    made = (sample.select("text", "label", "draw", "id")
            .mapInArrow(extract, "label string, draw double, id string, b array<int>, c array<long>")
            .repartition(1).mapInPandas(fit_all, "w array<double>, bias array<double>, t double").first())
    if made is None:  # no row was drawn
        return Model(labels, idf, np.zeros((1 << bits, len(labels))), np.zeros(len(labels)))
    return Model(labels, idf, np.array(made["w"]).reshape(1 << bits, len(labels)), np.array(made["bias"]), made["t"])


def predict(docs: DataFrame, model: Model, text_col: str = "text", label: str = "lang_pred",
            score: str = "score") -> DataFrame:
    """``docs`` with the predicted label and its calibrated probability. Reads the text only;
    an input column named like an output column is replaced."""
    ship_code(docs.sparkSession)
    docs = without(docs, [label, score])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets x labels, whatever the input
    at = docs.columns.index(text_col)
    names = [*docs.columns, label, score]
    schema = T.StructType([*docs.schema.fields, T.StructField(label, T.StringType()),
                           T.StructField(score, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            got = [m.predict(t.as_py()) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                names=names)

    return docs.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """The documents that are never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(col(id_col).cast("string")) % 4 == 2, F.lit(False))
