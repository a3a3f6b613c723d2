"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of 1 to 3 letters are hashed into ``2 ** bits`` features.  Document
frequencies come from all training documents.  Weights are trained with the
follow-the-regularised-leader update and elastic-net penalties on a bounded
sample of labelled documents; a temperature fitted on a held-back part of
that sample calibrates the scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageRules:
    bits: int = 15
    orders: tuple = (1, 2, 3)
    rows_per_label: int = 400      # bound of the training sample, per language
    epochs: int = 4
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 2e-3
    l2: float = 1e-3
    seed: int = 17


@dataclass
class LanguageModel:
    labels: list
    table: np.ndarray          # features x labels: idf times weight; one more row of zeros
    bias: np.ndarray
    temperature: float
    rules: LanguageRules


def letter_table() -> np.ndarray:
    """Code point -> code point of its lower-case letter, or 0 for what is not a letter.  Built once in a task."""
    table = np.zeros(0x110000, np.int32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            table[c] = ord(ch.lower()[0])
    return table


def text_grams(texts: list[str], rules: LanguageRules, table: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Per order the features of all texts in a row (``2**bits`` marks a gram without letters),
    and the code-point offsets of the texts.

    Texts are padded by separators on both sides, one fewer than the longest gram has letters, so that no gram
    with a letter of one text reaches into another.
    """
    size, pad = 1 << rules.bits, max(1, max(rules.orders) - 1)
    between = " " * pad
    points = np.frombuffer("".join(between + t + between for t in texts).encode("utf-32-le", "replace"), dtype=np.uint32)
    letters = table[points].astype(np.uint64)
    offsets = np.concatenate([[0], np.cumsum([len(t) + 2 * pad for t in texts])]).astype(np.int64)
    out = []
    for n in rules.orders:
        h = np.full(len(letters), n * 0x9E3779B1, dtype=np.uint64)
        blank = np.ones(len(letters), bool)
        for k in range(n):
            part = np.zeros_like(letters)
            part[:len(letters) - k] = letters[k:]
            h = (h ^ part) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            blank &= part == 0
        f = (h >> np.uint64(20)).astype(np.int64) & (size - 1)
        f[blank] = size
        out.append(f)
    return out, offsets


def _chunks(texts: list, limit: int = 400_000) -> Iterator[tuple[int, list[str]]]:
    start, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > limit:
            yield start, texts[start:i]
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, texts[start:]


def document_frequencies(texts: DataFrame, rules: LanguageRules) -> np.ndarray:
    """How many rows of ``texts`` (one column) hold each feature; all rows count."""
    size = 1 << rules.bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(size + 1, np.int64), 0
        seen, table = np.zeros(size + 1, bool), letter_table()
        for batch in batches:
            column = [t or "" for t in batch.column(0).to_pylist()]
            rows += len(column)
            for _, part in _chunks(column):
                grams, offsets = text_grams(part, rules, table)
                for i in range(len(part)):
                    for f in grams:
                        seen[f[offsets[i]:offsets[i + 1]]] = True
                    total += seen
                    seen[:] = False
        at = np.flatnonzero(total[:size])
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, size)), pa.array(np.append(total[at], rows))],
                                         names=["feature", "n"])

    parts = texts.mapInArrow(count, "feature bigint, n bigint")
    df = np.zeros(size + 1, np.int64)
    for r in parts.groupBy("feature").agg(F.sum("n").alias("n")).collect():   # at most 2**bits + 1 rows
        df[r["feature"]] = r["n"]
    return df


def sample_vectors(sample: DataFrame, rules: LanguageRules) -> DataFrame:
    """Term frequencies (label, features, tf) of the sampled rows (label, text)."""
    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = letter_table()
        for batch in batches:
            labels, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            keys, values = [], []
            for _, part in _chunks(texts):
                grams, offsets = text_grams(part, rules, table)
                for i in range(len(part)):
                    f = np.concatenate([g[offsets[i]:offsets[i + 1]] for g in grams])
                    f = f[f < 1 << rules.bits]
                    u, n = np.unique(f, return_counts=True)
                    keys.append(u)
                    values.append(n / max(1, len(f)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(labels, pa.string()), pa.array(keys, pa.list_(pa.int64())), pa.array(values, pa.list_(pa.float64()))],
                names=["label", "features", "tf"])
    return sample.mapInArrow(vectors, "label string, features array<bigint>, tf array<double>")


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train_ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], n_labels: int, size: int,
               rules: LanguageRules) -> np.ndarray:
    """FTRL-proximal with L1 and L2 on (label, features, values); the last feature is the bias."""
    z = np.zeros((size + 1, n_labels))
    n = np.zeros((size + 1, n_labels))
    order = np.random.default_rng(rules.seed)

    def weights(f: np.ndarray) -> np.ndarray:
        zf = z[f]
        w = -(zf - np.sign(zf) * rules.l1) / ((rules.beta + np.sqrt(n[f])) / rules.alpha + rules.l2)
        w[np.abs(zf) <= rules.l1] = 0
        return w

    for _ in range(rules.epochs):
        for i in order.permutation(len(rows)):
            y, f, x = rows[i]
            f, x = np.append(f, size), np.append(x, 1.0)
            w = weights(f)
            p = softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p[None, :]
            g2 = g * g
            z[f] += g - (np.sqrt(n[f] + g2) - np.sqrt(n[f])) / rules.alpha * w
            n[f] += g2
    return weights(np.arange(size + 1))


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss, by golden-section search on its logarithm."""
    if len(y) == 0:
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(logits / np.exp(log_t))
        return -float(np.mean(np.log(np.maximum(p[np.arange(len(y)), y], 1e-12))))

    lo, hi, g = np.log(0.05), np.log(20.0), (5 ** 0.5 - 1) / 2
    for _ in range(50):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def train(docs: DataFrame, rules: LanguageRules = LanguageRules(), text_col: str = "text",
          label_col: str = "lang", key_col: str = "doc_id") -> LanguageModel | None:
    """Train on the rows of ``docs`` with a label; None if there are none.

    The sample takes, per label, about ``rows_per_label`` rows chosen by a hash of the key, and
    at most twice as many.
    """
    rows = docs.filter(F.col(label_col).isNotNull()).select(
        F.col(label_col).cast("string").alias("label"), F.col(text_col).alias("text"),
        F.pmod(F.xxhash64(F.lit(rules.seed), F.col(key_col)), F.lit(1 << 40)).alias("u"))
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    labels = sorted(counts)
    size = 1 << rules.bits
    df = document_frequencies(rows.select("text"), rules)
    idf = np.log((1 + df[size]) / (1 + df[:size])) + 1
    take = None
    for label in labels:
        limit = int((1 << 40) * min(1.0, rules.rows_per_label / counts[label]))
        ok = (F.col("label") == label) & (F.col("u") < limit)
        take = ok if take is None else take | ok
    sample = rows.filter(take).limit(2 * rules.rows_per_label * len(labels))
    got = sample_vectors(sample.select("label", "text"), rules).collect()   # bounded by the sample
    at = {label: i for i, label in enumerate(labels)}
    data = []
    for r in sorted(got, key=lambda r: (r["label"], len(r["features"]), r["features"][:8], r["tf"][:8])):
        f, x = np.array(r["features"], np.int64), np.array(r["tf"])
        if len(f):
            data.append((at[r["label"]], f, x * idf[f]))
    kept = [d for i, d in enumerate(data) if i % 5]
    back = [d for i, d in enumerate(data) if i % 5 == 0]
    w = train_ftrl(kept, len(labels), size, rules)
    logits = np.array([x @ w[f] + w[size] for _, f, x in back]).reshape(len(back), len(labels))
    temperature = fit_temperature(logits, np.array([y for y, _, _ in back], int))
    table = np.zeros((size + 1, len(labels)), np.float32)
    table[:size] = w[:size] * idf[:, None]
    return LanguageModel(labels, table, w[size], temperature, rules)


def predict_batch(texts: list, model: LanguageModel, table: np.ndarray) -> tuple[list[str], list[float]]:
    names, scores = [], []
    for _, part in _chunks([t or "" for t in texts]):
        grams, offsets = text_grams(part, model.rules, table)
        total = np.zeros((len(part), len(model.labels)))
        count = np.zeros(len(part))
        for f in grams:
            total += np.add.reduceat(model.table[f], offsets[:-1], axis=0, dtype=np.float64)
            count += np.add.reduceat((f < len(model.table) - 1).astype(np.int64), offsets[:-1])
        p = softmax((total / np.maximum(count, 1)[:, None] + model.bias) / model.temperature)
        best = p.argmax(axis=1)
        for i in range(len(part)):
            known = count[i] > 0
            names.append(model.labels[best[i]] if known else UNKNOWN)
            scores.append(min(1.0, max(0.0, float(p[i, best[i]]))) if known else 0.0)
    return names, scores


def predict(text: Column, model: LanguageModel | None) -> Column:
    """struct(lang_pred, score) of a text column; ``und`` and 0 without letters or without a model."""
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def classify(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = letter_table()
        for array in arrays:
            texts = array.to_pylist()
            if model is None:
                names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            else:
                names, scores = predict_batch(texts, model, table)
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             fields=list(kind))
    return classify(text)


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    """True for the fold that training must not see; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def identify(docs: DataFrame, rules: LanguageRules = LanguageRules(), id_col: str = "doc_id",
             text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; trained on the labelled rows that are not held out.

    Rows with a null id are classified but not learned from.  Without any label
    every row is ``und`` with score 0.  Repeated rows are classified alike.
    """
    seen = docs.filter(F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    model = train(seen, rules, text_col, label_col, id_col)
    return (docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                        predict(F.col(text_col), model).alias("p"))
            .select("doc_id", "held_out", "p.lang_pred", "p.score"))
