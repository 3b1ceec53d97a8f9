"""Language identification by a convolutional network over bytes.

A window of ``WINDOW`` bytes is embedded byte by byte, passed through filters of several widths,
max-pooled over the window and classified by a softmax layer.  The network is trained in numpy on
the driver, from a bounded sample: about ``SAMPLE_PER_LANGUAGE`` documents of each language (rows
chosen by a hash of their id), and ``SAMPLE_WINDOWS`` windows of each.  More languages than
``max_languages``, which bounds the sample, fail the job: none is left out.  Prediction covers every
byte of every text: its windows' probabilities are averaged by length.

A text that is null or holds no letter is ``und`` with score 0, and so is every text if there is
nothing to learn from.  Ties go to the language that sorts first.  Repeated rows are predicted one
by one, an empty table gives no rows.  A column that has the
name of a new one is replaced; ``prefix`` keeps them apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm.folds import held_out
from kestrel.llm.textnum import flat, map_batches, slices

WINDOW = 256
WIDTHS = (2, 3, 4, 5)
FILTERS = 12
EMBEDDING = 8
SAMPLE_PER_LANGUAGE = 500
SAMPLE_WINDOWS = 4
#: Languages by default: so many times the sample of one goes through the driver.
MAX_LANGUAGES = 256
EPOCHS = 6
UNKNOWN = "und"


@dataclass
class Network:
    """Weights; the filters of all widths share one matrix, narrow ones padded with zeros."""

    languages: list[str]
    embedding: np.ndarray  # (256, EMBEDDING)
    filters: np.ndarray  # (max width * EMBEDDING, number of filters)
    bias: np.ndarray
    dense: np.ndarray  # (number of filters, languages)
    dense_bias: np.ndarray

    def patches(self, windows: np.ndarray) -> np.ndarray:
        """Embedded byte runs, (windows, positions, width * EMBEDDING)."""
        width = max(WIDTHS)
        x = self.embedding[windows]
        n, length, e = x.shape
        s0, s1, s2 = x.strides
        view = np.lib.stride_tricks.as_strided(x, (n, length - width + 1, width * e), (s0, s1, s2))
        return np.ascontiguousarray(view)

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Filter responses (before the bias), and their patches."""
        p = self.patches(windows)
        return (p.reshape(-1, p.shape[2]) @ self.filters).reshape(p.shape[0], p.shape[1], -1), p

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """Softmax over the languages for windows of bytes, in blocks that fit a cache."""
        out = np.empty((len(windows), len(self.languages)), np.float32)
        for i in range(0, len(windows), 32):
            top = self.pooled(windows[i:i + 32])[0].max(axis=1)
            out[i:i + 32] = np.maximum(top + self.bias, 0) @ self.dense + self.dense_bias
        out -= out.max(axis=1, keepdims=True)
        np.exp(out, out=out)
        return out / out.sum(axis=1, keepdims=True)


def gradients(net: Network, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Weighted cross-entropy of windows and labels, and its gradient by each array of the network."""
    width = max(WIDTHS)
    response, p = net.pooled(x)
    where = response.argmax(axis=1)
    top = np.take_along_axis(response, where[:, None, :], 1)[:, 0] + net.bias
    hidden = np.maximum(top, 0)
    z = hidden @ net.dense + net.dense_bias
    z = np.exp(z - z.max(axis=1, keepdims=True))
    g = z / z.sum(axis=1, keepdims=True)
    loss = float(-(np.log(g[np.arange(len(y)), y]) * weight).sum())
    g[np.arange(len(y)), y] -= 1
    g *= weight[:, None]
    back = (g @ net.dense.T) * (top > 0)
    rows = np.arange(len(y))[:, None]
    chosen = p[rows, where]  # (batch, filters, width * EMBEDDING)
    d_filters = np.einsum("bf,bfk->kf", back, chosen) * filter_mask()
    d_patch = (back[:, :, None] * net.filters.T[None]).reshape(-1, width, EMBEDDING)
    d_embedding = np.zeros_like(net.embedding)
    for k in range(width):
        np.add.at(d_embedding, x[rows, where + k].ravel(), d_patch[:, k])
    return loss, [d_embedding, d_filters, back.sum(0), hidden.T @ g, g.sum(0)]


def filter_mask() -> np.ndarray:
    """1 where a filter of its width has a weight."""
    mask = np.zeros((max(WIDTHS) * EMBEDDING, len(WIDTHS) * FILTERS), np.float32)
    for k, w in enumerate(WIDTHS):
        mask[:w * EMBEDDING, k * FILTERS:(k + 1) * FILTERS] = 1
    return mask


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 5) -> Network:
    """Adam on cross-entropy, classes weighted alike; single precision."""
    rng = np.random.default_rng(seed)
    width, n_filters = max(WIDTHS), len(WIDTHS) * FILTERS

    def normal(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    net = Network(languages, normal(256, EMBEDDING, scale=0.5),
                  normal(width * EMBEDDING, n_filters, scale=0.2) * filter_mask(), np.zeros(n_filters, np.float32),
                  normal(n_filters, len(languages), scale=0.2), np.zeros(len(languages), np.float32))
    weights = [net.embedding, net.filters, net.bias, net.dense, net.dense_bias]
    means = [np.zeros_like(w) for w in weights]
    squares = [np.zeros_like(w) for w in weights]
    share = np.bincount(labels, minlength=len(languages)).astype(np.float32)
    class_weight = share.sum() / np.maximum(share, 1) / len(languages)
    step, batch = 0, 32
    for _ in range(max(EPOCHS, 200 * batch // max(len(labels), 1))):
        order = rng.permutation(len(labels))
        for i in range(0, len(order), batch):
            pick = order[i:i + batch]
            x, y = windows[pick], labels[pick]
            # a third of the windows is cut short, as the last window of a text is
            cut = np.where(rng.random(len(y)) < 1 / 3, rng.integers(8, WINDOW, len(y)), WINDOW)
            x = x * (np.arange(WINDOW) < cut[:, None])
            _, found = gradients(net, x, y, class_weight[y] / len(y))
            step += 1
            for w, m, s, d in zip(weights, means, squares, found):
                m += 0.1 * (d - m)
                s += 0.001 * (d * d - s)
                w -= 0.004 * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
    return net


def fit(documents: DataFrame, max_languages: int = MAX_LANGUAGES) -> Network | None:
    """A network learned from ``text`` and ``lang`` of the rows that aren't held out."""
    known = documents.filter(F.col("lang").isNotNull() & ~held_out())
    counts = known.groupBy("lang").count().orderBy("lang").limit(max_languages + 1).collect()
    if not counts:
        return None
    if len(counts) > max_languages:
        raise ValueError(f"there are more than {max_languages} languages: set max_languages, which bounds the sample")
    languages = sorted(r["lang"] for r in counts)
    place = F.xxhash64(F.lit("sample"), F.col("doc_id")).bitwiseAND((1 << 40) - 1)
    keep = F.lit(False)
    for r in counts:  # expected size: the bound, whatever the table's
        keep = keep | ((F.col("lang") == r["lang"])
                       & (place < int(min(1.0, SAMPLE_PER_LANGUAGE / r["count"]) * (1 << 40))))
    length = F.octet_length("raw")
    pieces = F.transform(F.sequence(F.lit(0), F.lit(SAMPLE_WINDOWS - 1)), lambda i: F.substring(
        F.col("raw"), F.greatest(F.lit(0), (length - WINDOW) * i / (SAMPLE_WINDOWS - 1)).cast("int") + 1, WINDOW))
    bound = 2 * SAMPLE_PER_LANGUAGE * len(languages)
    rows = (known.filter(keep & F.col("text").rlike(r"\p{L}"))
            .select("lang", place.alias("place"), F.encode("text", "UTF-8").alias("raw"))
            .select("lang", "place", F.array_distinct(pieces).alias("pieces"))
            .orderBy("place", "lang", "pieces").limit(bound).collect())
    if not rows:
        return None
    labels = np.array([languages.index(r["lang"]) for r in rows for _ in r["pieces"]])
    windows = np.zeros((len(labels), WINDOW), np.uint8)
    for i, piece in enumerate(p for r in rows for p in r["pieces"]):
        windows[i, :len(piece)] = np.frombuffer(bytes(piece), np.uint8)
    return train(windows, labels, languages)


def text_windows(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the texts, padded with zeros; their texts and their lengths in bytes."""
    buf, offsets = flat(texts)
    size = np.diff(offsets)
    count = -(-size // WINDOW)
    text_of = np.repeat(np.arange(len(size)), count)
    number = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[:-1][text_of] + number * WINDOW
    length = np.minimum(offsets[1:][text_of] - start, WINDOW)
    padded = np.concatenate([buf, np.zeros(WINDOW, np.uint8)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[start]
    short = np.flatnonzero(length < WINDOW)
    windows[short] *= np.arange(WINDOW)[None] < length[short][:, None]
    return windows, text_of, length


def predict(df: DataFrame, net: Network | None, prefix: str = "") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score``, the mean probability of that language, both names
    behind ``prefix``."""
    language, sure = prefix + "lang_pred", prefix + "score"
    rest = [c for c in df.columns if c not in (language, sure)]
    if net is None:
        return df.select(*rest, F.lit(UNKNOWN).alias(language), F.lit(0.0).alias(sure))
    schema = T.StructType([*(df.schema[c] for c in rest), T.StructField(language, T.StringType()),
                           T.StructField(sure, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(net.languages, dtype=object)
        for batch in batches:
            for rows in slices(batch, "text"):
                windows, text_of, length = text_windows(rows.column("text"))
                p = net.probabilities(windows).astype(np.float64) * length[:, None]
                total = np.zeros((rows.num_rows, len(names)))
                np.add.at(total, text_of, p)
                best = total.argmax(axis=1)
                size = np.maximum(np.bincount(text_of, length, rows.num_rows), 1)
                score = np.clip(total[np.arange(len(best)), best] / size, 0, 1)
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in rest), pa.array(names[best], pa.string()),
                     pa.array(score, pa.float64())], [*rest, language, sure])

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return (map_batches(df.select(*rest), run, schema)
            .withColumn(sure, F.when(lettered, F.col(sure)).otherwise(0.0))
            .withColumn(language, F.when(lettered, F.col(language)).otherwise(UNKNOWN)))


def languages(documents: DataFrame) -> DataFrame:
    """Language and score of every document, by a network learned from those not held out."""
    found = predict(documents.select("doc_id", "text"), fit(documents.select("doc_id", "text", "lang")))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
