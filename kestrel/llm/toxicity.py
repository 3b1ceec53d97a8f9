"""Toxicity by gradient-boosted trees over dense features of whole texts, calibrated.

Features: densities of a given lexicon (``seed_words``, none by default) and of a learned one (whole
words and word beginnings), hits near second-person words, capitals, punctuation, digits, and obfuscation (hits that show only after
look-alike characters are mapped back and marks inside words are taken out).

Learning takes a bounded sample, ``SAMPLE`` labelled documents that aren't held out, chosen by a
hash of their id: all toxic ones up to half of it (more if there are too few clean ones), and clean
ones to fill.  Of near copies (texts whose smallest hash of two words is the same) one is kept,
so that they don't count as independent evidence.  Half of the rest gives the learned lexicon: words
and beginnings that occur in many more toxic than clean documents.  The other half trains the trees,
toxic rows weighing ``LEAST_SHARE`` of all at least; predictions across ``FOLDS`` folds of it calibrate
the scores (isotonic regression), with rows weighed back to the share of toxic labels in the whole table.
Scoring covers every byte of every text.

Null and empty texts have no words and are scored like any other text.  Labels other than 0 and 1
and rows without doc_id are not learned from; a document labelled twice is toxic if either label
says so.  Of rows that share a doc_id, one is learned from, chosen by a hash of the text.  Without any toxic and any clean label every score is 0.  Repeated rows are scored one by
one, an empty table gives no rows.  A column that has the name of a new one is
replaced; ``prefix`` keeps them apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm.boosting import Trees, boost, isotonic
from kestrel.llm.folds import held_out
from kestrel.llm.textnum import LOWER, U64, WordHasher, flat, map_batches, mix, separators, slices
from kestrel.plans.materialize import RunTables

SAMPLE = 10_000
FOLDS = 3
#: Rows of the average share added to each pool of the calibration: so many, but no more than this
#: part of the toxic rows.
PRIOR, PRIOR_PART = 20.0, 0.1
LEAST_SHARE = 0.05
THRESHOLD = 0.3
#: A learned entry occurs in such a share of its half's toxic documents, its log-odds are so high,
#: and its count lies so many standard deviations above what chance gives.
MIN_SHARE, MIN_ODDS, MIN_DEVIATIONS = 0.01, 3.0, 4.0
LEXICON_SIZE = 4000
NEAR = 5  # words between a hit and a second-person word
BEGINNINGS = (4, 5, 6)  # bytes

# Second-person words.
SECOND_PERSON = ("you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine "
                 "deinen ihr euch euer tú ti usted ustedes vosotros").split()

NOT_WORD = separators(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
SPACE = separators(b" \t\n\r\x0b\x0c")
MARKS = NOT_WORD & ~SPACE
#: Look-alike bytes as the letters they stand for.
LOOKALIKE = LOWER.copy()
for _sign, _letter in zip(b"013457@$", b"oieastas"):
    LOOKALIKE[_sign] = _letter


@dataclass
class Lexicon:
    """Sorted hashes; weights of the learned ones."""

    seed: np.ndarray
    person: np.ndarray
    learned: np.ndarray
    weight: np.ndarray


def _hash(words: list[str]) -> np.ndarray:
    return np.sort(WordHasher(NOT_WORD).words(pa.array(words, pa.string()))[0])


def _has(sorted_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Index in ``sorted_``, or -1."""
    if not len(sorted_):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(sorted_, hashes), len(sorted_) - 1)
    return np.where(sorted_[at] == hashes, at, -1)


def _beginnings(hasher: WordHasher, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """For each length: the words that are longer, and hashes of their beginnings."""
    for n in BEGINNINGS:
        long = np.flatnonzero(ends - starts > n)
        yield long, hasher.hashes(buf, starts[long], starts[long] + n) ^ U64(n)


class Featurizer:
    """Dense features of texts."""

    N = 19

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.plain, self.masked = WordHasher(NOT_WORD), WordHasher(SPACE, LOOKALIKE)

    def features(self, texts: pa.Array) -> np.ndarray:
        """One row per text."""
        lex, (buf, offsets) = self.lexicon, flat(texts)
        starts, ends, per_text = self.plain.bounds(buf, offsets)
        hashes = self.plain.hashes(buf, starts, ends)
        seed, known = _has(lex.seed, hashes) >= 0, _has(lex.learned, hashes)
        weight = np.where(known >= 0, lex.weight[known] if len(lex.weight) else 0.0, 0.0)
        begun = np.zeros(len(hashes), bool)
        for long, h in _beginnings(self.plain, buf, starts, ends):
            at = _has(lex.learned, h)
            begun[long] |= at >= 0
            weight[long] = np.maximum(weight[long], np.where(at >= 0, lex.weight[at] if len(lex.weight) else 0, 0))
        hit = seed | (known >= 0) | begun
        person = _has(lex.person, hashes) >= 0

        def per(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
            return sums[bounds[1:]] - sums[bounds[:-1]]

        n_words, n_bytes = np.diff(per_text), np.diff(offsets)
        words, size = np.maximum(n_words, 1), np.maximum(n_bytes, 1)
        # second-person words within NEAR words, inside the text
        text_of = np.repeat(np.arange(len(texts)), n_words)
        people = np.concatenate([[0], np.cumsum(person)])
        index = np.arange(len(hashes))
        left = np.maximum(index - NEAR, per_text[:-1][text_of])
        right = np.minimum(index + NEAR + 1, per_text[1:][text_of])
        near = hit & (people[right] > people[left])

        upper = (buf >= 65) & (buf <= 90)
        letter = upper | ((buf >= 97) & (buf <= 122)) | (buf >= 0xC3)
        mark = MARKS[buf]
        twice = mark.copy()
        if len(buf):
            twice[1:] &= mark[:-1]
            twice[0] = False
        capitals = np.concatenate([[0], np.cumsum(upper)])
        length = ends - starts
        shouted = (capitals[ends] - capitals[starts] == length) & (length > 2)

        kept = ~mark
        place = np.concatenate([[0], np.cumsum(kept)])
        bare, bare_offsets = buf[kept], place[offsets]
        s2, e2, per_bare = self.masked.bounds(bare, bare_offsets)
        h2 = self.masked.hashes(bare, s2, e2)
        shown = (_has(lex.seed, h2) >= 0) | (_has(lex.learned, h2) >= 0)
        plain_hits = per(seed | (known >= 0), per_text)
        hidden = np.maximum(per(shown, per_bare) - plain_hits, 0)
        return np.stack([
            per(seed, per_text) / words, np.log1p(per(seed, per_text)),
            per(known >= 0, per_text) / words, per(weight, per_text) / words, np.log1p(per(known >= 0, per_text)),
            per(begun, per_text) / words, np.log1p(per(begun, per_text)),
            hidden / words, per(near, per_text) / words, per(person, per_text) / words,
            per(upper, offsets) / np.maximum(per(letter, offsets), 1), per(shouted, per_text) / words,
            per(buf == 33, offsets) / size, per(buf == 63, offsets) / size, per(mark, offsets) / size,
            per(twice, offsets) / size, per((buf >= 48) & (buf <= 57), offsets) / size,
            per(length == 1, per_text) / words, np.log1p(n_words),
        ], axis=1)


@dataclass
class Model:
    lexicon: Lexicon
    trees: Trees
    knots: np.ndarray
    shares: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated scores, 0 to 1."""
        return np.clip(np.interp(self.trees.raw(x), self.knots, self.shares), 0, 1)


def learn_lexicon(rows: DataFrame, seed_words: list[str]) -> Lexicon:
    """Words and beginnings that mark toxic documents; ``rows``: text and toxic."""
    def run(batches):
        hasher = WordHasher(NOT_WORD)
        for batch in batches:
            for part in slices(batch, "text"):
                buf, offsets = flat(part.column("text"))
                starts, ends, per_text = hasher.bounds(buf, offsets)
                text_of = np.repeat(np.arange(part.num_rows), np.diff(per_text))
                all_h, all_t = [hasher.hashes(buf, starts, ends)], [text_of]
                for long, h in _beginnings(hasher, buf, starts, ends):
                    all_h.append(h)
                    all_t.append(text_of[long])
                toxic = part.column("toxic").to_numpy(zero_copy_only=False)
                t, h = np.unique(np.stack([np.concatenate(all_t).astype(np.uint64), np.concatenate(all_h)]), axis=1) \
                    if len(starts) else (np.empty(0, np.uint64), np.empty(0, np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(toxic[t.astype(np.int64)].astype(np.int32))], ["h", "toxic"])

    total = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    bad, good = total.get(1, 0), total.get(0, 0)
    odds = (F.log((F.col("bad") + 0.5) / F.lit(bad + 1.0)) - F.log((F.col("all") - F.col("bad") + 0.5) / F.lit(good + 1.0)))
    chance = F.col("all") * F.lit(bad / max(bad + good, 1))
    found = (map_batches(rows.select("text", "toxic"), run, "h long, toxic int")
             .groupBy("h").agg(F.sum("toxic").alias("bad"), F.count("*").alias("all"))
             .filter((F.col("bad") >= MIN_SHARE * bad) & (F.col("bad") - chance >= MIN_DEVIATIONS * F.sqrt(chance)))
             .select("h", odds.alias("odds"), "bad").filter(F.col("odds") >= MIN_ODDS)
             .orderBy(F.desc("odds"), "h").limit(LEXICON_SIZE).collect())
    hashes = np.array([r["h"] for r in found], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    weight = np.array([r["odds"] for r in found], float)
    return Lexicon(_hash(seed_words), _hash(SECOND_PERSON), hashes[order], weight[order])


def _with_kin(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, toxic, text) with ``kin``: the smallest hash of two neighbouring words, which
    near copies share more often than not."""
    def run(batches):
        hasher = WordHasher(NOT_WORD)
        for batch in batches:
            for part in slices(batch, "text"):
                hashes, per_text = hasher.words(part.column("text"))
                pairs = mix(hashes[:-1] ^ (hashes[1:] << U64(1)))
                kin = [int(pairs[a:b - 1].min() >> U64(1)) if b - a > 1 else int(hashes[a] >> U64(1)) if b > a else 0
                       for a, b in zip(per_text[:-1], per_text[1:])]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", "toxic", "text")),
                                                  pa.array(kin, pa.int64())], ["doc_id", "toxic", "text", "kin"])

    rows = rows.select("doc_id", "toxic", "text")
    return map_batches(rows, run, T.StructType([*rows.schema.fields, T.StructField("kin", T.LongType())]))


def fit(documents: DataFrame, labels: DataFrame, seed_words: list[str] = ()) -> Model | None:
    """Learn from the labelled documents that aren't held out.

    ``seed_words``: a lexicon that is known beforehand.
    """
    place = F.xxhash64(F.lit("sample"), F.col("doc_id"))
    marks = (labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))

    def run(batches):
        featurizer = Featurizer(lexicon)
        for batch in batches:
            for part in slices(batch, "text"):
                x = featurizer.features(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("toxic"), pa.array(list(x))],
                                                 ["doc_id", "toxic", "x"])

    with RunTables(documents.sparkSession, "toxicity") as tables:
        marks = tables.write(marks, "marks")
        total = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
        if len(total) < 2:
            return None
        taken = {1: min(total[1], max(SAMPLE // 2, SAMPLE - total[0]))}
        taken[0] = min(total[0], SAMPLE - taken[1])
        chosen = marks.filter("toxic = 1").orderBy(place, "doc_id").limit(taken[1]).unionByName(
            marks.filter("toxic = 0").orderBy(place, "doc_id").limit(taken[0]))
        # SAMPLE rows of two numbers are broadcast
        held = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(
            F.first("toxic").alias("toxic"), F.min_by("text", F.xxhash64("text")).alias("text"))
        rows = tables.write(_with_kin(held), "sample")
        first = rows.groupBy("kin", "toxic").agg(F.min("doc_id").alias("doc_id"))
        rows = rows.join(F.broadcast(first), ["kin", "toxic", "doc_id"]).withColumn(
            "half", F.pmod(F.xxhash64(F.lit("half"), F.col("kin")), F.lit(2)))
        lexicon = learn_lexicon(rows.filter("half = 0"), list(seed_words))
        schema = T.StructType([rows.schema["doc_id"], rows.schema["toxic"], T.StructField("x", T.ArrayType(T.DoubleType()))])
        got = (map_batches(rows.filter("half = 1").select("doc_id", "toxic", "text"), run, schema)
               .orderBy(place, "doc_id", "x").collect())
    y = np.array([r["toxic"] for r in got], float)
    if len(set(y)) < 2:
        return None
    x = np.array([r["x"] for r in got])
    fold = np.zeros(len(y), int)
    for label in (0, 1):
        fold[y == label] = np.arange((y == label).sum()) % FOLDS
    raw = np.zeros(len(y))
    for k in range(FOLDS):
        raw[fold == k] = boost(x[fold != k], y[fold != k], weight=balance(y[fold != k])).raw(x[fold == k])
    # a clean row stands for so many, where a toxic one stands for one
    weight = np.where(y == 1, 1.0, (total[0] / taken[0]) / (total[1] / taken[1]))
    return Model(lexicon, boost(x, y, weight=balance(y)),
                 *isotonic(raw, y, min(PRIOR, PRIOR_PART * y.sum()), weight))


def balance(y: np.ndarray) -> np.ndarray:
    """Weights: 1, and for toxic rows as much as gives them ``LEAST_SHARE`` of all."""
    toxic = y.sum()
    least = (len(y) - toxic) * LEAST_SHARE / (1 - LEAST_SHARE)
    return np.where(y == 1, max(1.0, least / max(toxic, 1.0)), 1.0)


def score(df: DataFrame, model: Model | None, prefix: str = "") -> DataFrame:
    """``df`` with ``score`` and ``predicted`` (1 if the score reaches ``THRESHOLD``), both names
    behind ``prefix``."""
    names = [prefix + "score", prefix + "predicted"]
    rest = [c for c in df.columns if c not in names]
    if model is None:
        return df.select(*rest, F.lit(0.0).alias(names[0]), F.lit(0).alias(names[1]))
    schema = T.StructType([*(df.schema[c] for c in rest), T.StructField(names[0], T.DoubleType()),
                           T.StructField(names[1], T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        featurizer = Featurizer(model.lexicon)
        for batch in batches:
            for rows in slices(batch, "text"):
                s = model.score(featurizer.features(rows.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in rest), pa.array(s),
                     pa.array((s >= THRESHOLD).astype(np.int32))], [*rest, *names])

    return map_batches(df.select(*rest), run, schema)


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Score of every document, by a model learned from the labels of those not held out."""
    found = score(documents.select("doc_id", "text"), fit(documents, labels))
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted")
