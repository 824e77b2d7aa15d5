"""Toxicity: bags of subword vectors, averaged into a linear softmax.

A text is lower-cased and cut into words; a word's subwords are the word itself and its
character n-grams, its ends marked, hashed to a fixed number of vectors. A window is ``WINDOW``
words: the mean of its subwords' vectors goes into a softmax of two classes, and a document is as toxic
as its worst window, so a few words count in a long text as in a short one. Every window of the
whole text is scored. Words never seen share the n-grams of those they are spelled like.

Vectors and softmax are trained jointly in numpy, in one task, on a bounded sample: at most
``TRAIN_ROWS`` labelled rows of each class, of at most ``TRAIN_CHARS`` characters. With two classes only the
difference of the softmax rows meets a mean of vectors, and a mean of vectors meets it as a mean of numbers;
so a step costs one look-up and one count for each subword, whatever the length of a vector.

Defined results: null and empty texts have no window and score 0; repeated
rows are scored each; ids that repeat among the labels are toxic if any of their rows is; labels
without a value or document are not used; without rows of both classes every score is 0; an empty table gives no
rows; columns to keep are named and may clash with own ones. A text takes some 60 bytes for each
character in its task.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayloom.llm.common import mix, named, small_batches, written

#: Vectors, their length, sizes of character n-grams, words of a window.
BUCKETS, DIMENSIONS, SIZES, WINDOW = 1 << 16, 8, (3, 4, 5), 40
#: Bounds of the sample that is trained on: rows of each class, characters of a row.
TRAIN_ROWS, TRAIN_CHARS = 3_000, 16_000
#: Passes over the sample, of which the first take all windows of a toxic document as toxic.
EPOCHS, WARM_UP, RATE, DECAY, BATCH, SEED = 20, 2, 0.5, 1e-5, 128, 11

_SEPARATES = np.array([not chr(c).isalnum() for c in range(128)])
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Subwords:
    """Words of some texts: code points with 0 between words, and the window of each position."""

    codes: np.ndarray
    window: np.ndarray
    document: np.ndarray  # of each window

    def groups(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(bucket, window) of all subwords, one kind after the other."""
        x, ends = self.codes, np.cumsum(self.codes == 0)
        codes = mix(x.astype(np.uint64) + np.uint64(1))
        for size in SIZES:
            n = len(x) - size + 1
            if n <= 0:
                continue
            # Only the ends of an n-gram may lie between words.
            at = np.flatnonzero(ends[size - 2 : size - 2 + n] == ends[:n])
            h = np.full(len(at), size, np.uint64)
            with np.errstate(over="ignore"):
                for j in range(size):
                    h = h * _STEP + codes[at + j]
            inside = np.where(x[at] == 0, at + 1, at)
            yield (mix(h) & np.uint64(BUCKETS - 1)).astype(np.int32), self.window[inside]
        starts = np.flatnonzero((x[:-1] == 0) & (x[1:] != 0)) + 1
        if len(starts):
            # A whole word: the sum of its letters, each scrambled with its place in the word.
            place = np.arange(len(x), dtype=np.int64)
            place[starts[0]:] -= np.repeat(starts, np.diff(np.append(starts, len(x))))
            with np.errstate(over="ignore"):
                letters = np.where(x == 0, np.uint64(0), mix(codes + place.astype(np.uint64) * _STEP))
                whole = np.add.reduceat(letters, starts)
            yield (mix(whole) & np.uint64(BUCKETS - 1)).astype(np.int32), self.window[starts]


def subwords(texts: list[str | None]) -> Subwords:
    """Cuts texts into words and windows."""
    lowered = [(t or "").lower() for t in texts]
    codes = np.frombuffer((" " + " ".join(lowered) + " ").encode("utf-32-le", "surrogatepass"), "<u4")
    document = np.repeat(np.arange(len(texts) + 1), [len(t) + 1 for t in lowered] + [1])
    small = np.minimum(codes, 127)
    apart = (codes < 128) & _SEPARATES[small] | (codes == 0xA0) | (codes >= 0x2000) & (codes < 0x2070) | (codes == 0x3000)
    keep = ~apart
    keep[1:] |= ~apart[:-1]
    keep[0] = True
    x = np.where(apart, np.uint32(0), codes)[keep]
    document = document[keep]
    starts = np.flatnonzero((x[:-1] == 0) & (x[1:] != 0)) + 1
    window, of = np.zeros(len(x), np.int64), document[starts]
    if not len(of):
        return Subwords(x, window, np.zeros(0, np.int64))
    place = np.arange(len(of))
    place -= np.maximum.accumulate(np.where(np.append(True, of[1:] != of[:-1]), place, 0))
    opens = place % WINDOW == 0
    window[starts[0] :] = np.repeat(np.cumsum(opens) - 1, np.diff(np.append(starts, len(x))))
    return Subwords(x, window, of[opens])


@dataclass
class Model:
    """One vector for each bucket and a row of weights and a bias for each class."""

    vectors: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    @property
    def leaning(self) -> np.ndarray:
        """What each bucket adds for class 1 against class 0."""
        return (self.vectors @ (self.weights[1] - self.weights[0])).astype(np.float64)

    def logits(self, texts: list[str | None], leaning: np.ndarray | None = None) -> np.ndarray:
        """Log odds of each text's worst window; minus infinity for a text without words."""
        leaning = self.leaning if leaning is None else leaning
        bags = subwords(texts)
        n = len(bags.document)
        total, count = np.zeros(n), np.zeros(n)
        for bucket, window in bags.groups():
            total += np.bincount(window, leaning[bucket], n)
            count += np.bincount(window, minlength=n)
        bias = float(self.bias[1] - self.bias[0])
        out = np.full(len(texts), -np.inf)
        np.maximum.at(out, bags.document, total / np.maximum(count, 1) + bias)
        return out


def train(texts: list[str], toxic: np.ndarray) -> Model:
    """Vectors and softmax, jointly, by adaptive gradient steps on batches of documents."""
    draw = np.random.default_rng(SEED)
    model = Model(draw.normal(0, 0.1, (BUCKETS, DIMENSIONS)), draw.normal(0, 0.5, (2, DIMENSIONS)), np.zeros(2))
    bags = subwords(texts)
    pairs = list(bags.groups())
    bucket, window = np.concatenate([b for b, _ in pairs]), np.concatenate([w for _, w in pairs])
    order = np.argsort(window, kind="stable")
    bucket, sizes = bucket[order], np.bincount(window, minlength=len(bags.document))
    del pairs, window, order
    first = np.concatenate(([0], np.cumsum(sizes)))
    windows_of = np.concatenate(([0], np.cumsum(np.bincount(bags.document, minlength=len(texts)))))
    kept = np.flatnonzero(np.diff(windows_of) > 0)
    # Both classes weigh the same, however many rows each has.
    weight = len(toxic) / (2.0 * np.bincount(toxic, minlength=2))
    sums = [np.full(p.shape, 1e-8) for p in (model.vectors, model.weights, model.bias)]
    for epoch in range(EPOCHS):
        docs = draw.permutation(kept)
        for at in range(0, len(docs), BATCH):
            some = np.sort(docs[at : at + BATCH])
            wins = np.concatenate([np.arange(windows_of[d], windows_of[d + 1]) for d in some])
            lengths = sizes[wins]
            ids = np.concatenate([bucket[first[w] : first[w + 1]] for w in wins])
            starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            difference = model.weights[1] - model.weights[0]
            logit = np.add.reduceat((model.vectors @ difference)[ids], starts) / lengths + model.bias[1] - model.bias[0]
            owner = np.repeat(np.arange(len(some)), windows_of[some + 1] - windows_of[some])
            worst = np.zeros(len(wins), bool)
            ranked = np.lexsort((-logit, owner))
            worst[ranked[np.append(True, owner[ranked][1:] != owner[ranked][:-1])]] = True
            y = toxic[some][owner].astype(float)
            share = np.where(worst, 1.0, 0.0)
            if epoch < WARM_UP:
                share = 1.0 / np.bincount(owner)[owner]
            error = share * weight[toxic[some][owner]] * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) / len(some)
            pull = np.bincount(ids, np.repeat(error / lengths, lengths), BUCKETS)
            touched = np.flatnonzero(pull)
            slope = pull @ model.vectors
            # The class rows of the softmax have opposite slopes.
            steps = (pull[touched, None] * difference + DECAY * model.vectors[touched],
                     np.stack([-slope, slope]), np.array([-error.sum(), error.sum()]))
            for value, total, step, rows in zip((model.vectors, model.weights, model.bias), sums, steps, (touched, slice(None), slice(None))):
                total[rows] += step**2
                value[rows] -= RATE * step / np.sqrt(total[rows])
    model.vectors = model.vectors.astype(np.float32)
    return model


def sample_ids(labels: DataFrame, learn: Column, doc_id: str = "doc_id", toxic: str = "toxic", rows: int = TRAIN_ROWS) -> DataFrame:
    """_id and _toxic of at most ``rows`` labelled ids of each class, by the hash of the id."""
    known = labels.select(named(doc_id).cast("long").alias("_id"), named(toxic).alias("_toxic")).where("_id is not null and _toxic is not null")
    known = known.where(learn).groupBy("_id").agg(F.max(F.col("_toxic").cast("int")).alias("_toxic"))
    one = lambda y: known.where(F.col("_toxic") == y).orderBy(F.xxhash64("_id"), "_id").limit(rows)
    return one(0).unionByName(one(1))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic",
        rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> Model | None:
    """A model of the labelled rows for which ``learn`` (over ``_id``) holds; None without both classes."""
    wanted = written(sample_ids(labels, learn, doc_id, toxic, rows), "toxicity-ids")
    texts = docs.select(named(doc_id).cast("long").alias("_id"), named(text).alias("_text")).where(F.length("_text").between(1, chars))
    # At most so many ids as the sample has: a proven bound for the broadcast. Of repeated ids one text is taken.
    found = texts.join(F.broadcast(wanted), "_id").groupBy("_id", "_toxic").agg(F.min("_text").alias("_text"))

    def learned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        every = pd.concat(list(frames) or [pd.DataFrame({"_id": [], "_toxic": [], "_text": []})]).sort_values("_id", kind="stable")
        y = every["_toxic"].to_numpy(np.int64)
        if len(y) and y.min() < y.max():
            yield pd.DataFrame({"model": [pickle.dumps(train(every["_text"].tolist(), y))]})

    models = written(found.repartition(1).mapInPandas(learned, "model binary"), "toxicity-model").collect()
    return pickle.loads(models[0]["model"]) if models else None


def score(docs: DataFrame, model: Model | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",), label: str = "toxicity") -> DataFrame:
    """``keep`` and the column ``label``: a score from 0 to 1, of every row's whole text."""
    names = [f"_keep_{i}" for i in range(len(keep))]
    rows = docs.select(*(named(c).alias(n) for n, c in zip(names, keep)), named(text).alias("_text"))
    out = [F.col(n).alias(c) for n, c in zip(names, keep)]
    if model is None:
        return rows.select(*out, F.lit(0.0).alias(label))
    shared = docs.sparkSession.sparkContext.broadcast((model, model.leaning))
    kinds = rows.schema

    def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fitted, leaning = shared.value
        for frame in frames:
            z = fitted.logits(frame["_text"].tolist(), leaning)
            with np.errstate(over="ignore"):
                yield frame[names].assign(_score=1 / (1 + np.exp(-z)))

    schema = ", ".join([*(f"{n} {kinds[n].dataType.simpleString()}" for n in names), "_score double"])
    with small_batches(docs.sparkSession):
        scored = written(rows.mapInPandas(judge, schema), "toxicity")
    return scored.select(*out, F.col("_score").alias(label))
