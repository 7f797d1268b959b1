"""Language of whole texts by averaged hashed subword embeddings and a linear softmax.

The subwords of a text are all its runs of one, two and three bytes (ASCII letters lowered), hashed into BUCKETS rows of an
embedding table.  A text's vector is the mean of its rows; a linear layer and a softmax give the languages.  Table and layer
are trained by stochastic gradient descent in numpy on a bounded sample of labelled rows: about PER_LANGUAGE rows of each
language, picked by a hash of doc_id.  A fifth of them is set aside to fit the softmax temperature and the limits of
rejection.

A text is rejected by either of two limits.  One is of confidence: the share below which REJECT_SHARE of right texts and snippets
fall.  A softmax may be sure of a text of a language it never saw, so the other is of familiarity: the mean over the text's subwords
of the logarithm of how much more often the sample has them than chance would.  Short texts vary more, so each of VIEW_SIZES has its
own limit, fitted on cuts of that size: the familiarity below which REJECT_SHARE of them fall, or the same share of an exponential
tail through the lowest TAIL of them where that is lower (the sample may be too small to hold so rare a text).

Prediction needs only the table times the layer and the familiarity of each row (BUCKETS x (languages + 1) numbers), which are
broadcast; their size depends on the number of languages, not on the documents.

Defined cases: a text that is null or has no letter (Unicode L) is `und` with score 0; equal texts get equal predictions; with
no labelled row every text is `und`; a null doc_id is never learned from and not held out; an empty table gives no row;
other columns are kept by `accepted` and ignored by `predict`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.hashing import hash_uniform
from larder.llm.words import LOWER, raw, slices, text_column

BUCKETS = 256 + (1 << 15)
DIMENSION = 16
PER_LANGUAGE = 800
EPOCHS = 6
BATCH = 32
RATE = 0.5
SNIPPETS = (24, 96)  # bytes of the short views that each sampled text adds to training
SNIPPET_VIEWS = 2
CALIBRATION = 0.2
REJECT_SHARE = 0.0005
REJECT_MOST = 1.0  # the highest confidence there is: nothing caps the limit
VIEW_SIZES = (3, 8, 24, 48, 96, 192, 384, 768)  # bytes; a text goes by the largest that it has, a shorter one by the first
VIEWS = 4  # cuts of each size from each calibration text
TAIL = 0.05
SLICE_CELLS = 1 << 21
UNDETERMINED = "und"
LETTER = regex.compile(r"\p{L}")
UNSEEN_FOLD = 1  # crc32(doc_id) mod 3 of rows that are never learned from


def subwords(body: np.ndarray) -> list[np.ndarray]:
    """Rows of the embedding table for the runs of one, two and three bytes at each place of `body`."""
    low = LOWER[body].astype(np.uint32)
    two = low[:-1] << np.uint32(8) | low[1:]
    three = two[:-1] << np.uint32(8) | low[2:]
    half = np.uint32(18)
    return [low, 256 + (two * np.uint32(0x9E3779B1) >> half), 256 + (1 << 14) + (three * np.uint32(0x85EBCA6B) >> half)]


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # BUCKETS x languages: embeddings times the layer
    bias: np.ndarray
    temperature: float = 1.0
    limit: float = 0.0
    seen: np.ndarray | None = None  # familiarity of each row of the table
    limits: np.ndarray | None = None  # of familiarity, for each of VIEW_SIZES

    def means(self, table: np.ndarray, body: np.ndarray, off: np.ndarray) -> np.ndarray:
        """The mean row of `table` over the subwords of each text."""
        n, k = len(off) - 1, table.shape[1]
        out = np.zeros((n, k))
        for i, j in slices(off, max(1 << 16, SLICE_CELLS // k)):
            part, at = body[off[i] : off[j]], off[i : j + 1] - off[i]
            total, count = np.zeros((j - i, k)), np.zeros(j - i)
            for order, rows in enumerate(subwords(part), 1):
                used = np.flatnonzero(np.diff(at) >= order)
                if not len(used):
                    continue
                start, stop = at[used], at[used + 1] - order + 1
                sums = np.add.reduceat(np.concatenate([table[rows], np.zeros((1, k), np.float32)]),
                                       np.stack([start, stop], 1).ravel(), axis=0, dtype=np.float64)[::2]
                total[used] += sums
                count[used] += stop - start
            out[i:j] += total / np.maximum(count, 1)[:, None]
        return out

    def logits(self, body: np.ndarray, off: np.ndarray) -> np.ndarray:
        """One row per text."""
        return self.means(self.table, body, off) + self.bias

    def probabilities(self, body: np.ndarray, off: np.ndarray) -> np.ndarray:
        return softmax(self.logits(body, off) / self.temperature)

    def judged(self, body: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shares of the languages, and whether both limits let each text pass."""
        both = self.means(np.column_stack([self.table, self.seen]), body, off)
        p = softmax((both[:, :-1] + self.bias) / self.temperature)
        size = np.maximum(np.searchsorted(VIEW_SIZES, np.diff(off), "right") - 1, 0)
        return p, (p.max(1) >= self.limit) & (both[:, -1] >= self.limits[size])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _counted(body: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of a text and their shares."""
    row, count = np.unique(np.concatenate(subwords(body)) if len(body) > 2 else LOWER[body].astype(np.uint32), return_counts=True)
    return row.astype(np.int64), (count / count.sum()).astype(np.float32)


def fit(texts: list[bytes], labels: list[str], seed: int = 7) -> Model:
    """Train and calibrate on a sample that fits in memory."""
    languages = sorted(set(labels))
    rng = np.random.default_rng(seed)
    target = np.searchsorted(languages, labels)
    held = rng.random(len(texts)) < CALIBRATION
    rows, shares, goal = [], [], []
    for k in np.flatnonzero(~held):
        body = np.frombuffer(texts[k], np.uint8)
        views = [body]
        for _ in range(SNIPPET_VIEWS):
            size = int(rng.integers(*SNIPPETS))
            if len(body) > size:
                at = int(rng.integers(0, len(body) - size))
                views.append(body[at : at + size])
        for v in views:
            r, s = _counted(v)
            rows.append(r)
            shares.append(s)
            goal.append(target[k])
    goal = np.array(goal, np.int64)
    k = len(languages)
    table = rng.normal(0, 0.1, (BUCKETS, DIMENSION)).astype(np.float32)
    layer = np.zeros((DIMENSION, k), np.float32)
    layer += rng.normal(0, 0.1, layer.shape).astype(np.float32)
    bias = np.zeros(k, np.float32)
    steps = EPOCHS * max(1, -(-len(rows) // BATCH))
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), BATCH):
            pick = order[i : i + BATCH]
            size = [len(rows[p]) for p in pick]
            row, share = np.concatenate([rows[p] for p in pick]), np.concatenate([shares[p] for p in pick])
            starts = np.concatenate([[0], np.cumsum(size)[:-1]])
            hidden = np.add.reduceat(table[row] * share[:, None], starts, axis=0)
            error = softmax(hidden @ layer + bias)
            error[np.arange(len(pick)), goal[pick]] -= 1
            rate = RATE * (1 - step / steps)
            back = error @ layer.T
            layer -= rate * hidden.T @ error / len(pick) * 4
            bias -= rate * error.mean(0)
            np.add.at(table, row, -rate * 4 * share[:, None] * np.repeat(back, size, axis=0))
            step += 1
    learnt = np.flatnonzero(~held)
    seen = familiarity([texts[i] for i in learnt], target[learnt], len(languages))
    model = Model(languages, (table @ layer).astype(np.float32), bias, seen=seen, limits=np.full(len(VIEW_SIZES), -np.inf))
    if held.any():
        calibrate(model, [texts[i] for i in np.flatnonzero(held)], target[held])
    return model


def familiarity(texts: list[bytes], target: np.ndarray, languages: int) -> np.ndarray:
    """For each row of the table the logarithm of its share, with equal weight of the languages, over that of chance."""
    counts = np.zeros((languages, BUCKETS))
    for text, k in zip(texts, target, strict=True):
        for rows in subwords(np.frombuffer(text, np.uint8)):
            counts[k] += np.bincount(rows, minlength=BUCKETS)
    weight = counts.sum() / languages / np.maximum(counts.sum(1), 1)
    total = (counts * weight[:, None]).sum(0) + 0.5
    out = np.empty(BUCKETS, np.float32)
    for a, b in ((0, 256), (256, 256 + (1 << 14)), (256 + (1 << 14), BUCKETS)):
        out[a:b] = np.log(total[a:b] / total[a:b].mean())
    return out


def cuts(texts: list[bytes], target: np.ndarray, size: int, rng: np.random.Generator) -> tuple[list[bytes], np.ndarray]:
    """VIEWS cuts of `size` bytes, from the first byte of a letter on, of each text that is longer; and their targets."""
    out, goal = [], []
    for text, k in zip(texts, target, strict=True):
        for _ in range(VIEWS if len(text) > size else 0):
            at = int(rng.integers(0, len(text) - size + 1))
            while at > 0 and text[at] & 0xC0 == 0x80:
                at -= 1
            out.append(text[at : at + size])
            goal.append(k)
    return out, np.array(goal, np.int64)


def lowest(values: np.ndarray) -> float:
    """The value that REJECT_SHARE of such values fall below."""
    edge = np.quantile(values, TAIL)
    below = values[values < edge]
    tail = edge - (edge - below).mean() * np.log(TAIL / REJECT_SHARE) if len(below) else edge
    return float(min(tail, np.quantile(values, REJECT_SHARE)))


def calibrate(model: Model, texts: list[bytes], target: np.ndarray, seed: int = 11) -> None:
    """Set the temperature of least log loss and the limits of rejection."""
    column = lambda t: raw(pa.array(t, pa.large_binary()))
    logits = model.logits(*column(texts))
    place = np.arange(len(target))
    loss = lambda t: -np.log(np.maximum(softmax(logits / t)[place, target], 1e-12)).mean()
    model.temperature = float(min(np.geomspace(0.25, 4, 25), key=loss))
    rng = np.random.default_rng(seed)
    views = [(texts, target), *[cuts(texts, target, size, rng) for size in VIEW_SIZES]]
    right = []
    for part, goal in views:
        if part:
            found = model.probabilities(*column(part))
            right.append(found.max(1)[found.argmax(1) == goal])
    right = np.concatenate(right)
    model.limit = float(np.quantile(right, REJECT_SHARE)) if len(right) else 0.0
    known = [model.means(model.seen[:, None], *column(part))[:, 0] if part else np.zeros(0) for part, _ in views]
    for i, values in enumerate(known[1:]):
        whole = known[0][np.array([len(t) for t in texts]) >= VIEW_SIZES[i]] if i == len(VIEW_SIZES) - 1 else np.zeros(0)
        values = np.concatenate([values, whole])
        model.limits[i] = lowest(values) if len(values) else -np.inf
    model.limits = np.maximum.accumulate(model.limits)  # the mean of more subwords varies less


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == UNSEEN_FOLD, F.lit(False))


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """A model from at most about `per_language` labelled rows of each language outside the held-out fold."""
    fold = F.crc32(F.col("doc_id").cast("string")) % 3 != UNSEEN_FOLD
    known = docs.filter(fold & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["count"] for r in docs.filter(fold & F.col("lang").isNotNull()).groupBy("lang").count().collect()}
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(per_language / n)).otherwise(share)
    sample = known.filter(hash_uniform("language sample", F.col("doc_id")) < share).select("doc_id", "lang", F.encode("text", "utf-8").alias("text"))
    rows = sorted(sample.collect(), key=lambda r: (r["doc_id"], bytes(r["text"])))
    return fit([bytes(r["text"]) for r in rows], [r["lang"] for r in rows]) if rows else None


def _decide(model: Model | None, col: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, confidence and whether the text is accepted; without a model no language is told, and any text with a letter accepted."""
    n = len(col)
    letters = np.array([LETTER.search(t.as_py()) is not None for t in col], bool)
    if model is None or not n:
        return [UNDETERMINED] * n, np.zeros(n), letters
    p, passed = model.judged(*raw(col))
    best = p.argmax(1)
    score = np.where(letters, p[np.arange(n), best], 0.0)
    names = [model.languages[b] if ok else UNDETERMINED for b, ok in zip(best, letters, strict=True)]
    return names, score, letters & passed


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, accepted of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, score, ok = _decide(shared.value, text_column(b, "text"))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(ok)],
                names=["doc_id", "held_out", "lang_pred", "score", "accepted"])

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, accepted boolean")


def accepted(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of `docs`, all columns, whose text the model doesn't reject."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(_decide(shared.value, text_column(b, "text"))[2]))

    return docs.mapInArrow(run, docs.schema)
