"""Quartile bucket digests of texts.

The byte triplets (1,2,3), (1,2,4) and (1,3,4) of each run of four bytes are hashed into 128 buckets.  A digest holds for each
bucket the quartile of its count (two bits), the logarithm of the length, and the ratios of the quartiles.  The difference of
two digests adds 1, 2 or 6 for buckets that are 1, 2 or 3 quartiles apart, and the differences of length and ratios; it is
bounded by UNLIKE, the mean difference of unrelated codes, and likeness is 1 minus its share of that bound.

Defined cases: a null text is empty; texts of under three bytes have no triplets, so they differ by length alone; equal
texts have equal digests; rows of equal doc_id are in order of their text, and null doc_ids come last; in a table of one
row the next document is the row itself; other columns are ignored.  Rows that share doc_id and the first PREFIX characters are one task's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.ordering import running_total
from larder.llm import ranges
from larder.llm.words import SLICE_BYTES, mix, raw, slices
from larder.session import materialize

BUCKETS = 128
UNLIKE = 208
DIGEST_BYTES = 2 + BUCKETS // 4
_SEED = mix(np.arange(1, 3 * 3 * 256 + 1, dtype=np.uint64)).astype(np.uint32).reshape(3, 3, 256)
TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 3))
_LENGTH_STEP = np.log(1.1)


def digests(body: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of bytes per text."""
    n = len(off) - 1
    out = np.zeros((n, DIGEST_BYTES), np.uint8)
    for i, j in slices(off, SLICE_BYTES):
        out[i:j] = _digests(body[off[i] : off[j]], off[i : j + 1] - off[i])
    return out


def _digests(body: np.ndarray, off: np.ndarray) -> np.ndarray:
    n, length = len(off) - 1, np.diff(off)
    text = np.repeat(np.arange(n, dtype=np.int32), length)
    count = np.zeros(n * BUCKETS, np.int64)
    for k, (a, b, c) in enumerate(TRIPLETS):
        if len(body) <= c:
            continue
        size = len(body) - c
        h = _SEED[k, 0][body[a : a + size]] + _SEED[k, 1][body[b : b + size]] ^ _SEED[k, 2][body[c : c + size]]
        h *= np.uint32(0x9E3779B1)
        code = (h >> np.uint32(25)).astype(np.int32) + text[:size] * BUCKETS
        count += np.bincount(code[text[:size] == text[c:]], minlength=n * BUCKETS)
    count = count.reshape(n, BUCKETS)
    ordered = np.sort(count, axis=1)
    q1, q2, q3 = (ordered[:, BUCKETS * q // 4 - 1] for q in (1, 2, 3))
    code = ((count > q1[:, None]).astype(np.uint8) + (count > q2[:, None]) + (count > q3[:, None])).astype(np.uint8)
    out = np.empty((n, DIGEST_BYTES), np.uint8)
    out[:, 0] = np.minimum(255, np.log(np.maximum(length, 1)) / _LENGTH_STEP)
    over = np.maximum(q3, 1)
    out[:, 1] = (np.minimum(15, q1 * 16 // over) * 16 + np.minimum(15, q2 * 16 // over)).astype(np.uint8)
    four = code.reshape(n, -1, 4)
    out[:, 2:] = four[:, :, 0] | four[:, :, 1] << 2 | four[:, :, 2] << 4 | four[:, :, 3] << 6
    return out


_APART = np.array([0, 1, 2, 6])
_CODES = np.array([[b >> s & 3 for s in (0, 2, 4, 6)] for b in range(256)])


def difference(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """0 to UNLIKE for each pair of rows."""
    out = np.zeros(len(x), np.int64)
    for i in range(0, len(x), 1 << 14):
        a, b = x[i : i + (1 << 14)], y[i : i + (1 << 14)]
        d = _APART[np.abs(_CODES[a[:, 2:]] - _CODES[b[:, 2:]])].sum((1, 2))
        d += np.abs(a[:, 0].astype(int) - b[:, 0])
        d += np.abs((a[:, 1] >> 4).astype(int) - (b[:, 1] >> 4)) + np.abs((a[:, 1] & 15).astype(int) - (b[:, 1] & 15))
        out[i : i + (1 << 14)] = d
    return np.minimum(out, UNLIKE)


def likeness(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return 1.0 - difference(x, y) / UNLIKE


def digests_of(texts: list[str]) -> np.ndarray:
    return digests(*raw(pa.array(texts, pa.large_string()))) if texts else np.zeros((0, DIGEST_BYTES), np.uint8)


def edited(text: str, after: str) -> str:
    """The last third replaced by as much of the next text."""
    k = len(text) // 3
    return text[: len(text) - k] + after[:k]


FIELDS = {"doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(),
          "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64()}
OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
#: A compared row, or the first or last row of a range with its text, which waits for its neighbour in another range.
EDGES = {"range": pa.int32(), "edge": pa.string(), "text": pa.large_string()}
PREFIX = 64  # rows of equal doc_id are dealt to ranges by so many characters of their texts


def _compared(ids: list, texts: list[str], after: list[str], marks: np.ndarray, marks_after: np.ndarray) -> Iterator[list[pa.Array]]:
    """The columns of FIELDS for rows and their next texts."""
    for i in range(0, len(ids), 512):
        part = slice(i, i + 512)
        changed = [edited(t, u) for t, u in zip(texts[part], after[part], strict=True)]
        new = digests_of(changed)
        yield [pa.array(v, t) for v, t in zip((
            ids[part], [len(t) for t in texts[part]], [hashlib.sha256(t.encode()).hexdigest() for t in changed],
            [m.tobytes().hex() for m in marks[part]], [m.tobytes().hex() for m in new],
            likeness(marks[part], new), likeness(marks[part], marks_after[part]),
        ), FIELDS.values(), strict=True)]


def _compare_in_ranges(docs: DataFrame) -> DataFrame:
    """The written table of all rows that meet their next one in their own range, and of the rows at the ranges' edges."""
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    order = F.desc_nulls_last("doc_id")
    placed = rows.repartitionByRange(ranges.bucket_count(docs), order, F.substring("text", 1, PREFIX)).sortWithinPartitions(order, "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = TaskContext.get().partitionId(), None  # held: the row before, whose next one is not seen yet
        names = [*FIELDS, *EDGES]

        def edge(kind: str, doc_id: int | None, text: str) -> pa.RecordBatch:
            nulls = [pa.nulls(1, t) for k, t in FIELDS.items() if k != "doc_id"]
            columns = [pa.array([v], t) for v, t in zip((at, kind, text), EDGES.values(), strict=True)]
            return pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), *nulls, *columns], names=names)

        for batch in batches:
            ids, texts = (c.to_pylist() for c in batch.columns)
            if not ids:
                continue
            marks = digests_of(texts)
            if held is None:
                yield edge("first", ids[0], texts[0])
            else:
                ids, texts, marks = [held[0], *ids], [held[1], *texts], np.concatenate([held[2][None], marks])
            held = ids[-1], texts[-1], marks[-1]
            for columns in _compared(ids[:-1], texts[:-1], texts[1:], marks[:-1], marks[1:]):
                yield pa.RecordBatch.from_arrays([*columns, *(pa.nulls(len(columns[0]), t) for t in EDGES.values())], names=names)
        if held is not None:
            yield edge("last", held[0], held[1])

    return materialize(placed.mapInArrow(compare, f"{OUT}, range int, edge string, text string"))


def _compare_edges(edges: DataFrame) -> DataFrame:
    """The last row of each range against the first one of the next range that has rows; the first range follows the last one."""
    firsts = edges.filter("edge = 'first'")
    numbers = materialize(running_total(firsts.select("range"), [F.col("range")], F.lit(1), "number"))
    count = max(1, numbers.count())
    lasts = edges.filter("edge = 'last'").join(numbers, "range").select("number", "doc_id", "text")
    nexts = firsts.join(numbers, "range").select(F.pmod(F.col("number") - 1, F.lit(count)).alias("number"), F.col("text").alias("after"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, after = (c.to_pylist() for c in batch.columns)
            for columns in _compared(ids, texts, after, digests_of(texts), digests_of(after)):
                yield pa.RecordBatch.from_arrays(columns, names=list(FIELDS))

    return lasts.join(nexts, "number").select("doc_id", "text", "after").mapInArrow(compare, OUT)


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likeness, in descending order of doc_id.

    Texts are shuffled once, by Spark's range exchange.  Two rows a range, its first and its last, are joined by the ranges' running numbers.
    """
    table = _compare_in_ranges(docs)
    return table.filter("edge IS NULL").select(*FIELDS).unionByName(_compare_edges(table.filter("edge IS NOT NULL")))
