"""Alignment of two tokenizers' ids by the byte offsets at which tokens of both end.

Both read a space and the text: A a byte-level BPE (tokenizers library), B a BPE with byte fallback (sentencepiece), which adds
that space itself.  Common ends cut a text's tokens into groups; every A-B pair of tokens in a group is a link.

*Galloping intersection.*  A text's shorter list of ends drives: each of its entries starts at the place that its rank suggests
in the longer list, doubles its step until the entry is passed, and then halves the bracket.  Entries of all texts of a slice take
their steps together.  Indices of common ends slice the groups, and differences of their ranks are the groups' sizes.

*Counts.*  An id pair's count is the number of documents that hold it linked.  Tasks write chunks of about `CHUNK_BYTES` of text: the chunk's
distinct pairs with its own document counts, and for each document which of them it links how often.  Only the
chunks' distinct pairs are shuffled and added up, and the sums come back to the chunks: a chunk asks once for a pair,
however many of its documents link it.  The highest count of an A id is one of at most 65,536 rows.

*Pieces.*  Texts are cut before a space or line feed that follows something else than white space: neither
tokenizer joins anything over such a place.  A worker encodes a distinct piece once and gathers the ids of texts by numpy.

Defined cases: texts that are null, empty, or not given back by both tokenizers byte by byte (as with U+2581) have no tokens and zeros;
equal rows are documents of their own in the counts; groups of many tokens are counted by distinct ids, not spelt out; a
text longer than a chunk is a chunk; null doc_ids stay null; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.words import U64, Words, raw, slices, text_column
from larder.session import materialize

CHUNK_BYTES = 8 << 20
KNOWN_PIECES = 1 << 20
BATCH = 4096
BITS_B = 15  # B's ids are below 2**15 and A's below 2**16, so that a pair is a positive int
SPELT_OUT = 1 << 10  # links of the largest group whose pairs are listed
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
# The last two bytes of white space beyond ASCII, and of some other characters: no cut after them.
BEFORE_LAST = np.isin(np.arange(256), [0xC2, 0x80, 0x81, 0x9A, 0xA0])
LAST = np.isin(np.arange(256), [*range(0x80, 0x90), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF])

CHUNK = ("chunk long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups array<string>, "
         "pair array<int>, docs array<int>, width array<long>, linked binary")
OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def byte_alphabet() -> dict[str, int]:
    """The character that stands for a byte in byte-level vocabularies: itself if printable, else one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def pieces_of(body: np.ndarray, off: np.ndarray) -> Words:
    """The texts, all of which begin with a space, cut before spaces and line feeds that begin a run of white space."""
    cut = np.zeros(len(body), bool)
    odd = np.zeros(len(body), bool)
    odd[1:] = BEFORE_LAST[body[:-1]] & LAST[body[1:]]
    cut[1:] = ((body[1:] == 32) | (body[1:] == 10)) & ~WHITE[body[:-1]] & ~odd[:-1]
    return Words(body, off, np.ones(len(body), bool), cut)


@lru_cache(maxsize=1)
def shared_encoders(path_a: str, path_b: str) -> Encoders:
    return Encoders(path_a, path_b)


class Encoders:
    """Both tokenizers of a worker, with the ids of the pieces they have seen."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings are ordinary text
        self.b = SentencePieceProcessor(model_file=path_b)
        alphabet = byte_alphabet()
        vocabulary = self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        self.space = self.b.piece_to_id("▁")
        self.size_a, self.size_b = (np.array([len(t) for t in table], np.int64) for table in (self.bytes_a, self.bytes_b))
        if len(self.size_b) > 1 << BITS_B or len(self.size_a) > 1 << (31 - BITS_B):
            raise ValueError("a vocabulary is too large for pairs of 31 bits")
        # Decimal ids with what may follow them in a list of groups.
        self.shown = [f"{i}{mark}".encode() for i in range(max(len(self.size_a), len(self.size_b))) for mark in (",", "|", ";", "")]
        self._forget()

    def _forget(self) -> None:
        self.key = np.zeros(0, U64)
        self.place = [[np.zeros(0, np.int64), np.zeros(0, np.int64)] for _ in "ab"]  # start in the pool, count
        self.pool = [np.zeros(0, np.int32) for _ in "ab"]
        self.whole = np.zeros(0, bool)  # B gives the piece's bytes back (A always does)

    def _alone(self, piece: list[bytes]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids by A and by B of each piece."""
        text = [p.decode() for p in piece]
        a = [e.ids for e in self.a.encode_batch(text, add_special_tokens=False)]
        # B adds a space: a piece's own first space is left to it, and before a line feed the added one is a token by itself.
        b = self.b.encode([t[1:] if t[0] == " " else t for t in text], num_threads=1)
        return a, [ids[1:] if t[0] != " " else ids or [self.space] for t, ids in zip(text, b, strict=True)]

    def _in_a_row(self, piece: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]] | None:
        """Ids by A and by B and their counts for pieces that are cut in each other's company as well; None if B changes a byte."""
        text = (b" a" + b"".join(piece)).decode()
        ids = [np.array(self.a.encode(text, add_special_tokens=False).ids, np.int32), np.array(self.b.encode(text[1:]), np.int32)]
        if b"".join([self.bytes_b[i] for i in ids[1].tolist()]) != text.encode():
            return None
        stop = np.cumsum([2, *map(len, piece)])
        counts = [np.diff(np.searchsorted(np.cumsum(size[i]), stop, "right")) for size, i in zip((self.size_a, self.size_b), ids, strict=True)]
        return [i[len(i) - int(c.sum()) :] for i, c in zip(ids, counts, strict=True)], counts

    def _learn(self, pieces: Words, key: np.ndarray, place: np.ndarray) -> None:
        """Encode those of the sorted keys that are new; place: a piece of each."""
        at = np.searchsorted(self.key, key)
        new = at == len(self.key)
        new[~new] = self.key[at[~new]] != key[~new]
        if not new.any():
            return
        data, body = pieces.body.tobytes(), pieces.body
        start, end = pieces.start[place[new]], pieces.end[place[new]]
        # A piece that ends a text with white space is not cut like that inside one.
        odd = WHITE[body[end - 1]] | (BEFORE_LAST[body[np.maximum(end - 2, 0)]] & LAST[body[end - 1]])
        counts, ids, given = [np.zeros((2, 0), np.int64)], [[], []], np.ones(len(start), bool)
        plain, rest = np.flatnonzero(~odd), np.flatnonzero(odd)
        parts = [plain[i : i + BATCH] for i in range(0, len(plain), BATCH)] + [rest] * (len(rest) > 0)
        for part in parts:
            piece = [data[s:e] for s, e in zip(start[part].tolist(), end[part].tolist(), strict=True)]
            row = None if part is rest else self._in_a_row(piece)
            if row is None:
                lists = self._alone(piece)
                given[part] = [b"".join([self.bytes_b[i] for i in x]) == p for p, x in zip(piece, lists[1], strict=True)]
                row = [np.array([i for x in k for i in x], np.int32) for k in lists], [[len(x) for x in k] for k in lists]
            for k in (0, 1):
                ids[k].append(row[0][k])
            counts.append(np.array(row[1], np.int64))
        count = np.concatenate(counts, axis=1)
        back = np.argsort(np.concatenate(parts))
        for k in (0, 1):
            begin = np.cumsum(count[k]) - count[k] + len(self.pool[k])
            self.pool[k] = np.concatenate([self.pool[k], *ids[k]])
            self.place[k] = [np.insert(old, at[new], add[back]) for old, add in zip(self.place[k], (begin, count[k]), strict=True)]
        self.key = np.insert(self.key, at[new], key[new])
        self.whole = np.insert(self.whole, at[new], given)

    def ids(self, body: np.ndarray, off: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For A and for B: the ids of all texts in a row and the count of each text; none where the bytes differ."""
        if len(self.key) > KNOWN_PIECES or max(map(len, self.pool)) > 1 << 25:
            self._forget()
        n = len(off) - 1
        length = np.diff(off)
        begin = off + np.arange(n + 1)  # a space before each text
        spaced = np.full(int(begin[-1]), 32, np.uint8)
        spaced[np.arange(len(body)) + np.repeat(np.arange(1, n + 1), length)] = body
        pieces = pieces_of(spaced, begin)
        key, place, back = np.unique(pieces.hashes(), return_index=True, return_inverse=True)
        self._learn(pieces, key, place)
        at = np.searchsorted(self.key, key)[back]
        text = pieces.text_of()
        lost = np.bincount(text, weights=~self.whole[at], minlength=n) > 0
        kept = ~(lost | (length == 0))[text]
        at, text = at[kept], text[kept]
        out = []
        for k in (0, 1):
            start, count = (x[at] for x in self.place[k])
            first = np.cumsum(count) - count
            flat = self.pool[k][np.repeat(start - first, count) + np.arange(int(count.sum()))]
            out.append((flat, np.bincount(text, weights=count, minlength=n).astype(np.int64)))
        return out


def gallop(ends: np.ndarray, wanted: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each wanted value the place of the first of the ascending ends that is not below it, sought from `start` on."""
    low, high = np.full(len(wanted), -1), np.full(len(wanted), len(ends))
    for up in (True, False):
        step, at = 1, np.flatnonzero((ends[start] < wanted) == up)
        (low if up else high)[at] = start[at]
        while len(at):  # double the step until the value is passed
            probe = start[at] + (step if up else -step)
            inside = (probe < len(ends)) & (probe >= 0)
            at, probe = at[inside], probe[inside]
            below = ends[probe] < wanted[at]
            low[at[below]], high[at[~below]] = probe[below], probe[~below]
            at = at[below == up]
            step *= 2
    at = np.flatnonzero(high - low > 1)
    while len(at):  # halve the bracket
        middle = (low[at] + high[at]) // 2
        below = ends[middle] < wanted[at]
        low[at[below]], high[at[~below]] = middle[below], middle[~below]
        at = at[high[at] - low[at] > 1]
    return high


def common_ends(ends: list[np.ndarray], counts: list[np.ndarray]) -> list[np.ndarray]:
    """The places, in A's and in B's ends, of the values that both have.

    Ends ascend over the texts of a slice, `counts` of them in each text, and a text's last ends are equal.
    """
    first = [np.cumsum(c) - c for c in counts]
    text = [np.repeat(np.arange(len(c)), c) for c in counts]
    met = [[], []]
    for short, long in ((0, 1), (1, 0)):
        drives = counts[short] <= counts[long] if short == 0 else counts[short] < counts[long]
        driver = np.flatnonzero(drives[text[short]])
        t = text[short][driver]
        rank = driver - first[short][t]
        found = gallop(ends[long], ends[short][driver], first[long][t] + rank * counts[long][t] // counts[short][t])
        same = ends[long][found] == ends[short][driver]
        met[short].append(driver[same])
        met[long].append(found[same])
    return [np.sort(np.concatenate(m)) for m in met]


def linked_pairs(ids: list[np.ndarray], start: list[np.ndarray], size: list[np.ndarray], text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text << 31 | pair, links) of each text's distinct id pairs; a group has `size` tokens from `start` on."""
    links = size[0] * size[1]
    few = np.flatnonzero(links <= SPELT_OUT)
    count = links[few]
    at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    width = np.repeat(size[1][few], count)
    a = ids[0][np.repeat(start[0][few], count) + at // width].astype(np.int64)
    b = ids[1][np.repeat(start[1][few], count) + at % width]
    key, times = np.unique(np.repeat(text[few] << 31, count) | a << BITS_B | b, return_counts=True)
    many = np.flatnonzero(links > SPELT_OUT)
    if not len(many):
        return key, times
    keys, weights = [key], [times]
    for g in many.tolist():
        (a, m), (b, n) = (np.unique(ids[k][start[k][g] : start[k][g] + size[k][g]], return_counts=True) for k in (0, 1))
        keys.append(((int(text[g]) << 31) + (a[:, None].astype(np.int64) << BITS_B) + b).ravel())
        weights.append((m[:, None] * n).ravel())
    key, back = np.unique(np.concatenate(keys), return_inverse=True)
    times = np.zeros(len(key), np.int64)
    np.add.at(times, back, np.concatenate(weights))
    return key, times


def group_digests(ids: list[np.ndarray], last: list[np.ndarray], group: list[np.ndarray], tokens: np.ndarray, groups: np.ndarray, shown: list[bytes]) -> list[str]:
    """The hash of each text's groups, `a1,a2|b1;a3|b2,b3`; '' without tokens.

    `last` and `group` tell for each token whether it ends its group, and which one it is in.
    """
    before = np.cumsum(np.bincount(group[1], minlength=len(groups))) if len(groups) else np.zeros(0, np.int64)
    through = np.cumsum(np.bincount(group[0], minlength=len(groups))) if len(groups) else before
    before = np.concatenate([[0], before[:-1]]) if len(groups) else before
    mark = np.empty(len(ids[0]) + len(ids[1]), np.int64)
    final = np.append(np.diff(groups) > 0, True)  # the group is its text's last one
    mark[np.arange(len(ids[0])) + before[group[0]]] = ids[0] * 4 + last[0]
    mark[np.arange(len(ids[1])) + through[group[1]]] = ids[1] * 4 + np.where(last[1], np.where(final[group[1]], 3, 2), 0)
    end = np.cumsum(tokens)
    codes, take = mark.tolist(), shown.__getitem__
    return [hashlib.sha256(b"".join(map(take, codes[e - n : e]))).hexdigest() if n else "" for e, n in zip(end.tolist(), tokens.tolist(), strict=True)]


def aligned(encoders: Encoders, body: np.ndarray, off: np.ndarray) -> tuple[list[np.ndarray], list[str], np.ndarray, np.ndarray]:
    """([n_a, n_b, n_groups, n_links] and digests of the texts of a slice, keys and links of `linked_pairs`)."""
    n = len(off) - 1
    (a, count_a), (b, count_b) = encoders.ids(body, off)
    ids, counts = [a, b], [count_a, count_b]
    ends = [np.cumsum(size[i]) for size, i in zip((encoders.size_a, encoders.size_b), ids, strict=True)]
    cuts = common_ends(ends, counts)
    size = [np.diff(c, prepend=-1) for c in cuts]
    start = [c - s + 1 for c, s in zip(cuts, size, strict=True)]
    text = np.repeat(np.arange(n), count_a)[cuts[0]]
    key, times = linked_pairs(ids, start, size, text)
    group = [np.repeat(np.arange(len(text)), s) for s in size]
    last = [np.zeros(len(i), bool) for i in ids]
    for mark, c in zip(last, cuts, strict=True):
        mark[c] = True
    digests = group_digests(ids, last, group, count_a + count_b, text, encoders.shown)
    n_links = np.zeros(n, np.int64)
    np.add.at(n_links, text, size[0] * size[1])
    return [count_a, count_b, np.bincount(text, minlength=n), n_links], digests, key, times


def chunks(docs: DataFrame, path_a: str, path_b: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The written table of chunks: figures of the documents, the chunk's pairs, and which of them each document links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders, held, size, name = shared_encoders(path_a, path_b), [], 0, TaskContext.get().partitionId() << 33

        def flush() -> pa.RecordBatch:
            nonlocal held, size, name
            pair, back, docs = np.unique(np.concatenate([h[3] for h in held]), return_inverse=True, return_counts=True)
            linked = np.concatenate([back.astype("<i4"), np.concatenate([h[4] for h in held]).astype("<i4")]).reshape(2, -1)
            linked[0, 1:] = np.diff(linked[0])  # pairs ascend in a document, so that differences are mostly small
            row = [[name], [[d for h in held for d in h[0]]], *[[np.concatenate([h[1][k] for h in held])] for k in range(4)],
                   [[t for h in held for t in h[2]]], [pair], [docs], [np.concatenate([h[5] for h in held])],
                   [pa.compress(linked.tobytes(), codec="zstd", asbytes=True)]]
            held, size, name = [], 0, name + 1
            lists = [pa.list_(t) for t in (pa.int64(), *[pa.int64()] * 4, pa.string(), pa.int32(), pa.int32(), pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, (pa.int64(), *lists, pa.binary()), strict=True)],
                                              names=[c.split()[0] for c in CHUNK.split(", ")])

        for batch in batches:
            doc_id = batch.column(0).to_pylist()
            body, off = raw(text_column(batch, "text"))
            for i, j in slices(off):
                figures, digests, key, times = aligned(encoders, body[off[i] : off[j]], off[i : j + 1] - off[i])
                width = np.bincount(key >> 31, minlength=j - i)
                held.append((doc_id[i:j], figures, digests, (key & ((1 << 31) - 1)).astype(np.int32), times, width))
                size += int(off[j] - off[i]) + 64 * (j - i)
                if size >= chunk_bytes:
                    yield flush()
        if held:
            yield flush()

    return materialize(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, CHUNK))


def pair_counts(held: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(chunk, pair) of every chunk's distinct pairs, and pair, count, best: the documents with the pair, and whether its A id has none with more."""
    asked = held.select("chunk", F.inline(F.arrays_zip("pair", "docs"))).repartition("pair")
    counted = asked.groupBy("pair").agg(F.sum("docs").alias("count")).withColumn("a", F.shiftright("pair", BITS_B))
    highest = counted.groupBy("a").agg(F.max("count").alias("highest"))  # a row an id of A, at most 65,536
    return asked.select("chunk", "pair"), counted.join(F.broadcast(highest), "a").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def align(docs: DataFrame, path_a: str, path_b: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    held = chunks(docs, path_a, path_b, chunk_bytes)
    asked, counted = pair_counts(held)
    answers = asked.join(counted, "pair").select(F.col("chunk").alias("asker"), "pair", "count", "best")

    def score(chunk: pa.Table, found: pa.Table) -> pa.Table:
        order = np.argsort(np.asarray(found["pair"]))
        count, best = (np.asarray(found[c])[order].astype(np.int64) for c in ("count", "best"))
        row = {c: chunk[c][0].as_py() if c in ("chunk", "linked") else chunk[c].combine_chunks().flatten() for c in chunk.column_names}
        width = np.asarray(row["width"])
        total = int(width.sum())
        linked = np.frombuffer(pa.decompress(row["linked"], 8 * total, codec="zstd"), "<i4").reshape(2, -1)
        pair, times = np.cumsum(linked[0], dtype=np.int64), linked[1].astype(np.int64)
        stop = np.cumsum(width)
        sums = []
        for value in (best, count):
            run = np.concatenate([[0], np.cumsum(value[pair] * times)])
            sums.append(run[stop] - run[stop - width])
        return pa.table([row["doc_id"], *[row[c] for c in ("n_a", "n_b", "n_groups", "n_links")], pa.array(sums[0]), pa.array(sums[1]), row["groups"]],
                        names=[c.split()[0] for c in OUT.split(", ")])

    return held.groupBy("chunk").cogroup(answers.groupBy("asker")).applyInArrow(score, OUT)
