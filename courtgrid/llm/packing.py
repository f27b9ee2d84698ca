"""Packing token sequences by order-preserving dynamic programming.

Documents keep their order; their tokens form one stream, which is cut into
windows of at most ``size`` tokens.  A cut may stand at a document's end (free),
after a sentence (``SENTENCE_PENALTY``), or anywhere else (``TOKEN_PENALTY``,
offered only where no boundary lies within reach).  The cuts minimise padding
plus penalties:

    best[j] = penalty[j] + size - at[j] + min(best[i] + at[i])   over at[j] - at[i] <= size

whose minimum over a sliding window is kept in a monotone queue, so the work is
linear in the boundaries.  A task packs its rows in runs of ``RUN_TOKENS``
tokens and carries the last, open window into the next run, so its memory is
bounded whatever its partition holds; only a task's last sequence may be short.
"""

from __future__ import annotations

import os
import zlib
from collections import deque
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import slices

SIZE = 2048
SENTENCE_PENALTY = 8
TOKEN_PENALTY = 16
RUN_TOKENS = 1 << 20
MEMO_CHUNKS = 800_000  # chunks of each of the two ages whose ids a worker keeps (a cache, never a limit on texts)
LONG_CHUNK = 48


class ChunkEncoder:
    """Ids of texts under a word-level BPE file, by way of their space-separated chunks.

    The vocabulary drops white space and ends each word with a piece that has a
    word-end mark, so a text's ids are its chunks' ids one after another.  New
    chunks are encoded together in one call and told apart by the marks.  Texts
    in which that does not hold (special strings, control characters that only
    Python takes for space) go to the tokenizer whole.
    """

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(file)
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.stop_ids = np.zeros(len(self._ends), bool)
        self.stop_ids[[i for t, i in vocabulary.items()
                       if t.endswith("</w>") and t[:-4].rstrip('"\')')[-1:] in (".", "!", "?")]] = True
        # the tokenizer's own split of a text into words (fixed value)
        self._word = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        # fixed values: special strings of the file, and characters that only Python takes for space
        self._odd = ("<|startoftext|>", "<|endoftext|>", "\x1c", "\x1d", "\x1e", "\x1f")
        self._memo: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}  # what was known before the memo was begun anew

    def _whole(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk; all are encoded in a few calls and told apart by the word ends."""
        import unicodedata

        out: list[bytes] = []
        for at in range(0, len(chunks), 400):
            part = chunks[at:at + 400]
            words = [1 if c.lower().isalpha() else len(self._word.findall(unicodedata.normalize("NFC", c).lower())) for c in part]
            ids = np.array(self._tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.int64)
            ends = np.flatnonzero(self._ends[ids]) + 1
            if len(ends) != sum(words):
                out.extend(map(self._whole, part))
                continue
            cuts = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(words)))].tolist()
            raw = ids.astype("<u4").tobytes()
            out.extend([raw[4 * a:4 * b] for a, b in zip(cuts, cuts[1:], strict=False)])
        return out

    def _learn_all(self, missing: list[str]) -> None:
        """Remember the ids of new chunks; a full stop or comma after a letter is a word of its own."""
        memo, tails = self._memo, {c: self._whole(c) for c in ".,"}
        tailed = [c for c in missing if c[-1] in tails and c[-2:-1].lower().isalpha()]
        apart = set(tailed)
        plain = list({c[:-1] for c in tailed if c[:-1] not in memo}.union(c for c in missing if c not in apart))
        memo.update(zip(plain, self._learn(plain), strict=True))
        for c in tailed:
            memo[c] = memo[c[:-1]] + tails[c[-1]]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        # the tokenizer lower-cases; doing so for A-Z beforehand changes nothing and leaves fewer chunks
        split = [None if any(x in t for x in self._odd) else t.encode().lower().decode().split() for t in texts]
        chunks = set(chain.from_iterable(x for x in split if x))
        missing: set[str] | list[str] = chunks.difference(self._memo)
        if missing:
            if len(self._memo) + len(missing) > MEMO_CHUNKS:  # chunks not met for a whole age are forgotten
                self._older, self._memo, missing = self._memo, {}, chunks
            known = missing.intersection(self._older)
            self._memo.update(zip(known, map(self._older.__getitem__, known), strict=True))
            missing = list(missing.difference(known))
            self._learn_all(missing)
        ids = self._memo.__getitem__
        out = [self._whole(t) if x is None else b"".join(map(ids, x)) for t, x in zip(texts, split, strict=True)]
        for c in missing:
            if len(c) > LONG_CHUNK:
                self._memo.pop(c, None)
                self._memo.pop(c[:-1], None)
        return out


def boundaries(ids: list[np.ndarray], stops: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Cut places of a run of documents (offsets in their stream) and their penalties.

    Document ends and sentence ends; in stretches of over ``size // 32`` tokens
    without one, also every ``size // 128``-th place as a plain cut, so that a cut
    is always in reach.
    """
    places, costs, base = [], [], 0
    for x in ids:
        ends = np.flatnonzero(stops[x]) + 1
        ends = ends[ends < len(x)]
        at = np.append(ends, len(x)) + base
        cost = np.full(len(at), SENTENCE_PENALTY)
        cost[-1] = 0
        places.append(at)
        costs.append(cost)
        base += len(x)
    at, cost = np.concatenate(places), np.concatenate(costs)
    step = max(1, size // 128)
    far = np.flatnonzero(np.diff(np.concatenate(([0], at))) > max(1, size // 32))
    if len(far):
        before = np.concatenate(([0], at))
        extra = np.concatenate([np.arange(before[i] + step, at[i], step) for i in far])
        at, cost = np.concatenate((at, extra)), np.concatenate((cost, np.full(len(extra), TOKEN_PENALTY)))
        order = np.argsort(at, kind="stable")
        at, cost = at[order], cost[order]
    return at, cost


def best_cuts(at: list[int], penalty: list[int], size: int) -> list[int]:
    """The cheapest cut places, ending with the last of ``at``.

    ``at`` is ascending; neighbours (and 0 and the first) are at most ``size`` apart.
    """
    n = len(at)
    best, came = [0] * n, [-1] * n
    queue: deque[tuple[int, int, int]] = deque([(0, 0, -1)])  # (best + at, at, place), ascending in the first
    for j in range(n):
        here = at[j]
        while here - queue[0][1] > size:
            queue.popleft()
        low, _, came[j] = queue[0]
        best[j] = penalty[j] + size - here + low
        worth = best[j] + here
        while queue and queue[-1][0] >= worth:
            queue.pop()
        queue.append((worth, here, j))
    cuts, j = [], n - 1
    while j >= 0:
        cuts.append(at[j])
        j = came[j]
    return cuts[::-1]


PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Packer:
    """Packs the documents of one task; ``add`` and ``close`` return finished pieces."""

    def __init__(self, first_sequence: int, stops: np.ndarray, size: int = SIZE):
        self._stops, self._size, self._sequence = stops, size, first_sequence
        self._held: list[tuple] = []  # (key, ids, start, doc_tokens) of the stream from the last cut on
        self._tokens = 0

    def add(self, key, ids: np.ndarray) -> list[tuple]:
        self._held.append((key, ids, 0, len(ids)))
        self._tokens += len(ids)
        return self._flush(False) if self._tokens >= RUN_TOKENS else []

    def close(self) -> list[tuple]:
        return self._flush(True) if self._held else []

    def _flush(self, last: bool) -> list[tuple]:
        at, penalty = boundaries([x for _, x, _, _ in self._held], self._stops, self._size)
        cuts = best_cuts(at.tolist(), penalty.tolist(), self._size)
        if not last:
            cuts = cuts[:-1]  # the open window goes on with the next run
        out, rest, done = [], [], 0
        edges = [0, *cuts]
        k = 0
        for key, ids, start, total in self._held:
            end, at_doc = done + len(ids), done
            while at_doc < end:
                while k + 1 < len(edges) and edges[k + 1] <= at_doc:
                    k += 1
                if k + 1 >= len(edges):
                    rest.append((key, ids[at_doc - done:], start + at_doc - done, total))
                    break
                stop = min(end, edges[k + 1])
                piece = ids[at_doc - done:stop - done]
                out.append((key, start + at_doc - done, len(piece), zlib.crc32(piece.tobytes()), total,
                            self._sequence + k, at_doc - edges[k]))
                at_doc = stop
            done = end
        self._sequence += len(cuts)
        self._held, self._tokens = rest, sum(len(x) for _, x, _, _ in rest)
        return out


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(file: str) -> ChunkEncoder:
    """The worker's encoder for a tokenizer file (kept between tasks)."""
    if file not in _ENCODERS:
        _ENCODERS[file] = ChunkEncoder(file)
    return _ENCODERS[file]


def pack(docs: DataFrame, tokenizer_file: str, size: int = SIZE, end_id: int = 1) -> DataFrame:
    """Pack every document into sequences of at most ``size`` tokens.

    A document's tokens are its ids and then ``end_id``, so an empty or null
    text is the one token ``end_id``.  Returns one row per piece: doc_id, start,
    length, ids_crc32, doc_tokens, sequence_id, offset.  Rows are packed in the
    order in which Spark reads them; sequences of different tasks never mix, and
    ``sequence_id`` holds the task's partition in its upper bits.  Repeated rows
    and null ids are packed like others; an empty table gives no rows; other
    columns play no part.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_file)
        packer = Packer(TaskContext.get().partitionId() << 33, encode.stop_ids, size)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for part in slices(batch, "text"):
                out: list[tuple] = []
                ids = encode.encode([t or "" for t in part.column(1).to_pylist()])
                for doc_id, x in zip(part.column(0).to_pylist(), ids, strict=True):
                    out += packer.add(doc_id, np.frombuffer(x + end, "<u4"))
                if out:
                    yield _rows(out, kind)
        if out := packer.close():
            yield _rows(out, kind)

    rows = docs.select("doc_id", docs["text"].cast("string").alias("text"))
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(rows.schema["doc_id"].dataType)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {PIECES}")


def _rows(out: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    names = ["doc_id", *(c.split()[0] for c in PIECES.split(", "))]
    cols = list(zip(*out, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(cols[0], kind),
                                       *(pa.array(c, pa.int64()) for c in cols[1:])], names=names)
