"""Exact token counts of a sentencepiece BPE vocabulary at every prefix.

The vocabulary joins pieces over spaces only at a piece's start, so a text is a
row of *words* (a run of spaces and the non-spaces after it) whose pieces never
cross a word's end.  The count at a prefix is therefore
``count[i] = count[start of its word] + inside[i - start]``: one addition per
prefix over counts already stored.  ``inside``, the counts of a word's own
prefixes, comes from the recurrence of byte-pair encoding: dropping the last
piece of an encoding leaves the encoding of a shorter prefix, so
``inside[j] = inside[j - len(last piece)] + 1``.

A text is encoded once, word by word with a memo; truncation and budget
questions are then a binary search over the stored counts and a walk through
the one word in which the budget ends.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import cached_property
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

MEMO_WORDS = 500_000  # words whose counts a worker keeps (a cache, never a limit on texts)
LONG_WORD = 64        # code points up to which a word is kept in the memo
_WORD = re.compile(r" *[^ ]+| +")


class PrefixCounter:
    """Token counts of texts and their prefixes for one sentencepiece model file."""

    def __init__(self, model_file: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = [self._model.id_to_piece(i) for i in range(self._model.get_piece_size())]
        space = "▁"
        if any(space in p.lstrip(space) for p in pieces):
            raise ValueError(f"{model_file}: pieces cross word ends")
        self._begins = np.array([p.startswith(space) for p in pieces])
        self._memo: dict[str, int] = {}
        # the model puts one space before a text; the marker itself reads as a space
        self._first = self._model.encode("a", out_type=str)[0].startswith(space)
        # a line feed has no piece of its own, so what follows it is encoded as if it stood alone
        self._alone = self._model.encode("\na", out_type=str)[:-1]
        if self._model.encode("\na", out_type=str)[-1] != "a":
            raise ValueError(f"{model_file}: no text can be encoded without the space in front")
        self._vocabulary = {p.replace(space, " ") for p in pieces}
        self.longest = max(map(len, pieces))
        self._pairs: dict[tuple[str, str], bool] = {}
        self._whole: dict[str, bool] = {}  # vocabulary entry -> is it encoded as itself

    def words(self, text: str) -> list[str]:
        """The text's words as the model sees them: with the space it puts in front."""
        if not text:
            return []
        return _WORD.findall((" " if self._first else "") + text.replace("▁", " "))

    def _encode(self, words: list[str]) -> list[int]:
        """Token counts of words; each is encoded without the space the model would add."""
        if not self._first:
            return [len(x) for x in self._model.encode(words, num_threads=1)]
        plain = [i for i, w in enumerate(words) if w[0] == " " and w[1:2] not in ("", " ")]
        counts = [0] * len(words)
        for at in range(0, len(plain), 4000):  # one call for many words: each starts at a piece with the marker
            part = plain[at:at + 4000]
            ids = np.array(self._model.encode("".join([words[i] for i in part])[1:], num_threads=1), np.int64)
            begins = np.flatnonzero(self._begins[ids])
            if len(begins) != len(part):
                raise AssertionError("a word without a piece of its own start")
            for i, n in zip(part, np.diff(np.append(begins, len(ids))).tolist(), strict=True):
                counts[i] = n
        rest = [i for i, n in enumerate(counts) if not n]
        got = self._model.encode([words[i].removeprefix(" ") for i in rest], num_threads=1)
        for i, x in zip(rest, got, strict=True):
            counts[i] = max(len(x), 1)
        return counts

    def count_words(self, words: list[str]) -> list[int]:
        """Token counts of words; unknown ones are encoded together and remembered."""
        memo = self._memo
        missing = [w for w in set(words) if w not in memo]
        if missing:
            if len(memo) + len(missing) > MEMO_WORDS:
                memo.clear()
                missing = list(set(words))
            memo.update(zip(missing, self._encode(missing), strict=True))
        counts = list(map(memo.__getitem__, words))
        for w in missing:
            if len(w) > LONG_WORD:
                del memo[w]
        return counts

    def count(self, text: str) -> int:
        """Tokens of the whole text."""
        return sum(self.count_words(self.words(text)))

    def prefixes(self, texts: list[str]) -> list["Prefixes"]:
        """Prefix counts of many texts; their words are looked up together."""
        words = [self.words(t) for t in texts]
        counts = self.count_words(list(chain.from_iterable(words)))
        ends = list(accumulate(map(len, words), initial=0))
        return [Prefixes(self, t, w, counts[a:b]) for t, w, a, b in zip(texts, words, ends, ends[1:], strict=False)]

    def _pieces(self, text: str) -> list[str]:
        return [p.replace("▁", " ") for p in self._model.encode("\n" + text, out_type=str)[len(self._alone):]]

    def _follows(self, last: str, piece: str) -> bool:
        """May ``piece`` follow ``last``: does byte-pair encoding leave the two apart?"""
        pair = (last, piece)
        if pair not in self._pairs:
            if len(self._pairs) > MEMO_WORDS:
                self._pairs.clear()
            self._pairs[pair] = self._pieces(last + piece) == self._pieces(last) + self._pieces(piece)
        return self._pairs[pair]

    def _is_whole(self, piece: str) -> bool:
        if piece not in self._whole:
            self._whole[piece] = len(self._pieces(piece)) == 1
        return self._whole[piece]

    def inside(self, word: str) -> np.ndarray:
        """Token counts of all prefixes of a word, the empty one first.

        The last piece of a prefix is the longest vocabulary entry that ends
        there and may follow the last piece of the prefix before it (an encoding
        is the byte-pair one if all its neighbours are).  A code point without a
        piece stands for its bytes and joins nothing.
        """
        counts, last = np.zeros(len(word) + 1, np.int64), [""] * (len(word) + 1)
        for j in range(1, len(word) + 1):
            for size in range(min(j, self.longest), 0, -1):
                piece = word[j - size:j]
                if size > 1 and piece not in self._vocabulary:
                    continue
                if size > 1 and not self._is_whole(piece):
                    continue
                before = last[j - size]
                if before and not self._follows(before, piece):
                    continue
                tokens = 1 if piece in self._vocabulary else len(piece.encode())
                counts[j], last[j] = counts[j - size] + tokens, piece
                break
        return counts


class Prefixes:
    """Counts at every prefix of one text: a prefix of i code points has ``at(i)`` tokens."""

    def __init__(self, counter: PrefixCounter, text: str, words: list[str] | None = None,
                 counts: list[int] | None = None):
        self._counter = counter
        self._words = counter.words(text) if words is None else words
        lead = 1 if counter._first and text else 0
        self._lead = lead
        counts = counter.count_words(self._words) if counts is None else counts
        self._counts = np.fromiter(accumulate(counts, initial=0), np.int64, len(counts) + 1)
        self.length = len(text)
        self._inside: dict[int, np.ndarray] = {}

    @cached_property
    def _starts(self) -> np.ndarray:
        return np.fromiter(accumulate(map(len, self._words), initial=0), np.int64, len(self._words) + 1)

    @property
    def total(self) -> int:
        return int(self._counts[-1])

    def _in_word(self, w: int) -> np.ndarray:
        if w not in self._inside:
            self._inside[w] = self._counter.inside(self._words[w])
        return self._inside[w]

    def at(self, i: int) -> int:
        """Tokens of the first ``i`` code points."""
        if i <= 0:
            return 0
        i = min(i, self.length) + self._lead
        w = int(np.searchsorted(self._starts, i, side="left")) - 1
        return int(self._counts[w] + self._in_word(w)[i - self._starts[w]])

    def all(self) -> np.ndarray:
        """Tokens of every prefix, from the empty one to the whole text."""
        parts = [self._counts[w] + self._in_word(w)[1:] for w in range(len(self._words))]
        full = np.concatenate(([0], *parts)) if parts else np.zeros(1, np.int64)
        return np.concatenate(([0], full[1 + self._lead:])) if self._lead else full

    def truncate(self, budget: int) -> int:
        """Code points of the longest prefix that has at most ``budget`` tokens.

        Every word has a token, so the prefix ends before or in the first word
        whose end is over the budget.  Counts may fall within a word, so all its
        prefixes are looked at, as far as pieces can reach with the tokens left.
        """
        w = bisect_right(self._counts.tolist(), budget) - 1
        if w < 0:
            return 0
        end, left = int(self._starts[w]), budget - int(self._counts[w])
        if w < len(self._words) and left:
            counts = self._counter.inside(self._words[w][:left * self._counter.longest])
            end += int(np.flatnonzero(counts <= left)[-1])
        return max(0, end - self._lead)


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(model_file: str) -> PrefixCounter:
    """The worker's counter for a model file (kept between tasks)."""
    if model_file not in _COUNTERS:
        _COUNTERS[model_file] = PrefixCounter(model_file)
    return _COUNTERS[model_file]


def token_counts(docs: DataFrame, model_file: str, limit: int = 4096) -> DataFrame:
    """Token counts of every whole text: doc_id, n_bytes, n_tokens, over_limit, n_fit.

    ``n_fit`` is the code points of the longest prefix of at most ``limit`` tokens.
    Begin and end tokens are not counted, and nothing is truncated.  Null and
    empty texts have 0 bytes and 0 tokens; null ids and repeated rows are kept
    row by row; an empty table gives no rows.  Other columns play no part.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(model_file)
        for batch in batches:
            for part in slices(batch, "text"):
                found = tokens.prefixes([t or "" for t in part.column(1).to_pylist()])
                totals = [p.total for p in found]
                fit = [p.length if n <= limit else p.truncate(limit) for p, n in zip(found, totals, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(totals, pa.int64()),
                                                  pa.array(fit, pa.int64())],
                                                 names=["doc_id", "n_bytes", "n_tokens", "n_fit"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"),
                       F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, n_fit long")
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "n_fit")
