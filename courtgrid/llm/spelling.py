"""Spelling variants: words one edit apart, by dynamic programming over sorted lists.

Two words of at least 7 code points that differ by one inserted, deleted or replaced
code point agree in a half: with m the shorter length, in the first m // 2 code points
or in the last m - m // 2.  A word of length m joins the classes m and m - 1, in each
under its first half and, read backwards, its last half.  A group (class, side, half)
is a sorted list.  The edit matrix of a query against the list is walked once along
the list: words with a common prefix (the longest common prefixes of neighbours say
which) share its rows, of which a band of three entries can matter, and a range of
words goes when the row of its shared prefix has no entry below two.  The walk is done
for all queries of a task at once, a row of the matrix at a time.

A group of more than BLOCK words is split into pairs of blocks, so a task's list is
bounded; a pair of words is found in one group only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import spread_blocks
from .common import materialise

LEAST = 7            # code points of a word
RATIO = 10           # a form occurs at least so many times as often
BLOCK = 8192         # words of a block of a large group
CHUNK = 32_768       # words of complete groups handled at a time
QUERIES = 16_384     # queries walked at a time
FAR = 9              # more than any entry that matters

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = "[A-Za-zÀ-ÿ]"
PARTIAL = "word string, n_near long, form_n long, form string"


def vocabulary(docs: DataFrame, least: int = LEAST, often: int = 2) -> DataFrame:
    """Words with their occurrences n: maximal letter runs, A-Z in lower case, one code
    point less where 31 divides the crc32 of ``<doc_id>:<run>``.

    Only runs of ``least`` code points can give such words.  A null text has no word, a
    null id counts as empty.
    """
    run = F.translate(F.col("run"), UPPER, LOWER)
    h = F.crc32(F.concat(F.col("id"), F.lit(":"), F.col("run")))
    at = (F.col("h") % F.length("run")).cast("int")
    short = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    return (docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                        F.explode(F.regexp_extract_all("text", F.lit(f"{RUN}{{{least},}}"), F.lit(0))).alias("run"))
            .select("id", run.alias("run")).select("run", h.alias("h"))
            .select(F.when(F.col("h") % 31 == 0, short).otherwise(F.col("run")).alias("word"))
            .where(F.length("word") >= least)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= often))


class Lists:
    """Sorted lists of complete groups: texts, lengths past the shared half, neighbours' common prefixes."""

    def __init__(self, words: list[str], shared: np.ndarray, group: np.ndarray):
        size = np.fromiter(map(len, words), np.int64, len(words))
        self.text = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.first = np.concatenate(([0], np.cumsum(size)[:-1])) if len(words) else np.zeros(0, np.int64)
        self.size, n = size, len(words)
        common = np.zeros(n, np.int64)
        same = np.zeros(n, bool)
        same[1:] = group[1:] == group[:-1]
        alive, d = np.flatnonzero(same), 0
        while len(alive):
            alive = alive[(size[alive] > d) & (size[alive - 1] > d)]
            alive = alive[self.text[self.first[alive] + d] == self.text[self.first[alive - 1] + d]]
            common[alive] += 1
            d += 1
        same &= common >= shared
        self.common = np.where(same, common - shared, -1)  # past the shared half; -1: a list begins
        self.start = self.first + shared
        self.left = size - shared
        begins = np.flatnonzero(self.common < 0)
        self.low = np.repeat(begins, np.diff(np.append(begins, n)))
        self.high = np.repeat(np.append(begins[1:], n), np.diff(np.append(begins, n))) if n else self.low

    def letter(self, word: np.ndarray, at: np.ndarray | int) -> np.ndarray:
        """Code point of each word at a place past the shared half (where it has none: any)."""
        return self.text[np.clip(self.start[word] + at, 0, max(len(self.text) - 1, 0))]

    def one_apart(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, word of its list) exactly one edit apart."""
        n = len(self.left)
        q, lo, hi = queries, self.low[queries], self.high[queries]
        r0, r1, r2 = (np.full(len(q), v, np.int8) for v in (FAR, 0, 1))  # row entries at places t - 1, t, t + 1
        left, right, t = [], [], 0
        while len(q):
            ends = self.left[lo] == t  # the word that is the shared prefix itself comes first
            gap = self.left[q] - t
            last = np.where(gap == -1, r0, np.where(gap == 0, r1, np.where(gap == 1, r2, FAR)))
            hit = ends & (last == 1)
            left.append(q[hit])
            right.append(lo[hit])
            lo = lo + ends
            go = lo < hi
            q, lo, hi, r0, r1, r2 = q[go], lo[go], hi[go], r0[go], r1[go], r2[go]
            if not len(q):
                break
            begins = np.append(np.flatnonzero(self.common <= t), n)  # where the next letter changes
            a, b = np.searchsorted(begins, lo), np.searchsorted(begins, hi)
            count = b - a
            entry = np.repeat(np.arange(len(q)), count)
            child = np.arange(len(entry)) - np.repeat(np.cumsum(count) - count, count) + a[entry]
            lo, hi, q = begins[child], begins[child + 1], q[entry]
            letter, own = self.letter(lo, t), self.left[q]
            o0, o1, o2 = r0[entry], r1[entry], r2[entry]
            r0 = np.minimum(o1 + 1, o0 + (self.letter(q, t - 1) != letter))
            r0 = np.where(own >= t, r0, FAR)
            r1 = np.minimum(np.minimum(o2, r0) + 1, o1 + (self.letter(q, t) != letter))
            r1 = np.where(own >= t + 1, r1, FAR)
            r2 = np.minimum(r1 + 1, o2 + (self.letter(q, t + 1) != letter))
            r2 = np.where(own >= t + 2, r2, FAR)
            keep = np.minimum(np.minimum(r0, r1), r2) <= 1
            q, lo, hi = q[keep], lo[keep], hi[keep]
            r0, r1, r2 = (r[keep].astype(np.int8) for r in (r0, r1, r2))
            t += 1
        if not left:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(left), np.concatenate(right)

    def same_end(self, a: np.ndarray, b: np.ndarray, half: np.ndarray) -> np.ndarray:
        """Do two words agree in their last ``half`` code points?"""
        same = np.ones(len(a), bool)
        for i in range(int(half.max()) if len(half) else 0):
            open_ = same & (half > i)
            x, y = a[open_], b[open_]
            same[open_] = self.text[self.first[x] + self.size[x] - 1 - i] == self.text[self.first[y] + self.size[y] - 1 - i]
        return same


def near_rows(cls: np.ndarray, side: np.ndarray, bi: np.ndarray, bj: np.ndarray, own: np.ndarray,
              words: list[str], n: np.ndarray) -> pa.RecordBatch:
    """Per word of sorted complete groups: how many near words, and the most frequent one."""
    half = cls // 2
    shared = np.where(side == 0, half, cls - half)
    change = np.ones(len(cls), bool)
    change[1:] = (np.diff(cls) != 0) | (np.diff(side) != 0) | (np.diff(bi) != 0) | (np.diff(bj) != 0)
    lists = Lists(words, shared, np.cumsum(change))
    asked = np.flatnonzero((lists.size == cls) & (lists.high - lists.low > 1))
    pairs = [lists.one_apart(asked[at:at + QUERIES]) for at in range(0, len(asked), QUERIES)]
    q = np.concatenate([p[0] for p in pairs]) if pairs else np.zeros(0, np.int64)
    w = np.concatenate([p[1] for p in pairs]) if pairs else np.zeros(0, np.int64)
    ok = (bi[q] == bj[q]) | (own[q] != own[w])  # a block's own pairs are found where it meets itself
    back = ok & (side[q] == 1)
    ok[back] &= ~lists.same_end(q[back], w[back], half[q[back]])  # found under the first half
    q, w = q[ok], w[ok]
    longer = lists.size[w] > lists.size[q]  # equal lengths are found from either word
    src, dst = np.concatenate((q, w[longer])), np.concatenate((w, q[longer]))
    if not len(src):
        return pa.RecordBatch.from_pylist([], schema=SCHEMA)
    used = np.unique(dst)
    plain = {int(i): words[i][::-1] if side[i] else words[i] for i in np.unique(np.concatenate((src, dst)))}
    rank = np.zeros(len(words), np.int64)
    rank[np.array(sorted(used.tolist(), key=plain.__getitem__), np.int64)] = np.arange(len(used))
    order = np.lexsort((rank[dst], -n[dst], src))
    src, dst = src[order], dst[order]
    head = np.flatnonzero(np.append(True, src[1:] != src[:-1]))
    best = dst[head]
    return pa.RecordBatch.from_arrays([
        pa.array([plain[i] for i in src[head].tolist()], pa.string()), pa.array(np.diff(np.append(head, len(src)))),
        pa.array(n[best]), pa.array([plain[i] for i in best.tolist()], pa.string())], schema=SCHEMA)


SCHEMA = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        if held.num_rows < CHUNK:
            continue
        cut = _last_begin(held)
        if cut:
            yield _near(held.slice(0, cut))
            held = held.slice(cut).combine_chunks()
    if held is not None and held.num_rows:
        yield _near(held)


def _last_begin(held: pa.Table) -> int:
    """Row at which the last group begins; groups are told apart by their key's hash."""
    keys = [held.column(c).to_numpy() for c in ("cls", "side", "bi", "bj", "half")]
    change = np.zeros(held.num_rows, bool)
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    at = np.flatnonzero(change)
    return int(at[-1]) if len(at) else 0


def _near(table: pa.Table) -> pa.RecordBatch:
    return near_rows(*(table.column(c).to_numpy().astype(np.int64) for c in ("cls", "side", "bi", "bj", "own_block")),
                     table.column("text").to_pylist(), table.column("n").to_numpy())


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """Of each word of ``words`` (word, n; distinct) that has one: number of near words, and the largest
    count and the first such word among them: word, n_near, form_n, form."""
    size = F.length("word")
    sides = [F.struct(cls.alias("cls"), F.lit(side).alias("side"),
                      (F.reverse("word") if side else F.col("word")).alias("text"),
                      (cls - F.floor(cls / 2).cast("int") if side else F.floor(cls / 2).cast("int")).alias("shared"))
             for cls in (size, size - 1) for side in (0, 1)]
    keyed = (words.select("n", F.explode(F.array(*sides)).alias("s")).select("n", "s.*")
             .where(F.col("cls") >= LEAST)
             .select("cls", "side", "text", "n", F.xxhash64(F.col("text").substr(F.lit(1), F.col("shared"))).alias("half")))
    key = ["cls", "side", "half"]
    hot = materialise(keyed.groupBy(*key).agg(F.count(F.lit(1)).alias("many")).where(F.col("many") > block), "spelling-hot")
    dealt = keyed.join(hot, key, "left").withColumn("many", F.coalesce("many", F.lit(1)))
    spread = spread_blocks(dealt, "half", "many", "text", block)
    group = [*key, "bi", "bj"]
    found = (spread.repartition(*group).sortWithinPartitions(*group, "text")
             .select("cls", "side", "half", "bi", "bj", "own_block", "text", "n").mapInArrow(_walk, PARTIAL))
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form")))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
            .select("word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form")))


def roots(links: DataFrame) -> DataFrame:
    """The last word that forms lead to (``links``: word, form; no circle): word, root.

    Each round takes the root's root, so chains halve.
    """
    now = materialise(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = materialise(now.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        now = new.select("word", "root")
        if new.where("moved").isEmpty():
            return now


def variants(words: DataFrame, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """Form and root of every word of ``words`` (word, n): word, form, root, n, n_near, form_n.

    The form is the near word of largest n (ties: the first by code points) if that n is
    at least ``ratio`` times the word's own.  A form has a larger n than its word, so forms
    never lead back.  Words alone have form and form_n null, n_near 0 and are their own root.
    """
    words = materialise(words, "spelling-words")
    best = near_words(words, block)
    formed = F.col("form_n") >= ratio * F.col("n")
    placed = materialise(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(formed, F.col("form")).alias("form"), F.when(formed, F.col("form_n")).alias("form_n")), "spelling-forms")
    last = roots(placed.where(F.col("form").isNotNull()))
    return placed.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Spelling variants among all words of all texts of ``docs`` (doc_id, text; other columns are not read).

    Null and empty texts give no word; repeated rows count again; an empty table gives no row.
    """
    return variants(vocabulary(docs))
