"""The corpus operators against brute force on small tables with nulls, empty
and very long texts, ties, repeated rows and clashing extra columns."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from courtgrid.llm import (embedding_dedup, fingerprints, line_dedup, lm, mixing, ngram_join, packing, sharding,
                           token_counts, toxicity)
from courtgrid.llm.common import materialise
from courtgrid.llm.queries import tokenizer_file

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, size string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(rng, n):
    return " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    texts = [words(rng, int(n)) for n in rng.integers(20, 200, 60)]
    line = words(rng, 55)
    texts += [t + "\n" + line for t in texts[:8]]
    near = texts[20].split()
    near[3] = "changed"
    texts += [texts[20], " ".join(near), words(rng, 6000), "", None, "   ", "one two", "one two", "Ünïcödé 🙂 text."]
    out = [(i, t, "en", f"s{i % 5}" if i % 7 else None, len(t or ""), "x", "y") for i, t in enumerate(texts)]
    return [*out, out[4], (None, "a row without an id", None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    w = WORD.findall(low)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_ngram_join_is_brute_force(docs, rows):
    sets = [shingles(r[1]) for r in rows]
    links = [0] * len(rows)
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    head = defaultdict(list)
    for i, r in enumerate(rows):
        head[root[i]].append(r[0])
    want = Counter((r[0], min((x for x in head[root[i]] if x is not None), default=None), links[i]) for i, r in enumerate(rows))
    got = Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in ngram_join.join(docs).collect())
    assert got == want


def test_ngram_join_hot_group_in_blocks(spark):
    rng = np.random.default_rng(2)
    base = words(rng, 120).split()
    made = []
    for i in range(90):
        own = list(base)
        own[int(rng.integers(0, 120))] = f"w{i}"
        made.append((i, " ".join(own)))
    got = ngram_join.join(spark.createDataFrame(made, "doc_id long, text string"), block=16).collect()
    sets = [shingles(t) for _, t in made]
    want = {i: sum(len(a & b) >= 0.8 * len(a | b) for j, b in enumerate(sets) if j != i) for i, a in enumerate(sets)}
    assert {r["doc_id"]: r["n_links"] for r in got} == want
    assert {r["class_id"] for r in got} == {0}


def test_forest_depths_reach_the_target():
    depth = ngram_join.choose_depths({}, 0.8, 0.9999)
    assert 1 - np.prod([1 - 0.8 ** d for d in depth]) >= 0.9999
    heavy = {(0, 3): 1e9}
    assert ngram_join.choose_depths(heavy, 0.8, 0.9999)[0] >= 4  # the tree with the costly level stays deeper


def test_line_dedup_is_brute_force(docs, rows):
    sites, first = defaultdict(set), {}
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for r in ordered:
        for p, x in enumerate((r[1] or "").split("\n")):
            x = x.strip(" \t\r\x0b\x0c")
            if len(WORD.findall(x)) >= 5:
                sites[x].add(r[3])
                first.setdefault(x, (r[0], p))
    want = Counter()
    for r in rows:
        kept = [x for p, x in enumerate((r[1] or "").split("\n"))
                if not (len(sites.get(x.strip(" \t\r\x0b\x0c"), ())) >= 4 and first[x.strip(" \t\r\x0b\x0c")] != (r[0], p))]
        want[r[0], "\n".join(kept) if r[1] is not None else None] += 1
    got = Counter((r["doc_id"], r["text"]) for r in line_dedup.clean_lines(docs).collect())
    assert got == want
    assert any("\n" in (r[1] or "") and (r[0], r[1]) not in got for r in rows)


def test_pipeline_counts_short_lines(spark, tmp_path):
    rng = np.random.default_rng(6)
    made = [(i, f"{words(rng, 30)}\nAll rights reserved.\n\n{words(rng, 20)}", "en", f"s{i % 5}", 1, "x", "y") for i in range(10)]
    made += [(10 + i, f"{words(rng, 30)}\nOnly here.", "en", "s1", 1, "x", "y") for i in range(4)]
    out = corpus_pipeline.line_stage(spark, spark.createDataFrame(made, SCHEMA), str(tmp_path)).collect()
    got = {r["doc_id"]: r["text"] for r in out}
    assert [i for i, t in got.items() if "All rights reserved." in t] == [0]
    assert all(got[i] == made[i][1].replace("All rights reserved.\n", "") for i in range(1, 10))  # blank lines stay
    assert all(got[i] == made[i][1] for i in range(10, 14))


def test_forest_joins_pairs_at_the_threshold():
    rng = np.random.default_rng(9)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    spread = unit(rng.standard_normal((4096, 64)))
    crowd = unit(unit(rng.standard_normal((8, 64)))[rng.integers(0, 8, 4096)] + 0.06 * rng.standard_normal((4096, 64)))
    for sample in (spread, crowd):
        for depth in (4, 12, 20):
            forest = embedding_dedup.Forest({64: sample}, depth, 0.95)
            left = np.repeat(sample, 10, 0)
            right = embedding_dedup.at_cosine(left, 0.95, rng)
            apart = np.ones(len(left), bool)
            for tree in range(forest.trees):
                apart[apart] = ~forest.together(left[apart], right[apart], tree)
            assert apart.mean() <= 3e-4, (depth, forest.trees)  # 1e-4 aimed at, and what chance adds on 40,960 pairs
            few = [set(a) & set(b) for a, b in zip(forest.leaves(left[:50]), forest.leaves(right[:50]), strict=True)]
            assert [not x for x in few] == apart[:50].tolist()


def test_embeddings_are_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((300, 24))
    near = base[:40] + rng.standard_normal((40, 24)) * 0.18
    x = np.concatenate((base, near, base[:5], base[5:8] * 3))
    vec = [(i, [float(a) for a in v]) for i, v in enumerate(x)]
    bad = [(900, None), (901, []), (902, [0.0] * 24), (903, [float("nan")] * 24), (904, [None] * 24), (905, [1.0, 2.0])]
    df = spark.createDataFrame(vec + bad, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(df, block=64).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = unit @ unit.T >= 0.95
    np.fill_diagonal(link, False)
    found = sum(got[i]["n_links"] for i in range(len(x)))
    assert all(got[i]["n_links"] <= link[i].sum() for i in range(len(x)))
    assert found >= 0.98 * link.sum() > 0
    assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"] for i, _ in bad)


def test_toxicity_separates_planted_words(spark):
    rng = np.random.default_rng(8)
    made, labels = [], []
    for i in range(400):
        toxic = i % 5 == 0
        w = words(rng, 40).split()
        if toxic:
            w[3], w[9] = "zorgle" + w[3], "idiot"
        made.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame([*made, (1000, None), (1001, "")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i]["held_out"] for i in held)
    assert np.mean([got[i]["predicted"] == (i % 5 == 0) for i in held]) > 0.97
    assert got[1000]["score"] == got[1001]["score"] < 0.7


def test_fingerprints(docs, rows):
    unique = sorted({(r[0] is not None, r[0] or 0, r[1] or "") for r in rows})
    got = {(r["doc_id"], r["n_chars"]): r for r in fingerprints.fingerprint_rows(docs.dropDuplicates(["doc_id", "text"])).collect()}
    texts = [t for _, _, t in unique]
    by_text = {}
    for (has, i, t), after in zip(unique, texts[1:] + texts[:1], strict=True):
        r = got[i if has else None, len(t)]
        half = len(t) // 2
        assert r["edited_sha256"] == hashlib.sha256((t[:len(t) - half] + after[:half]).encode()).hexdigest()
        assert by_text.setdefault(t, r["fingerprint"]) == r["fingerprint"]
        assert 0 <= r["near_edited"] <= 1
    assert got[70, len(rows[70][1])]["near_edited"] > 0.4  # a long text keeps its first half


def test_chunks_shift_with_an_insertion():
    raw = np.random.default_rng(3).integers(97, 123, 20_000, dtype=np.uint8).tobytes()
    a, b = fingerprints.chunk_weights(raw), fingerprints.chunk_weights(b"inserted " + raw)
    assert fingerprints.containment(a, b) > 0.95
    assert sum(a.values()) == len(raw)


def test_lm_base_score_and_normalisation(docs, rows):
    tokens = lambda t: WORD.findall((t or "").translate({i: i + 32 for i in range(65, 91)})) + ["\0end"]
    counts = Counter()
    for r in rows:
        if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 != 2:
            counts.update(tokens(r[1]))
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for r in rows:
        t = tokens(r[1])
        want[r[0], len(t), sum(counts[x] > 0 for x in t), round(sum(np.log10((counts[x] + 1) / (n + v + 1)) for x in t), 5)] += 1
    got = lm.score(docs).collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 5)) for r in got) == want
    model = lm.LogBilinear(np.array([5, 3, 9, 1, 2]))
    k = np.arange(5)
    total = sum(np.exp(model.log_prob(np.full(5, c), k, k[::-1])) for c in range(5))
    assert np.allclose(total, 1, atol=1e-5)


def test_lm_adds_up_over_all_words():
    rng = np.random.default_rng(4)
    every = rng.integers(-2**62, 2**62, 3000)
    n = np.sort(rng.integers(1, 200, 3000))[::-1]
    words, counts = np.append(every[:2500], lm.END), np.append(n[:2500], 50)
    vocabulary = lm.Vocabulary(words, counts, int(n.sum()) + 50, 3001)
    at = vocabulary.bucket(np.append(every, lm.END))
    kinds = np.unique(at)
    vocabulary.fill_rests(kinds, np.bincount(at, np.append(n, 50))[kinds], np.bincount(at)[kinds])
    assert vocabulary.own.sum() == lm.n_vectors(vocabulary.total) + 1 > 2000 and vocabulary.unit_counts.sum() == n.sum() + 50
    assert lm.n_vectors(5_000_000_000) > 200 * 1022
    model = lm.LogBilinear(vocabulary.unit_counts, vocabulary.starts, vocabulary.width)
    _, known, units = vocabulary.look_up(np.append(every, lm.END))
    for _ in range(5):
        i = rng.permutation(len(units))
        model.train(units[i], units[i[::-1]], units, rng)
    n = np.append(n, 50)
    for one, two in ((0, 0), (5, 900), (vocabulary.starts[0], 40)):
        context = np.full(len(units), one), np.full(len(units), two)
        word = np.exp(model.log_prob(units, *context) + vocabulary.log_shares(np.append(every, lm.END), n, units))
        rest = vocabulary.starts[:-1]
        unseen = np.exp(model.log_prob(rest, np.full(len(rest), one), np.full(len(rest), two))) / vocabulary.rest_mass
        assert word.sum() + unseen.sum() == pytest.approx(1, abs=1e-4)


@pytest.fixture(scope="module")
def pair_texts():
    """Common words, and between them rarer ones in pairs: b3 stands after a3 alone."""
    rng = np.random.default_rng(12)
    made = []
    for i in range(3000):
        own = []
        for f, g, p in zip(rng.integers(0, 1022, 20), rng.integers(0, 1022, 20), rng.integers(0, 400, 20), strict=True):
            own.append(f"f{f} f{g} a{p} b{p}")
        made.append((i, " ".join(own)))
    return made


def test_lm_tells_rarer_words_apart_in_any_partitions(spark, pair_texts):
    docs = spark.createDataFrame(pair_texts, "doc_id long, text string")
    gain = {}
    for n in (1, 200):
        gain[n] = lm.score(docs.repartition(n)).where("held_out").agg(F.sum(F.col("score") - F.col("base_score")) / F.sum("n_tokens")).first()[0]
    assert min(gain.values()) > 0.45, gain
    assert abs(gain[1] - gain[200]) < 0.02, gain


def test_shards(docs, rows):
    got = sharding.shard_by_size(docs, 4).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_token_counts_and_prefixes(docs, rows):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    got = token_counts.token_counts(docs, tokenizer_file("piece_bpe_32k.model"), 100).collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["over_limit"]) for r in got) == Counter(
        (r[0], len(model.encode(r[1] or "")), len(model.encode(r[1] or "")) > 100) for r in rows)
    for text in ("the  theory\n of <s> things▁ 🙂ﬁ", "a"):
        p = token_counts.counter(tokenizer_file("piece_bpe_32k.model")).prefixes([text])[0]
        assert p.all().tolist() == [len(model.encode(text[:i])) for i in range(len(text) + 1)]
        assert len(model.encode(text[:p.truncate(5)])) <= 5


def test_truncation_goes_into_words(spark):
    import sentencepiece

    file = tokenizer_file("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=file)
    rng = np.random.default_rng(3)
    texts = ["\u6f22\u5b57\u306e\u6587\u7ae0\u306f\u7a7a\u767d\u304c\u306a\u3044" * 3, "".join(rng.choice(list("abcdefghABCDEF0189+/"), 90)),
             "https://example.org/a/very/long/path?with=several&parts=joined", "lines\njoined\nby\nfeeds\tand\ttabs",
             "  two  spaces internationalisation  ", "counterrevolutionaries", "a"]
    for text in texts:
        p = token_counts.counter(file).prefixes([text])[0]
        counts = [len(model.encode(text[:i])) for i in range(len(text) + 1)]
        for budget in range(counts[-1] + 2):
            assert p.truncate(budget) == max(i for i, n in enumerate(counts) if n <= budget), (text, budget)
    rows = spark.createDataFrame(list(enumerate(texts)) + [(20, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["n_fit"] for r in token_counts.token_counts(rows, file, 8).collect()}
    fit = [max(i for i in range(len(t) + 1) if len(model.encode(t[:i])) <= 8) for t in texts]
    assert got == dict(enumerate(fit)) | {20: 0}


def test_shards_of_a_row_that_is_a_third_of_all(spark):
    """One row repeated 20,000 times: ranges stay near their aim and shards equal."""
    hot = [(7, "the same row again")] * 20_000 + [(None, None)] * 2_000
    rest = [(i, f"text {i} " + "x" * (i % 40)) for i in range(38_000)]
    table = spark.createDataFrame(hot + rest, "doc_id long, text string").repartition(6)
    stored = materialise(sharding.sized_rows(table), "shard-test")
    total = stored.agg(F.sum("size")).first()[0]
    _, sizes = sharding.splitters(stored, 30, total)
    assert len(sizes) > 15 and max(r["size"] for r in sizes) <= sharding.OVERFULL * total / 30
    got = sharding.shard_by_size(table, 4).groupBy("shard").agg(
        F.sum("size").alias("size"), F.count("*").alias("n"), F.min("slot").alias("low"), F.max("slot").alias("high"),
        F.countDistinct("slot").alias("slots")).collect()
    assert len(got) == 4 and sum(r["n"] for r in got) == 60_000
    assert all(abs(r["size"] - total / 4) < 0.03 * total / 4 for r in got)
    assert all((r["low"], r["high"], r["slots"]) == (0, r["n"] - 1, r["n"]) for r in got)


def test_mix_reaches_targets(docs, rows):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    size = lambda r: len(WORD.findall(r[1] or ""))
    per = Counter()
    for r in rows:
        per[r[3]] += size(r)
    order = sorted(x for x in per if x is not None) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, left, free = dict.fromkeys(per, 0.0), 1.5 * sum(per.values()), set(per)
    while left > 1e-9 and free:  # reshare by weight until none is above twice its size
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        left = 0.0
        for s in list(free):
            target[s] += share[s]
            if target[s] >= 2 * per[s]:
                left += target[s] - 2 * per[s]
                target[s] = 2.0 * per[s]
                free.discard(s)
    for r in got:
        assert r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] <= 2 * r["size"] and r["taken"] == r["times"] * r["size"]
    taken = Counter()
    for r in got:
        taken[r["source"]] += r["taken"]
    largest = Counter()
    for r in rows:
        largest[r[3]] = max(largest[r[3]], size(r))
    assert all(abs(taken[s] - target[s]) <= 2 * largest[s] for s in per)


def test_packing_round_trip(docs, rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    got = packing.pack(docs, tokenizer_file("word_bpe_49k.json"), 256).collect()
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 256
    pieces = defaultdict(list)
    for r in got:
        pieces[r["doc_id"], r["doc_tokens"]].append((r["start"], r["length"], r["ids_crc32"]))
    for r in {(r[0], r[1]) for r in rows}:
        ids = np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4")
        own = sorted(set(pieces[r[0], len(ids)]))
        assert {c for s, n, c in own} >= {zlib.crc32(ids[s:s + n].tobytes()) for s, n, _ in own}
        assert sum(n for _, n, _ in pieces[r[0], len(ids)]) % len(ids) == 0
    full = sum(r["length"] for r in got)
    assert full / (256 * len(sequences)) > 0.9


def test_cuts_are_the_cheapest():
    rng = np.random.default_rng(4)
    for _ in range(60):
        at = sorted({int(x) for x in rng.integers(1, 60, 20)} | set(range(10, 70, 10)))
        cost = [int(x) for x in rng.integers(0, 6, len(at))]
        best = {0: 0}
        for p, c in zip(at, cost, strict=True):
            best[p] = min(best[q] + 16 - (p - q) + c for q in best if p - q <= 16)
        cuts = packing.best_cuts(at, cost, 16)
        price = dict(zip(at, cost, strict=True))
        assert sum(16 - (b - a) + price[b] for a, b in zip([0, *cuts], cuts, strict=False)) == best[at[-1]]


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for df in (ngram_join.join(empty), line_dedup.clean_lines(empty), toxicity.toxicity(empty, labels),
               fingerprints.fingerprint_rows(empty), lm.score(empty), sharding.shard_by_size(empty),
               token_counts.token_counts(empty, tokenizer_file("piece_bpe_32k.model")), mixing.mix(empty),
               packing.pack(empty, tokenizer_file("word_bpe_49k.json")),
               embedding_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>"))):
        assert df.count() == 0


def test_stages_keep_the_columns(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns = now.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, str(tmp_path))
        assert out.columns == columns, name
        out.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        if name == "ngram_join":
            kept = ngram_join.join(now.where(F.col("doc_id").isNotNull())).agg(F.max("n_links")).first()[0]
            assert kept == 0
    assert corpus_pipeline.STAGES[-1][1](spark, now, str(tmp_path)).count() > 0


def test_frequent_words_are_whole_levels(spark):
    counts = spark.createDataFrame([(1, 100), (2, 50), (3, 50), (4, 1), (5, 1)], "word long, n long")
    got = {most: sorted(r["word"] for r in lm.frequent_words(counts, most).collect()) for most in (0, 1, 2, 3, 4, 5)}
    assert got == {0: [], 1: [1], 2: [1], 3: [1, 2, 3], 4: [1, 2, 3], 5: [1, 2, 3, 4, 5]}
    assert lm.frequent_words(counts.limit(0)).count() == 0


def test_short_lines_count_and_long_documents_are_linear(spark):
    """A two-word line on many sites goes; a document of 100,000 such lines is no trouble."""
    short = "All rights"
    rows = [(i, f"unique text number {i}\n{short}", "en", f"site{i}", None, None, None) for i in range(6)]
    rows.append((99, "\n".join([short] * 100_000 + ["the end"]), "en", "site99", None, None, None))
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in line_dedup.clean_lines(docs).collect()}
    assert got[0] == (f"unique text number 0\n{short}", 2, 0)
    assert all(got[i] == (f"unique text number {i}", 2, 1) for i in range(1, 6))
    assert got[99] == ("the end", 100_001, 100_000)


def test_line_stage_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(i, f"text {i} of a site\nthe same line", "en", f"s{i}", 9, 77, 88) for i in range(6)],
                                 "doc_id long, text string, lang string, source string, n_chars long, n_lines int, n_removed int")
    got = corpus_pipeline.line_stage(spark, docs, "").collect()
    assert {(r["n_lines"], r["n_removed"]) for r in got} == {(77, 88)} and got[0].asDict().keys() == set(docs.columns)


def test_keep_one_of_repeated_and_wordless_rows(spark):
    """A third of the rows are one row; rows without words all stay, with ids or without."""
    rng = np.random.default_rng(12)
    hot = words(rng, 30)
    rows = [(7, hot, "en", "s", None, None, None)] * 60 + [(None, t, "en", s, None, None, None) for t in ("", None, "  ") for s in "abc"]
    rows += [(100 + i, words(rng, 30), "en", "s", None, None, None) for i in range(60)]
    rows += [(300 + i, hot + " " + words(rng, 2), "en", "s", None, None, None) for i in range(20)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = Counter((r["doc_id"], r["text"]) for r in ngram_join.keep_one(docs).collect())
    assert got == Counter([(7, hot)] + [(None, t) for t in ("", None, "  ") for _ in "abc"]
                          + [(100 + i, rows[69 + i][1]) for i in range(60)])
    links = {r["doc_id"]: r["n_links"] for r in ngram_join.join(docs).collect() if r["doc_id"] is not None and r["doc_id"] < 100}
    assert links == {7: 59 + 20}


def test_toxicity_sample_is_bounded_in_texts(spark):
    """Few ids on many rows: the sample's bound holds for texts, and repeated rows count once."""
    rows = [(i % 30, f"text number {i % 3000}") for i in range(9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(30)], "doc_id long, quality int, toxic int")
    train = toxicity.training_texts(docs, labels, 500)
    assert 300 < train.count() < 700
    assert toxicity.training_texts(docs, labels, 10 ** 6).count() == len(
        {r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1})


def test_packing_memo_of_two_ages(spark, monkeypatch):
    monkeypatch.setattr(packing, "MEMO_CHUNKS", 40)
    rng = np.random.default_rng(13)
    encode = packing.ChunkEncoder(tokenizer_file("word_bpe_49k.json"))
    common = words(rng, 15)
    for _ in range(30):
        texts = [common + " " + words(rng, 12) + ". X," for _ in range(3)]
        want = [encode._whole(t) for t in texts]
        assert encode.encode(texts) == want
    assert len(encode._memo) + len(encode._older) < 250
