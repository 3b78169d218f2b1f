"""Every operator against its plain version on messy tables, and on empty ones."""

import hashlib
import math
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import decontam, exact_dedup, lang_id, license_rules, license_scan, lm_scoring, pieces, quality_rules, sharding, simhash, suffix_dedup
from strata.llm.common import documents, join_spread, mod_crc
from strata.llm.components import components
from strata.llm.queries import PIECE_MODEL, QUERIES

from . import brute
from .conftest import write_tables


def got(spark, name, tables, *columns):
    return Counter(tuple(r) for r in QUERIES[name](spark, tables.dir).select(*columns).collect())


def test_every_query_takes_empty_tables(spark, empty):
    for name, query in {**QUERIES, "pipeline": corpus_pipeline.run}.items():
        df = query(spark, empty.dir)
        assert df.collect() == [] and df.columns, name


def test_op1(spark, messy):
    assert got(spark, "op1_simhash", messy, "doc_id", "fingerprint", "component_id") == Counter(brute.op1(messy.docs))


def test_op1_links_equal_all_pairs(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(-(2**63), 2**63, 40)
    prints = {int(b) ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 5), replace=False)) for b in base for _ in range(6)}
    prints = [((p + 2**63) % 2**64) - 2**63 for p in prints]
    links = simhash.link_fingerprints(spark.createDataFrame([(p,) for p in prints], "fp long"))
    wanted = {(a, b) for a in prints for b in prints if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    assert {tuple(r) for r in links.collect()} == wanted


def test_op1_links_of_a_family_that_shares_a_segment(spark):
    """Thousands of fingerprints of one 32-bit half, around it up to one bit off, and of 48 equal bits."""
    rng = np.random.default_rng(4)
    half = 0x5A5A1234
    rest = [int(r) for r in rng.integers(0, 2**32, 1500)]
    rest += [r ^ sum(1 << int(k) for k in rng.choice(32, rng.integers(1, 5), replace=False)) for r in rest[:600]]
    prints = {r << 32 | half ^ (1 << int(b) if b < 32 else 0) for r, b in zip(rest, rng.integers(0, 64, len(rest)))}
    prints |= {half << 32 | 0x7777 << 16 | int(r) for r in rng.integers(0, 2**16, 300)}
    prints = sorted(((p + 2**63) % 2**64) - 2**63 for p in prints)
    a = np.array(prints).view(np.uint64)
    near = np.argwhere(np.triu(np.bitwise_count(a[:, None] ^ a[None, :]) <= 3, 1))
    wanted = {(prints[i], prints[j]) for i, j in near}
    table = spark.createDataFrame([(p,) for p in prints], "fp long")
    for most in (1024, 20, 0):  # one family is split; also the smaller ones; every key is
        assert {tuple(r) for r in simhash.link_fingerprints(table, most_in_key=most).collect()} == wanted
    assert len(wanted) > 600


def test_components_of_a_hub(spark):
    """A node that half of all links touch, dealt over many parts, with tails behind its neighbours."""
    edges = [(5000, k) for k in range(2000)] + [(k, 10_000 + k) for k in range(2000)] + [(20_000, 20_001)]
    roots = dict(components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert len(roots) == 4001 and roots.pop(20_001) == 20_000 and set(roots.values()) == {0}


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(200, 200), (7, 3)]
    roots = dict(components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert {roots[i] for i in range(1, 41)} == {0} and {roots[k] for k in range(101, 140)} == {100}


def test_join_spread_equals_the_join_on_a_hot_key(spark):
    rows = spark.range(6000).select(F.when(F.col("id") < 2000, 0).otherwise(F.shiftright("id", 1)).alias("k"), F.col("id").alias("v"))
    groups = rows.groupBy("k").agg(F.max("v").alias("most"), F.count(F.lit(1)).alias("n"))
    some = groups.filter("k % 3 = 0")
    found = join_spread(rows, some, "k", ["v"]).select("k", "v", "most", "n")
    assert Counter(found.collect()) == Counter(rows.join(some, "k").select("k", "v", "most", "n").collect())
    none = groups.limit(0)
    assert join_spread(rows, none, "k", ["v"]).count() == 0


def test_op2(spark, messy):
    columns = ("doc_id", "keep_id", "group_size", "text_sha256")
    assert got(spark, "op2_exact_dedup", messy, *columns) == Counter(brute.op2(messy.docs))
    rows = QUERIES["op2_exact_dedup"](spark, messy.dir).filter("kept").collect()
    assert len(rows) == len({r["text_sha256"] for r in rows}) and all(r["doc_id"] == r["keep_id"] for r in rows)


def test_op2_bytes_decide_when_digests_collide(spark, messy):
    docs = spark.read.parquet(f"{messy.dir}/documents.parquet")
    weak = exact_dedup.assign_groups(docs, digest=lambda t: F.substring(F.sha2(t.cast("binary"), 256), 1, 1))
    found = Counter(tuple(r) for r in weak.select("doc_id", "keep_id", "group_size").collect())
    assert found == Counter(r[:3] for r in brute.op2(messy.docs))
    assert weak.filter("kept").count() == len({brute.lower(t) for _, t, _ in messy.docs})


def test_op2_filter_only_drops_what_is_not_there(spark):
    rows = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("digest"), "id")
    keys = rows.filter("id % 50 = 0").select("digest")
    left = {r["id"] for r in exact_dedup.maybe_in(rows, keys).collect()}
    assert {i for i in range(5000) if i % 50 == 0} <= left and len(left) < 150
    assert exact_dedup.maybe_in(rows, keys.limit(0)).collect() == []


def test_op3(spark, messy):
    rows = QUERIES["op3_sharding"](spark, messy.dir).collect()
    wanted = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in messy.docs)
    assert Counter(tuple(r)[:3] for r in rows) == wanted
    slots = [sorted(r["slot"] for r in rows if r["shard"] == s) for s in range(16)]
    assert all(x == list(range(len(x))) for x in slots)
    assert max(map(len, slots)) - min(map(len, slots)) <= 1


def test_op3_matrix_and_parts(spark):
    for seed in range(20):
        m = sharding.communication_matrix(np.array([5, 0, 70, 1]), sharding.shard_sizes(76, 16), seed)
        assert m.sum(1).tolist() == [5, 0, 70, 1] and m.sum(0).tolist() == sharding.shard_sizes(76, 16).tolist()
    # a table of two rows and two shards: the first row goes to either shard about equally often
    ones = sum(int(sharding.communication_matrix(np.array([1, 1]), np.array([1, 1]), s)[0, 0]) for s in range(400))
    assert 140 < ones < 260
    placed = sharding.shuffle_into_shards(spark.range(1000), shards=3, part_rows=50).collect()
    for s in range(3):
        assert sorted(r["slot"] for r in placed if r["shard"] == s) == list(range(334 if s == 0 else 333))


def test_op3_draws_beyond_numpys_range():
    rng = np.random.default_rng(8)
    # chi-square against the exact law
    ways = lambda a, k: math.lgamma(a + 1) - math.lgamma(k + 1) - math.lgamma(a - k + 1)
    for good, bad, draws in ((700, 300, 100), (40, 5000, 300), (90_000, 60_000, 40_000), (5, 3, 6)):
        x = np.arange(max(0, draws - bad), min(good, draws) + 1)
        p = np.exp([ways(good, int(k)) + ways(bad, draws - int(k)) - ways(good + bad, draws) for k in x])
        cell = np.searchsorted(np.linspace(0.05, 0.95, 19), np.cumsum(p))
        wanted = 10000 * np.bincount(cell, p, 20)
        drawn = np.array([sharding.large_hypergeometric(rng, good, bad, draws) for _ in range(10000)])
        found = np.bincount(cell[drawn - x[0]], minlength=20)
        some = wanted > 0
        assert ((found - wanted)[some] ** 2 / wanted[some]).sum() < some.sum() + 5 * np.sqrt(2 * some.sum())
    # mean and deviation of a large urn
    big = np.array([sharding.large_hypergeometric(rng, 3 * 10**9, 17 * 10**9, 10**6) for _ in range(400)])
    assert abs(big.mean() - 150_000) < 6 * 357 / 20 and 0.8 < big.std() / 357 < 1.2
    assert sharding.large_hypergeometric(rng, 2 * 10**9, 0, 5) == 5 and sharding.large_hypergeometric(rng, 0, 2 * 10**9, 5) == 0


def test_op3_matrix_of_many_large_blocks():
    import time

    blocks = np.random.default_rng(1).integers(50_000, 150_000, 200_000)
    sizes = sharding.shard_sizes(int(blocks.sum()), 16)
    start = time.time()
    m = sharding.communication_matrix(blocks, sizes, 3)
    assert time.time() - start < 60 and int(blocks.sum()) > 19 * 10**9
    assert (m.sum(1) == blocks).all() and (m.sum(0) == sizes).all() and (m >= 0).all()
    assert sharding.communication_matrix(np.array([], np.int64), sharding.shard_sizes(0, 4), 1).shape == (0, 4)


def test_op3_every_arrangement_is_equally_likely(spark):
    # 6 rows in 3 blocks of 2, 3 shards of 2: each of the 90 ways to fill the shards, by matrix and permutations
    made = Counter()
    for seed in range(3000):
        m = sharding.communication_matrix(np.array([2, 2, 2]), np.array([2, 2, 2]), seed)
        made[tuple(m.ravel())] += 1
    ways = {t: 8 / np.prod([np.prod([[1, 1, 2][x] for x in t[3 * i : 3 * i + 3]]) for i in range(3)]) for t in made}
    assert len(made) == 21 and sum(ways.values()) == 90
    assert sum((made[t] - 3000 * w / 90) ** 2 / (3000 * w / 90) for t, w in ways.items()) < 21 + 5 * np.sqrt(42)


def test_op4(spark, messy):
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got(spark, "op4_suffix_dedup", messy, *columns) == Counter(brute.op4(messy.docs))


def test_op4_small_shards_and_hot_anchors(spark, messy):
    import hashlib

    docs = spark.read.parquet(f"{messy.dir}/documents.parquet")
    wanted = Counter(brute.op4(messy.docs, 40))
    for options in ({"shard_bytes": 4000, "buckets": 3}, {"shard_bytes": 3000, "buckets": 5, "hot_shards": 2}):
        rows = suffix_dedup.remove_repeats(docs, size=40, **options).collect()
        found = Counter((r[0], r[1], r[2], len(r[3]), hashlib.sha256(r[4]).hexdigest()) for r in rows)
        assert found == wanted


def test_op4_passage_in_every_shard(spark):
    """Of a window that all shards hold one copy a slice of shards goes to the last merge."""
    import hashlib

    rng = np.random.default_rng(9)
    passage = bytes(rng.integers(97, 123, 300, dtype=np.uint8)).decode()
    docs = [(i, "".join(map(chr, rng.integers(97, 123, 1500))) + passage + str(i), "en") for i in range(60)]
    docs += [(100 + i, "".join(map(chr, rng.integers(97, 123, 1500))) + passage[40:], "en") for i in range(20)]
    table = spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string")
    size, buckets, hot_shards = 100, 7, 10
    rows = suffix_dedup.remove_repeats(table, size=size, shard_bytes=1600, buckets=buckets, hot_shards=hot_shards).collect()
    found = Counter((r[0], r[1], r[2], len(r[3]), hashlib.sha256(r[4]).hexdigest()) for r in rows)
    assert found == Counter(brute.op4(docs, size))

    shards = suffix_dedup.make_shards(table, 1600)
    n = shards.count()
    answers = suffix_dedup.repeated_anchors(shards, size, buckets)
    search = suffix_dedup.search_shard(size, buckets, hot_shards)
    sent = shards.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(search, suffix_dedup.STEP)

    def copies(steps, kind):
        out = Counter()
        for r in steps.filter(f"kind = {kind}").collect():
            columns = np.frombuffer(r["a"], np.int64).reshape(6, -1)
            text = bytes(suffix_dedup.unpacked(r["b"], int(columns[5].sum())))
            at = np.cumsum(columns[5]) - columns[5]
            out.update(text[a : a + m] for a, m in zip(at.tolist(), columns[5].tolist()))
        return out

    before, after = copies(sent, 2), copies(suffix_dedup.merge_parts(sent, n, size, hot_shards), 1)
    assert n == 80 and max(before.values()) == 80 and len(before) > 150
    assert all(after[w] <= -(-n // hot_shards) for w in before)


def test_op5(spark, messy):
    rows = QUERIES["op5_lm_scoring"](spark, messy.dir).collect()
    exact = Counter((r[0], r[1], r[2], r[3], r[4], round(r[5], 6)) for r in rows)
    assert exact == Counter((*r[:5], round(r[5], 6)) for r in brute.op5(messy.docs))
    assert all(r["score"] <= 0 for r in rows)
    learned = [r for r in rows if not r["held_out"] and r["n_tokens"] > 50]
    assert sum(r["score"] > r["base_score"] for r in learned) > 0.9 * len(learned)


def test_op5_filter_grows_with_the_ngrams(spark, tmp_path):
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in rng.permutation(40000)]  # no word or pair occurs twice
    docs = [(i, " ".join(words[i * 500 : i * 500 + 500]), "en") for i in range(80)]
    tables = write_tables(tmp_path / "op5", docs, [], [])
    rows = {r["doc_id"]: r for r in QUERIES["op5_lm_scoring"](spark, tables).collect()}
    wanted = dict(brute.op5_score(docs))
    off = [abs(rows[i]["score"] - wanted[i]) / rows[i]["n_tokens"] for i in wanted]
    assert len(off) == 80 and max(off) < 0.02  # in log10 a token


def test_op5_equals_the_quantised_counts(spark, messy):
    docs = documents(spark, messy.dir).select("doc_id", "text")
    rows = lm_scoring.score_documents(docs, mod_crc(7) != 2, bits_per_item=64).select("doc_id", "n_tokens", "score").collect()
    wanted = sorted(((i is None, i or 0), s) for i, s in brute.op5_score(messy.docs))
    found = sorted((((r[0] is None, r[0] or 0), r[2], r[1]) for r in rows))
    assert [f[0] for f in found] == [w[0] for w in wanted]
    assert all(abs(f[1] - w[1]) < 1e-9 * f[2] for f, w in zip(found, wanted))


@pytest.mark.parametrize("order, probers, bits", [(1, 1 << 14, 64), (2, 1, 64), (3, 1 << 14, 1024)])
def test_op5_orders_and_copies_of_slices(spark, messy, monkeypatch, order, probers, bits):
    # three orders ask for more n-grams: at 64 bits one of them is a false positive now and then
    monkeypatch.setattr(lm_scoring, "PROBERS", probers)
    docs = documents(spark, messy.dir).select("doc_id", "text").repartition(3)
    scored = lm_scoring.score_documents(docs, mod_crc(7) != 2, bits_per_item=bits, order=order)
    rows = scored.select("doc_id", "n_tokens", "score").collect()
    wanted = sorted(((i is None, i or 0), s) for i, s in brute.op5_score(messy.docs, order=order))
    found = sorted((((r[0] is None, r[0] or 0), r[2], r[1]) for r in rows))
    assert [f[0] for f in found] == [w[0] for w in wanted]
    assert all(abs(f[1] - w[1]) < 1e-9 * f[2] for f, w in zip(found, wanted))


def test_op5_probes_see_only_the_written_bits(spark, messy):
    corpus = lm_scoring.code_corpus(documents(spark, messy.dir), mod_crc(7) != 2)
    slices = lm_scoring.learn_slices(corpus, 2, 8, 16)
    assert slices.columns == ["bucket", "highest", "n_bits", "bits"]

    def levels(held):
        rows = lm_scoring.probe_slices(corpus, held, 2, 8, corpus.count()).collect()
        return np.concatenate([lm_scoring.unpacked(r["levels"], np.uint8, r["size"]) for r in rows])

    full = slices.withColumn("highest", F.lit(3)).withColumn("bits", F.expr("unhex(repeat('FF', length(bits)))"))
    assert set(levels(full)) == {3} and set(levels(slices.limit(0))) == {0}
    assert len(set(levels(slices))) > 2


def test_op5_a_second_copy_raises_the_score_of_its_text_most(spark, tmp_path):
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{k}" for k in rng.zipf(1.3, 200) % 500) for _ in range(60)]

    def scores(name, n):  # texts from the start again after the last one
        tables = write_tables(tmp_path / name, [(i, texts[i % 60], "en") for i in range(n)], [], [])
        rows = lm_scoring.score_documents(documents(spark, tables), F.lit(True), order=3).collect()
        return {r["doc_id"]: r["score"] for r in rows}

    once, twice = scores("once", 60), scores("twice", 70)
    gain = [twice[i] - once[i] for i in range(60)]
    assert min(gain[:10]) > max(gain[10:]) and all(twice[i] == twice[60 + i] for i in range(10))


def test_op5_levels_end_at_the_highest_written():
    keys = np.arange(1, 2001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A)
    full = np.ones(512, bool)
    level = lm_scoring.read_levels(full, 3, keys)
    assert set(level) == {3} and np.isfinite(lm_scoring.estimates(level)).all()
    counts = np.arange(1, 2001)
    held, highest = lm_scoring.make_slice(keys, lm_scoring.quantise(counts), 16)
    read = lm_scoring.read_levels(held, highest, keys)
    assert (read >= lm_scoring.quantise(counts)).all() and np.mean(read == lm_scoring.quantise(counts)) > 0.98
    others = lm_scoring.read_levels(held, highest, keys + np.uint64(1))
    assert np.mean(others > 0) < 0.01


def test_op6_accuracy_on_held_out_rows(spark, sf_smoke):
    sf = sf_smoke.replace("0.001", "0.01")
    labels = dict(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality").collect())
    rows = [r for r in QUERIES["op6_quality"](spark, sf).collect() if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in rows]) > 0.93
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_op6_messy(spark, messy):
    rows = QUERIES["op6_quality"](spark, messy.dir).collect()
    assert Counter((r["doc_id"], r["held_out"]) for r in rows) == Counter((i, brute.fold(i, 3) == 1) for i, _, _ in messy.docs)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_op6_scores_equal_plain_statistics_and_rules(spark, messy, monkeypatch):
    fitted, fit = [], quality_rules.fit
    monkeypatch.setattr(quality_rules, "fit", lambda *args: fitted.append(fit(*args)) or fitted[-1])
    found = {}
    for r in QUERIES["op6_quality"](spark, messy.dir).collect():
        found.setdefault(r["doc_id"], []).append(r["score"])
    (model,) = fitted
    assert model.rules  # both labels are there to learn from
    wanted = {}
    for i, text, _ in messy.docs:
        held = brute.statistics(text or "")
        rules = [all(held[s] > t if above else held[s] <= t for s, above, t in r.conditions) for r in model.rules]
        total = model.bias + sum(w for w, on in zip(model.weights, rules) if on)
        wanted.setdefault(i, []).append(1 / (1 + math.exp(-total)))
    assert found.keys() == wanted.keys()
    assert all(sorted(found[i]) == pytest.approx(sorted(wanted[i]), rel=1e-9) for i in wanted)


def test_op6_tree_paths():
    text = """DecisionTreeClassificationModel
  If (feature 0 <= 0.5)
   If (feature 1 <= 2.0)
    Predict: 0.0
   Else (feature 1 > 2.0)
    Predict: 1.0
  Else (feature 0 > 0.5)
   Predict: 1.0
"""
    found = {r.conditions for r in quality_rules.tree_rules(text, ["a", "b"])}
    assert found == {
        (("a", False, 0.5),), (("a", True, 0.5),),
        (("a", False, 0.5), ("b", False, 2.0)), (("a", False, 0.5), ("b", True, 2.0)),
    }


def test_op7(spark, messy):
    columns = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    wanted = brute.op7(messy.docs, license_scan.BASE_PHRASES, license_rules.RULES)
    assert got(spark, "op7_license_scan", messy, *columns) == Counter(wanted)


def test_op7_containment_and_priority(spark):
    texts = [
        "Licensed under the Apache License, Version 2.0", "GNU General Public License version 3 or any later version",
        "CC BY-NC-SA 4.0", "Simplified BSD license", "nothing here",
    ]
    rows = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [rows[i]["scan"]["labels"] for i in (0, 3, 4)] == [["Apache-2.0"], ["BSD-2-Clause"], []]
    assert "GPL-3.0-or-later" in rows[1]["scan"]["labels"] and "GPL-3.0" not in rows[1]["scan"]["labels"]
    assert "CC-BY-NC-SA-4.0" in rows[2]["scan"]["labels"] and "CC-BY-NC-SA" not in rows[2]["scan"]["labels"]


def test_op7_many_matches_in_one_text(spark):
    import time

    many = "mit license and " * 64_000
    docs = spark.createDataFrame([(1, many), (2, "mit license " * 300 + "tail")], "doc_id long, text string")
    license_scan.scan(docs.filter("doc_id = 2")).collect()
    start = time.time()
    rows = {r["doc_id"]: r["scan"] for r in license_scan.scan(docs).collect()}
    assert time.time() - start < 30
    assert rows[1]["n_words"] == 192_000 and rows[1]["labels"] == rows[2]["labels"] == ["MIT"]


def test_op7_places_over_chunks_equal_plain_ones(spark, monkeypatch):
    monkeypatch.setattr(license_scan, "CHUNK", 3)
    pieces_ = ["mit license", "apache license version 2 0", "cc by nc 4 0", "gpl v3", "lorem ipsum", "public domain", "bsd 3 clause license"]
    rng = np.random.default_rng(6)
    docs = [(i, " ".join(rng.choice(pieces_, rng.integers(0, 40))), "en") for i in range(60)]
    rows = license_scan.scan(spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string")).collect()
    found = Counter((r["doc_id"], ",".join(r["scan"]["labels"]), r["scan"]["score"]) for r in rows)
    wanted = brute.op7(docs, license_scan.BASE_PHRASES, license_rules.RULES)
    assert found == Counter((w[0], w[6], w[7]) for w in wanted)


def text_of(rng, parsed):
    """A text that a parsed regular expression matches, with every choice at random."""
    out = ""
    for op, arg in parsed:
        match str(op):
            case "LITERAL":
                out += chr(arg)
            case "IN":
                kind, one = arg[rng.integers(len(arg))]
                out += chr(one if str(kind) == "LITERAL" else rng.integers(one[0], one[1] + 1))
            case "SUBPATTERN":
                out += text_of(rng, arg[3])
            case "BRANCH":
                out += text_of(rng, arg[1][rng.integers(len(arg[1]))])
            case "MAX_REPEAT":
                out += "".join(text_of(rng, arg[2]) for _ in range(rng.integers(arg[0], arg[1] + 1)))
            case "ASSERT_NOT":
                pass
            case _:
                raise ValueError(op)
    return out


def test_op7_every_match_holds_its_keyword_and_an_anchor():
    import re

    rng = np.random.default_rng(7)
    for r in license_rules.RULES:
        for _ in range(40):
            text = text_of(rng, re._parser.parse(r.regex))
            assert re.fullmatch(r.regex, text), r
            assert r.keyword in text and any(a in text for a in license_rules.ANCHORS), (r, text)


def test_op7_headers_and_licence_texts(spark):
    """Labels of usual file headers, as their first and only ones."""
    headers = {
        "Apache": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS",
        "MIT": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "BSD-4-Clause": "All advertising materials mentioning features or use of this software must display the following acknowledgement: none",
        "BSD-3-Clause": "may be used to endorse or promote products derived from this software without specific prior written permission.",
        "GPL": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "LGPL": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "MPL": "This Source Code Form is subject to the terms of the Mozilla Public License",
        "Unlicense": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary",
        "Zlib": "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.",
        "Artistic": "You may use it under the same terms as Perl itself.",
        "CC": "See https://creativecommons.org/licenses/by-nc-sa/4.0/ there",
        "CC0-1.0": "See https://creativecommons.org/publicdomain/zero/1.0/ there",
        "QPL-1.0": "Q Public License, version 1.0", "OpenRAIL": "the BigScience OpenRAIL-M license",
        "No-permission": "No part of this book may be reproduced in any form without written permission",
        "Warranty-disclaimer": "The author disclaims all warranties and more",
    }
    docs = [(i, t, "en") for i, t in enumerate(headers.values())]
    found = license_scan.scan(spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string")).orderBy("doc_id").collect()
    method = [[x for x in r["scan"]["labels"] if x not in license_scan.BASE_PHRASES.values()] for r in found]
    assert method == [[label] for label in headers]
    wanted = brute.op7(docs, license_scan.BASE_PHRASES, license_rules.RULES)
    assert [(",".join(r["scan"]["labels"]), r["scan"]["score"]) for r in found] == [(w[6], w[7]) for w in wanted]


def test_op8(spark, messy):
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got(spark, "op8_decontamination", messy, *columns) == Counter(brute.op8(messy.docs, messy.benchmark))


def test_op8_in_blocks(spark, messy):
    docs, benchmark = (spark.read.parquet(f"{messy.dir}/{t}.parquet") for t in ("documents", "benchmark"))
    rows = decontam.find(docs.select("doc_id", "text"), benchmark, shard_bytes=3000, block_bytes=1500).collect()
    found = Counter((r[0], r["hits"]["n_words"], sum(s["last"] - s["first"] + 1 for s in r["hits"]["spans"]), len(r["hits"]["items"])) for r in rows)
    assert found == Counter(r[:4] for r in brute.op8(messy.docs, messy.benchmark))


def test_op8_blocks_follow_distinct_items(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(decontam.Windows, "of", staticmethod(lambda items, size: taken.append(items)))
    items = [(i, f"item {i} " + "w " * 20) for i in range(30)]
    benchmark = spark.createDataFrame(items + [items[3]] * 500, "item_id long, text string")
    list(decontam.blocks_of(benchmark, 10, 200))
    assert sorted(t for b in taken for t in b) == sorted((str(i), t.encode()) for i, t in items)


def test_op9_round_trip(spark, messy):
    rows = QUERIES["op9_sentencepiece"](spark, messy.dir).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(d[0] for d in messy.docs)
    assert all(r["round_trip"] for r in rows)
    assert all(r["second_score"] is None or r["second_score"] <= r["score"] for r in rows)
    assert all((r["n_pieces"] == 0) == (r["score"] == 0.0) for r in rows)


def test_op9_columns_equal_a_plain_two_best_search(spark, messy):
    model = pieces.PieceModel.read(PIECE_MODEL)

    def plain(text):
        """The two best segmentations, as score and linked ids."""
        line = pieces.SPACE + pieces.escape(text)
        best = [[(0.0, None)]]
        for into in model.edges(line)[1:]:
            ways = [(s + model.scores.get(p, model.unknown_score), (p, back)) for i, p in into for s, back in best[i]]
            best.append(sorted(ways, key=lambda w: -w[0])[:2])
        made = []
        for score, back in best[-1]:
            ids = []
            while back:
                ids.append(model.piece_ids(back[0]))
                back = back[1]
            made.append((score, [i for piece in reversed(ids) for i in piece]))
        return made

    texts = {}
    for i, text, _ in messy.docs:
        texts.setdefault(i, set()).add(text or "")
    compared = 0
    for r in QUERIES["op9_sentencepiece"](spark, messy.dir).collect():
        if len(texts[r["doc_id"]]) > 1:
            continue  # rows that share an id
        (text,) = texts[r["doc_id"]]
        if not text:
            assert (r["n_pieces"], r["score"], r["second_score"]) == (0, 0.0, None)
            continue
        (score, ids), *second = plain(text)
        assert r["score"] == pytest.approx(score, rel=1e-9)
        assert (r["second_score"] is None) == (not second)
        assert not second or r["second_score"] == pytest.approx(second[0][0], rel=1e-9)
        if not second or score - second[0][0] > 1e-6:  # else two segmentations are equally good
            assert r["n_pieces"] == len(ids)
            assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
            compared += 1
    assert compared > 50


def test_op9_nbest_equals_all_segmentations():
    model = pieces.PieceModel.read(PIECE_MODEL)
    decode = model.decoder().decode

    def every(text):
        line = pieces.SPACE + pieces.escape(text)
        into = model.edges(line)
        paths = [{(0.0, ())}]
        for j in range(1, len(line) + 1):
            paths.append({(s + model.scores.get(p, model.unknown_score), ids + model.piece_ids(p)) for i, p in into[j] for s, ids in paths[i]})
        return sorted((s for s, _ in paths[-1]), reverse=True)

    texts = ["the cat", "a b", "Hello  w", "x", "  ", "né ▁z", "\n\nab", "日本 a", "then the", "﷐ \x00"]
    for text, found in zip(texts, model.encode(texts, 6)):
        assert [s for s, _ in found] == every(text)[:6]
        assert len({tuple(ids.tolist()) for _, ids in found}) == len(found)
        assert all(decode(ids.tolist()) == text for _, ids in found)


def test_op10_accuracy_on_held_out_rows(spark, sf_smoke):
    sf = sf_smoke.replace("0.001", "0.01")
    langs = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect())
    rows = [r for r in QUERIES["op10_language_id"](spark, sf).collect() if r["held_out"]]
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in rows]) > 0.97


def test_op10_messy(spark, messy):
    rows = QUERIES["op10_language_id"](spark, messy.dir).collect()
    assert Counter((r["doc_id"], r["held_out"]) for r in rows) == Counter((i, brute.fold(i, 4) == 2) for i, _, _ in messy.docs)
    known = {lang for i, t, lang in messy.docs if brute.fold(i, 4) != 2 and lang}
    by_id = {r["doc_id"]: r for r in rows}
    for i, t, _ in messy.docs:
        letters = any(c.isalpha() for c in t or "")
        if i is not None:
            assert (by_id[i]["lang_pred"] == "und") == (not letters)
            assert by_id[i]["lang_pred"] in known | {"und"} and 0 <= by_id[i]["score"] <= 1


def test_language_stage_keeps_every_text_with_a_letter(spark, messy, tmp_path):
    has_letter = lambda t: any(c.isalpha() for c in t or "")
    short = [(2000 + i, t, "en") for i, t in enumerate(["a", "ok", "e", "la", "der the le", "no 1", "zz zz", "\u65e5"])]
    docs = [d for d in messy.docs if d[0] != 1010] + short
    docs += [(3000 + i, d[1], f"l{i}") for i, d in enumerate(docs[:20])]  # more languages share the probability
    for name, rows in (("many", docs), ("none", [(i, t, None) for i, t, _ in docs])):
        sf = write_tables(tmp_path / name, rows, [], [])
        kept = corpus_pipeline.language_id(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)
        assert Counter(tuple(r) for r in kept.select("doc_id", "text").collect()) == Counter((i, t) for i, t, _ in rows if has_letter(t)), name


def test_op10_numbers_are_no_letters(spark):
    texts = ["\u00b2\u00bd 12", "\u2460 \u2167 \u00be", "\u00bd" * 5000, "\u00bd a", "\u02b0", "_ 1", "\u4e00"]
    rows = [(i, t, None) for i, t in enumerate(texts)] + [(100 + i, f"text {i}", "en") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lang_id.train(docs)
    found = dict(docs.select("doc_id", lang_id.predict_column(docs, model, F.col("text"))["lang_pred"]).collect())
    assert [found[i] for i in range(7)] == ["und", "und", "und", "en", "en", "und", "en"]
    assert {r["doc_id"] for r in lang_id.keep_known(docs, model).collect()} == {3, 4, 6} | set(range(100, 120))


def test_op10_sample_of_many_copies_is_the_least_hashes(spark):
    rows = [(1, "copy", "en")] * 3000 + [(i, f"t{i}", "en") for i in range(2, 400)] + [(i, "x", "de") for i in range(1000, 1005)]
    hashed = spark.createDataFrame(rows, "doc_id long, text string, lang string").select("lang", F.xxhash64("doc_id", "text").alias("at"))
    wanted = {}
    for lang, at in set(map(tuple, hashed.collect())):
        wanted.setdefault(lang, []).append(at)
    for each in (3, 150, 5000):
        found = Counter(map(tuple, lang_id.least_orders(hashed, each).collect()))
        assert found == Counter((lang, a) for lang, at in wanted.items() for a in sorted(at)[:each])


def test_op10_prediction_equals_a_plain_one(spark, messy):
    docs = documents(spark, messy.dir).select("doc_id", "text", "lang")
    model = lang_id.train(docs.filter(mod_crc(4) != 2))
    made = {(r[0], r[1]) for r in docs.select("text", lang_id.predict_column(docs, model, F.col("text"))["lang_pred"]).collect()}
    for text, lang in made:
        if not any(c.isalpha() for c in text or ""):
            assert lang == "und"
            continue
        grams = Counter()
        low = text.lower()
        for n in (1, 2, 3):
            for i in range(len(low) - n + 1):
                code = 0
                for c in low[i : i + n]:
                    code = (code * 0x110000 + ord(c)) % 2**64
                grams[((code + n) * 0x9E3779B97F4A7C15 % 2**64) >> 48] += 1
        x = {f: (1 + np.log(c)) * model.idf[f] for f, c in grams.items()}
        norm = np.sqrt(sum(v * v for v in x.values()))
        z = sum(v / norm * model.weights[f] for f, v in x.items()) + model.bias
        assert np.sort(z)[-1] - z[model.langs.index(lang)] < 1e-9


def test_op10_sample_has_every_language(spark):
    rows = [(i, f"text {i}", f"l{i % 900}") for i in range(9000)] + [(7, "text 7", "l7")] * 300
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6)
    drawn = lang_id.training_sample(train, 100)
    assert Counter(r[0] for r in drawn) == {f"l{k}": 1 for k in range(900)}
    drawn = lang_id.training_sample(train, 2700)
    assert Counter(r[0] for r in drawn) == {f"l{k}": 3 for k in range(900)}


def test_op10_ngrams_of_a_long_text_do_not_depend_on_chunks(monkeypatch):
    text = "abcdé ü" * 30
    whole = lang_id.ngram_counts(text)
    for chunk in (1, 2, 3, 7, 50):
        monkeypatch.setattr(lang_id, "CHUNK", chunk)
        found = lang_id.ngram_counts(text)
        assert all((a == b).all() for a, b in zip(whole, found))


def test_pipeline_equals_plain_stages(spark, messy):
    docs = spark.read.parquet(f"{messy.dir}/documents.parquet")
    columns, sf = docs.columns, messy.dir
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, tables[-1], sf)
        rows = out.collect()
        if name != "sentencepiece":
            assert out.columns == columns, name
        tables.append(spark.createDataFrame(rows, out.schema))
    text = lambda df: [(r["doc_id"], r["text"], r["lang"]) for r in df.collect()]
    all_, known, exact, near, clean, coded = (text(t) for t in tables)
    assert all(any(c.isalpha() for c in t or "") for _, t, _ in known) and len(known) > 0.8 * len(all_)
    groups = brute.op2(known)
    wanted = {(i, brute.lower(t)) for (i, t, _), g in zip(known, groups) if i == g[1]}
    assert {(i, brute.lower(t)) for i, t, _ in exact} == wanted and len(exact) == len({brute.lower(t) for _, t, _ in known})
    components_ = brute.op1(exact)
    assert sorted((i for i, _, _ in near), key=brute.first_id) == sorted({c for _, _, c in components_}, key=brute.first_id)
    clean_ids = {r[0] for r in brute.op8(near, messy.benchmark) if not r[5]}
    assert {i for i, _, _ in clean} == clean_ids
    assert coded == clean and all(r["round_trip"] for r in tables[-1].collect())
    assert Counter(r["doc_id"] for r in corpus_pipeline.run(spark, sf).collect()) == Counter(i for i, _, _ in coded)
