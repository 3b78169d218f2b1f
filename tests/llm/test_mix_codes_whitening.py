"""Mixing, vector codes and whitening against plain versions."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import mixing, vector_codes, whitening
from strata.llm.queries import ORACLES, QUERIES

from ..oracle_check import compare, duck
from . import brute
from .conftest import write_tables


@pytest.mark.parametrize("name", ["op1_simhash", "op11_mixing", "op12_vector_codes"])
def test_sql(spark, sf_smoke, name):
    assert compare(spark, name, sf_smoke, QUERIES[name], ORACLES[name], duck(sf_smoke))["status"] == "ok"


# ---- mixing
def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def check_mix(rows, docs, sources):
    sizes = Counter()
    for (_, t, _), s in zip(docs, sources):
        sizes[s] += words(t)
    target = brute.op11_targets(sizes)
    wanted = Counter((i, words(t), sizes[s], round(target[s], 6)) for (i, t, _), s in zip(docs, sources))
    assert Counter((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6)) for r in rows) == wanted
    assert all(r["taken"] % r["size"] == 0 and r["taken"] <= 3 * r["size"] if r["size"] else r["taken"] == 0 for r in rows)
    taken, largest, epochs = Counter(), Counter(), defaultdict(set)
    for r in rows:
        at = (r["source_size"], r["target"])  # sources of equal size and target are checked together
        taken[at] += r["taken"]
        largest[at] = max(largest[at], r["size"])
        if r["size"]:
            epochs[at].add(r["taken"] // r["size"])
    alike = Counter((sizes[s], round(target[s], 6)) for s in sizes)
    for at in taken:
        many = alike[at[0], round(at[1], 6)]
        assert abs(taken[at] - many * at[1]) <= many * largest[at] / 2 + 1e-6
        assert max(epochs[at], default=0) - min(epochs[at], default=0) <= 1  # complete epochs come first
    return target


def test_op11(spark, messy):
    rows = QUERIES["op11_mixing"](spark, messy.dir).collect()
    check_mix(rows, messy.docs, ["hot" if i % 3 else None for i in range(len(messy.docs))])
    again = QUERIES["op11_mixing"](spark, messy.dir).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))


def test_op11_caps_and_null_sources(spark, tmp_path):
    docs = [(i, "w " * (1 + i % 40), "en") for i in range(900)] + [(2000 + i, t, "en") for i, t in enumerate([None, "", "  "])]
    sources = [["a", "b", "c", "d", None][0 if i % 3 else i // 3 % 5] for i in range(900)] + ["empty"] * 3
    rows = QUERIES["op11_mixing"](spark, write_tables(tmp_path / "caps", docs, [], [], sources=sources)).collect()
    target = check_mix(rows, docs, sources)
    sizes = {s: t for s, t in target.items()}
    assert target["empty"] == 0 and any(t == 3 * sum(words(d[1]) for d, x in zip(docs, sources) if x == s) for s, t in sizes.items() if t)


def plain_mix(docs, sources, weight, seed=11):
    """Copies of each row by one sort of each source."""
    import hashlib

    sizes = Counter()
    for (_, t, _), s in zip(docs, sources):
        sizes[s] += words(t)
    target = brute.op11_targets(sizes)
    by_source = defaultdict(list)
    for k, ((i, t, _), s) in enumerate(zip(docs, sources)):
        inner = hashlib.md5((t or "").encode()).hexdigest()
        u = (int(hashlib.md5(f"{seed}:{'' if i is None else i}:{inner}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        by_source[s].append((-math.log(u) / weight(t or ""), k))
    copies = {}
    for s, keys in by_source.items():
        epochs = math.floor(target[s] / sizes[s]) if sizes[s] else 0
        left = target[s] - epochs * sizes[s]
        for _, k in sorted(keys):
            n = words(docs[k][1])
            copies[k] = epochs + (2 * left >= n) if n else 0
            left -= n
    return Counter((docs[k][0], n) for k, n in copies.items())


def prose(t):
    n = words(t)
    if not t or not n:
        return 0.1
    clean = sum(c not in mixing.MARKS for c in t) / len(t)
    return 0.1 + 0.9 * clean * (1.0 if 3 * n <= len(t) <= 12 * n else 0.5)


@pytest.mark.parametrize("cells,most_rows", [(4096, 1 << 16), (4, 5)])
def test_op11_equals_one_sort(spark, tmp_path, monkeypatch, cells, most_rows):
    monkeypatch.setattr(mixing, "CELLS", cells)
    rng = np.random.default_rng(1)
    docs = [(i, " ".join(rng.choice(["word", "a", "12", "longer", "x=y", "and"], rng.integers(0, 30))), "en") for i in range(1500)]
    sources = [["hot", "b", "c"][0 if i % 2 else i % 3] for i in range(1500)]
    sf = write_tables(tmp_path / "sort", docs, [], [], sources=sources)
    mixed = mixing.mix_sources(spark.read.parquet(f"{sf}/documents.parquet"), most_rows=most_rows)
    assert Counter(tuple(r) for r in mixed.select("doc_id", "copies").collect()) == plain_mix(docs, sources, prose)


def test_op11_repeated_rows_are_cut_one_by_one(spark, tmp_path):
    docs = [(7, "one two three", "en")] * 400 + [(i, "some other words here", "en") for i in range(100, 140)]
    sources = ["a"] * 400 + ["b"] * 40
    sf = write_tables(tmp_path / "ties", docs, [], [], sources=sources)
    table = spark.read.parquet(f"{sf}/documents.parquet")
    for most_rows in (1 << 16, 10):
        mixed = mixing.mix_sources(table, most_rows=most_rows, keep=("doc_id", "n_chars", "row"))
        rows = mixed.collect()
        assert mixed.columns[:3] == ["doc_id", "n_chars", "row"]
        check_mix(rows, docs, sources)
        assert mixing.repeated(mixed).count() == sum(r["copies"] for r in rows)


def test_op11_quality_moves_the_choice(spark):
    docs = spark.range(8000).select(
        F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.when(F.col("id") < 4000, "x").otherwise("y").alias("source")
    )
    good = F.col("doc_id") % 2 == 0
    mixed = mixing.mix_sources(docs, weights=(1, 3), most_epochs=2, quality=F.when(good, 8.0).otherwise(F.when(F.col("doc_id") % 3 == 0, None).otherwise(1.0)))
    taken = mixed.groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.sum("copies").alias("n")).collect()
    n = {r["odd"]: r["n"] for r in taken}
    assert n[0] > 1.3 * n[1] and n[0] + n[1] == 8000


# ---- vector codes
def test_op12(spark, messy):
    rows = QUERIES["op12_vector_codes"](spark, messy.dir).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
    assert Counter(tuple(r) for r in rows.collect()) == Counter(brute.op12(messy.vectors))


def test_op12_odd_lengths_large_values_and_few_rows(spark):
    rows = [(1, [0.5] * 8, 1), (2, [1e30] * 8, None), (3, [1.0] * 5, 1), (4, [], None), (5, [-0.25] * 8, 1)]
    frame = spark.createDataFrame(rows, "vec_id string, embedding array<double>, label int")
    coded, books = vector_codes.compress(frame)
    found = {r["vec_id"]: r for r in coded.collect()}
    assert [len(b) for b in books] == [3] * 8 and found["3"]["code"] is None and found["4"]["error"] is None
    assert [found[i]["code"] for i in "125"] == ["00" * 8, "01" * 8, "02" * 8] and found["2"]["error"] == 0
    assert found["4"]["label_error"] == 0 and found["3"]["label_error"] == 0
    uneven = vector_codes.part_dims(10, 8)
    assert [len(d) for d in uneven] == [2, 2, 1, 1, 1, 1, 1, 1] and uneven[-1] == range(9, 10)


def test_op12_dictionary_distances_equal_plain_ones():
    rng = np.random.default_rng(2)
    whole = rng.integers(-50, 50, (300, 6))
    entries = rng.integers(-50, 50, (5, 3))
    block = vector_codes.Block.unpacked(*vector_codes.Block.of(whole).packed())
    best, error = block.nearest(entries, range(2, 5))
    plain = ((whole[:, None, 2:5] - entries[None]) ** 2).sum(2)
    assert (best == plain.argmin(1)).all() and (error == plain.min(1)).all()


# ---- whitening
def plain_whitening(vectors, k=16):
    kept = [(i, v) for i, v, _ in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in kept]
    fit = sorted({tuple(r) for r in x})
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * a - b) / n for a, b in zip(r, s)] for r in fit])
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    rows = np.array([[(n * a - b) / n for a, b in zip(r, s)] for r in x])
    deviation = [sum((n * a - b) ** 2 for a, b in zip(r, s)) for r in x]
    return [i for i, _ in kept], n, deviation, rows @ v / np.sqrt(e), e / np.trace(centred.T @ centred / n)


def test_op13(spark, messy):
    rows = QUERIES["op13_whitening"](spark, messy.dir).collect()
    ids, n, deviation, whitened, explained = plain_whitening(messy.vectors)
    assert len(rows) == 16 * len(ids) and {r["n"] for r in rows} == {n}
    assert Counter((r["vec_id"], r["deviation"]) for r in rows) == Counter(
        {p: 16 * c for p, c in Counter(zip(ids, deviation)).items()}
    )
    for c in range(16):
        mine = [r for r in rows if r["component"] == c + 1]
        assert all(abs(r["explained"] / explained[c] - 1) < 1e-9 for r in mine)
        value = {r["vec_id"]: r["whitened"] for r in mine}
        at = {i: whitened[k, c] for k, i in enumerate(ids)}
        once = [i for i, m in Counter(ids).items() if m == 1 and i is not None]
        sign = 1 if value[once[0]] * at[once[0]] > 0 else -1
        assert all(abs(value[i] - sign * at[i]) < 1e-6 for i in once)
    assert {r["identity_error"] for r in rows} and rows[0]["identity_error"] < 1e-9


def test_op13_without_variance(spark):
    kinds = "vec_id long, embedding array<float>"
    one = spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25])], kinds)
    assert whitening.whiten(one).collect() == []
    # three points on a line, and vectors of another length: one component
    line = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 1.0]), (3, [2.0, 2.0]), (4, [1.0]), (5, []), (None, [2.0, 2.0])], kinds)
    rows = whitening.whiten(line).collect()
    assert Counter((r["vec_id"], r["component"]) for r in rows) == Counter([(1, 1), (2, 1), (3, 1), (None, 1)])
    assert {round(abs(r["whitened"]), 9) for r in rows} == {0.0, round(math.sqrt(1.5), 9)}
    assert all(abs(r["explained"] - 1) < 1e-9 and r["identity_error"] < 1e-9 for r in rows)


def test_op13_exact_sums_beyond_64_bits(spark):
    big = [(i, [float(2**23 * (i % 5)), float(i)]) for i in range(40)]
    rows = whitening.whiten(spark.createDataFrame(big, "vec_id long, embedding array<double>")).collect()
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in big]
    s = [sum(c) for c in zip(*x)]
    exact = {i: sum((40 * a - b) ** 2 for a, b in zip(r, s)) for i, r in enumerate(x)}
    found = {r["vec_id"]: r["deviation"] for r in rows}
    assert found == {i: d if d < 2**63 else None for i, d in exact.items()} and None in found.values()


def test_op13_blocks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "ROWS_PER_BLOCK", 7)
    monkeypatch.setattr(whitening, "COLUMNS_PER_BLOCK", 3)
    rng = np.random.default_rng(4)
    vectors = [(i, rng.normal(size=8).round(3).tolist(), 0) for i in range(100)]
    rows = whitening.whiten(spark.createDataFrame([v[:2] for v in vectors], "vec_id long, embedding array<double>")).collect()
    ids, n, deviation, whitened, explained = plain_whitening(vectors)
    found = {(r["vec_id"], r["component"]): r["whitened"] for r in rows}
    assert len(rows) == 800
    for c in range(8):
        mine = np.array([found[i, c + 1] for i in ids])
        assert np.allclose(np.abs(mine @ whitened[:, c]) / n, 1, atol=1e-9)
