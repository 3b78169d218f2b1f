"""The registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.xxh64_sql import xxh64
from . import (
    decontam,
    exact_dedup,
    lang_id,
    license_scan,
    lm_scoring,
    mixing,
    pieces,
    quality_rules,
    sharding,
    simhash,
    suffix_dedup,
    vector_codes,
    whitening,
)
from .common import documents, mod_crc


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(documents(spark, sf_dir), words=3, most_bits=3)
    return groups.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.assign_groups(documents(spark, sf_dir))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text").cast("binary")
    rows = documents(spark, sf_dir).select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit(b""))).alias("text_crc32"),
    )
    placed = sharding.shuffle_into_shards(rows, shards=16)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"), size=100)
    return cut.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    scored = lm_scoring.score_documents(docs, learn=mod_crc(7) != 2)
    return scored.select(
        "doc_id",
        (~F.col("learns")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    held_out = mod_crc(3) == 1
    scored = quality_rules.score_texts(docs, labels, learn=~held_out)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        "doc_id",
        "scan.n_words",
        "scan.n_base",
        "scan.first_word",
        "scan.last_word",
        F.array_join("scan.base_labels", ",").alias("base_labels"),
        F.array_join("scan.labels", ",").alias("labels"),
        "scan.score",
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontam.find(documents(spark, sf_dir).select("doc_id", "text"), benchmark, window=10)
    n_hit = decontam.hit_words()
    return found.select(
        "doc_id",
        "hits.n_words",
        n_hit.alias("n_hit"),
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hits.items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op9_sentencepiece(spark: SparkSession, sf_dir: str, model_path: str = PIECE_MODEL) -> DataFrame:
    """Digests of the best segmentation of every whole text (number of pieces,
    hash of the ids), the scores of the two best, and whether decoding the ids
    gives the text back."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = pieces.PieceModel.read(model_path)
    coded = pieces.encode(docs, model, into="coded", nbest=2)
    decoded = pieces.decode_column(docs, model, F.col("coded.ids"))
    return coded.select(
        "doc_id",
        F.size("coded.ids").cast("long").alias("n_pieces"),
        F.sha2(F.array_join("coded.ids", " ").cast("binary"), 256).alias("ids_sha256"),
        "coded.score",
        F.get("coded.others", F.lit(0))["score"].alias("second_score"),
        (decoded == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    held_out = mod_crc(4) == 2
    model = lang_id.train(docs.filter(~held_out))
    guess = docs.select(
        "doc_id", held_out.alias("held_out"), lang_id.predict_column(docs, model, F.col("text")).alias("guess")
    )
    return guess.select("doc_id", "held_out", "guess.lang_pred", "guess.score")


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(documents(spark, sf_dir), weights=(1, 2, 3), most_epochs=3)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress(embeddings(spark, sf_dir), parts=8, entries=16, rounds=6, scale=4096)
    sha = F.lit(vector_codes.digest(books)).alias("codebooks_sha256")
    return coded.select("vec_id", "code", "error", "label_error", sha)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(embeddings(spark, sf_dir), components=16, scale=64, shift=1_000_000)


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_sharding": op3_sharding,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_quality": op6_quality,
    "op7_license_scan": op7_license_scan,
    "op8_decontamination": op8_decontamination,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_language_id": op10_language_id,
    "op11_mixing": op11_mixing,
    "op12_vector_codes": op12_vector_codes,
    "op13_whitening": op13_whitening,
}

# whole texts with A-Z lower-cased, and the word pattern of the contract, in DuckDB
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def vector_codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Lloyd's rounds in SQL, one after the other, a component a row."""
    steps = [f"""
        k AS (
            SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST) - 1 AS r, embedding AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
        x AS MATERIALIZED (
            SELECT r, j // (len(v) // {parts}) AS p, j, CAST(floor(4096 * v[j + 1]) AS BIGINT) AS x
            FROM (SELECT r, v, unnest(range(len(v))) AS j FROM k)),
        b0 AS MATERIALIZED (SELECT p, r AS e, j, x AS y FROM x WHERE r < {entries})"""]
    for i in range(rounds + 1):
        steps.append(f"""
        a{i} AS MATERIALIZED (
            SELECT r, p, e, d FROM (
                SELECT r, p, e, sum((x - y) * (x - y)) AS d, row_number() OVER (PARTITION BY r, p ORDER BY sum((x - y) * (x - y)), e) AS n
                FROM x JOIN b{i} USING (p, j) GROUP BY r, p, e) WHERE n = 1)""")
        if i < rounds:
            steps.append(f"""
        b{i + 1} AS MATERIALIZED (
            SELECT p, e, j, coalesce(m, y) AS y FROM b{i} LEFT JOIN (
                SELECT p, e, j, CAST(floor(sum(x) / count(*)) AS BIGINT) AS m FROM x JOIN a{i} USING (r, p) GROUP BY p, e, j)
            USING (p, e, j))""")
    return "WITH" + ",".join(steps) + f""",
        coded AS (
            SELECT r, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
            FROM a{rounds} GROUP BY r)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY p, e, j)) FROM b{rounds}) AS codebooks_sha256
        FROM k JOIN coded USING (r)"""


def simhash_sql(words: int = 3, most_bits: int = 3) -> str:
    """Every distinct shingle's XXH64 in SQL arithmetic, bits counted a text, all pairs of distinct
    fingerprints compared, and what each one reaches by links."""
    ones = ", ".join(f"sum(n * ((h >> {b}) & 1)) AS b{b}" for b in range(64))
    bits = " + ".join(f"(CASE WHEN 2 * b{b} > m THEN {2**b}::UBIGINT ELSE 0::UBIGINT END)" for b in range(64))
    return f"""
        WITH RECURSIVE d AS MATERIALIZED (
            SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        s AS MATERIALIZED (
            SELECT r, k, count(*) AS n FROM (
                SELECT r, array_to_string(w[i:i + {words - 1}], ' ') AS k
                FROM (SELECT r, w, unnest(range(1, greatest(len(w) - {words - 1}, 1) + 1)) AS i FROM d WHERE len(w) > 0))
            GROUP BY r, k),
        hashed AS MATERIALIZED (SELECT k, CAST({xxh64("k", "42::UHUGEINT")} AS UBIGINT) AS h FROM (SELECT DISTINCT k FROM s)),
        counted AS (SELECT r, sum(n) AS m, {ones} FROM s JOIN hashed USING (k) GROUP BY r),
        prints AS MATERIALIZED (SELECT doc_id, coalesce(f, 0::UBIGINT) AS f FROM d LEFT JOIN (SELECT r, {bits} AS f FROM counted) USING (r)),
        p AS MATERIALIZED (SELECT f, min(doc_id) AS least FROM prints GROUP BY f),
        links AS MATERIALIZED (SELECT a.f AS u, b.f AS v FROM p a JOIN p b ON a.f <> b.f AND bit_count(xor(a.f, b.f)) <= {most_bits}),
        reach AS (SELECT f, f AS g FROM p UNION SELECT reach.f, v FROM reach JOIN links ON u = g),
        named AS (SELECT reach.f, min(least) AS component_id FROM reach JOIN p ON p.f = g GROUP BY reach.f)
        SELECT doc_id, lpad(lower(to_hex(f)), 16, '0') AS fingerprint, component_id FROM prints JOIN named USING (f)"""


ORACLES = {
    "op1_simhash": simhash_sql(),
    "op11_mixing": r"""
        WITH t AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
        d AS (SELECT *, CAST(len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM t),
        s AS (
            SELECT source, sum(size) AS z, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w FROM d GROUP BY source),
        a AS (SELECT sum(z) AS z, sum(w) AS w FROM s),
        ranked AS (
            SELECT s.*, coalesce(sum(3 * s.z) OVER before, 0) AS zs, coalesce(sum(s.w) OVER before, 0) AS ws FROM s
            WINDOW before AS (ORDER BY s.z / s.w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        capped AS (SELECT r.*, 3 * r.z * (a.w - ws) <= (a.z - zs) * r.w AS at_cap FROM ranked r, a),
        free AS (
            SELECT CAST(sum(z) - coalesce(sum(3 * z) FILTER (WHERE at_cap), 0) AS DOUBLE) AS z, CAST(sum(w) FILTER (WHERE NOT at_cap) AS DOUBLE) AS w
            FROM capped),
        aims AS (
            SELECT source, CAST(c.z AS BIGINT) AS source_size,
                   CASE WHEN at_cap THEN CAST(3 * c.z AS DOUBLE) ELSE c.w * free.z / free.w END AS target
            FROM capped c, free),
        quality AS (
            SELECT *, CASE WHEN length(t) > 0 AND size > 0
                THEN 0.1::DOUBLE + 0.9::DOUBLE * (CAST(length(translate(t, '0123456789#$%&*+/<=>@[\]^_`{|}~', '')) AS DOUBLE) / length(t))
                     * CASE WHEN length(t) BETWEEN size * 3 AND size * 12 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END
                ELSE 0.1::DOUBLE END AS q
            FROM d),
        keyed AS (
            SELECT *, floor((ln(-ln((CAST('0x' || md5('11:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(t))[1:13] AS BIGINT) + 0.5::DOUBLE)
                                    / 4503599627370496)) - ln(q)) * 35184372088832) AS place
            FROM quality),
        summed AS (
            SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS upto
            FROM keyed),
        whole AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM aims)
        SELECT doc_id, size, source_size, target,
               CAST(size * (epochs + CASE WHEN 2 * (target - epochs * source_size - upto) >= size THEN 1 ELSE 0 END) AS BIGINT) AS taken
        FROM summed JOIN whole ON summed.source IS NOT DISTINCT FROM whole.source""",
    "op12_vector_codes": vector_codes_sql(),
    "op2_exact_dedup": """
        WITH d AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents)
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY t) AS keep_id,
               count(*) OVER (PARTITION BY t) AS group_size,
               row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
               sha256(t) AS text_sha256
        FROM d""",
    "op4_suffix_dedup": """
        WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, row_number() OVER (ORDER BY doc_id) AS r FROM documents),
        starts AS (
            SELECT r, i, b[i + 1:i + 100] AS k
            FROM (SELECT r, b, unnest(range(0, octet_length(b) - 99)) AS i FROM d WHERE octet_length(b) >= 100)),
        later AS (SELECT r, i FROM (SELECT r, i, row_number() OVER (PARTITION BY k ORDER BY r, i) AS n FROM starts) WHERE n > 1),
        steps AS (SELECT r, i, i - lag(i) OVER (PARTITION BY r ORDER BY i) AS back FROM later),
        runs AS (
            SELECT r, i, sum(CASE WHEN back <= 100 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS g FROM steps),
        spans AS (SELECT r, min(i) AS a, max(i) + 100 AS z FROM runs GROUP BY r, g),
        cuts AS (SELECT r, a, z, lag(z, 1, 0) OVER (PARTITION BY r ORDER BY a) AS before FROM spans),
        kept AS (
            SELECT r, sum(z - a) AS gone, count(*) AS n, max(z) AS z,
                   string_agg(CASE WHEN a > before THEN hex(b[before + 1:a]) ELSE '' END, '' ORDER BY a) AS s
            FROM cuts JOIN d USING (r) GROUP BY r)
        SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
               CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
               sha256(CASE WHEN n IS NULL THEN b
                           ELSE unhex(s || CASE WHEN octet_length(b) > z THEN hex(b[z + 1:]) ELSE '' END) END) AS kept_sha256
        FROM d LEFT JOIN kept USING (r)""",
    "op8_decontamination": f"""
        WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({LOWER}, '{WORDS}') AS w FROM documents),
        b AS (SELECT item_id, regexp_extract_all({LOWER}, '{WORDS}') AS w FROM benchmark),
        windows AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS k
            FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT size FROM windows),
        places AS (
            SELECT r, i, size, array_to_string(w[i:i + size - 1], ' ') AS k
            FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
        hits AS (SELECT p.r, p.i, p.size, item_id FROM places p JOIN windows USING (size, k)),
        words AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + size)) AS j FROM hits) GROUP BY r),
        items AS (
            SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s
            FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items.s, '')) AS items_sha256,
               coalesce(words.n, 0) > 0 AS contaminated
        FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)""",
}
