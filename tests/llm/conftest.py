import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from ..conftest import SF_SMOKE

# columns that operators might use themselves
CLASHING = ["hits", "shard", "slot", "fp", "score", "digest", "scan", "piece_ids", "kept", "guess", "label", "row", "chunk"]


def write_tables(folder, docs, benchmark, labels, vectors=(), sources=None):
    """The tables that the queries read, as ``(doc_id, text, lang)``, ``(item_id, text)``,
    ``(doc_id, quality)`` and ``(vec_id, embedding, label)`` rows; documents and embeddings get
    extra columns with clashing names."""
    os.makedirs(folder / "documents.parquet")
    n = len(docs)
    table = {
        "doc_id": pa.array([d[0] for d in docs], pa.int64()),
        "text": pa.array([d[1] for d in docs], pa.string()),
        "lang": pa.array([d[2] for d in docs], pa.string()),
        "source": pa.array(sources or ["hot" if i % 3 else None for i in range(n)], pa.string()),
        "n_chars": pa.array([len(d[1] or "") for d in docs], pa.int64()),
    } | {c: pa.array(["x"] * n, pa.string()) for c in CLASHING}
    for i in range(3):  # several files
        part = pa.table({k: v[i::3] if n else v for k, v in ((k, v.to_pylist()) for k, v in table.items())}, pa.schema([(k, v.type) for k, v in table.items()]))
        pq.write_table(part, folder / "documents.parquet" / f"part-{i}.parquet")
    pq.write_table(
        pa.table({"item_id": pa.array([b[0] for b in benchmark], pa.int64()), "text": pa.array([b[1] for b in benchmark], pa.string())}),
        folder / "benchmark.parquet",
    )
    pq.write_table(
        pa.table({"doc_id": pa.array([x[0] for x in labels], pa.int64()), "quality": pa.array([x[1] for x in labels], pa.int32()), "toxic": pa.array([0] * len(labels), pa.int32())}),
        folder / "labels.parquet",
    )
    pq.write_table(
        pa.table(
            {
                "vec_id": pa.array([v[0] for v in vectors], pa.int64()),
                "embedding": pa.array([v[1] for v in vectors], pa.list_(pa.float32())),
                "label": pa.array([v[2] for v in vectors], pa.int32()),
            }
            | {c: pa.array(["x"] * len(vectors), pa.string()) for c in ("code", "error", "index", "row", "n", "component")}
        ),
        folder / "embeddings.parquet",
    )
    return str(folder)


class Tables:
    def __init__(self, folder, docs, benchmark, labels, vectors=()):
        self.docs, self.benchmark, self.labels, self.vectors = docs, benchmark, labels, list(vectors)
        self.dir = write_tables(folder, docs, benchmark, labels, self.vectors)


@pytest.fixture(scope="session")
def messy(tmp_path_factory):
    """Real texts with nulls, empty, blank and very long texts, odd characters, ties and repeated rows."""
    if not os.path.exists(SF_SMOKE):
        pytest.skip("test data not available")
    rows = pq.read_table(f"{SF_SMOKE}/documents.parquet").to_pylist()[:120]
    docs = [(r["doc_id"], r["text"], r["lang"]) for r in rows]
    bench = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF_SMOKE}/benchmark.parquet").to_pylist()[:12]]
    labels = [(r["doc_id"], r["quality"]) for r in pq.read_table(f"{SF_SMOKE}/labels.parquet").to_pylist()]
    long = " ".join(t for _, t, _ in docs[:40])
    passage = "x" * 40 + " the same passage of a hundred bytes and more " * 4
    docs += [
        (1000, None, "en"), (1001, "", "en"), (1002, " \t\n\r\x0b\x0c ", None), (1003, "a", "en"), (1004, "1234 !!", "en"),
        (1005, long, "en"), (1006, long[:30000].upper(), None), (None, "no id at all, but some words here", "en"),
        (None, None, None), (1007, docs[0][1], docs[0][2]), (1007, docs[0][1], docs[0][2]), (1008, docs[0][1].upper(), "fr"),
        (1009, "É é ß İ ı K Å zürich ÀÉ", "de"), (1010, "▁ ▁▁ a▁b ﷐ \U0001f600 日本語 \x00\x01", "xx"),
        (1011, passage + "tail one", "en"), (1012, "head two " + passage, "en"), (1013, "cc by cc by all rights reserved", "en"),
        (1014, bench[0][1], "en"), (1015, "Cc-BY! General  PUBLIC license, version 3 or any later version. MIT License", "en"),
        (1016, "word " * 5000, "en"), (1017, "é" * 300, "fr"), (1018, bench[1][1].upper() + " end", None),
        (1019, "one two three", "en"), (1020, "one two  three", "en"), (1021, "y" * 99, "en"), (1022, "y" * 250, "en"),
    ]
    bench += [(900, None), (901, ""), (902, "one two three"), (None, "some words here"), (903, "!!"), (902, "one two three")]
    labels += [(None, 1), (1001, None), (1016, 0)]
    vectors = [(r["vec_id"], r["embedding"], r["label"]) for r in pq.read_table(f"{SF_SMOKE}/embeddings.parquet").to_pylist()[:150]]
    first = vectors[0][1]
    vectors += [
        (None, first, None), (500, None, 1), (501, [None, *first[1:]], 1), (502, [float("nan"), *first[1:]], 1),
        (503, [float("-inf"), *first[1:]], 2), (3, vectors[9][1], None), (3, vectors[9][1], None), (-5, [0.0] * 64, None),
    ]
    vectors += [(600 + i, vectors[7][1], 3) for i in range(60)]
    return Tables(tmp_path_factory.mktemp("messy"), docs, bench, labels, vectors)


@pytest.fixture(scope="session")
def empty(tmp_path_factory):
    return Tables(tmp_path_factory.mktemp("empty"), [], [], [])
