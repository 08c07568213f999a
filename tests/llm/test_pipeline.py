"""run() of the pipeline against its stages written out by hand."""

import math
import random

import pytest

pipeline = pytest.importorskip("corpus_pipeline")

from splicedf.llm import mixing  # noqa: E402
from tests.llm.test_operators import bench_rows, components, contaminated, fixture, quality, targets, ws  # noqa: E402

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with nulls, repeats, copies, near copies and passages of the benchmark; every text long enough is kept or not by its n-grams."""
    at = tmp_path_factory.mktemp("corpus")
    rows = [r[:5] for r in fixture()]
    labels = [(r[0], int(r[0] % 3 > 0), int(r[0] % 11 == 0)) for r in rows if r[0] is not None and r[0] % 4]
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(str(at / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(at / "labels.parquet"))
    bench = bench_rows(fixture())
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(at / "benchmark.parquet"))
    return str(at), rows, labels, bench


def by_hand(rows, labels, bench):
    """Rows that each stage but the last leaves."""
    out = []
    kept = {}
    for v, row in zip(sorted_like(rows, quality(rows, labels)), rows):
        kept[id(row)] = v[7]
    rows = [r for r in rows if kept[id(r)]]
    out.append(rows)
    low = sorted_like(rows, components(rows, 5, 4, 5))
    rows = [r for r, c in zip(rows, low) if r[0] is None or r[0] == c[2]]
    out.append(rows)
    bad = sorted_like(rows, contaminated(rows, bench))
    rows = [r for r, c in zip(rows, bad) if not c[5]]
    out.append(rows)
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(ws(r[1]))
    want = targets(sizes)
    mixed = []
    for r in rows:
        rate = want[r[3]] / sizes[r[3]] if sizes[r[3]] else 0
        mixed += [r] * (math.floor(rate) + (draw(r[0]) < rate - math.floor(rate)))
    out.append(mixed)
    return out


def draw(key):
    import hashlib

    return int(hashlib.md5(f"{'null' if key is None else key}:{mixing.SEED}".encode()).hexdigest()[:13], 16) / 2**52


def sorted_like(rows, found):
    """The results of a brute force, which come sorted, in the order of rows; equal keys have equal results here."""
    left = {}
    for v in found:
        left.setdefault((v[0], v[1]), []).append(v)
    key = {3: lambda r: (r[0], len(shingles(r[1]))), 9: lambda r: (r[0], len(ws(r[1]))), 6: lambda r: (r[0], len(item_words(r[1])))}[len(found[0])]
    return [left[key(r)].pop() for r in rows]


def shingles(text):
    from tests.llm.test_operators import lowered

    w = ws(lowered(text))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def item_words(text):
    import re

    from tests.llm.test_operators import lowered

    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def key_of(rows):
    return sorted(((r[0], r[1], r[3]) for r in rows), key=repr)


def test_run_and_stages(spark, folder, tmp_path):
    at, rows, labels, bench = folder
    docs, want = spark.read.parquet(f"{at}/documents.parquet"), by_hand(rows, labels, bench)
    for k, ((name, stage), left) in enumerate(zip(pipeline.STAGES, want)):
        made = stage(spark, docs, at)
        assert made.columns == docs.columns
        made.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert key_of(docs.collect()) == key_of(left), name
    assert len(want[0]) < len(rows) and len(want[1]) < len(want[0]) and len(want[2]) < len(want[1])
    last = pipeline.STAGES[-1][1](spark, docs, at).collect()
    sizes = sorted(((r[0], len(r[1].encode()) + 1) for r in want[-1]), key=repr)
    assert sorted(((r["doc_id"], r["size"]) for r in last), key=repr) == sizes
    whole = pipeline.run(spark, at).collect()
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"], r["shard"]) for r in whole), key=repr) == sorted(((r["doc_id"], r["size"], r["text_crc32"], r["shard"]) for r in last), key=repr)


def test_clean_documents_survive(spark, tmp_path):
    """Different clean texts, without labels or benchmark, all reach the last stage."""
    r = random.Random(2)
    rows = [(i, " ".join("".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(60)), "en", "s", 1) for i in range(40)]
    spark.createDataFrame(rows, COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "none of this occurs anywhere in what the documents say today")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert sorted(x["doc_id"] for x in pipeline.run(spark, str(tmp_path)).collect()) == list(range(40))


def test_empty(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert pipeline.run(spark, str(tmp_path)).count() == 0
