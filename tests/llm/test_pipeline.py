import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from strataquarry.llm import decontam, line_dedup, quality  # noqa: E402

from .fixtures import DOCS, corpus  # noqa: E402
from .test_decontam import nearest  # noqa: E402
from .test_jaccard import brute as near_brute  # noqa: E402
from .test_lines import brute as line_brute  # noqa: E402
from .test_packing import check  # noqa: E402
from .test_quality import plain  # noqa: E402


def test_stages_equal_brute_force(spark, tmp_path):
    data = [r for r in corpus(9) if r[0] != 64] + [(900 + i, f"shared footer line\n{r[1]}", "en", "s9", 0) for i, r in enumerate(corpus(21, 12)[:12])]
    items = [(1, data[5][1]), (2, "no such passage stands in any of these few documents at all")]
    docs = spark.createDataFrame(data, DOCS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int").where("doc_id < 0").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = [r for r in data if not plain(r[1])[5]]
    lines = {i: t for i, t, *_ in line_brute([(r[0], r[1], r[3]) for r in want], line_dedup.RATIO, line_dedup.SURE)}
    ids = [r[0] for r in want]
    near = near_brute([lines[i] for i in ids])
    ids = [i for k, i in enumerate(ids) if near[k][0] == k]
    leaks = lambda i: any(nearest(t.split(), lines[i].split()) <= int(0.2 * len(t.split())) for _, t in items if len(t.split()) >= decontam.MIN_WORDS)
    ids = [i for i in ids if not leaks(i)]
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    order = {i: k for k, i in enumerate(ids)}
    assert {p.doc_id for p in pieces} == set(ids)
    remapped = [type("P", (), {**p.asDict(), "doc_id": order[p.doc_id]}) for p in pieces]
    check(remapped, [lines[i] for i in ids], 2048)


def test_stages_return_documents(spark, tmp_path):
    docs = spark.createDataFrame([], DOCS)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.count() == 0
    assert quality.MIN_SCORE < 0


def test_clashing_columns_pass_through(spark, tmp_path):
    """Whatever internal names the stages use, columns of documents come out as they went in."""
    names = ["own", "key", "rep", "least", "parity", "h", "absent", "hashes", "kept", "lines", "dropped", "leaks", "total", "trusted", "tid", "label", "node", "group", "_k", "_key", "_leaks"]
    data = [(*r, *(f"{n}{r[0]}" for n in names)) for r in corpus(5)] * 2
    docs = spark.createDataFrame(data, DOCS + "".join(f", {n} string" for n in names))
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, data[5][1])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        rows = out.collect()
        assert out.columns == docs.columns and rows
        assert all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names)
