import re

import llm_helpers  # noqa: F401
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tickloom.llm import queries

SF = "/root/testdata/sf0.001"


def test_stages_one_after_another(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    given, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        kept[name] = docs.count()
        if name != "packing":
            assert docs.columns == given and kept[name] <= before.count()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    all_docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = spark.read.parquet(str(tmp_path / "quality")).join(labels, "doc_id").selectExpr("avg(quality) q", "count(*) n").first()
    assert good.q > 0.97 and good.n >= 0.97 * labels.where("quality = 1").join(all_docs, "doc_id").count()
    toxic = spark.read.parquet(str(tmp_path / "toxicity")).join(labels, "doc_id").selectExpr("avg(toxic) t").first()
    assert toxic.t < 0.05
    text = "\n".join(r.text for r in spark.read.parquet(str(tmp_path / "pii")).collect())
    source = "\n".join(r.text for r in spark.read.parquet(str(tmp_path / "simhash")).collect())
    private = re.findall(r"[\w.]+@[\w.]+\.\w+|\b\d{1,3}(?:\.\d{1,3}){3}\b|\b\d{16}\b|AKIA\w{16}|[0-9a-f]{40}", source)
    assert private and not any(p in text for p in private)
    places = docs.selectExpr("count(*) n", "count(distinct doc_id) d", "max(offset + length) m").first()
    assert places.d == kept["pii"] and places.m <= 4096


@pytest.mark.parametrize("rows", [0, 3])
def test_few_documents_and_no_labels(spark, tmp_path, rows):
    docs = spark.createDataFrame([(1, "a b c", "en", None, 5), (1, "a b c", "en", None, 5), (None, None, None, None, None)][:rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(out) == (2 if rows else 0)


def test_all_are_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in names if re.match(r"op\d", q)} and "pipeline" in names
    assert set(queries.all_queries()) <= set(names)


def test_held_out_fifth(spark):
    import zlib

    ids = list(range(50)) + [None]
    got = spark.createDataFrame([(i,) for i in ids], "doc_id long").withColumn("h", queries.held_out(queries.F.col("doc_id"))).collect()
    assert {r.doc_id: r.h for r in got} == {i: None if i is None else zlib.crc32(str(i).encode()) % 5 == 0 for i in ids}
