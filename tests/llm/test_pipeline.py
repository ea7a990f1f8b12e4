import random
import shutil

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm.conftest import make_docs, prose
from vintagelake.llm import bpe, decontaminate, langid, quality, queries, simhash
from vintagelake.llm.common import table


def test_each_stage_keeps_what_its_operator_decides(spark):
    docs = table(spark, SF_SMALL, "documents")
    columns = docs.columns
    left = {r["doc_id"] for r in docs.select("doc_id").collect()}
    judged = quality.judge(docs, table(spark, SF_SMALL, "labels")).where("keep").collect()
    after = corpus_pipeline.quality_classifier(spark, docs, SF_SMALL)
    kept = {r["doc_id"] for r in after.select("doc_id").collect()}
    assert after.columns == columns and kept == {r["doc_id"] for r in judged} and kept < left

    docs = docs.where(docs["doc_id"].isin(kept))
    after = corpus_pipeline.language_id(spark, docs, SF_SMALL)
    seen = langid.predict(docs, langid.fit(docs)).where("recognised").collect()
    kept = {r["doc_id"] for r in after.select("doc_id").collect()}
    assert after.columns == columns and kept == {r["doc_id"] for r in seen}

    after = corpus_pipeline.near_dedup(spark, docs, SF_SMALL)
    classes = simhash.near_duplicates(docs).collect()
    kept = {r["doc_id"] for r in after.select("doc_id").collect()}
    assert after.columns == columns and kept == {r["component_id"] for r in classes}

    after = corpus_pipeline.decontamination(spark, docs, SF_SMALL)
    found = decontaminate.digest(decontaminate.contamination(docs, table(spark, SF_SMALL, "benchmark"))).collect()
    assert after.columns == columns
    assert {r["doc_id"] for r in after.select("doc_id").collect()} == {r["doc_id"] for r in found if not r["contaminated"]}

    codec = bpe.WordBpe(queries.WORD_BPE)
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    for r in corpus_pipeline.encode(spark, docs, SF_SMALL).collect():
        assert bytes(r["ids"]) == codec.encode(texts[r["doc_id"]]) and r["n_tokens"] == len(np.frombuffer(r["ids"], "<u4"))


@pytest.fixture(scope="module")
def odd_folder(spark, odd_rows, tmp_path_factory):
    """A folder of tables with nulls, repeated rows, equal texts under several ids, and clashing columns."""
    folder = tmp_path_factory.mktemp("tables")
    rnd = random.Random(0)
    copies = [(3000 + i, odd_rows[-1][1], "en", "a") for i in range(4)]
    make_docs(spark, odd_rows + copies).write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame([(r[0], 1, 0) for r in odd_rows if r[0] and r[0] >= 20], "doc_id long, quality int, toxic int").write.parquet(
        str(folder / "labels.parquet"))
    spark.createDataFrame([(1, prose(rnd, 20)), (2, odd_rows[-2][1])], "item_id long, text string").write.parquet(
        str(folder / "benchmark.parquet"))
    return str(folder)


def test_run_on_odd_tables(spark, odd_folder, odd_rows):
    got = [r["doc_id"] for r in corpus_pipeline.run(spark, odd_folder).collect()]
    assert len([g for g in got if g is not None]) == len({g for g in got if g is not None})
    assert odd_rows[-1][0] in got and not any(3000 <= (g or 0) < 3004 for g in got)  # one of the copies stays
    assert odd_rows[-2][0] not in got  # a benchmark item
    assert 4 not in got and 5 not in got and 9 not in got


def test_run_on_empty_tables(spark, none, odd_folder, tmp_path):
    none.write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("labels", "benchmark"):
        shutil.copytree(f"{odd_folder}/{name}.parquet", tmp_path / f"{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_are_the_dealt_ones():
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == [
        "quality_classifier", "language_id", "near_dedup", "decontamination", "encode"]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_match_their_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    cursor = duck.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    got = queries.queries()[name](spark, SF_SMALL)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(cursor.fetchall())
