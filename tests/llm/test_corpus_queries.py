"""The registered queries: against their SQL, and the pipeline stage by stage against brute force."""

import sys
from pathlib import Path

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parents[2]))

import __spark_entry__ as contract  # noqa: E402
import corpus_pipeline  # noqa: E402
from cohortforge.llm import pii, quality  # noqa: E402
from cohortforge.llm.queries import QUERIES, SQL  # noqa: E402
from test_near_dedup import brute as components_of  # noqa: E402


def test_all_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, sf_dir, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    result = connection.execute(SQL[name])
    columns = [c[0] for c in result.description]
    df = QUERIES[name](spark, sf_dir)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(str, result.fetchall())) == sorted(str(tuple(r)) for r in df.select(*columns).collect())


def test_pipeline_against_brute_force(spark, sf_dir, tokenizer_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    good = {r["doc_id"] for r in quality.classify(docs, labels).where("predicted = 1").collect()}
    kept = {i: t for i, t in texts.items() if i in good}
    roots = components_of(list(kept.items()))
    kept = {i: t for i, t in kept.items() if roots[i] == i}
    plain = lambda t: " " + " ".join(t.lower().split()) + " "
    items = [plain(r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    kept = {i: t for i, t in kept.items() if not any(item in plain(t) for item in items)}
    found = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert found.keys() == kept.keys() and all(r["exact"] for r in found.values())
    tokenizer = Tokenizer.from_file(tokenizer_path)
    for doc, r in found.items():
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["n_tokens"]
        final = tokenizer.decode(ids, skip_special_tokens=False)
        assert tokenizer.encode(final, add_special_tokens=False).ids == ids
        assert not pii.base_spans(final)


def test_stages_keep_columns_and_rows_decide(spark, edges, sf_dir):
    columns = edges.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_dedup", "decontaminate", "pii", "bpe"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, edges, sf_dir)
        assert out.columns == columns
        assert out.count() <= edges.count()
        assert stage(spark, edges.limit(0), sf_dir).collect() == []
