import corpus_pipeline
import public_tokenizers as P
from llm_cases import table
from test_dedup import brute_components
from test_tokens import check_packing
from tokenizers import Tokenizer

import __spark_entry__ as entry
from tablewright.llm import toxicity


def test_entry_lists_all_operators():
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert set(entry.oracle_sql()) <= set(names)


def test_run_against_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    chain = toxicity.train(docs, spark.read.parquet(f"{sf_small}/labels.parquet"))
    scorer = toxicity.Scorer(chain)
    rows = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    clean = {i: t for i, t in rows.items() if scorer.scores([t])[0, -1] < toxicity.THRESHOLD}
    last = {t: max(i for i, own in clean.items() if own == t) for t in set(clean.values())}
    distinct = {i: t for i, t in clean.items() if last[t] == i}
    order = sorted(distinct)
    groups = brute_components([distinct[i] for i in order])
    stay = {i: distinct[i] for k, i in enumerate(order) if groups[k][0] == 0 or groups[k][1] == k}
    assert 0 < len(stay) < len(distinct) < len(clean) < len(rows)
    check_packing(corpus_pipeline.run(spark, sf_small).collect(), stay, Tokenizer.from_file(P.path("byte_bpe_50k.json")))


def test_stages_keep_columns_and_take_awkward_rows(spark, sf_small):
    for data in (None, []):
        docs = table(spark, data)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf_small)
            assert out.columns == docs.columns
            docs = spark.createDataFrame(out.collect(), docs.schema)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_small).count() >= docs.count()
