import public_tokenizers as P
import pytest
import tiktoken
from test_jaccard import word_sets
from test_winnow import brute as leaks

import corpus_pipeline
from tidemark.llm import bpe, jaccard, quality, toxicity, winnow

SF = "/root/testdata/sf0.001"


def test_one_of_each_group(spark, docs_of):
    text = "a b c d e f g h i"
    rows = [(5, text), (3, text), (3, text), (9, "x y"), (9, "other words"), (None, text), (None, text), (7, None), (8, "")]
    docs = docs_of(rows)
    kept = jaccard.one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted([r.doc_id for r in kept.collect()], key=str) == sorted([3, 9, 9, None, None, 7, 8], key=str)


def test_a_text_goes_only_if_one_of_its_own_group_stays(spark, docs_of):
    text, near = "a b c d e f g h i j k l m n o p q r s t", "a b c d e f g h i j k l m n o p q r s t u"
    other = "one two three four five six seven eight nine ten"
    rows = [(9, text), (9, other), (10, text), (11, near), (11, "alone in the whole wide world of texts"), (12, other + " more"),
            (13, text), (13, text), (4, "x"), (4, "y")]
    kept = sorted((r.doc_id, r.text) for r in jaccard.one_of_each_group(docs_of(rows)).collect())
    texts = [t for _, t in kept]
    assert len([t for t in texts if t in (text, near)]) == 1 and len([t for t in texts if t.startswith(other)]) == 1
    assert {(4, "x"), (4, "y"), (11, "alone in the whole wide world of texts")} <= set(kept) and len(kept) == 5


def test_stages_against_brute_force(spark):
    """Each stage on what its predecessor kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    good = {r.doc_id for r in corpus_pipeline.good(spark, docs, SF).collect()}
    assert good == {r.doc_id for r in quality.score(docs, labels).where("predicted = 1").collect()}
    docs = docs.where(docs.doc_id.isin(list(good)))
    safe = {r.doc_id for r in corpus_pipeline.harmless(spark, docs, SF).collect()}
    assert safe == {r.doc_id for r in toxicity.score(docs, labels).where("predicted = 0").collect()}
    docs = docs.where(docs.doc_id.isin(list(safe)))
    unique = {r.doc_id for r in corpus_pipeline.unique(spark, docs, SF).collect()}
    sets = {i: word_sets(rows[i]) for i in safe}
    for i in safe - unique:
        assert any(100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]) for j in safe if j < i or j in unique)
    for i in unique:
        assert not any(sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]) for j in unique if j < i)
    docs = docs.where(docs.doc_id.isin(list(unique)))
    left = {r.doc_id for r in corpus_pipeline.decontaminated(spark, docs, SF).collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert left == {i for i, _, n, *_ in leaks([(i, rows[i]) for i in unique], items) if not n}
    exact = tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={},
                              mergeable_ranks=bpe.load_ranks(P.path("byte_bpe_50k.tiktoken")))
    got = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == {i: len(exact.encode_ordinary(rows[i])) for i in left}


def test_stages_keep_the_columns(spark, docs_of):
    docs = docs_of([(1, "some words of text"), (2, None), (None, ""), (2, None)])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).dtypes == docs.dtypes
    empty = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


@pytest.mark.parametrize("module", [winnow])
def test_clean_is_native(spark, docs_of, module):
    docs = docs_of([(1, "some words")])
    plan = module.clean(docs, spark.read.parquet(f"{SF}/benchmark.parquet"))._jdf.queryExecution().toString()
    assert "InArrow" not in plan and "Python" not in plan
