import zlib
from collections import Counter, defaultdict

import pytest
from fixtures import CLASHING, SCHEMA, awkward_rows, clashing_rows, words
from test_decontaminate import brute_leaks
from test_mixing import brute_targets
from test_simhash import brute

import __spark_entry__ as contract
import corpus_pipeline
from aeroflow.llm import toxicity
from aeroflow.llm.common import stored, table

STAGES = dict(corpus_pipeline.STAGES)


def test_registered():
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.fixture(scope="module")
def kept(spark, small_dir):
    """What each stage kept, by its name, and the input."""
    out = {"documents": table(spark, small_dir, "documents")}
    docs = out["documents"]
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = stored(stage(spark, docs, small_dir), "test-stage")
    return out


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_columns(kept):
    names = kept["documents"].columns
    for name in list(STAGES)[:-1]:
        assert kept[name].columns == names
    assert kept["sharding"].columns == [*names, "shard"]


def test_toxic_documents_go_and_clean_ones_stay(spark, small_dir, kept):
    docs = kept["documents"]
    model = toxicity.train(docs, table(spark, small_dir, "labels"))
    expected = [(i, t) for i, t in rows(docs) if model.probability(toxicity.words_of(t)) < 0.3]
    assert sorted(rows(kept["toxicity"])) == sorted(expected)
    clean = {r["doc_id"] for r in table(spark, small_dir, "labels").where("toxic = 0").collect()}
    left = {i for i, _ in expected}
    assert len(clean - left) <= 0.03 * len(clean)


def test_one_document_of_each_group_stays(kept):
    before = rows(kept["toxicity"])
    groups = {c for _, _, c in brute(before)}
    assert sorted(i for i, _ in rows(kept["near_duplicates"])) == sorted(groups)


def test_leaking_documents_go(spark, small_dir, kept):
    items = [tuple(r) for r in table(spark, small_dir, "benchmark").select("item_id", "text").collect()]
    before = rows(kept["near_duplicates"])
    leaked = {d for d, *_ in brute_leaks(before, items)}
    assert sorted(rows(kept["decontamination"])) == sorted(r for r in before if r[0] not in leaked)


def test_sources_have_their_words(kept):
    before, sizes, made = kept["decontamination"].collect(), defaultdict(int), defaultdict(int)
    for r in before:
        sizes[r["source"]] += len(words(r["text"]))
    copies = Counter()
    texts = {r["doc_id"]: r["text"] for r in before}
    for r in kept["mixing"].collect():
        made[r["source"]] += len(words(r["text"]))
        assert texts[r["doc_id"]].startswith(r["text"])
        copies[r["doc_id"]] += 1
    assert max(copies.values()) <= 3
    for source, target in brute_targets(sizes).items():
        assert abs(made[source] - target) <= 1


def test_every_row_has_a_shard(kept):
    load = Counter()
    seen = defaultdict(set)
    for r in kept["sharding"].collect():
        load[r["shard"]] += len(r["text"].encode()) + 1
        seen[(r["doc_id"], zlib.crc32(r["text"].encode()))].add(r["shard"])
    assert set(load) == set(range(8))
    assert all(len(s) == 1 for s in seen.values())
    assert kept["sharding"].count() == kept["mixing"].count()


def test_run_gives_the_same_rows(spark, small_dir, kept):
    assert sorted(map(str, corpus_pipeline.run(spark, small_dir).collect())) == sorted(map(str, kept["sharding"].collect()))


@pytest.mark.parametrize("name", list(STAGES))
def test_awkward_rows(spark, small_dir, name):
    for schema, given in ((SCHEMA, awkward_rows()), (CLASHING, clashing_rows())):
        docs = spark.createDataFrame(given, schema)
        out = STAGES[name](spark, docs, small_dir)
        assert out.columns[: len(docs.columns)] == docs.columns
        assert out.count() > 0
        assert STAGES[name](spark, docs.limit(0), small_dir).count() == 0
