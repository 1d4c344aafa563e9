"""The pipeline: every stage against a brute-force version of its decision."""

import os
import re
from collections import Counter, defaultdict

import pytest
from test_llm_near_dedup import brute

import __spark_entry__ as contract
import corpus_pipeline
from chaffsieve.llm.near_dedup import Sketch

BASE = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    if not os.path.isdir(BASE):
        pytest.skip("no test data")
    docs = spark.read.parquet(f"{BASE}/documents.parquet")
    found = {"": docs}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, BASE).write.parquet(path)
        docs = found[name] = spark.read.parquet(path)
    return found


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_columns(stages):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert stages[name].columns == stages[""].columns


def test_language_keeps_documents_with_words_of_a_language(stages):
    kept = {i for i, _ in texts(stages["language_id"])}
    assert kept == {i for i, t in texts(stages[""]) if any(c.isalpha() for c in t or "")}


def test_exact_keeps_the_largest_id_of_each_text(stages):
    largest = {}
    for i, t in texts(stages["language_id"]):
        largest[t] = max(i, largest.get(t, i))
    assert sorted(texts(stages["exact_dedup"])) == sorted((i, t) for t, i in largest.items())


def test_near_keeps_the_smallest_id_of_each_component(stages):
    rows = texts(stages["exact_dedup"])
    assert {i for i, _ in texts(stages["near_dedup"])} == {i for i, _, _, kept in brute(rows, Sketch(5, 80)) if kept}


def test_mix_comes_near_its_targets(stages):
    before = stages["near_dedup"].collect()
    size, words = Counter(), {}
    for r in before:
        words[r["doc_id"]] = len(WORD.findall(r["text"]))
        size[r["source"]] += words[r["doc_id"]]
    taken, each = Counter(), Counter()
    for r in stages["mix_sources"].collect():
        n = len(WORD.findall(r["text"]))
        taken[r["source"]] += n
        each[r["doc_id"]] += n
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(size))}
    assert all(taken[s] <= 3 * size[s] for s in size)
    assert all(each[i] <= 3 * n for i, n in words.items())
    free = [s for s in size if taken[s] < 3 * size[s]]
    level = [taken[s] / weight[s] for s in free]
    assert max(level) - min(level) <= 1.0
    assert abs(sum(taken.values()) - sum(size.values())) <= len(size)


def test_packing_covers_the_mix(stages):
    from tokenizers import Tokenizer

    import public_tokenizers

    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for i, t in texts(stages["mix_sources"]):
        want[i] += len(made.encode(t, add_special_tokens=False).ids) + 1
    have, by_sequence = Counter(), defaultdict(int)
    for r in stages["pack_sequences"].collect():
        have[r["doc_id"]] += r["length"]
        by_sequence[r["sequence_id"]] += r["length"]
    assert have == want
    assert all(n == 2048 or n & (n - 1) == 0 for n in by_sequence.values())


def test_registered(spark, stages):
    assert contract.queries()["pipeline"](spark, BASE).count() == stages["pack_sequences"].count()


def test_stages_on_odd_rows(spark, odd_documents, no_documents):
    for docs in (odd_documents, no_documents):
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            result = stage(spark, docs, BASE)
            assert i == 4 or result.columns == docs.columns, name
            result.count()
