"""The pipeline's stages against plain versions, on one small table."""

import ctypes
import random
import re
from pathlib import Path

import pyarrow as pa
import pytest

import corpus_pipeline
from namavali.llm import ngram_join, packing, queries, secrets
from tests.llm.test_text_ops import ODD, documents, plain_near, plain_secrets


def test_stages(spark, tmp_path):
    r = random.Random(21)
    vocabulary = "the of and to house river tree stone light water ground paper".split() + [f"word{i}" for i in range(400)]
    base = [" ".join(r.choices(vocabulary, [30] * 4 + [1] * (len(vocabulary) - 4), k=r.randint(60, 200))) for _ in range(30)]
    texts = list(ODD) + base + base[:5] + [b + " extra" for b in base[5:12]] + ["$$$ ".join(b.split()) for b in base[:3]]
    texts[20] += ' token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"'
    documents(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept[name] = {x.doc_id: x.text for x in docs.collect()}
    first = kept["quality_rules"]
    assert set(range(len(ODD), len(ODD) + 30)) <= set(first) and not set(range(len(texts) - 3, len(texts))) & set(first)
    last = {}
    for i, t in first.items():
        last[t] = max(i, last.get(t, -1))
    assert set(kept["exact_dedup"]) == set(last.values())
    assert set(kept["near_dedup"]) == {c for _, _, c in plain_near(list(kept["exact_dedup"].items()), 5, 80)}
    assert set(kept["secret_scan"]) == set(kept["near_dedup"]) and not any(plain_secrets(t) for t in kept["secret_scan"].values())
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {x.doc_id for x in whole} == set(kept["near_dedup"])
    assert queries.QUERIES.keys() >= {"op2_ngram_join"}


def _held() -> float:
    """MB of memory of this process that are no mapped files."""
    return int(re.search(r"\nAnonymous:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()).group(1)) / 1024


def _tasks(monkeypatch, spark) -> dict:
    """The functions that workers run for the stages that need Python."""
    docs = documents(spark, ["a text"])
    rows = docs.selectExpr("doc_id AS id", "text")
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: run)
    ranks = queries.vocabulary("byte_bpe_50k.tiktoken"), queries.pattern()
    made = {"sets": ngram_join.sets_table(rows, 5), "blocks": ngram_join.shingle_blocks(rows, 5, 8), "secrets": secrets.find_secrets(docs, *ranks)}
    return made | {"packing": packing.pieces(docs, queries.vocabulary("word_bpe_49k.json"))}


def _batch(n: int, words: int = 40_000) -> pa.RecordBatch:
    r = random.Random(n)
    vocabulary = [f"w{r.getrandbits(32):x}" for _ in range(words)]
    return pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array([" ".join(r.choices(vocabulary, k=250)) for _ in range(n)])], ["doc_id", "text"])


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="memory can't be read here")
def test_a_task_leaves_no_freed_memory_in_its_worker(spark, monkeypatch):
    tasks, batch = _tasks(monkeypatch, spark), _batch(6_000)
    for name, run in tasks.items():
        for _ in run(iter([batch])):
            pass
        held = _held()
        pa.default_memory_pool().release_unused()
        ctypes.CDLL(None).malloc_trim(0)
        assert held - _held() < 15, name


def test_words_of_packing_go_when_another_operator_runs(spark, monkeypatch):
    tasks, batch, path = _tasks(monkeypatch, spark), _batch(200), queries.vocabulary("word_bpe_49k.json")
    told = [x.to_pylist() for x in tasks["packing"](iter([batch]))]
    cache = packing.word_cache(path)
    assert cache.ids and [x.to_pylist() for x in tasks["packing"](iter([batch]))] == told and packing.word_cache(path) is cache
    for name in ("sets", "blocks", "secrets"):
        list(tasks["packing"](iter([batch])))
        list(tasks[name](iter([batch])))
        assert not packing.word_cache(path).ids
    assert [x.to_pylist() for x in tasks["packing"](iter([batch]))] == told
