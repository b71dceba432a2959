"""The pipeline's stages against brute force, each on its own input."""

import time
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from pagemill.llm import bpe
from pagemill.llm.common import stored
from pagemill.llm.queries import tokenizer_path
from tests.llm.test_dedup import brute_components, brute_paragraphs, shingle_set, word_list
from tests.llm.test_text import brute_contamination


@pytest.fixture(scope="module")
def folder(docs, benchmark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    docs.write.parquet(f"{path}/documents.parquet")
    benchmark.write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder, rows, items):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "substring_dedup", "decontamination", "bpe"]
    steps, given = {}, spark.read.parquet(f"{folder}/documents.parquet")
    columns = given.columns
    for name, stage in corpus_pipeline.STAGES:
        given = stage(spark, given, folder).cache()
        steps[name] = [(r.doc_id, r.text) for r in given.collect()]
        if name != "bpe":
            assert given.columns == columns
    start = [(r[0], r[1]) for r in rows]

    kept = Counter(steps["language_id"])
    assert not kept - Counter(start)
    assert not {112, 113, 114, 119} & {i for i, _ in kept}
    lettered = [r for r in start if any(c.isalpha() for c in r[1] or "")]
    assert sum(kept.values()) >= 0.9 * len(lettered)

    components = brute_components({i: shingle_set(word_list(t), 5) for i, t in steps["language_id"]}, 80)
    assert Counter(steps["near_duplicates"]) == Counter(r for r in steps["language_id"] if components[r[0]] == r[0])

    gone = {k for k, removed in brute_paragraphs(steps["near_duplicates"]).items() if removed}
    cut = [(i, "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone)) for i, t in steps["near_duplicates"]]
    assert Counter(steps["substring_dedup"]) == Counter(cut)

    hits = brute_contamination(steps["substring_dedup"], items)
    assert Counter(steps["decontamination"]) == Counter(r for r in steps["substring_dedup"] if not hits[r[0]][1])
    assert {r[0] for r in steps["substring_dedup"]} - {r[0] for r in steps["decontamination"]}

    tok = bpe.tokenizer(tokenizer_path())
    for r in given.collect():
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert ids == tok.encode(r.text, add_special_tokens=False).ids
        assert r.decoded == tok.decode(ids, skip_special_tokens=False)
    assert Counter(steps["bpe"]) == Counter(steps["decontamination"])


def test_run_and_empty_table(spark, folder, none, benchmark, tmp_path):
    want = {c for c in spark.read.parquet(f"{folder}/documents.parquet").columns} | {"ids", "decoded"}
    assert set(corpus_pipeline.run(spark, folder).columns) == want
    none.write.parquet(f"{tmp_path}/documents.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_finished_steps_leave_no_shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: sum("shuffle_" in disk.getAllFiles().apply(i).getName() for i in range(disk.getAllFiles().size()))
    stored(spark.range(1))
    time.sleep(2)
    before = files()
    stored(spark.range(1000).repartition(4, "id"))
    assert files() > before
    stored(spark.range(1))
    until = time.time() + 20
    while files() > before and time.time() < until:
        time.sleep(0.2)
    assert files() <= before
