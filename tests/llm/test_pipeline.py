"""The pipeline's stages against what the operators' definitions say, each on its own input."""

import hashlib
import os
import shutil
import subprocess
import sys

import pytest

import corpus_pipeline as pipeline
from zonewise.llm import decontaminate, pieces, quality, simhash


@pytest.fixture(scope="module")
def steps(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    seen = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for k, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, seen[-1], sf_dir).write.parquet(f"{folder}/{k}")
        seen.append(spark.read.parquet(f"{folder}/{k}"))
    return seen


def test_columns(steps):
    assert all(s.columns == steps[0].columns for s in steps[:5])


def test_toxic_documents_go_and_good_ones_stay(spark, sf_dir, steps):
    kept = {r.doc_id for r in steps[1].select("doc_id").collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    good, toxic = ([r.doc_id in kept for r in labels if r.toxic == t and r.quality == 1] for t in (0, 1))
    assert sum(good) > 0.97 * len(good) and sum(toxic) < 0.2 * len(toxic)


def test_lines(steps):
    before = {r.doc_id: r for r in steps[1].collect()}
    after = {r.doc_id: r for r in steps[2].collect()}
    assert before.keys() == after.keys()
    assert all(r.n_chars == len(r.text) and set(r.text.split("\n")) <= {*before[i].text.split("\n"), ""} for i, r in after.items())


def test_one_of_each_group_stays(steps):
    groups = {}
    for r in steps[2].collect():
        groups.setdefault(simhash.fingerprint(r.text.encode()), []).append(r.doc_id)
    prints = sorted(groups)
    label = {p: min(groups[p]) for p in prints}
    for _ in range(10):
        for k, p in enumerate(prints):
            for q in prints[:k]:
                if (p ^ q).bit_count() <= 3:
                    label[p] = label[q] = min(label[p], label[q])
    assert {r.doc_id for r in steps[3].collect()} == set(label.values())


def test_no_contaminated_document_stays(spark, sf_dir, steps):
    bad = decontaminate.matches(steps[3], spark.read.parquet(f"{sf_dir}/benchmark.parquet")).filter("contaminated")
    bad = {r.doc_id for r in bad.collect()}
    assert {r.doc_id for r in steps[4].collect()} == {r.doc_id for r in steps[3].collect()} - bad


def test_texts_come_back(steps):
    texts = {r.doc_id: r.text for r in steps[4].collect()}
    model = pieces.load(pipeline.TOKENIZER)
    rows = steps[5].collect()
    assert {r.doc_id for r in rows} == texts.keys()
    for r in rows:
        assert pieces.decoded(r.ids, model.texts) == texts[r.doc_id] and r.n_tokens == len(r.ids)
        assert r.text_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_run(spark, sf_dir, steps):
    key = lambda r: (r.doc_id, r.ids)
    assert sorted(map(key, pipeline.run(spark, sf_dir).collect())) == sorted(map(key, steps[5].collect()))


def test_the_rest_works_without_the_subpackage(tmp_path):
    """Without the folder and the pipeline the entry point has all other queries."""
    root = os.path.dirname(pipeline.__file__)
    shutil.copytree(os.path.join(root, "zonewise"), tmp_path / "zonewise", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; names = list(e.queries()); assert len(names) > 100 and not any(n.startswith('op') or n == 'pipeline' for n in names)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, check=True)
