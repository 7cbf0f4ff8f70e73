"""Every stage of the pipeline against a plain version of it, on the smallest table, and the guard around it."""

import hashlib
import subprocess
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from llm.cases import TINY
from llm.test_curriculum_mix import reshared
from llm.test_fertility import VOCABULARY, WORD, base
from llm.test_ngram_join import brute
from tokenizers import Tokenizer

import corpus_pipeline
from barlake.llm.fertility import measure_texts, verdicts
from barlake.llm.quality_embeddings import fit
from barlake.workspace import materialise

REPOSITORY = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before the first stage and after each one."""
    docs = [spark.read.parquet(f"{TINY}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(materialise(stage(spark, docs[-1], TINY), name))
    return docs


def rows(frame):
    return [tuple(r) for r in frame.collect()]


def test_columns_stay(stages):
    assert all(s.schema == stages[0].schema for s in stages[1:-1])


def test_quality_classifier(spark, stages):
    model = fit(stages[0], spark.read.parquet(f"{TINY}/labels.parquet"))
    before = rows(stages[0])
    good = model.probabilities([(r[1] or "").encode() for r in before])[:, 1] >= 0.5
    assert sorted(rows(stages[1])) == sorted(r for r, g in zip(before, good) if g)


def test_quality_rules(stages):
    before = rows(stages[1])
    kept = verdicts(measure_texts(VOCABULARY, [(r[1] or "").encode() for r in before]))[1]
    assert sorted(rows(stages[2])) == sorted(r for r, k in zip(before, kept) if k)
    assert not any(base(r[1])[5] for r in rows(stages[2]))


def test_near_duplicates(stages):
    before = rows(stages[2])
    classes = brute([(r[0], r[1]) for r in before])
    assert sorted(rows(stages[3])) == sorted(r for r in before if classes[r[0]][0] == r[0])


def drawn(row):
    """Documents stand in the order of a hash of id and text, so that one id does not stand together."""
    text = hashlib.md5(row[1].encode()).hexdigest()
    return hashlib.md5(f"{row[0]}:{text}".encode()).hexdigest()


def test_source_mix(stages):
    before = rows(stages[3])
    sizes = {r[0]: len(WORD.findall(r[1])) for r in before}
    of_source = Counter()
    for r in before:
        of_source[r[3]] += sizes[r[0]]
    target, expected, begun = reshared(of_source), Counter(), Counter()
    for r in sorted(before, key=drawn):
        for p in range(3):
            middle = p * of_source[r[3]] + begun[r[3]] + sizes[r[0]] / 2
            expected[r] += sizes[r[0]] > 0 and middle <= target[r[3]] + 1e-6
        begun[r[3]] += sizes[r[0]]
    assert Counter(rows(stages[4])) == +expected


def test_bpe_encoding(stages):
    before = rows(stages[4])
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = Counter()
    for r, e in zip(before, library.encode_batch([r[1] for r in before], add_special_tokens=False)):
        expected[r[0], len(e.ids), np.array(e.ids, "<u4").tobytes()] += 1
    assert Counter((i, n, bytes(ids)) for i, n, ids in rows(stages[5])) == expected


def test_run_equals_its_stages(spark, stages):
    found = Counter((i, n, bytes(ids)) for i, n, ids in rows(corpus_pipeline.run(spark, TINY)))
    assert found == Counter((i, n, bytes(ids)) for i, n, ids in rows(stages[5]))


def test_empty_documents(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{TINY}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_the_rest_does_without(tmp_path):
    """The entry module without this subpackage and the pipeline has the other queries, and no other module
    of the library imports this subpackage."""
    code = (
        "import sys, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('barlake.llm'):\n"
        "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert 'pipeline' not in e.queries() and not any(q.startswith('op') and q[2].isdigit() for q in e.queries())\n"
        "assert len(e.queries()) >= 73 and set(e.oracle_sql()) <= set(e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=REPOSITORY, check=True, timeout=120)
    for path in (REPOSITORY / "barlake").rglob("*.py"):
        if "llm" not in path.relative_to(REPOSITORY).parts:
            assert "barlake.llm" not in path.read_text()
