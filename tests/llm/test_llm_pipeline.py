"""The pipeline's stages, each on what the one before it kept."""

import corpus_pipeline
import pytest
from llm_cases import AWKWARD, awkward, labels
from test_llm_text import cleaned, groups, holds

from daybook.llm import linededup
from daybook.llm.common import kept


def test_stages_are_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "mix", "pack"]


@pytest.fixture(scope="module")
def stages(spark, data):
    """What goes into each stage and comes out of it."""
    docs, found = spark.read.parquet(f"{data}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = kept(stage(spark, docs, data), name)
        found[name] = docs, out
        docs = out
    return found


def test_all_but_the_last_return_documents(stages):
    for name, (before, after) in stages.items():
        assert name == "pack" or after.columns == before.columns


def test_quality_takes_whole_rows_away(stages):
    before, after = stages["quality"]
    assert after.exceptAll(before).isEmpty() and 0 < after.count() < before.count()


def test_lines_go_by_definition(stages):
    before, after = stages["line_dedup"]
    want = cleaned([(r.doc_id, r.text, r.source) for r in before.collect()], None, linededup.WORDS)
    assert sorted((r.doc_id, r.text, r.n_chars) for r in after.collect()) == sorted((i, text, len(text)) for i, text, *_ in want)
    assert any(w[3] for w in want)


def test_one_document_of_each_group_stays(stages):
    before, after = stages["near_dedup"]
    assert after.exceptAll(before).isEmpty()
    want = {least for _, _, least in groups([(r.doc_id, r.text) for r in before.collect()])}
    assert sorted(r.doc_id for r in after.collect()) == sorted(want)


def test_mix_takes_whole_documents_up_to_three_times(stages):
    before, after = stages["mix"]
    times = {}
    for r in after.collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert max(times.values()) <= 3 and after.distinct().exceptAll(before).isEmpty()


def test_pack_holds_every_token(stages):
    before, after = stages["pack"]
    holds(after.collect(), [(r.doc_id, r.text, r.source) for r in before.collect()], 4096)


def test_run_gives_what_the_stages_give(spark, data, stages):
    total = lambda df: df.agg({"length": "sum", "sequence_id": "max"}).first()
    assert total(corpus_pipeline.run(spark, data)) == total(stages["pack"][1])


def test_awkward_rows_go_through(spark, tmp_path):
    labels(spark).write.parquet(str(tmp_path / "labels.parquet"))
    docs = awkward(spark)
    for name, stage in corpus_pipeline.STAGES:
        for rows in (docs, docs.filter("false")):
            out = stage(spark, rows, str(tmp_path))
            assert (out.count() > 0) == (rows is docs)
            assert name == "pack" or out.columns == docs.columns
    assert corpus_pipeline.quality(spark, docs, str(tmp_path)).count() <= len(AWKWARD)
