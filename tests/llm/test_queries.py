"""Every registered query of the package, and the pipeline, on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from tools.compare import canonical, connect  # noqa: E402
from wattframe.llm.queries import ORACLES, QUERIES  # noqa: E402
from wattframe.llm.tables import table  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")

WHOLE = {"documents": ("op2", "op3", "op5", "op6", "op8", "op9"), "pages": ("op1", "op4")}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_its_sql(spark, name):
    frame = QUERIES[name](spark, SF_DIR)
    result = connect(SF_DIR).execute(ORACLES[name])
    theirs = canonical([c[0] for c in result.description], result.fetchall())
    assert canonical(frame.columns, [tuple(r) for r in frame.collect()]) == theirs


@pytest.mark.parametrize("source, op", [(source, op) for source, ops in WHOLE.items() for op in ops])
def test_one_row_for_each(spark, source, op):
    (name,) = [name for name in QUERIES if name.startswith(f"{op}_")]
    frame = QUERIES[name](spark, SF_DIR)
    key = "page_id" if source == "pages" else "doc_id"
    ids = sorted(r[0] for r in table(spark, SF_DIR, source).select(key).collect())
    assert sorted(r[0] for r in frame.select(key).collect()) == ids


def test_pipeline(spark):
    docs = table(spark, SF_DIR, "documents")
    whole = docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == corpus_pipeline.COLUMNS
    assert 0 < docs.count() < whole
    last = corpus_pipeline.run(spark, SF_DIR)
    assert last.columns[:2] == ["doc_id", "start"] and last.count() > 0
