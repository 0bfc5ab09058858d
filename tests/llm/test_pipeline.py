"""The pipeline's stages on the smallest tables, and the queries next to their SQL."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))

import corpus_pipeline  # noqa: E402
import __spark_entry__ as entry_module  # noqa: E402
from lotledger.llm import exactdedup, mixing, ngramjoin, ordinal, queries  # noqa: E402
from lotledger.llm.common import table, written  # noqa: E402
from oracle_check import compare, connect  # noqa: E402
from test_data import TOKENIZER, check_pieces  # noqa: E402, F401
from test_dedup import joined_by_force  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(spark, name):
    assert compare(spark, connect(SF), SF, queries.queries()[name], queries.oracle_sql()[name]) is None


def test_registered():
    assert set(queries.queries()) | {"pipeline"} <= set(entry_module.queries())
    assert set(queries.oracle_sql()) <= set(entry_module.oracle_sql())


def test_stages(spark):
    docs = table(spark, SF, "documents")
    stages = [f for _, f in corpus_pipeline.STAGES]
    kept = written(stages[0](spark, docs, SF))
    assert kept.columns == docs.columns
    marks = {r.doc_id: r.keep for r in ordinal.scored(docs, table(spark, SF, "labels")).collect()}
    assert {r.doc_id for r in kept.collect()} == {i for i, keep in marks.items() if keep}
    once = written(stages[1](spark, kept, SF))
    best = {}
    for r in kept.collect():
        best[r.text] = max(best.get(r.text, -1), r.doc_id)
    assert {(r.doc_id, r.text) for r in once.collect()} == {(i, x) for x, i in best.items()} and once.columns == docs.columns
    apart = written(stages[2](spark, once, SF))
    force = joined_by_force([(r.doc_id, r.text) for r in once.collect()], 5, 80)
    assert {r.doc_id for r in apart.collect()} == {i for i, _, c in force if i == c} and apart.columns == docs.columns
    mixed = written(stages[3](spark, apart, SF))
    assert sorted(mixed.collect()) == sorted(apart.collect()) and mixed.columns == docs.columns
    packed = stages[4](spark, mixed, SF).collect()
    check_pieces([(r.doc_id, r.text) for r in mixed.collect()], packed, 2048)
    # The sequences follow the mix.
    order = [r.doc_id for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)) if r.start == 0]
    assert order == [r.doc_id for r in mixed.collect()]


def test_run(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"] and got.count() > 0


def test_stages_of_odd_rows(spark):
    rows = [(1, "a few good words here", None), (1, "a few good words here", None), (None, None, "s"), (None, "x y z", "s"), (4, "", ""), (5, "a few good words here", "s")]
    docs = spark.createDataFrame([(i, x, "en", s, None, 1, 2) for i, x, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, position int, kept int")
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        docs = written(stage(spark, docs, SF))
        assert docs.columns[-2:] == ["position", "kept"]
    assert sorted(r.text or "" for r in docs.collect()) == ["", "a few good words here", "x y z"]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0


def test_stages_keep_columns_of_any_name(spark):
    """Extra columns, also named like helpers of the stages, pass whole."""
    names = ["_id", "_sha", "_copy", "_position", "kept", "position", "block", "slot", "component_id", "n_bytes", "bucket"]
    rows = [(i, f"text number {i % 4} of a few words " * 3, "s", *[f"{n}{i}" for n in names]) for i in range(8)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "source", *names])
    for stage in (exactdedup.deduplicated, ngramjoin.deduplicated, mixing.interleaved):
        got = stage(docs)
        assert got.columns == docs.columns
        assert {tuple(r) for r in got.collect()} <= set(rows)
        assert got.count() == (8 if stage is mixing.interleaved else 4)
