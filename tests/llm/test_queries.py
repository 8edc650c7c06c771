"""Registered queries against DuckDB and the pipeline against a plain version, on the smallest tables."""

import pandas as pd
import pytest

import corpus_pipeline
from tabrisk.llm.common import table, write_stage
from tabrisk.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tests.llm.test_small import brute_classes
from tools.check_oracle import duck, frame_hash


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = duck(SF_SMALL, ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want)
    assert frame_hash(got) == frame_hash(want)


def test_all_thirteen_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark):
    docs = table(spark, SF_SMALL, "documents")
    kept = [docs.toPandas()]
    for name, stage in corpus_pipeline.STAGES:
        docs = write_stage(stage(spark, docs, SF_SMALL), f"test-{name}")
        if name != "pack":
            assert docs.columns == corpus_pipeline.COLUMNS
        kept.append(docs.toPandas())
    start, lang, good, single, masked, packed = kept
    assert set(start.doc_id) - set(lang.doc_id) == {i for i, t in zip(start.doc_id, start.text) if t is None or not any(c.isalpha() for c in t)}
    labels = pd.read_parquet(f"{SF_SMALL}/labels.parquet").merge(lang, on="doc_id")
    gone = set(lang.doc_id) - set(good.doc_id)
    assert gone and (labels.quality == (~labels.doc_id.isin(gone)).astype(int)).mean() > 0.9
    rows = list(good[["doc_id", "text"]].itertuples(index=False, name=None))
    _, _, comp = brute_classes(rows)
    least = {}
    for i, c in comp.items():
        least[c] = min(least.get(c, rows[i][0]), rows[i][0])
    assert sorted(single.doc_id) == sorted(least.values())
    from tabrisk.llm import secret_scan

    assert dict(zip(masked.doc_id, masked.text)) == {i: secret_scan.masked(t) for i, t in zip(single.doc_id, single.text)}
    assert set(packed.doc_id) == set(masked.doc_id)
