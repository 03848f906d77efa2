"""Held-out accuracy of the learnt kinds on the labelled documents."""

from pathlib import Path

import numpy as np
import pytest

from tarnquill.llm.quality import classified, learn_rules, text_statistics

FOLDER = Path("/root/testdata/sf0.1")


@pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")
def test_held_out_accuracy():
    import duckdb

    rows = duckdb.connect().sql(
        f"SELECT text, label FROM '{FOLDER}/documents.parquet' JOIN '{FOLDER}/quality_labels.parquet' USING (doc_id) "
        "WHERE label IS NOT NULL AND trim(text) <> '' ORDER BY doc_id"
    ).fetchall()
    x, y = np.array([text_statistics(t) for t, _ in rows]), np.array([k for _, k in rows], object)
    fold = np.arange(len(x)) % 4
    right = sum((classified(x[fold == f], learn_rules(x[fold != f], y[fold != f])) == y[fold == f]).sum() for f in range(4))
    assert right / len(x) > 0.9  # some three in a hundred labels are wrong
