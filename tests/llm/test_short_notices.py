"""License notices of fewer words than a shingle, against a search for their words."""

import re

import pytest

from reportstar.llm import licenses
from reportstar.staging import stage


def test_short_notices(spark):
    rows = [
        (1, "All rights reserved."), (2, "one two\nALL RIGHTS  RESERVED, 2020"), (3, "overall rights reserved"), (4, "all rights"),
        (5, "# SPDX-License-Identifier: MIT\n(c) all rights reserved. All rights reserved"), (6, None), (7, ""), (8, "all rights reservedly"),
        (9, "// SPDX-License-Identifier: GPL-3.0-only"), (10, "x SPDX-License-Identifier: Apache-2.0 y"), (1, "All rights reserved."),
    ]
    docs = stage(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, license string"), "short")
    found = licenses.scan_licenses(docs)
    assert found.dtypes == licenses.scan_licenses(docs).dtypes
    want = []
    for i, text in rows:
        w = re.findall(r"[^\W_]+", (text or "").lower())
        for name, notice in licenses.SHORT_TEMPLATES.items():
            t = re.findall(r"[^\W_]+", notice.lower())
            at = [k for k in range(len(w)) if w[k : k + len(t)] == t]
            if at:
                want.append((i, name, 1.0, at[0] if len(t) < 5 else 0))
    assert sorted(tuple(r) for r in found.collect()) == sorted(want) and len(want) == 7
    only = licenses.scan_licenses(docs, {"all": "All rights reserved."})
    assert sorted((r.doc_id, r.first_word) for r in only.collect()) == [(1, 0), (1, 0), (2, 2), (5, 5)]
    with pytest.raises(ValueError, match="at least 3"):
        licenses.scan_licenses(docs, {"x": "two words"})
