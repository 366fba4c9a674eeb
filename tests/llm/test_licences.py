import random

import pyarrow as pa
import pytest

from nestdoc.llm import licences as L

from ..conftest import SF01
from .helpers import SCHEMA, odd_rows, prose

SIGNS = {"gpl": "GNU General Public License", "cc-by-nc": "CC BY-NC", "mit": "MIT License", "apache-2.0": "Apache License",
         "proprietary": "All rights reserved"}


@pytest.fixture(scope="module")
def model(spark):
    return L.train(spark.read.parquet(f"{SF01}/documents.parquet"))


def test_like_looking_for_the_lines(spark, model):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    want = {(r["doc_id"], f) for r in docs.collect() for f, sign in SIGNS.items() if sign in r["text"]}
    got = {(r["doc_id"], r["family"]) for r in L.scan(docs, model).collect()}
    assert got == want and len(want) > 10


def test_notices_in_long_paragraphs_and_unknown_ones(spark, model):
    rng = random.Random(1)
    rows = [
        (1, f"{prose(rng, 300)} Permission is hereby granted, free of charge, to any person obtaining a copy of this software {prose(rng, 300)}"),
        (2, "the public library holds a licence to lend films"),
        (3, f"a\nlicensed under the GNU General Public License, version 3\nReleased under the MIT License.\n{prose(rng, 90)}"),
    ]
    found = [(r["doc_id"], r["family"], r["start_word"]) for r in L.scan(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()]
    assert [f[:2] for f in found] == [(1, "mit"), (3, "gpl"), (3, "mit")]
    assert 240 <= found[0][2] <= 300 and [f[2] for f in found[1:]] == [1, 10]


def test_odd_rows_and_empty_table(spark, model):
    df = spark.createDataFrame([(*r, 2) for r in odd_rows(random.Random(2))], SCHEMA + ", family int")
    assert L.scan(df, model).count() == 0
    assert L.scan(df.limit(0), model).count() == 0
    assert L.fit([]).findings(pa.array(["Released under the MIT License.", None]))[0][2] == "mit"


def test_short_notices(spark, model):
    signs = SIGNS | {"proprietary": "All rights reserved"}
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    want = {(r["doc_id"], f) for r in docs.collect() for f, sign in signs.items() if sign in r["text"]}
    got = {(r["doc_id"], r["family"]) for r in L.scan(docs, model).collect()}
    assert got == want and sum(f == "proprietary" for _, f in want) == 7
    lines = {"Copyright (c) 2020 A. All rights reserved.": "proprietary", "SPDX-License-Identifier: GPL-2.0-or-later": "gpl", "BSD 2-Clause License": "bsd"}
    found = model.findings(pa.array([*lines, "all of the rights were reserved for them"]))
    assert [f[2] for f in found] == list(lines.values())
    # corpus lines that hold only the short notice are not taught as `unknown`
    taught = L.fit(["All rights reserved."] * 500)
    assert [f[2] for f in taught.findings(pa.array(["All rights reserved."]))] == ["proprietary"]


def test_several_families_and_wrapped_notices(spark, model):
    rows = [
        (1, "Released under the MIT License or the Apache License 2.0"),
        (2, "dual licensed under MPL-2.0, GPL-2.0 and LGPL-2.1"),
        (3, "Some words.\nPermission is hereby granted, free of\n * charge, to any person obtaining a copy\n * of this software"),
        (4, "All rights\n\nreserved."),
        (5, "All rights\nreserved."),
    ]
    found = sorted((r["doc_id"], r["start_word"], r["family"]) for r in L.scan(spark.createDataFrame(rows, "doc_id long, text string"), model).collect())
    assert found == [(1, 0, "mit"), (1, 7, "apache-2.0"), (2, 3, "mpl-2.0"), (2, 6, "gpl"), (2, 10, "lgpl"), (3, 2, "mit"), (5, 0, "proprietary")]
    # a notice that a window's end cuts in two is not another family's
    cut = [" ".join(["word"] * n) + "\nLicensed under CC BY-NC 4.0.\n" + " ".join(["word"] * 30) for n in range(30, 70)]
    assert [(f[0], f[1], f[2]) for f in model.findings(pa.array(cut))] == [(k, k + 30, "cc-by-nc") for k in range(40)]
