"""Licence scan: ties, several licences of a file, identifiers, independence
of other files, and the prefilter against all windows."""

import pytest
from pyspark.sql import functions as F

from pitchside.llm import licenses

CODE = "\n\n" + "\n".join(f"value_{n} = compute(value_{n - 1}, other)" for n in range(40))
APACHE, MIT = "Licensed under the Apache License, Version 2.0.", "Released under the MIT License."


def scanned(spark, files, **options):
    df = spark.createDataFrame(files, "path string, body string")
    return {r["path"]: r for r in licenses.scan(df, F.col("path"), F.col("body"), **options).collect()}


def test_ties_several_licences_and_identifiers(spark):
    got = scanned(spark, [
        ("a/x", f"{MIT}\n\n{CODE}\n\n{APACHE}"), ("b/x.py", "# SPDX-License-Identifier: MIT" + CODE),
        ("c/x.c", "/* SPDX-License-Identifier: Apache-2.0 */" + CODE), ("d/x.js", "// SPDX-License-Identifier: Zlib" + CODE),
        ("e/LICENSE", MIT), ("e/y.py", "y = 1"), ("f/x", None), ("f/x", None), ("g/x", "")])
    assert (got["a/x"]["licence"], got["a/x"]["licences"]) == ("Apache-2.0", ["Apache-2.0", "MIT"])
    assert got["b/x.py"]["licence"] == "MIT" and got["c/x.c"]["licence"] == "Apache-2.0"
    assert got["d/x.js"]["licence"] is None and got["d/x.js"]["licences"] == []
    assert (got["e/y.py"]["origin"], got["e/y.py"]["licences"]) == ("inherited", ["MIT"])
    assert got["f/x"]["licence"] is None and got["g/x"]["licence"] is None


def test_other_files_do_not_change_a_licence(spark):
    own = [("a/x.py", "# " + MIT + CODE), ("b/x.py", "Copyright 2020 A. All rights reserved." + CODE)]
    alone = scanned(spark, own)
    crowd = [(f"z/{n}", f"{APACHE} Copyright of the license {n}, all rights, version {n}.") for n in range(60)]
    among = scanned(spark, own + crowd)
    for path, _ in own:
        assert (alone[path]["licence"], alone[path]["score"]) == (among[path]["licence"], among[path]["score"])


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_prefilter_loses_no_licence(spark, sf):
    """Without the prefilter every window meets the templates: same licences."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(f"s/{r.doc_id}/f", r.text) for r in docs.collect() if r.text and len(r.text) < 4000]
    rows += [(f"t/{n}/f", "/*\n * " + text.replace(", ", ",\n * ") + "\n */" + CODE) for n, (_, text) in enumerate(licenses.TEMPLATES)
             if len(text) < 700]
    near = scanned(spark, rows)
    wide = scanned(spark, rows, min_near=0.05)
    assert {p: (r["licence"], r["licences"]) for p, r in near.items()} == {p: (r["licence"], r["licences"]) for p, r in wide.items()}
    assert sum(r["licence"] is not None for r in near.values()) > 30
