from periodload.llm import licenses as L

PROSE = [f"ander whed or {w} thea the thth of ontily\nthe hant {w} ingble and under version of the work" for w in ("re", "ing", "or", "es", "ti", "na", "le", "que", "vi", "ment", "st", "lo")]


def found(spark, docs, **options):
    rows = L.find_licenses(spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as words", "2 as family"), **options).collect()
    return sorted((r["doc_id"], r["paragraph"], r["family"], r["confirmed"]) for r in rows)


def test_notices_are_found_and_prose_is_not(spark):
    docs = list(enumerate(PROSE))
    docs += [
        (100, "Some prose.\n\nLicensed under the Apache License, Version 2.0."), (101, "This work is licensed under the GNU General Public License, version 3.\nReleased under the MIT License."),
        (102, "Licensed under CC BY-NC 4.0."), (103, None), (104, ""), (105, "the version of the work under the re"), (106, "Released under the MIT License."), (106, "Released under the MIT License."),
        (107, "ing or " * 20_000 + "\nlicensed under the apache license version 2.0"),
    ]
    assert found(spark, docs) == [
        (100, 2, "Apache", True), (101, 0, "GPL", True), (101, 1, "MIT", True), (102, 0, "CC", True), (106, 0, "MIT", True), (106, 0, "MIT", True), (107, 1, "Apache", True),
    ]


def test_weights_are_sparse_and_cues_complete():
    model = L.Model([p.lower().split() for p in PROSE])
    assert model.threshold >= 0.5 and model.bias[-1] > max(model.bias[:-1])
    for i, g in enumerate(model.vocabulary):
        if any(w[i] > model.weights[-1][i] for w in model.weights[:-1]):
            assert set(g.split(" ")) & set(model.cues)
    zero = sum(w == 0 for ws in model.weights for w in ws)
    assert zero > len(model.vocabulary)


def test_empty_table_and_native_plan(spark):
    assert found(spark, []) == []
    df = L.find_licenses(spark.createDataFrame([(1, "x")], "doc_id long, text string").filter("doc_id > 0"), model=L.Model([]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


WRAPPED = {
    "MIT": """/*
 * Permission is hereby granted, free of charge, to any person obtaining a copy
 * of this software and associated documentation files (the "Software"), to deal
 * in the Software without restriction, including without limitation the rights
 */""",
    "BSD": """# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions are met:""",
    "GPL": """// This program is free software: you can redistribute it and/or modify
// it under the terms of the GNU General Public License as published by
// the Free Software Foundation, either version 3 of the License, or""",
}


def test_wrapped_notices_are_found_as_blocks(spark):
    docs = list(enumerate(PROSE)) + [(100 + i, f"ander whed or\n\n{t}\n\nthe hant re ingble") for i, t in enumerate(WRAPPED.values())]
    starts = {"MIT": 3, "BSD": 2, "GPL": 2}
    assert [r for r in found(spark, docs) if r[3]] == [(100 + i, starts[f], f, True) for i, f in enumerate(WRAPPED)]
    # No empty line between them, beside a one-line notice, and in most texts of the corpus.
    both = "\n".join([*WRAPPED["MIT"].split("\n")[1:4], WRAPPED["BSD"], "Licensed under CC BY-NC 4.0."])
    docs = list(enumerate(PROSE)) + [(100 + i, both) for i in range(20)]
    assert [r for r in found(spark, docs) if r[3]] == [r for i in range(20) for r in ((100 + i, 0, "BSD", True), (100 + i, 0, "MIT", True), (100 + i, 5, "CC", True))]
