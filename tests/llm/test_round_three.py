"""Cases that came up late: rows without ids, pages that never close a tag, framed pages."""

import random
import time

import numpy as np
import pytest

from emploiscope.llm import decontaminate, dom_boost, jaccard_join, language_id, license_rules

from .test_llm_operators import classes, contamination, near_copies, rows_of


def test_rows_without_an_id_have_their_own_hits(spark, documents):
    random.seed(2)
    words = [f"w{k}" for k in range(400)]
    items = [(f"q{k}", " ".join(random.sample(words, 20))) for k in range(4)]
    clean = [" ".join(random.sample(words, 60)) for _ in range(6)]
    texts = [clean[0], clean[1] + " " + items[0][1], clean[2], items[1][1], clean[3], clean[4] + " " + items[2][1]]
    rows = [(i, t, "a", "en") for i, t in zip([None, None, 7, 7, 8, None], texts, strict=True)]
    items_df = spark.createDataFrame(items, "item_id string, text string")
    found = decontaminate.contamination(documents(rows), items_df).collect()
    key = lambda r: (repr(r[0]), r[1:])
    # The plain version takes numbers as ids; each text is its own document here.
    plain = [(rows[i][0], *rest) for i, *rest in contamination([(i, t, "a", "en") for i, t in enumerate(texts)], items)]
    assert sorted([(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in found], key=key) == sorted([(p[0], p[1], p[2], len(p[3]), p[-1]) for p in plain], key=key)
    kept = decontaminate.drop_contaminated(documents(rows), items_df)
    assert sorted(r["text"] for r in kept.collect()) == sorted([texts[0], texts[2], texts[4]]) and kept.columns == documents(rows).columns


def test_rows_without_an_id_have_their_own_links(documents, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LONG", 3)
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 500)
    rows = [(None if i % 3 == 1 else i // 40 if i % 7 == 2 else i, *rest) for i, *rest in near_copies(240, seed=4)]
    rows += [(1000, "", "a", "en"), (None, " ", "a", "en"), (None, None, "a", "en")]
    out = jaccard_join.similar_documents(documents(rows))
    assert rows_of(out, "doc_id", "n_shingles", "component_id") == classes(rows)
    kept = [(r["doc_id"], r["text"]) for r in jaccard_join.deduplicate(documents(rows)).collect()]
    # Nothing kept links with anything else kept, and each class of the table is still there.
    left = classes([(k, text, "a", "en") for k, (_, text) in enumerate(kept)])
    assert all(i == smallest for i, _, smallest in left)
    assert len(kept) == len({smallest for *_, smallest in classes([(k, *rest) for k, (_, *rest) in enumerate(rows)])})


def test_a_chain_through_a_row_without_an_id(documents):
    words = [f"w{k}" for k in range(60)]
    texts = [" ".join(words), " ".join(words[:56] + ["x"] * 4), " ".join(["y"] * 4 + words[4:56] + ["x"] * 4)]
    out = jaccard_join.similar_documents(documents([(i, t, "a", "en") for i, t in zip([1, None, 2], texts, strict=True)]))
    assert rows_of(out, "doc_id", "component_id") == sorted([(1, 1), (None, 1), (2, 1)], key=repr)
    kept = jaccard_join.deduplicate(documents([(None, texts[1], "a", "en"), (None, texts[2], "a", "en"), (None, texts[2], "b", "en")]))
    assert kept.count() == 1


def test_tags_that_never_close_take_linear_time():
    started = time.perf_counter()
    for part in ("<a ", "<a '", '<a "', "<a x=\"y' ", "<!", "<p <", "</p ", "<a '\"", "< "):
        dom_boost.parse(part * (300_000 // len(part)))
    assert time.perf_counter() - started < 20


def test_framed_pages_keep_their_article(spark):
    body = "<h1>Title here</h1><p>The first long paragraph of the article stands here, and goes on for a while.</p><p>Let <math>x</math> be <svg><text>one</text></svg> more sentence of it.</p>"
    text = "Title here\nThe first long paragraph of the article stands here, and goes on for a while.\nLet x be one more sentence of it."
    side = "<nav><a href=1>Home</a> <a href=2>News</a></nav>"
    end = "<footer>All rights reserved</footer>"
    layouts = [
        f"<html><body>{side}<article>{body}</article>{end}</body></html>",
        f"<html><body><form action=x>{side}<article>{body}</article>{end}</form></body></html>",
        f'<html><body class="sidebar-layout has-comments">{side}<article>{body}</article>{end}</body></html>',
        f'<html><body><div class="page sidebar">{side}<main>{body}</main>{end}</div></body></html>',
    ]
    pages = spark.createDataFrame([(i, "u", layouts[i % len(layouts)]) for i in range(40)], "page_id bigint, url string, html string")
    for r in dom_boost.extract_main_text(pages).collect():
        assert r["text"] == text, layouts[r["page_id"] % len(layouts)]


def test_long_words_sum_all_segmentations():
    random.seed(3)
    pieces = ["▁", "a", "b", "ab", "ba", "▁a", "aba", "bab", "abbabaab"]
    vocabulary = language_id.Vocabulary.of(pieces)
    values = np.random.default_rng(1).random((len(pieces) + 1, 2)) / 3
    model = language_id.Model(vocabulary, ["x", "y"], values, np.zeros(2))
    for length in (1, 39, 40, 41, 57, 200):
        word = "▁" + "".join(random.choice("abc") for _ in range(length))
        # These likelihoods are within a double, so the batched recursion has no need of scaling.
        plain, _ = model.forward(language_id._codes([word]))
        assert language_id._log_sums(values, model.pieces_of(word)) == pytest.approx(np.log(plain[0]))
        assert model.expected_of_long(word, np.array([2.0, 1.0])) == pytest.approx(model.expected([word], np.array([[2.0, 1.0]])))
    logs = language_id._log_sums(values * 1e-5, model.pieces_of("▁" + "ab" * 2000))
    assert np.isfinite(logs).all() and (logs[-1] < -5000).all()
    started = time.perf_counter()
    model.classify(["ab" * 50_000])
    assert time.perf_counter() - started < 30


def test_licence_sentences_of_any_length():
    grant = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
    notice = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    as_is = "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to fitness."
    for words in (1, 200, 20_000):
        tail = "including the rights to use" + " and to use" * words + "."
        assert license_rules.scan_text(f"{grant}{tail}\n\n{notice}\n\n{as_is}")[0] == ["MIT"], words
    cases = {
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.': ["Apache-2.0"],
        "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License.": ["Apache-2.0"],
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": ["MPL-2.0"],
        "// SPDX-License-Identifier: (MIT OR Apache-2.0)\nint x;": ["mit-or-apache-2.0"],
        "int y;\n# SPDX-License-Identifier: MIT\nimport x": ["mit"],
    }
    for text, expected in cases.items():
        assert license_rules.scan_text(text)[0] == expected, text
