"""Each operator against a plain computation on small fixtures, and on the awkward cases it promises to take."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from emploiscope.llm import (
    arrow_tokens,
    decontaminate,
    dom_boost,
    jaccard_join,
    karmarkar_karp,
    language_id,
    license_rules,
    line_rules,
    secret_forest,
    temperature_mix,
)
from emploiscope.llm.components import components
from emploiscope.llm.queries import tokenizer_path
from emploiscope.llm.text import blocks
from emploiscope.llm.workspace import Workspace

SPACED = re.compile("[^\x20\x09-\x0d]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


# --- line rules -----------------------------------------------------------------------------------


def repeat_words(words):
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
    return len(covered)


def test_line_rules_against_plain_python(documents):
    random.seed(3)
    texts = []
    for i in range(60):
        lines = [" ".join(random.choice("alpha beta gamma delta eps zeta eta #x $y".split()) for _ in range(random.randint(1, 14))) for _ in range(random.randint(1, 8))]
        if i % 3 == 0:
            lines.insert(0, "  Read   MORE on our site ")
        texts.append("\n".join(lines))
    rows = [(i, t, "abc"[i % 2], "en") for i, t in enumerate(texts)]
    found = {r["doc_id"]: r for r in line_rules.judge_documents(documents(rows)).collect()}
    norm = lambda line: " ".join(SPACED.findall(line)).lower()
    host = defaultdict(lambda: defaultdict(set))
    size = defaultdict(set)
    for i, t, s, _ in rows:
        size[s].add(t)
        for line in t.split("\n"):
            if SPACED.search(line):
                host[s][norm(line)].add(t)
    for i, t, s, _ in rows:
        words = SPACED.findall(t)
        lines = [x for x in t.split("\n") if SPACED.search(x)]
        over = [x for x in lines if len(host[s][norm(x)]) > 5 and 100 * len(host[s][norm(x)]) > 5 * len(size[s])]
        kept = len(words) - sum(len(SPACED.findall(x)) for x in over)
        failed = len(words) < 10 or 100 * repeat_words(words) > 20 * len(words)
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), repeat_words(words))
        assert (r.base_failed, r.n_kept_words, r.kept) == (failed, kept, not failed and kept >= 10 and 100 * kept >= 50 * len(words))


def test_boilerplate_goes_and_copies_do_not_count(documents):
    body = lambda i: " ".join(f"w{i}x{k}" for k in range(12))
    notice = "please accept all cookies of this site before you go on reading here now and then again later today"
    rows = [(i, f"{notice}\n{body(i)}", "a", "en") for i in range(20)]
    rows += [(100 + i, "\n".join(body(7000 + k) for k in range(3)), "a", "en") for i in range(30)]
    found = {r["doc_id"]: r for r in line_rules.judge_documents(documents(rows)).collect()}
    assert not found[3].kept and found[3].n_kept_words == 12  # less than half is left
    assert found[100].kept and found[100].n_kept_words == 36  # thirty copies are one document


def test_boilerplate_lines_leave_the_text(documents):
    body = lambda i: " ".join(f"w{i}x{k}" for k in range(12))
    rows = [(i, f"  Read   MORE here\n\n{body(i)} \n \nread more HERE\n{body(i + 500)}", "a", "en") for i in range(20)]
    rows += [(20, "read more here", "a", "en"), (21, "read more here\nx", None, "en"), (22, None, "a", "en"), (3, *rows[3][1:])]
    out = line_rules.without_boilerplate(documents(rows))
    assert out.columns == documents(rows).columns
    expected = [(i, f"\n{body(i)} \n \n{body(i + 500)}") for i in [*range(20), 3]]
    expected += [(20, ""), (21, "read more here\nx"), (22, None)]
    assert rows_of(out, "doc_id", "text") == sorted(expected, key=repr)
    words = {r["doc_id"]: r["n_kept_words"] for r in line_rules.judge_documents(documents(rows)).collect()}
    assert all(words[i] == len((t or "").split()) for i, t in expected)
    assert line_rules.without_boilerplate(documents([])).count() == 0


def test_line_rules_edges(documents, edge_rows):
    out = line_rules.judge_documents(documents(edge_rows))
    assert out.count() == len(edge_rows)
    kept = {r["doc_id"]: r for r in out.collect()}
    assert kept[1].n_words == kept[2].n_words == kept[3].n_words == 0 and not kept[1].kept
    assert kept[4].n_words == 120_000 and kept[4].kept
    assert line_rules.judge_documents(documents([])).count() == 0
    docs = documents(edge_rows)
    assert rows_of(line_rules.keep_documents(docs), "doc_id") == [(4,), (7,)]
    assert line_rules.keep_documents(docs).columns == docs.columns


# --- sharding -------------------------------------------------------------------------------------


def test_differencing_is_tight_and_complete():
    random.seed(5)
    sizes = [random.randint(1, 10**6) for _ in range(600)]
    shard = karmarkar_karp.difference(sizes, 24)
    load = Counter()
    for s, k in zip(sizes, shard, strict=True):
        load[k] += s
    assert len(load) == 24 and max(load.values()) - min(load.values()) < 2000
    assert karmarkar_karp.difference([], 24) == []
    assert sorted(karmarkar_karp.difference([8, 7, 6, 5, 4], 2).count(k) for k in (0, 1)) == [2, 3]


def test_differencing_against_the_best_split():
    random.seed(6)
    for _ in range(20):
        sizes = [random.randint(1, 50) for _ in range(8)]
        shard = karmarkar_karp.difference(sizes, 2)
        got = abs(sum(s if k else -s for s, k in zip(sizes, shard, strict=True)))
        best = min(abs(sum(s * x for s, x in zip(sizes, signs, strict=True))) for signs in itertools.product((1, -1), repeat=8))
        assert best <= got <= best + 12


def test_shards(documents, edge_rows):
    rows = edge_rows + [(1000 + i, "copy of one text", "a", "en") for i in range(50)] + [(2000 + i, f"text {i} " * (i % 9), "a", "en") for i in range(200)]
    out = karmarkar_karp.shard_documents(documents(rows), 24, carry=("text",)).collect()
    assert len(out) == len(rows)
    where, slots = defaultdict(set), defaultdict(list)
    for r in out:
        text = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(text) + 8, zlib.crc32(text), "bytes", None)
        where[text].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
    assert all(len(x) == 1 for x in where.values())
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert karmarkar_karp.shard_documents(documents([])).count() == 0
    with pytest.raises(ValueError):
        karmarkar_karp.shard_documents(documents([]), carry=("slot",))


def test_slots_in_pieces(documents, monkeypatch):
    monkeypatch.setattr(karmarkar_karp, "SLOT_ROWS", 3)
    out = karmarkar_karp.shard_documents(documents([(i, f"t{i % 40}", "a", "en") for i in range(300)]), 5).collect()
    by = defaultdict(list)
    for r in out:
        by[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in by.values())


# --- mixing ---------------------------------------------------------------------------------------


def test_mixture_meets_its_limits(documents):
    rows = [(i, "w " * 40, "big" if i < 800 else f"s{i % 8}", "en") for i in range(1000)]
    target = temperature_mix.Target(entropy_share=0.8, max_repeats=3.0)
    out = temperature_mix.mix_sources(documents(rows), target).toPandas()
    tokens = out[out.epoch == 0].groupby("source").n_tokens.sum()
    used = out.groupby("source").n_tokens.sum()
    assert len(out[out.epoch == 0]) == 1000
    assert (used / tokens).max() <= 3.0 + 40 / tokens.min()
    exponent = out.exponent.iloc[0]
    weights = (tokens / tokens.sum()) ** exponent
    weights /= weights.sum()
    # Realised weights differ from those wanted by a document at most.
    assert (abs(used / used.sum() - weights) < 0.005).all()
    for _, group in out.groupby(["source", "epoch"]):
        assert sorted(group.block.unique()) == list(range(group.block.nunique()))
    for _, group in out.groupby(["source", "epoch", "block"]):
        assert sorted(group.slot) == list(range(len(group)))


def entropy_share(tokens, exponent):
    w = np.array(tokens, dtype=float) ** exponent
    w /= w.sum()
    return -(w * np.log(w)).sum() / np.log(len(w))


def test_exponent_against_a_scan(spark):
    tokens = [10_000, 500, 700, 20, 4000]
    sources = spark.createDataFrame([(str(i), t) for i, t in enumerate(tokens)], "key string, tokens bigint")
    found = temperature_mix.find_exponent(sources, temperature_mix.Target(0.9, 1e9))
    assert entropy_share(tokens, found) >= 0.9 > entropy_share(tokens, found + 2e-6)
    found = temperature_mix.find_exponent(sources, temperature_mix.Target(1.0, 4.0))
    assert 500 ** (1 - found) <= 4.0 < 500 ** (1 - found + 2e-6)
    assert temperature_mix.find_exponent(sources, temperature_mix.Target(0.1, 1e9)) == 1.0
    assert temperature_mix.find_exponent(sources.filter("tokens = 500"), temperature_mix.Target()) == 1.0


def test_mixture_edges(documents, edge_rows, monkeypatch):
    monkeypatch.setattr(temperature_mix, "BLOCK_TOKENS", 500)
    docs = documents(edge_rows)
    out = temperature_mix.mix_sources(docs, carry=("lang",))
    assert out.filter("epoch = 0").count() == len(edge_rows)
    assert {r[0] for r in out.select("source").distinct().collect()} == {"a", "b", None}
    mixed = temperature_mix.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == out.count()
    assert temperature_mix.mix_sources(documents([])).count() == 0
    with pytest.raises(ValueError):
        temperature_mix.mix_sources(docs, carry=("slot",))


# --- secrets --------------------------------------------------------------------------------------


def test_secrets_found_and_words_left_alone(documents):
    random.seed(8)
    key = lambda n: "".join(random.choice("0123456789abcdef") for _ in range(n))
    rows, planted = [], set()
    for i in range(300):
        text = "some internationalisation counterrevolutionaries words and more " * 3
        if i % 4 == 0:
            secret = key(40)
            text += f' token = "{secret}" end'
            planted.add((i, secret))
        elif i % 4 == 1:
            secret = "AKIA" + "".join(random.choice("ABCDEFGHJKLMNPQ0123456789") for _ in range(16))
            text += f" key {secret} end"
            planted.add((i, secret))
        elif i % 4 == 2:
            text += f" commit {key(40)} end"
        rows.append((i, text, "a", "en"))
    out = secret_forest.scan_secrets(documents(rows)).collect()
    assert {(r["doc_id"], r["candidate"]) for r in out if r["is_secret"]} == planted
    assert len(out) > len(planted) + 300


def test_stems_are_counted_over_all_documents(documents):
    letters = "abcdefghijklmno"
    common = ["".join(x) for x in itertools.product(letters, letters, letters, "z")]
    rows = [(i, " ".join(common), "a", "en") for i in range(6)]
    rows += [(10 + i, "zebra " * 50 if i == 0 else "zzzz" if i < 5 else "other yyyy", "b", "en") for i in range(30)]
    assert secret_forest.frequent_stems(documents(rows)) == sorted([*common, "othe", "ther", "yyyy"])


def test_secrets_edges(documents, edge_rows):
    assert secret_forest.scan_secrets(documents([])).count() == 0
    out = secret_forest.scan_secrets(documents(edge_rows + [(9, "password=b7db7aa4a5fcc78305", None, None)])).collect()
    assert [(r["doc_id"], r["candidate"], r["is_secret"]) for r in out] == [(9, "b7db7aa4a5fcc78305", True)]


# --- similarity join ------------------------------------------------------------------------------


def shingles(text):
    w = SPACED.findall(lower(text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def classes(rows):
    sets = [(i, shingles(t)) for i, t, *_ in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                parent[root(a)] = root(b)
    ids = defaultdict(list)
    for k, (i, _) in enumerate(sets):
        ids[root(k)].append(i)
    return sorted([(i, len(s), min([x for x in ids[root(k)] if x is not None], default=None)) for k, (i, s) in enumerate(sets)], key=repr)


def near_copies(n, seed=1):
    """Texts with hot passages, groups of copies edited a little or a lot, chains and short texts."""
    random.seed(seed)
    vocabulary = [f"v{i}" for i in range(400)]
    passages = [" ".join(random.choice(vocabulary) for _ in range(30)) for _ in range(2)]
    bases = [[random.choice(vocabulary) for _ in range(random.choice((40, 90, 160)))] for _ in range(max(2, n // 40))]
    rows = []
    for i in range(n):
        kind = random.random()
        if kind < 0.6:
            words = list(bases[0] if kind < 0.35 else random.choice(bases))
            for _ in range(random.choice((0, 1, 1, 2, 3, 4))):
                words[random.randrange(len(words))] = random.choice(vocabulary)
        elif kind < 0.8:
            words = [random.choice(vocabulary) for _ in range(random.randint(1, 60))] + random.choice(passages).split()
        else:
            words = [random.choice(vocabulary[:6]) for _ in range(random.randint(1, 7))]
        rows.append((i, " ".join(words).replace("v1", "V1") if i % 2 else " ".join(words), "a", "en"))
    return rows


@pytest.mark.parametrize(("n", "long", "block"), [(300, 16, 10**6), (300, 3, 500)])
def test_join_against_all_pairs(documents, monkeypatch, n, long, block):
    monkeypatch.setattr(jaccard_join, "LONG", long)
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", block)
    rows = near_copies(n, seed=long)
    out = jaccard_join.similar_documents(documents(rows))
    assert rows_of(out, "doc_id", "n_shingles", "component_id") == classes(rows)


def test_join_of_short_near_copies_in_large_groups(documents):
    """The shared lists of a group are long, and in some groups none of them is in the lowest share of hashes."""
    random.seed(31)
    rows = []
    for group in range(60):
        passage = [f"g{group}w{k}" for k in range(12 + group % 8)]
        rows += [(len(rows) + k, " ".join([*passage, f"own{group}x{k}"]), "a", "en") for k in range(40)]
    random.shuffle(rows)
    out = jaccard_join.similar_documents(documents(rows))
    assert rows_of(out, "doc_id", "component_id") == sorted(((i, i - i % 40) for i, *_ in rows), key=repr)


def test_join_without_broadcast(documents, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BROADCAST_IDS", 0)
    rows = near_copies(120, seed=9)
    assert rows_of(jaccard_join.similar_documents(documents(rows)), "doc_id", "n_shingles", "component_id") == classes(rows)


def test_join_edges(documents, edge_rows):
    out = jaccard_join.similar_documents(documents(edge_rows))
    assert rows_of(out, "doc_id", "n_shingles", "component_id") == classes(edge_rows)
    assert jaccard_join.similar_documents(documents([])).count() == 0
    docs = documents(edge_rows)
    kept = jaccard_join.deduplicate(docs)
    assert kept.columns == docs.columns
    # 7 is 4 again, the text without an id is 5 again, and so is the second row of 5.
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == [1, 2, 3, 4, 5, 6, 8]


def test_occurrences_counts_or_gives_up():
    random.seed(2)
    for _ in range(200):
        a = np.unique(np.array([random.randrange(3000) for _ in range(random.randint(1, 300))], dtype=np.uint64))
        b = np.unique(np.array([random.randrange(3000) for _ in range(random.randint(1, 300))] + a[: random.randint(0, len(a))].tolist(), dtype=np.uint64))
        common = len(np.intersect1d(a, b))
        for required in (1, len(a) // 2, len(a)):
            found = jaccard_join.occurrences(a, b, max(1, required))
            assert found == common if common >= max(1, required) else found < max(1, required)


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (200, 201), (201, 200)], "a bigint, b bigint")
    found = {r["node"]: r["component"] for r in components(links, Workspace(spark, "test")).collect()}
    assert found == {**{i: 0 for i in range(61)}, 200: 200, 201: 200}


# --- decontamination ------------------------------------------------------------------------------

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def contamination(rows, items):
    windows = defaultdict(set)
    for item, text in items:
        w = WORDS.findall(lower(text or ""))
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k : k + n])].add(str(item))
    sizes = {len(x) for x in windows}
    out = []
    for i, text, *_ in rows:
        w = WORDS.findall(lower(text or ""))
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if own := windows.get(tuple(w[k : k + n])):
                    found |= own
                    hit.update(range(k, k + n))
        out.append((i, len(w), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [10**6, 40])
def test_contamination_against_plain_python(spark, documents, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_SHINGLES", block)
    random.seed(4)
    word = lambda: random.choice(("aa", "bb", "cc", "dd", "Eé", "ff1"))
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate((30, 13, 14, 7, 3, 1, 40, 25))] + [(98, None), (99, "?!"), (97, "zz")]
    rows = []
    for i in range(80):
        text = [word() for _ in range(random.randint(0, 60))]
        if i % 3 == 0:
            source = items[random.randrange(8)][1].split()
            text[5:5] = source[random.randint(0, 3) :]
        rows.append((i, ", ".join(text).upper() if i % 2 else "\n".join(text), "a", "en"))
    bench = spark.createDataFrame([(*x, 1) for x in items], "item_id int, text string, n_words int")
    out = decontaminate.contamination(documents(rows), bench)
    assert rows_of(out, "doc_id", "n_words", "n_hit", "items", "contaminated") == contamination(rows, items)


def test_contamination_edges(spark, documents, edge_rows):
    bench = spark.createDataFrame([("q1", "one two three"), ("q2", None)], "item_id string, text string")
    out = decontaminate.contamination(documents(edge_rows), bench)
    got = {(r["doc_id"], r["n_hit"], r["contaminated"]) for r in out.collect()}
    assert out.count() == len(edge_rows) and {(5, 3, True), (None, 3, True), (1, 0, False), (4, 0, False)} <= got
    assert decontaminate.contamination(documents([]), bench).count() == 0
    assert decontaminate.contamination(documents(edge_rows), bench.limit(0)).filter("n_hit > 0").count() == 0
    kept = decontaminate.drop_contaminated(documents(edge_rows), bench)
    assert kept.filter("doc_id = 5").count() == 0 and kept.count() == len(edge_rows) - 3


# --- licences -------------------------------------------------------------------------------------


def test_licences():
    mit = (
        'MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use.\nThe above copyright notice and this permission notice shall be included "
        'in all copies or substantial portions of the Software.\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
        "FITNESS. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT."
    )
    cases = {
        "Text.\nLicensed under the Apache Licence, Version 2.0.\nMore.": ["Apache-2.0"],
        "This work is licensed under the GNU General Public License, version 3.": ["GPL-3"],
        "Released under the MIT License.\nLicensed under CC BY-NC 4.0.": ["MIT", "CC-BY-NC-4.0"],
        "// SPDX-License-Identifier: Apache-2.0": ["apache-2.0"],
        mit: ["MIT"],
        "We gave him licence to speak. He wore a copyright badge.": [],
        "": [],
    }
    for text, expected in cases.items():
        assert license_rules.scan_text(text)[0] == expected, text
    order = [("bsd-grant", ""), ("bsd-source", ""), ("bsd-binary", ""), ("bsd-as-is", "")]
    assert license_rules.licences_of(order) == ["BSD-2-Clause"]
    assert license_rules.licences_of([order[0], ("unknown", ""), *order[1:]]) == []


def test_licence_headers_in_comments():
    import textwrap

    headers = {
        "MIT": (
            'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\n'
            'The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n'
            'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT.'
        ),
        "BSD-2-Clause": (
            'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n'
            '1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n'
            '2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n\n'
            'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING FITNESS, ARE DISCLAIMED.'
        ),
        "GPL-3": (
            'This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.\n\n'
            'This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.'
        ),
    }
    for name, text in headers.items():
        lines = [x for part in text.split("\n") for x in textwrap.wrap(part, 66) or [""]]
        assert license_rules.scan_text("\n".join(lines))[0] == [name]
        for start, leader, end in (("/*\n", " * ", "\n */"), ("", " * ", ""), ("", "# ", ""), ("", "// ", ""), ("", "-- ", ""), ("/* ", "", " */")):
            comment = start + "\n".join((leader + x).rstrip() for x in lines) + end + "\n\nint main() {}"
            assert license_rules.scan_text(comment) == license_rules.scan_text(text), (name, leader)
    listed = "/* x */ y\n* Licensed under the Apache License, Version 2.0\n* Released under the MIT License\n"
    assert license_rules.scan_text(listed)[0] == ["Apache-2.0", "MIT"]


def test_licence_table(documents, edge_rows):
    out = license_rules.scan_licenses(documents(edge_rows + [(20, "x\nReleased under the MIT License.", "a", "en")]))
    assert out.count() == len(edge_rows) + 1
    assert rows_of(out.filter("size(licenses) > 0"), "doc_id", "licenses") == [(20, ["MIT"])]
    assert license_rules.scan_licenses(documents([])).count() == 0


# --- pages ----------------------------------------------------------------------------------------

PAGE = (
    "<!DOCTYPE html><html><head><title>t</title><script>var t='</p>';</script></head><body><nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav>"
    "<div class=\"ad\">Buy {i} now.</div><article><h1>Title {i}</h1><p><b>First &amp; foremost, a paragraph number {i} with words.<br><p>Second  one,\n longer than the first, {more}</p></article>"
    "<footer>&copy; site {i} &middot; imprint</footer>{end}"
)


def pages(spark, n=60):
    rows = [(i, f"http://x/{i}", PAGE.format(i=i, more="and so on. " * (i % 7 + 1), end="</body></html>" if i % 3 else ""), "k") for i in range(n)]
    rows += [(900, None, None, "k"), (901, "u", "", "k"), (901, "u", "", "k"), (None, "u", "<p>a<p>b", "k")]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")


def test_pages(spark):
    found = {r["page_id"]: r for r in dom_boost.extract_main_text(pages(spark)).collect()}
    for i in range(60):
        more = " ".join(("and so on. " * (i % 7 + 1)).split())
        assert found[i].text == f"Title {i}\nFirst & foremost, a paragraph number {i} with words.\nSecond one, longer than the first, {more}"
        assert found[i].n_chars == len(found[i].text)
    assert found[900].text == found[901].text == ""
    assert dom_boost.extract_main_text(pages(spark).limit(0)).count() == 0


def test_unseen_layouts(spark):
    forest = dom_boost.fit(pages(spark, 200))

    def read(source):
        page = dom_boost.parse(source)
        return dom_boost.main_text(page, dom_boost.decode(page, forest.log_odds(dom_boost.features(page))))

    inner = "<p>Body one, long enough to be text, with a clause.</p>{}<p>Body two, which is rather long as well.</p>"
    for extra in ('<aside class="ad">Buy!</aside>', '<section class="comments"><p>A reader says hello.</p></section>', "<form><p>Your name</p><input></form>", '<div id="cookie-notice"><p>We use cookies.</p></div>'):
        text = read(f"<body><nav><a href=a>A</a></nav><article><h1>T</h1>{inner.format(extra)}</article></body>")
        assert text == "T\nBody one, long enough to be text, with a clause.\nBody two, which is rather long as well."


def test_decoding_is_the_best_consistent_labelling():
    random.seed(1)
    for _ in range(50):
        n = random.randint(2, 8)
        page = dom_boost.Page(["#page"] * n, [(0, 0)] * n, [-1, *[random.randrange(i) for i in range(1, n)]], [(i, "x" * random.randint(1, 9)) for i in range(1, n)], [0] * n, [0] * n)
        odds = np.array([random.uniform(-3, 3) for _ in range(n)])

        def value(keep):
            return sum(len(t) * -np.logaddexp(0, -odds[i] if keep[i] else odds[i]) for i, t in page.runs)  # noqa: B023

        allowed = [k for k in itertools.product((False, True), repeat=n) if k[0] and all(not k[i] or k[page.parents[i]] for i in range(1, n))]
        assert value(dom_boost.decode(page, odds)) == pytest.approx(max(map(value, allowed)), abs=0.05)


# --- languages ------------------------------------------------------------------------------------


def segmentations(word, probability):
    if not word:
        return 1.0
    return sum(probability[word[:k]] * segmentations(word[k:], probability) for k in range(1, len(word) + 1) if word[:k] in probability)


def test_forward_sums_all_segmentations():
    pieces = ["▁", "a", "b", "ab", "ba", "▁a", "▁ab", "aba", "bab"]
    vocabulary = language_id.Vocabulary.of(pieces)
    random.seed(1)
    values = np.array([[random.random()] for _ in range(len(pieces) + 1)])
    by_piece = {}
    for p in pieces:
        prefix = language_id._prefix_hashes(language_id._codes([p]))
        by_piece[p] = values[vocabulary.ids(prefix, 0, len(p), language_id._powers(len(p)))[0], 0]
    by_piece["c"] = values[-1, 0]
    model = language_id.Model(vocabulary, ["x"], values, np.zeros(1))
    words = ["▁abab", "▁baba", "▁cabc", "▁aaaa"]
    alpha, _ = model.forward(language_id._codes(words))
    assert alpha[:, -1, 0] == pytest.approx([segmentations(w, by_piece) for w in words])
    # Expected counts of one word: each piece's share of the likelihood.
    total = model.expected(["▁abab"], np.array([[1.0]]))
    lengths = np.append(vocabulary.lengths, 1)
    assert (total[:, 0] * lengths).sum() == pytest.approx(5.0)


def test_languages(documents, edge_rows):
    random.seed(2)
    stems = {"en": "th ing er on st".split(), "de": "sch ung ein er ß".split()}
    rows = []
    for i in range(200):
        lang = "en" if i % 2 else "de"
        text = " ".join("".join(random.choice(stems[lang]) for _ in range(3)) for _ in range(20))
        rows.append((1000 + i, text, "a", lang))
    pieces = ["▁", *"abcdefghijklmnopqrstuvwxyzß", "th", "ing", "sch", "ung", "▁th", "ein", "er"]
    out = language_id.identify_languages(documents(rows + edge_rows + [(70, "² 123 ...", "a", "en")]), pieces, per_language=60)
    found = {r["doc_id"]: r for r in out.collect()}
    assert all(found[i].lang_pred == lang for i, _, _, lang in rows)
    assert all(found[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, *_ in rows)
    assert [found[i].lang_pred for i in (1, 2, 3, 70)] == ["und"] * 4 and found[70].score == 0
    assert out.count() == len(rows) + len(edge_rows) + 1 and all(0 <= r.score <= 1 for r in found.values())
    assert language_id.identify_languages(documents([]), pieces).count() == 0
    assert {r["lang_pred"] for r in language_id.identify_languages(documents([(1, "text", "a", None)]), pieces).collect()} == {"und"}


# --- token files ----------------------------------------------------------------------------------


def test_pieces_are_encoded_as_whole_texts():
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    encoder = arrow_tokens.Encoder(path)
    random.seed(3)
    parts = [" ", "  ", "\n", "\t", "a", "It's", "x1", "é", " ", " ", "...", "<|endoftext|>", "日本", "\x1c", "\x85", "'ll"]
    texts = ["", " ", "  ", " a", "a ", "a  b", "a \n b", "\n a", "don't  stop", *("".join(random.choice(parts) for _ in range(12)) for _ in range(400))]
    for some in (texts, texts[::-1], ["", ""], []):
        column = pa.array([*some, "x"])
        for low, high, data, offsets in blocks(column, size=300):
            ids, counts = encoder.encode(data, offsets)
            ends = np.cumsum(counts)
            for text, end, n in zip(column.to_pylist()[low:high], ends.tolist(), counts.tolist(), strict=True):
                assert ids[end - n : end].tolist() == [*whole.encode(text, add_special_tokens=False).ids, 0], repr(text)


def test_sequences_round_trip(spark, documents, edge_rows, monkeypatch):
    monkeypatch.setattr(arrow_tokens, "KNOWN_PIECES", 20)
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    rows = edge_rows + [(100 + i, f"text {i} and more " * (i % 5), "a", "en") for i in range(40)] + [(90, "a <|endoftext|> b", "a", "en")]
    manifest = arrow_tokens.write_sequences(documents(rows), path, length=64).persist()
    out = arrow_tokens.document_digests(manifest).collect()
    stream = {}
    at = 0
    for i, text, *_ in sorted(rows, key=lambda r: -1 if r[0] is None else r[0]):
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        stream.setdefault(i, []).append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, out), key=repr) == sorted((x for v in stream.values() for x in v), key=repr)
    file = manifest.orderBy("part").first()
    sequences = arrow_tokens.Sequences(file["path"])
    ids, mask = sequences.sequence(0)
    assert len(ids) == len(mask) == 64 and mask.all() == (file["n_tokens"] >= 64)
    assert (ids == sequences.tokens(0, 64)).all() if file["n_tokens"] >= 64 else True
    assert arrow_tokens.document_digests(arrow_tokens.write_sequences(documents([]), path)).count() == 0
