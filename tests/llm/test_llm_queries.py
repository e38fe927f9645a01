"""The registered queries against their SQL, the pipeline against a brute-force version, and the registration."""

import random
import zlib
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from crosscheck.compare import connect, differences
from emploiscope.llm import queries, temperature_mix
from emploiscope.llm.workspace import Workspace, without

from .test_llm_operators import SPACED, classes, contamination, near_copies, repeat_words

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_agrees_with_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.ORACLES[name]) == ""


def test_every_operator_is_registered():
    names = entry.queries()
    assert [sum(x.startswith(f"op{n}_") for x in names) for n in range(1, 14)] == [1] * 13
    assert names["pipeline"] is corpus_pipeline.run and "pipeline" not in entry.oracle_sql()


@pytest.mark.parametrize("name", ["op2", "op4", "op6", "op7", "op9", "op10"])
def test_other_queries_return_every_row(spark, name):
    query = next(q for k, q in queries.QUERIES.items() if k.startswith(f"{name}_"))
    df = query(spark, SF_DIR)
    rows = df.collect()
    if name == "op4":
        text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
        assert all(r["candidate"] in text[r["doc_id"]] for r in rows)
        planted = {(i, x) for i, t in text.items() if t for x in __import__("re").findall(r'token = "([0-9a-f]{40})"', t)}
        assert planted <= {(r["doc_id"], r["candidate"]) for r in rows if r["is_secret"]}
    else:
        table, key = ("pages", "page_id") if name == "op6" else ("documents", "doc_id")
        ids = [r[0] for r in spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(key).collect()]
        assert sorted(r[key] for r in rows) == sorted(ids)
    if name == "op9":
        lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang").collect()}
        held = [r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"] and lang[r["doc_id"]]]
        assert sum(held) >= 0.95 * len(held)


def kept_by_quality(rows):
    def norm(line):
        return " ".join(SPACED.findall(line)).lower()

    holders, size = defaultdict(lambda: defaultdict(set)), defaultdict(set)
    for _, t, s, _ in rows:
        size[s].add(t)
        for line in t.split("\n"):
            holders[s][norm(line)].add(t)
    out = []
    for row in rows:
        t, s = row[1], row[2]
        words = SPACED.findall(t)
        over = [x for x in t.split("\n") if norm(x) and len(holders[s][norm(x)]) > 5 and 100 * len(holders[s][norm(x)]) > 5 * len(size[s])]
        kept = len(words) - sum(len(SPACED.findall(x)) for x in over)
        if len(words) >= 10 and 100 * repeat_words(words) <= 20 * len(words) and kept >= 10 and 100 * kept >= 50 * len(words):
            out.append(row)
    return out


def test_pipeline_against_brute_force(spark, documents, tmp_path):
    random.seed(12)
    items = [(f"q{k}", " ".join(random.choice("abcdefghij") * 2 for _ in range(30))) for k in range(5)]
    rows = []
    for i, text, *_ in near_copies(160, seed=21):
        if i % 11 == 0:
            text += " " + random.choice(items)[1]
        lines = text.split(" ")
        text = "\n".join(" ".join(lines[k : k + 12]) for k in range(0, len(lines), 12))
        if i % 4 == 0:
            text = "all rights are reserved by us and by nobody else at all\n" + text
        rows.append((i, text, "big" if i % 3 else f"s{i % 2}", "en"))
    documents(rows).select("doc_id", "text", "lang", "source", "n_words").withColumnRenamed("n_words", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, work, stages = docs.columns, Workspace(spark, "test"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = work.save(stage(spark, docs, str(tmp_path)), name.replace(" ", "-"))
        stages.append(docs)
    assert all(s.columns == columns for s in stages[:-1])
    ids = [sorted(r[0] for r in s.select("doc_id").collect()) for s in stages]

    good = kept_by_quality(rows)
    assert ids[0] == [r[0] for r in good]
    first = {c for i, _, c in classes(good)}
    assert ids[1] == sorted(first)
    left = [r for r in good if r[0] in first]
    bad = {i for i, *_, contaminated in contamination(left, items) if contaminated}
    left = [r for r in left if r[0] not in bad]
    assert ids[2] == [r[0] for r in left] and bad

    # Mixing: every document once, and each source up to its weight within one document.
    tokens, used, longest = Counter(), Counter(), Counter()
    length = {i: len(SPACED.findall(t)) for i, t, *_ in left}
    source = {r[0]: r[2] for r in left}
    for i in ids[2]:
        tokens[source[i]] += length[i]
        longest[source[i]] = max(longest[source[i]], length[i])
    for i in ids[3]:
        used[source[i]] += length[i]
    assert set(ids[3]) == set(ids[2])
    table = spark.createDataFrame(list(tokens.items()), "key string, tokens bigint")
    exponent = temperature_mix.find_exponent(table, temperature_mix.Target())
    largest = max(tokens.values())
    for s, n in tokens.items():
        budget = n * (largest / n) ** (1 - exponent)
        assert budget - 1 <= used[s] < budget + longest[s]

    # Sharding: sizes, checksums, equal texts together, gapless slots.
    text = {r[0]: r[1] for r in left}
    shards, slots = defaultdict(set), defaultdict(list)
    result = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in result) == ids[3] == ids[4]
    for r in result:
        raw = text[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 8, zlib.crc32(raw))
        shards[raw].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
    assert all(len(x) == 1 for x in shards.values()) and all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_without_by_broadcast_and_by_shuffle(spark, documents, monkeypatch):
    docs, keys = documents([(i, "t", "a", "en") for i in range(9)]), spark.createDataFrame([(2,), (4,)], "doc_id bigint")
    for most in (10, 0):
        monkeypatch.setattr("emploiscope.llm.workspace.BROADCAST_KEYS", most)
        assert without(docs, keys, "doc_id").count() == 7
