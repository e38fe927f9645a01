"""Source divergence, personal data and the prefix trie against plain versions of their definitions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from emploiscope.llm import personal_data, prefix_trie, queries, source_divergence, table_boost
from emploiscope.llm.workspace import Workspace

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def divergences(rows):
    """rows: (text, lang, source)."""
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(LOWER))) for text, lang, source in rows]
    holders, group = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in docs:
        holders[lang].update(set(terms))
        group[lang, source].update(terms)
    kept = {lang: sorted(t for t, n in c.items() if n >= 3) for lang, c in holders.items()}
    out = []
    for lang, source in group:
        terms, v = kept[lang], len(kept[lang])
        mine = {s: c for (k, s), c in group.items() if k == lang}
        whole = Counter()
        for c in mine.values():
            whole.update(c)

        def shares(c, terms=terms, v=v):
            n = sum(c[t] for t in terms)
            return {t: 1 + 10**9 * (c[t] + 1) // (n + v) for t in terms}

        p, q = shares(mine[source]), shares(whole)
        pairs = []
        for other, c in mine.items():
            if other != source:
                r = shares(c)
                pairs.append((-sum((p[t] - r[t]) ** 2 // r[t] for t in terms), other))
        found = [(-((p[t] - q[t]) ** 2 // q[t]), t) for t in terms if mine[source][t] and p[t] > q[t]]
        for part, ranked, most in (("pair", pairs, None), ("term", found, 200)):
            ranked.sort(key=lambda x: (x[0], x[1].encode()))
            out += [(lang, source, part, item, -value, k) for k, (value, item) in enumerate(ranked[:most], 1)]
    return sorted(out)


def divergence_rows(seed):
    random.seed(seed)
    vocabulary = [f"{a}{b}" for a in "abcdé" for b in "xyzük"] + ["Zz", "ZZ", "日本", "\U0001f600", "ﬀ"]
    rows = []
    for _ in range(120):
        words = random.choices(vocabulary, weights=range(1, len(vocabulary) + 1), k=random.randint(0, 40))
        rows.append((random.choice([" ", "1", "\n-"]).join(words), random.choice(["en", "de", None, ""]), random.choice(["a", "b", "ç", None, "B"])))
    return [*rows, (None, "en", "quiet"), ("rare once", "lonely", "s"), (" ".join(f"w{i}" for i in range(40_000)), "en", "a"), *[("so many copies of this", "en", "copies")] * 50]


@pytest.mark.parametrize("seed", [1, 3])
def test_divergence_against_plain_sums(spark, seed, monkeypatch):
    monkeypatch.setattr(source_divergence, "ENTRIES_PER_SUM", 1 << 20 if seed == 1 else 5)
    rows = divergence_rows(seed)
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "text string, lang string, source string, term string, n int")
    found = source_divergence.audit_sources(table, entries_per_block=1 << 20 if seed == 1 else 7)
    assert sorted(tuple(r) for r in found.select("lang", "source", "part", "item", "value", "rank").collect()) == divergences(rows)


def test_divergence_without_terms(spark):
    schema = "text string, lang string, source string"
    assert source_divergence.audit_sources(spark.createDataFrame([], schema)).count() == 0
    rows = [("1 2", "en", "a"), (None, "en", "b"), ("word", None, None)]
    found = source_divergence.audit_sources(spark.createDataFrame(rows, schema)).collect()
    assert sorted(tuple(r) for r in found) == divergences(rows) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


PLAIN = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(re.sub(r"\D", "", s)) <= 19 and checksum(re.sub(r"\D", "", s)) % 10 == 0),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(re.sub(r"\D", "", s)) <= 15),
}


def checksum(digits):
    return sum(int(d) if k % 2 == 0 else sum(map(int, str(2 * int(d)))) for k, d in enumerate(reversed(digits)))


def plain_spans(text):
    out = []
    for place, (kind, (pattern, good)) in enumerate(PLAIN.items()):
        out += [(m.start(), place, m.end(), kind) for m in re.finditer(pattern, text, re.ASCII) if good(m.group())]
    return sorted(out)


def test_strict_spans_against_the_patterns():
    random.seed(5)
    bits = ["4111111111111111", "4111 1111-1111 1111", "1.2.3.4", "1.2.3.4.5", "999.1.1.1", "001.02.3.255", "a.b+c@d-e.fr", "x@y", "@", "+1 (017) 555-7713", "+33", "+", "12", " ", " - ", ".", "é", "-", "(", "b@c.d@e.f_g@h.i"]
    for _ in range(3000):
        text = "".join(random.choices(bits, k=random.randint(1, 9)))
        assert [(s, k, e) for s, k, e, _ in plain_spans(text)] == personal_data.strict_spans(text), text


def test_long_runs_take_linear_time():
    for run in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "1 " * 200_000, "+1(" * 100_000, "@a" * 200_000, "a@" * 200_000):
        personal_data.strict_spans(run)
        personal_data.proposed_spans(run)


def test_personal_data_in_other_forms(spark, documents, edge_rows):
    random.seed(8)
    rows, planted, clean = list(edge_rows), {}, set()
    for i in range(100, 700):
        ip = ".".join(str(random.randint(1, 255)) for _ in range(4))
        body = "".join(random.choice("0123456789") for _ in range(15))
        card = next(body + d for d in "0123456789" if checksum(body + d) % 10 == 0)
        strict = [f"{random.randint(1, 99)}@mail{i}.example.com", ip, card, f"+1 ({random.randint(100, 999)}) 555-{random.randint(1000, 9999)}"][i % 4]
        rows.append((i, f"ordinary words stand before {strict} and some words after it in {random.randint(1900, 2030)}", "a", "en"))
    forms = {0: "who (at) some.example.org", 1: "10[.]20[.]30[.]40", 2: "4111.1111.1111.1111", 3: "(017) 555-7713"}
    for i in range(700, 740):
        planted[i] = (personal_data.KINDS[i % 4], forms[i % 4])
        rows.append((i, f"ordinary words stand before {forms[i % 4]} and some words after it", "a", "en"))
    for i, text in enumerate(["on 12.05.2021 it rained", "number 4111.1111.1111.1112 of all", "version 300[.]20[.]30[.]40 is out", "meet at noon (at) home", "2021-05-12 and 1234567890"], 800):
        clean.add(i)
        rows.append((i, text, "a", "en"))
    found = personal_data.find_personal_data(documents(rows)).collect()
    assert len(found) == len(rows)
    text = {r[0]: r[1] for r in rows}
    for r in found:
        strict = [(s["start"], s["end"], s["kind"]) for s in r["strict"]]
        assert strict == [(s, e, k) for s, _, e, k in plain_spans(text[r["doc_id"]] or "")]
        assert set(strict) <= {(s["start"], s["end"], s["kind"]) for s in r["spans"]}
        if r["doc_id"] in planted:
            assert [(s["kind"], text[r["doc_id"]][s["start"] : s["end"]]) for s in r["spans"]] == [planted[r["doc_id"]]]
        if r["doc_id"] in clean:
            assert not r["spans"]
    assert personal_data.find_personal_data(documents([])).count() == 0
    spans = [(s["start"], personal_data.KINDS.index(s["kind"]), s["end"]) for r in found if r["doc_id"] == 700 for s in r["spans"]]
    assert personal_data.redact(text[700], spans) == "ordinary words stand before [email] and some words after it"


def test_all_findings_are_fitted_and_set_the_thresholds(spark, monkeypatch):
    random.seed(5)
    rows = []
    for _ in range(400):
        x = [random.randint(0, 9) / 2.0 for _ in range(6)]
        rows.append((int(x[1] + x[4] + random.random() > 5), x))
    df = spark.createDataFrame(rows, "label int, features array<float>")
    whole = table_boost.boost_table(df, 6)
    monkeypatch.setattr(table_boost, "DRIVER_ROWS", 0)
    monkeypatch.setattr(table_boost, "TREES", 3)
    dealt = table_boost.boost_table(df.repartition(3), 6)
    assert (whole.feature[:3] == dealt.feature).all() and (whole.threshold[:3] == dealt.threshold).all() and (whole.value[:3] == dealt.value).all()
    assert table_boost.boost_table(df.filter("label = 1"), 6) is None and table_boost.boost_table(df.limit(0), 6) is None

    scored = [(0, int(random.random() > max(0.0, 0.7 - i / 3000) / 5), 0.5 + i / 8000) for i in range(3000)]
    scored += [(1, i % 2, 0.9) for i in range(10)] + [(2, 1, 0.8), (2, 1, 0.7), (2, 0, 0.7), (2, 0, 0.6)]
    got = personal_data.thresholds(spark.createDataFrame(scored, "kind int, label int, score double"))

    def plain(kind):
        mine, least = sorted({s for k, _, s in scored if k == kind}, reverse=True), None
        for s in mine:
            taken = [label for k, label, t in scored if k == kind and t >= s]
            if sum(taken) / len(taken) >= personal_data.PRECISION and any(label for k, label, t in scored if k == kind and t == s):
                least = s
        return 2.0 if least is None else max(0.5, (least + max([s for s in mine if s < least], default=0)) / 2)

    assert got[1:].tolist() == [plain(1), plain(2), 2.0] == [2.0, 0.75, 2.0]
    assert 0.5 < got[0] == plain(0) < 0.875


def test_personal_data_digest(spark, tmp_path):
    rows = [(1, "mail a@b.cd or 1.2.3.4"), (2, None), (3, "")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r for r in queries.op12_personal_data(spark, str(tmp_path)).collect()}
    assert found[1]["spans"] == "email:5:11,ip:15:22" and found[1]["base_sha256"] == hashlib.sha256(b"email:5:11,ip:15:22").hexdigest()
    assert (found[1]["n_email"], found[1]["n_ip"], found[1]["n_card"], found[1]["n_phone"]) == (1, 1, 0, 0)
    assert found[2]["base_sha256"] == found[3]["base_sha256"] == hashlib.sha256(b"").hexdigest()


def trie(rows):
    """rows: (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(x)] for c, x in own.items()}
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 4
        head = c - (c % 20 if c >= 0 else -(-c % 20))
        turns = own.get(head, [])[:h] + own[c][h:]
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)
    out = {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, ())
        saved = (len(members[node]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        out[node] = [1 if not below else sum(out[x][0] for x in below), saved + sum(out[x][1] for x in below)]
    return sorted(
        (members[n][0], len(n), members[n[:-1]][0] if n else None, len(members[n]), len(children.get(n, ())), *out[n], hashlib.sha256(",".join(map(str, ends.get(n, []))).encode()).hexdigest())
        for n in members
    )


def trie_rows(spark, rows):
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, depth int, piece string")
    order = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(r) for r in prefix_trie.conversation_trie(table).select(*order).collect())


def test_trie_against_plain_recursion(spark):
    random.seed(3)
    rows = []
    for c in [*range(-45, 130), 10**12 + 1]:
        for turn in range(random.randint(1, 6)):
            rows.append((c, random.choice([turn, turn, None]), random.choice(["user", "assistant", None]), random.choice(["a b", "a  b\tc", "", None, "x"])))
    rows += [(500, t, "user", f"turn {t}") for t in range(150)] + [(501, t, "user", f"turn {t}") for t in range(150)]
    rows += [(c, t, "user", "same copy") for c in range(600, 700) for t in range(3)] + [(700, 1, "u", "twice"), (700, 1, "u", "twice"), (None, 0, "u", "nobody's"), (3000, 0, None, "w " * 50_000)]
    assert trie_rows(spark, rows) == trie(rows)


def test_trie_of_nothing_and_of_single_turns(spark):
    assert trie_rows(spark, []) == []
    rows = [(c, 0, "user", "hello you") for c in range(41, 60)]
    assert trie_rows(spark, rows) == trie(rows)


def test_contraction_of_any_tree(spark):
    random.seed(11)
    parents = [None] + [random.choice([i - 1, i - 1, i - 1, random.randrange(i)]) for i in range(1, 160)]
    weights = [random.randint(0, 9) for _ in parents]
    depth = [0] * len(parents)
    for i in range(1, len(parents)):
        depth[i] = depth[parents[i]] + 1
    rows = [(i, depth[i], p, None if p is None else depth[p], weights[i]) for i, p in enumerate(parents)]
    table = spark.createDataFrame(rows, "conv_id bigint, depth bigint, parent_conv_id bigint, parent_depth bigint, w bigint")
    total = list(weights)
    for i in reversed(range(1, len(parents))):
        total[parents[i]] += total[i]
    found = prefix_trie.subtree_totals(table, ["w"], Workspace(spark, "test"))
    assert sorted((r["conv_id"], r["w"]) for r in found.collect()) == list(enumerate(total))
