"""Personal data in texts: strict spans, and further ones proposed by generators and chosen by boosted trees.

Strict spans (e-mail and IP addresses, card and phone numbers in their usual forms) always stay.
Generators with high recall propose overlapping spans in other forms: written-out or full-width
at signs, bracketed dots, other separators, phone numbers without a plus sign. Boosted trees judge
them by format and context, and a threshold per kind, set on findings held out from the fit, decides.
The fit sees all distinct findings that are not held out, the thresholds all that are.

The fit needs no labels from outside, though it takes them. A strict span found in the corpus is
rewritten in the forms the generators look for, and in broken forms of the same shape, both in
their real context; candidates that their own digits refute are counterexamples as they stand.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emploiscope.llm.dom_boost import Forest
from emploiscope.llm.table_boost import boost_table
from emploiscope.llm.text import gives_back
from emploiscope.llm.workspace import Workspace

KINDS = ("email", "ip", "card", "phone")
# One finding in so many is held out from the fit, for the thresholds.
HELD_OUT_ONE_IN = 3
PRECISION = 0.99
LEAST_SCORE = 0.5
# Held-out findings are counted by so many equal steps of score, so that no task ranks all of a kind. No result depends on it.
SCORE_STEPS = 4096
NEAR = 40

# The strict forms. Repeats are possessive, which changes no match and keeps long texts linear.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# What the generators look for, and words that tell of personal data or against it.
_AT = re.compile(r"[@＠]|[(\[{] ?at ?[)\]}]", re.I)
_BEFORE_AT = re.compile(r"[^\s@＠<>()\[\]{},;:\"']{1,64} ?\Z")
_AFTER_AT = re.compile(r" ?[^\W_][\w-]{0,62}(?: ?(?:\.|[(\[{] ?(?:dot|\.) ?[)\]}]) ?[\w-]{1,63}){1,4}", re.I)
_ANY_IP = re.compile(r"(?<![\w.])[0-9]{1,3}(?:(?: ?\. ?|[(\[]\.[)\]]|[(\[]dot[)\]])[0-9]{1,3}){3}(?![\w.])", re.I)
_ANY_CARD = re.compile(r"(?<![\w.])[0-9]{2,19}(?:[ .\-/  ][0-9]{2,6}){0,8}(?!\w)")
_ANY_PHONE = re.compile(r"(?<![\w+.])\(?[0-9](?:[ ().\-/ ]{0,3}[0-9]){6,14}(?!\w)")
_TELLING = (
    re.compile(r"\b(?:e-?mail|mail|courriel|correo|contact|kontakt|contacto|write|schreib)", re.I),
    re.compile(r"\b(?:ip|host|server|serveur|servidor|address|adresse|login|client)\b", re.I),
    re.compile(r"\b(?:card|visa|mastercard|amex|credit|karte|kreditkarte|carte|tarjeta|payment)", re.I),
    re.compile(r"\b(?:tel|phone|call|mobile|mobil|fax|tél|telefon|teléfono|whatsapp|ruf|appel)", re.I),
)
_AGAINST = re.compile(r"(?:\b(?:version|ver|release|build|section|isbn|issn|doi|id|no|nr|order|serial|date|page|figure)\b|[#§$€£v])[ .:]*\Z", re.I)
_DATE = re.compile(r"(?:[0-9]{1,2}[./-][0-9]{1,2}[./-](?:19|20)?[0-9]{2}|(?:19|20)[0-9]{2}[./-][0-9]{1,2}[./-][0-9]{1,2})\b")
_DIGITS = re.compile(r"[0-9]+")

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if place % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def strict_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind that pass its check, by start and kind."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > last and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            last = domain.end()
            out.append((begin, 0, last))
        at = text.find("@", max(last, at + 1))
    for m in _IP.finditer(text):
        if all(map(_byte, m.group().split("."))):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if 12 <= m.end() - m.start() and 12 <= len(digits := "".join(_DIGITS.findall(m.group()))) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(map(len, _DIGITS.findall(m.group()))) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def proposed_spans(text: str) -> list[Span]:
    """Spans the generators propose; kinds may overlap each other and the strict spans."""
    out = []
    for m in _AT.finditer(text):
        before = _BEFORE_AT.search(text, max(0, m.start() - 65), m.start())
        after = _AFTER_AT.match(text, m.end()) if before else None
        if after:
            out.append((before.start(), 0, after.end()))
    out += [(m.start(), 1, m.end()) for m in _ANY_IP.finditer(text)]
    for kind, pattern, least, most in ((2, _ANY_CARD, 12, 19), (3, _ANY_PHONE, 7, 15)):
        for m in pattern.finditer(text):
            if m.end() - m.start() >= least and least <= sum(map(len, _DIGITS.findall(m.group()))) <= most:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


FEATURES = 26


def span_features(text: str, span: Span) -> list[float]:
    """Format of the span itself and its context."""
    start, kind, end = span
    s = text[start:end]
    before, after = text[max(0, start - NEAR) : start], text[end : end + NEAR]
    # Names in addresses may hold any digits; they say nothing.
    groups = _DIGITS.findall(s) if kind else []
    digits = "".join(groups)
    sizes = [len(g) for g in groups] or [0]
    separators = [c for c in s if not c.isalnum()]
    last = re.split(r"[^\w]+", s.rstrip("])} "))[-1]

    def side(c: str) -> float:
        return 0.0 if not c else 1.0 if c.isspace() else 2.0 if c in ".,;:!?" else 3.0 if not c.isalnum() else 4.0

    return [
        *[float(kind == k) for k in range(len(KINDS))],
        float(len(s)),
        float(len(digits)),
        float(len(groups)),
        float(max(sizes)),
        float(min(sizes)),
        float(sizes[0]),
        float(sizes[-1]),
        float(len(set(separators))),
        float(len(separators)),
        float(any(c in "/.  " for c in separators)),
        float(luhn(digits)) if 11 < len(digits) < 20 else -1.0,
        float(all(map(_byte, groups))) if len(groups) == 4 else -1.0,
        float(len(last)) if last.isalpha() else -1.0,
        float(bool(_DATE.search(s))),
        float(s[:1] == "+" or s[:2] == "00"),
        float(s[:1] in "(0"),
        side(before[-1:]),
        side(after[:1]),
        float(bool(_TELLING[kind].search(before))),
        float(any(bool(p.search(before)) for k, p in enumerate(_TELLING) if k != kind)),
        float(bool(_AGAINST.search(before))),
        float(before.count("\n") > 0),
    ]


def refuted(text: str, span: Span) -> bool:
    """Whether the span's own digits or letters say that it can't be of its kind."""
    start, kind, end = span
    s = text[start:end]
    groups = _DIGITS.findall(s)
    if kind == 0:
        return not re.search(r"[^\W\d_]{2,}\W*\Z", s)
    if kind == 1:
        return not all(map(_byte, groups))
    if kind == 2:
        return not luhn("".join(groups))
    return bool(_DATE.search(s)) or len(groups) < 2 or not 9 <= sum(map(len, groups)) <= 15


def rewritten(s: str, kind: int) -> tuple[list[str], list[str]]:
    """Other forms of a strict span, and broken forms of the same shape."""
    digits = "".join(_DIGITS.findall(s))
    fours = [digits[i : i + 4] for i in range(0, len(digits), 4)]
    if kind == 0:
        local, domain = s.split("@")
        name = domain.rsplit(".", 1)[0]
        forms = [f"{local} (at) {domain}", f"{local}[at]{domain}", f"{local}＠{domain}", f"{local} [at] " + domain.replace(".", " [dot] ")]
        return forms, [f"{local}＠{name}.{len(s)}", f"{local} (at) {name}.{len(s) % 10}", f"{local}[at]{name}.x{len(s)}"]
    if kind == 1:
        parts = s.split(".")
        broken = [*parts[:3], str(256 + int(parts[3]))]
        return ["[.]".join(parts), "(.)".join(parts), " . ".join(parts), "[dot]".join(parts)], ["[.]".join(broken), " . ".join(broken), "(.)".join(broken)]
    if kind == 2:
        wrong = digits[:-1] + str((int(digits[-1]) + 1 + len(s) % 8) % 10)
        four = [wrong[i : i + 4] for i in range(0, len(wrong), 4)]
        return [".".join(fours), "/".join(fours), " ".join(fours)], [".".join(four), "/".join(four), " ".join(four), wrong]
    shown = s[1:]
    home = re.sub(r"\A[0-9]{1,3}[ .-]+(?=[(0-9])", "", shown)
    return [shown, home, "00" + shown, shown.replace("-", "/").replace(" ", "/"), shown.replace("-", ".")], [
        f"{int(digits[-2:]) % 28 + 1:02d}.{int(digits[-3:-1]) % 12 + 1:02d}.20{digits[-2:]}",
        f"20{digits[-2:]}-{int(digits[-3:-1]) % 12 + 1:02d}-{int(digits[-2:]) % 28 + 1:02d}",
        digits,
    ]


def _examples(text: str, strict: list[Span], proposed: list[Span]) -> Iterator[tuple[int, int, list[float]]]:
    """``(kind, label, features)`` to fit on: rewritten strict spans, and refuted candidates."""
    for start, kind, end in strict:
        before, after = text[max(0, start - NEAR) : start], text[end : end + NEAR]
        for label, forms in zip((1, 0), rewritten(text[start:end], kind), strict=True):
            for form in forms:
                yield kind, label, span_features(before + form + after, (len(before), kind, len(before) + len(form)))
    for span in proposed:
        if refuted(text, span):
            yield span[1], 0, span_features(text, span)


def _open(strict: list[Span], proposed: list[Span]) -> list[Span]:
    """The proposed spans that touch no strict one. Both are sorted by start."""
    taken = np.array([(a, b) for a, _, b in strict]).reshape(-1, 2)
    reach = np.maximum.accumulate(taken[:, 1])
    out = []
    for start, kind, end in proposed:
        # Strict spans of different kinds may nest, so the furthest end so far decides.
        before = int(np.searchsorted(taken[:, 0], end)) - 1
        if before < 0 or reach[before] <= start:
            out.append((start, kind, end))
    return out


_SPANS = "doc_id bigint, strict array<int>, proposed array<int>, features array<float>, examples array<float>"
_HAS = re.compile(r"[0-9@＠]|[(\[{] ?at", re.I)


@gives_back
def _propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its strict and proposed spans (start, kind, end each), features, and examples (kind, label, features each)."""
    for batch in batches:
        columns: list[list] = [[], [], [], []]
        for text in batch.column("text").to_pylist():
            strict = proposed = still = []
            if text and _HAS.search(text):
                strict, proposed = strict_spans(text), proposed_spans(text)
                still = _open(strict, proposed)
            columns[0].append([x for span in strict for x in span])
            columns[1].append([x for span in still for x in span])
            columns[2].append([x for span in still for x in span_features(text, span)])
            columns[3].append([x for kind, label, values in _examples(text, strict, still) for x in (kind, label, *values)])
        types = [pa.list_(pa.int32())] * 2 + [pa.list_(pa.float32())] * 2
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=["doc_id", "strict", "proposed", "features", "examples"])


@dataclass
class Model:
    """The forest and the least score of every kind."""

    forest: Forest
    thresholds: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.forest.log_odds(x)))


def thresholds(scored: DataFrame) -> np.ndarray:
    """Per kind, from all rows of ``kind, label, score``, the least score that is taken; 2 (none) without such a score.

    It lies half-way below the least score down to which ``PRECISION`` of the findings are right; equal
    scores pass together, some of the last of them right.
    """
    step = F.floor(F.col("score") * SCORE_STEPS).alias("step")
    each = scored.groupBy("kind", "score", step).agg(F.sum(F.col("label").cast("bigint")).alias("right"), F.count("*").alias("n"))
    above = Window.partitionBy("kind").orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, -1)
    per_step = each.groupBy("kind", "step").agg(F.sum("right").alias("right"), F.sum("n").alias("n"))
    before = per_step.select("kind", "step", *(F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in ("right", "n")))
    down = Window.partitionBy("kind", "step").orderBy(F.desc("score"))
    right, n = (F.sum(c).over(down) + F.col(f"{c}_above") for c in ("right", "n"))
    counted_ = each.join(before, ["kind", "step"]).select("kind", "score", F.when((right / n >= PRECISION) & (F.col("right") > 0), F.col("score")).alias("good"))
    last = counted_.groupBy("kind").agg(F.min("good").alias("last")).filter("last IS NOT NULL")
    below = each.join(last, "kind").groupBy("kind", "last").agg(F.coalesce(F.max(F.when(F.col("score") < F.col("last"), F.col("score"))), F.lit(0.0)).alias("below"))
    out = np.full(len(KINDS), 2.0)
    for r in below.collect():
        out[r["kind"]] = max(LEAST_SCORE, (r["last"] + r["below"]) / 2)
    return out


def fit(examples: DataFrame, work: Workspace) -> Model | None:
    """A model for all distinct rows of ``kind, label, features``; None if those to fit on have one label only."""
    held = F.pmod(F.xxhash64("kind", "label", "features"), F.lit(HELD_OUT_ONE_IN)) == 0
    rows = work.save(examples.select("kind", "label", "features").distinct().withColumn("held", held), "examples")
    forest = boost_table(rows.filter("NOT held"), FEATURES)
    if forest is None:
        return None
    model = Model(forest, np.full(len(KINDS), 2.0))
    model.thresholds = thresholds(rows.filter("held").mapInArrow(_scored(model), "kind int, label int, score double"))
    return model


def _scored(model: Model) -> Callable:
    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("features").flatten().to_numpy().astype(np.float64).reshape(-1, FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column("kind"), batch.column("label"), pa.array(model.scores(x))], names=["kind", "label", "score"])

    return run


def chosen(spans: list[Span], scores: np.ndarray, thresholds: np.ndarray) -> list[Span]:
    """Of overlapping spans above their threshold the best scored stays, then the longest, then the first."""
    ranked = sorted((-score, s[0] - s[2], *s) for s, score in zip(spans, scores.tolist(), strict=True) if score >= thresholds[s[1]])
    out: list[Span] = []
    for *_, start, kind, end in ranked:
        if all(end <= a or b <= start for a, _, b in out):
            out.append((start, kind, end))
    return out


def _triples(flat: list[int]) -> list[Span]:
    return list(zip(flat[::3], flat[1::3], flat[2::3], strict=True))


def _judge(model: Model | None) -> Callable:
    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("features").flatten().to_numpy().astype(np.float64).reshape(-1, FEATURES)
            scores = model.scores(flat) if model is not None else np.zeros(len(flat))
            rows, at = [], 0
            for strict, proposed in zip(batch.column("strict").to_pylist(), batch.column("proposed").to_pylist(), strict=True):
                strict, proposed = _triples(strict), _triples(proposed)
                added = chosen(proposed, scores[at : at + len(proposed)], model.thresholds) if model is not None else []
                at += len(proposed)
                rows.append([_spans(strict), _spans(sorted([*strict, *added])), [s for s, _, _ in sorted(added)]])
            types = [_SPAN_LIST, _SPAN_LIST, pa.list_(pa.int32())]
            arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)] if rows else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=["doc_id", "strict", "spans", "added"])

    return run


_SPAN_LIST = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def _spans(spans: list[Span]) -> list[dict]:
    return [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans]


def find_personal_data(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """``doc_id, strict, spans, added`` per row of ``docs(doc_id, text)``.

    ``strict`` and ``spans`` are lists of (kind, start, end) by start and kind, in code points, the
    end exclusive; ``spans`` are the strict ones and those added, whose starts are ``added``.
    ``labelled(text, start, end, kind, label)`` adds findings judged by people to the fit. Null and
    empty texts have no spans; repeated rows get their own; null doc_ids are carried; other columns
    are ignored, so their names cannot clash; an empty table gives an empty table. Without findings
    of both labels nothing is added.
    """
    work = Workspace(docs.sparkSession, "personal-data")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = work.save(rows.mapInArrow(_propose, _SPANS), "spans")
    step = FEATURES + 2
    each = found.filter(F.size("examples") > 0).select("examples", F.explode(F.sequence(F.lit(1), F.size("examples"), F.lit(step))).alias("i"))
    each = each.select(F.slice("examples", F.col("i"), F.lit(step)).alias("e"))
    examples = each.select(F.col("e")[0].cast("int").alias("kind"), F.col("e")[1].cast("int").alias("label"), F.slice("e", 3, FEATURES).alias("features"))
    if labelled is not None:
        examples = examples.union(labelled.mapInArrow(_labelled_features, "kind int, label int, features array<float>"))
    return found.drop("examples").mapInArrow(_judge(fit(examples, work)), "doc_id bigint, strict array<struct<kind:string,start:int,end:int>>, spans array<struct<kind:string,start:int,end:int>>, added array<int>")


def _labelled_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [r for r in batch.to_pylist() if r["text"] and r["kind"] in KINDS and r["label"] is not None]
        kinds = [KINDS.index(r["kind"]) for r in rows]
        values = [span_features(r["text"], (r["start"], k, r["end"])) for r, k in zip(rows, kinds, strict=True)]
        arrays = [pa.array(kinds, pa.int32()), pa.array([int(r["label"]) for r in rows], pa.int32()), pa.array(values, pa.list_(pa.float32()))]
        yield pa.RecordBatch.from_arrays(arrays, names=["kind", "label", "features"])


def listed(spans: str) -> F.Column:
    """A list of spans as text: kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def counted(spans: str, kind: str) -> F.Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def redact(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in brackets; of overlapping ones the first, as far as it reaches."""
    out, at = [], 0
    for start, kind, end in sorted(spans):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind]}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])
