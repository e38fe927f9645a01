"""Language identification by unigrams over a fixed vocabulary of pieces, summed over all segmentations.

A language is a probability for every piece of a public vocabulary. A word's likelihood is the sum,
over all ways to cut it into pieces, of the product of their probabilities, computed by a forward
recursion over its characters, in batches of words of one length or, for long words, one by one with
likelihoods scaled as they go. A text's likelihood is the product over its words. The
probabilities are fitted by expectation maximisation on a bounded sample of labelled texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emploiscope.llm.text import gives_back
from emploiscope.llm.workspace import Workspace

SAMPLE_PER_LANGUAGE = 400
ROUNDS = 3
MAX_PIECE = 16
SHORT = 40
KNOWN_WORDS = 200_000
FLOOR = 1e-6
UNKNOWN = "und"
START = "▁"

_LETTERS = re.compile(r"[^\W\d_]+")
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)


def letters(text: str | None) -> list[str]:
    """The lower-cased runs of letters of a text; none if it has no letter at all."""
    found = _LETTERS.findall(text.lower()) if text else []
    return found if any(c.isalpha() for word in found for c in word) else []


def _powers(n: int) -> np.ndarray:
    steps = np.full(n + 1, _BASE)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


def _prefix_hashes(codes: np.ndarray) -> np.ndarray:
    """``codes``: words of one length, as rows of code points. Column j: hash of the first j characters."""
    out = np.zeros((codes.shape[0], codes.shape[1] + 1), dtype=np.uint64)
    for j in range(codes.shape[1]):
        out[:, j + 1] = out[:, j] * _BASE + codes[:, j] + _U(1)
    return out


@dataclass
class Vocabulary:
    """The pieces, sorted by hash. Id ``len(hashes)`` stands for any single character that is no piece."""

    hashes: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, pieces: list[str]) -> Vocabulary:
        # The text is lower-cased, so pieces with upper case could never match.
        pieces = sorted({p for p in pieces if p and len(p) <= MAX_PIECE and p == p.lower()})
        hashed = {}
        for n in sorted({len(p) for p in pieces}):
            same = [p for p in pieces if len(p) == n]
            hashed |= dict(zip(_prefix_hashes(_codes(same))[:, -1].tolist(), [n] * len(same), strict=True))
        order = sorted(hashed)
        return cls(np.array(order, dtype=np.uint64), np.array([hashed[h] for h in order]))

    def ids(self, prefix: np.ndarray, i: int, j: int, powers: np.ndarray) -> np.ndarray:
        """Piece ids of characters i to j of every word; -1 where they are no piece and more than one character."""
        return self.ids_of(prefix[:, j] - prefix[:, i] * powers[j - i], j - i)

    def ids_of(self, hashes: np.ndarray, length: int) -> np.ndarray:
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        return np.where(self.hashes[at] == hashes, at, len(self.hashes) if length == 1 else -1)


def _codes(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).reshape(len(words), -1).astype(np.uint64)


def _log_sums(probability: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Row j: log of the likelihood of the first j characters, summed over all segmentations.

    ``ids[k - 1, j - 1]`` is the piece of k characters that ends at character j, or -1.
    """
    steps, length = ids.shape
    # Id -1 takes the last row: no piece, no likelihood.
    padded = np.vstack([probability, np.zeros(probability.shape[1])])
    recent = np.zeros((steps, probability.shape[1]))
    recent[0] = 1.0
    shift = np.zeros(probability.shape[1])
    out = np.zeros((length + 1, probability.shape[1]))
    for low in range(0, length, 1024):
        chosen = padded[ids[:, low : low + 1024]]
        for j in range(chosen.shape[1]):
            now = (recent * chosen[:, j]).sum(axis=0)
            out[low + j + 1] = np.log(now) + shift
            recent[1:] = recent[:-1].copy()
            recent[0] = now
            if j % steps == 0:
                top = recent.max(axis=0)
                recent /= top
                shift += np.log(top)
    return out


@dataclass
class Model:
    vocabulary: Vocabulary
    languages: list[str]
    # probability[piece, language]; the last row is any other single character.
    probability: np.ndarray
    prior: np.ndarray
    known: dict[str, int] = field(default_factory=dict)
    scores: list[np.ndarray] = field(default_factory=list)

    def forward(self, codes: np.ndarray) -> tuple[np.ndarray, list[list[tuple[int, np.ndarray]]]]:
        """``alpha[word, j, language]``: likelihood of the first j characters; and the pieces that end at each j."""
        n, length = codes.shape
        prefix, powers = _prefix_hashes(codes), _powers(length)
        alpha = np.zeros((n, length + 1, len(self.languages)))
        alpha[:, 0] = 1.0
        ending: list[list[tuple[int, np.ndarray]]] = [[]]
        for j in range(1, length + 1):
            ending.append([])
            for i in range(max(0, j - MAX_PIECE), j):
                ids = self.vocabulary.ids(prefix, i, j, powers)
                rows = np.flatnonzero(ids >= 0)
                if len(rows):
                    ending[j].append((i, ids))
                    alpha[rows, j] += alpha[rows, i] * self.probability[ids[rows]]
        return alpha, ending

    def pieces_of(self, word: str) -> np.ndarray:
        """``ids[k - 1, j - 1]``: the piece of k characters that ends at character j of a word, or -1."""
        codes = _codes([word])
        prefix, powers = _prefix_hashes(codes)[0], _powers(MAX_PIECE)
        ids = np.full((MAX_PIECE, len(word)), -1, dtype=np.int32)
        for k in range(1, min(MAX_PIECE, len(word)) + 1):
            ids[k - 1, k - 1 :] = self.vocabulary.ids_of(prefix[k:] - prefix[:-k] * powers[k], k)
        return ids

    def expected_of_long(self, word: str, counts: np.ndarray) -> np.ndarray:
        """As ``expected``, for one word of any length."""
        ids = self.pieces_of(word)
        starting = np.full_like(ids, -1)
        for k in range(1, min(MAX_PIECE, len(word)) + 1):
            starting[k - 1, : len(word) - k + 1] = ids[k - 1, k - 1 :]
        before, after = _log_sums(self.probability, ids), _log_sums(self.probability, starting[:, ::-1])[::-1]
        total = np.zeros_like(self.probability)
        for k in range(1, min(MAX_PIECE, len(word)) + 1):
            end = np.flatnonzero(ids[k - 1] >= 0) + 1
            piece = ids[k - 1, end - 1]
            np.add.at(total, piece, np.exp(before[end - k] + after[end] - before[-1]) * self.probability[piece] * counts)
        return total

    def expected(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        """Expected piece counts of words (all of one length, ``counts[word, language]``) over all segmentations."""
        codes = _codes(words)
        alpha, ending = self.forward(codes)
        beta = np.zeros_like(alpha)
        beta[:, -1] = 1.0
        for j in range(codes.shape[1], 0, -1):
            for i, ids in ending[j]:
                rows = np.flatnonzero(ids >= 0)
                beta[rows, i] += beta[rows, j] * self.probability[ids[rows]]
        weight = counts / alpha[:, -1]
        total = np.zeros_like(self.probability)
        for j, pieces in enumerate(ending):
            for i, ids in pieces:
                rows = np.flatnonzero(ids >= 0)
                np.add.at(total, ids[rows], alpha[rows, i] * self.probability[ids[rows]] * beta[rows, j] * weight[rows])
        return total

    def _learn(self, words: set[str]) -> None:
        """Log likelihoods of new words, by length; the memory for words is bounded."""
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.known, self.scores, new = {}, [], list(words)
        by_length: dict[int, list[tuple[int, str]]] = {}
        logs = np.zeros((len(new), len(self.languages)))
        for k, word in enumerate(new):
            marked = START + word
            if len(marked) > SHORT:
                logs[k] = _log_sums(self.probability, self.pieces_of(marked))[-1]
            else:
                by_length.setdefault(len(marked), []).append((k, marked))
        for parts in by_length.values():
            for low in range(0, len(parts), 4096):
                index, strings = zip(*parts[low : low + 4096], strict=True)
                alpha, _ = self.forward(_codes(list(strings)))
                logs[list(index)] = np.log(alpha[:, -1])
        base = len(self.known)
        self.known.update(zip(new, range(base, base + len(new)), strict=True))
        self.scores.append(logs)

    def classify(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The most likely language and its posterior; equal ones go to the first in order."""
        found = [letters(t) for t in texts]
        self._learn(set().union(*found))
        scores = self.scores[0] if len(self.scores) == 1 else np.concatenate(self.scores)
        self.scores = [scores]
        languages, posterior = [], []
        for words in found:
            if not words:
                languages.append(UNKNOWN)
                posterior.append(0.0)
                continue
            times = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))
            total = self.prior + scores[times].sum(axis=0)
            best = int(np.argmax(total))
            languages.append(self.languages[best])
            posterior.append(float(1.0 / np.exp(total - total[best]).sum()))
        return languages, posterior


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts: Counter = Counter()
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            # Once per text, so that no long text stands for its language.
            counts.update((lang, word) for word in set(letters(text)))
        yield pd.DataFrame([(a, b, n) for (a, b), n in counts.items()], columns=["lang", "word", "n"])


def fit(labelled: DataFrame, pieces: list[str], per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Fit on ``labelled(doc_id, text, lang)``, at most ``per_language`` texts (whole) of each language.

    The sample is chosen by a hash of doc_id, so only its word counts reach the driver: their number
    is bounded by the sample, not by the corpus. Priors are the shares of all labelled rows.
    """
    work = Workspace(labelled.sparkSession, "language-id")
    labelled = labelled.filter("lang is not null and text is not null and doc_id is not null")
    shares = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = labelled.select("doc_id", "lang").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= per_language)
    sample = labelled.join(F.broadcast(work.save(chosen.select("doc_id", "lang").distinct(), "sample")), ["doc_id", "lang"])
    counts = sample.select("lang", "text").mapInPandas(_count_words, "lang string, word string, n bigint")
    words = counts.groupBy("lang", "word").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(shares)
    vocabulary = Vocabulary.of(pieces)
    n = len(vocabulary.hashes) + 1
    prior = np.log(np.array([shares[x] for x in languages], dtype=float) / max(1, sum(shares.values())))
    model = Model(vocabulary, languages, np.full((n, len(languages)), 1.0 / n), prior)
    place = {x: k for k, x in enumerate(languages)}
    by_length: dict[int, dict[str, np.ndarray]] = {}
    # In a fixed order, so that sums do not depend on how rows arrive.
    for lang, word, times in sorted(words.itertuples(index=False)):
        marked = START + word
        by_length.setdefault(len(marked), {}).setdefault(marked, np.zeros(len(languages)))[place[lang]] += times
    for _ in range(ROUNDS):
        total = np.zeros_like(model.probability)
        for length, parts in by_length.items():
            if length > SHORT:
                for word, times in parts.items():
                    total += model.expected_of_long(word, times)
                continue
            strings, counts = list(parts), np.array(list(parts.values()))
            for low in range(0, len(strings), 8192):
                total += model.expected(strings[low : low + 8192], counts[low : low + 8192])
        model.probability = total / np.maximum(total.sum(axis=0), 1e-300) * (1 - FLOOR * n) + FLOOR
    return model


def _predict(model: Model):
    kept: list[Model] = []

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not kept:
            kept.append(Model(model.vocabulary, model.languages, model.probability, model.prior))
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                rows = batch.slice(low, 256)
                languages, scores = kept[0].classify(rows.column("text").to_pylist()) if model.languages else ([UNKNOWN] * rows.num_rows, [0.0] * rows.num_rows)
                arrays = [rows.column("doc_id"), rows.column("held_out"), pa.array(languages, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def identify_languages(docs: DataFrame, pieces: list[str], per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` per row of ``docs(doc_id, text, lang)``.

    A document is held out of the fit if crc32 of its doc_id as text is 2 modulo 4; one without
    doc_id is neither held out nor fitted on. Prediction sees the text alone. A text that is null or
    has no letter is ``und`` with score 0, and so is everything if no labelled row can be learned
    from. ``score`` is the posterior of the predicted language. Repeated rows are predicted alike.
    Other columns are ignored; an empty table gives none.
    """
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), held_out.alias("held_out"))
    model = fit(rows.filter("not held_out"), pieces, per_language)
    return rows.select("doc_id", "text", "held_out").mapInArrow(_predict(model), "doc_id bigint, held_out boolean, lang_pred string, score double")
