"""Licence scan by sentence rules.

A text is cut into sentences; a normalised sentence is recognised as one of the known licence
sentences and becomes an identifier, with a version where it states one. Licences are ordered rules
over sequences of identifiers: the first rule that fits a stretch of the sequence takes it. A
licence-like sentence that is not known becomes ``unknown`` and breaks a sequence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emploiscope.llm.workspace import bounded_batches

UNKNOWN = "unknown"

# Sentences of public licences, normalised as by normalise(), and their identifiers.
# In a pattern, V stands for a version, ANY for any words.
SENTENCES = [
    ("apache-under", "(?:this (?:work|file|software|project|text) is )?licensed under the apache license,? version V(?: the license)?"),
    ("apache-under", "(?:this (?:work|file|software|project|text) is )?(?:licensed|released) under (?:the )?apache license"),
    ("apache-compliance", "you may not use this file except in compliance with the license"),
    ("apache-copy", "you may obtain a copy of the license at ANY"),
    ("apache-as-is", "unless required by applicable law or agreed to in writing,? software distributed under the license is distributed on an as is basis,? without warranties or conditions of any kind,? either express or implied"),
    ("apache-see", "see the license for the specific language governing permissions and limitations under the license"),
    ("mit-under", "(?:this (?:work|file|software|project|text) is )?(?:licensed|released|distributed) under the (?:terms of the )?mit license"),
    ("mit-title", "(?:the )?mit license(?: mit)?"),
    ("mit-grant", "permission is hereby granted,? free of charge,? to any person obtaining a copy of this software and associated documentation files the software,? to deal in the software without restriction ANY"),
    ("mit-notice", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit-as-is", "the software is provided as is,? without warranty of any kind,? express or implied,? including but not limited to ANY"),
    ("mit-liability", "in no event shall the authors or copyright holders be liable for any claim,? damages or other liability ANY"),
    ("isc-grant", "permission to use,? copy,? modify,? and or distribute this software for any purpose with or without fee is hereby granted,? provided that ANY"),
    ("isc-as-is", "the software is provided as is and the author disclaims all warranties ANY"),
    ("bsd-grant", "redistribution and use in source and binary forms,? with or without modification,? are permitted provided that the following conditions are met"),
    ("bsd-source", "(?:1 )?redistributions of source code must retain the above copyright notice,? this list of conditions and the following disclaimer"),
    ("bsd-binary", "(?:2 )?redistributions in binary form must reproduce the above copyright notice,? this list of conditions and the following disclaimer ANY"),
    ("bsd-endorse", "(?:3 )?neither the name of ANY may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-as-is", "this software is provided by the copyright holders and contributors as is and any express or implied warranties ANY"),
    ("bsd-liability", "in no event shall the copyright (?:holder|owner)s? or contributors be liable for any direct,? indirect ANY"),
    ("bsd-under", "(?:this (?:work|file|software|project|text) is )?(?:licensed|released) under the (?:new |simplified |2 clause |3 clause )?bsd license"),
    ("gpl-under", "(?:this (?:work|file|software|project|text) is )?(?:licensed|released) under the gnu general public license,?(?: version V)?(?: or later)?"),
    ("gpl-redistribute", "(?:this program is free software )?you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation,? either version V of the license,? or at your option any later version"),
    ("lgpl-under", "(?:this (?:work|file|software|project|text) is )?(?:licensed|released) under the gnu (?:lesser|library) general public license,?(?: version V)?(?: or later)?"),
    ("agpl-under", "(?:this (?:work|file|software|project|text) is )?(?:licensed|released) under the gnu affero general public license,?(?: version V)?(?: or later)?"),
    ("gpl-hope", "this program is distributed in the hope that it will be useful,? but without any warranty ANY"),
    ("gpl-details", "see the gnu general public license for more details"),
    ("mpl-under", "this source code form is subject to the terms of the mozilla public license,? v[.]? ?V"),
    ("mpl-under", "(?:this (?:work|file|software|project|text) is )?(?:licensed|released) under the mozilla public license,?(?: version V)?"),
    ("cc-under", "(?:this (?:work|file|article|text) is )?licensed under (?:a |the )?(?:creative commons |cc )(?P<kind>by(?: nc)?(?: sa| nd)?|zero|0)(?: license)?(?: V)?(?: ANY)?"),
    ("cc-under", "(?:this (?:work|file|article|text) is )?licensed under (?:a |the )?creative commons (?P<long>attribution(?: noncommercial| non commercial)?(?: sharealike| share alike| noderivatives| no derivatives)?)(?: V)?(?: international)?(?: license)?(?: V)?"),
    ("public-domain", "this is free and unencumbered software released into the public domain"),
    ("public-domain", "this (?:work|file|text|software) is (?:dedicated to|in) the public domain"),
    ("spdx", "spdx license identifier (?P<spdx>ANY)"),
    ("reserved", "all rights reserved"),
]

# Ordered rules: identifiers in sequence, and the licence they mean. Earlier rules win.
RULES = [
    (("apache-under", "apache-compliance", "apache-copy", "apache-as-is", "apache-see"), "Apache"),
    (("apache-under", "apache-compliance", "apache-copy"), "Apache"),
    (("mit-title", "mit-grant", "mit-notice", "mit-as-is", "mit-liability"), "MIT"),
    (("mit-grant", "mit-notice", "mit-as-is", "mit-liability"), "MIT"),
    (("mit-grant", "mit-notice", "mit-as-is"), "MIT"),
    (("isc-grant", "isc-as-is"), "ISC"),
    (("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is", "bsd-liability"), "BSD-3-Clause"),
    (("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is"), "BSD-3-Clause"),
    (("bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is", "bsd-liability"), "BSD-2-Clause"),
    (("bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is"), "BSD-2-Clause"),
    (("gpl-redistribute", "gpl-hope", "gpl-details"), "GPL"),
    (("gpl-redistribute",), "GPL"),
    (("apache-under",), "Apache"),
    (("mit-under",), "MIT"),
    (("bsd-under",), "BSD"),
    (("gpl-under",), "GPL"),
    (("lgpl-under",), "LGPL"),
    (("agpl-under",), "AGPL"),
    (("mpl-under",), "MPL"),
    (("cc-under",), "CC"),
    (("public-domain",), "Public-Domain"),
    (("spdx",), "SPDX"),
]

# A sentence without one of these can't be a licence sentence.
_TELLING = ("licen", "permission", "redistribut", "copyright", "warrant", "public domain", "as is", "spdx", "rights reserved", "in no event", "endorse")
# No sentence ends inside "v. 2.0"; what the short Apache header says after its semicolon is one of its own.
_SENTENCE = re.compile(r"(?<=;)\s+(?=you may not use this file)|(?<=[.!?])(?<!\b[vV]\.)[\s\"')\]]+(?=[^\s])|\n\s*\n|\n(?=\s*(?:[-*•]|\d+[.)])\s)")
# What a comment puts before each of its lines, and the ends of a block comment.
_LEADER = re.compile(r"^[ \t]*(?P<mark>/\*+|\*+/|//+!?|\#+|--+|;+|%+|\*|<!--|-->)(?=[ \t\n]|$)", re.M)
_CLOSING = re.compile(r"[ \t]*(?:\*+/|-->)[ \t]*$", re.M)
_SPDX_LINE = re.compile(r"^(.*SPDX-License-Identifier:.*)$", re.M | re.I)
_NOISE = re.compile(r"[^a-z0-9.,]+")
_LICENCE_LIKE = re.compile(r"\b(?:licen[sc]e[ds]?|permission is|redistribut\w+|warrant\w+|public domain)\b")


def normalise(sentence: str) -> str:
    """Lower case, one spelling, words and inner points and commas only."""
    text = sentence.lower().replace("licence", "license")
    text = _NOISE.sub(" ", text).strip(" .,")
    return re.sub(r" *, *", ", ", text)


def _compiled() -> list[tuple[str, re.Pattern]]:
    out = []
    for name, pattern in SENTENCES:
        pattern = pattern.replace("V", r"(?:v ?)?(?P<version>\d+(?:\.\d+)*)", 1).replace("V", r"\d+(?:\.\d+)*")
        pattern = pattern.replace(" ANY", r",? ?.*?").replace("ANY", r".*?")
        out.append((name, re.compile(pattern)))
    return out


_PATTERNS = _compiled()


def recognise(sentence: str) -> tuple[str, str] | None:
    """``(identifier, detail)`` of a sentence, ``unknown`` for one that only sounds like a licence, else None."""
    text = normalise(sentence)
    if not any(x in text for x in _TELLING):
        return None
    for name, pattern in _PATTERNS:
        if m := pattern.fullmatch(text):
            groups = m.groupdict()
            detail = " ".join(x for x in (groups.get("kind") or groups.get("long") or groups.get("spdx"), groups.get("version")) if x)
            return name, detail
    return (UNKNOWN, "") if _LICENCE_LIKE.search(text) else None


def _name(licence: str, detail: str) -> str:
    if licence == "SPDX":
        return "-".join(detail.split())
    if licence == "CC":
        words = re.sub("attribution", "by", re.sub("non ?commercial", "nc", re.sub("share ?alike", "sa", re.sub("no ?derivatives", "nd", detail))))
        return "CC-" + "-".join(words.upper().split()).replace("ZERO", "0")
    return f"{licence}-{detail}" if detail else licence


def licences_of(identifiers: list[tuple[str, str]]) -> list[str]:
    """The licences of a sequence of identifiers, in order, by the first rule that fits at each place."""
    out: list[str] = []
    at = 0
    names = [x[0] for x in identifiers]
    while at < len(names):
        for sequence, licence in RULES:
            if tuple(names[at : at + len(sequence)]) == sequence:
                detail = next((d for _, d in identifiers[at : at + len(sequence)] if d), "")
                out.append(_name(licence, detail))
                at += len(sequence)
                break
        else:
            at += 1
    return out


def without_leaders(text: str) -> str:
    """The text without the leaders of comments: a block's, and marks that consecutive lines share."""
    if not _LEADER.search(text):
        return text
    lines = text.split("\n")
    marks = [m["mark"] if (m := _LEADER.match(line)) else "" for line in lines]
    block, run_end, wrapped = "", 0, False
    out: list[str] = []
    for at, (line, mark) in enumerate(zip(lines, marks, strict=True)):
        if mark.startswith(("/*", "<!--")):
            block = mark[0]
        if mark == "*" and at >= run_end:
            run_end = next((k for k in range(at, len(marks)) if marks[k] != "*"), len(marks))
            wrapped = _wrapped(lines[at:run_end])
        shared = mark in (marks[at - 1] if at else "", marks[at + 1] if at + 1 < len(marks) else "")
        # Stars outside a block are a list's unless a line goes on from the one before.
        leads = wrapped or block == "/" if mark == "*" else shared or mark.startswith(("/*", "*/", "<!--", "-->"))
        body = _LEADER.sub("", line, count=1) if mark and leads else line
        if block and ("*/" if block == "/" else "-->") in line:
            body, block = _CLOSING.sub("", body), ""
        out.append(body)
    return "\n".join(out)


def _wrapped(lines: list[str]) -> bool:
    """Whether one of the starred lines begins in lower case after one that ends no sentence."""
    body = [line.strip().lstrip("*").strip() for line in lines]
    return any(a and a[-1] not in ".!?:;" and b[:1].islower() for a, b in zip(body, body[1:]))


def scan_text(text: str) -> tuple[list[str], list[str]]:
    """Licences and identifiers (``name`` or ``name/detail``) of a whole text."""
    lowered = text.lower()
    if not any(x in lowered for x in _TELLING):
        return [], []
    found = []
    for line in _SENTENCE.split(_SPDX_LINE.sub(r"\n\1\n", without_leaders(text))):
        hit = recognise(line) if line else None
        if hit and hit[0] == UNKNOWN and "\n" in line:
            # Other text without a full stop may stand in the lines around.
            found += [x for part in line.split("\n") if (x := recognise(part)) and x[0] != UNKNOWN] or [hit]
        elif hit:
            found.append(hit)
    return licences_of(found), [f"{a}/{b}" if b else a for a, b in found]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        results = [scan_text(x) if x else ([], []) for x in batch.column("text").to_pylist()]
        strings = pa.list_(pa.string())
        arrays = [
            batch.column("doc_id"),
            pa.array([r[0] for r in results], strings),
            pa.array([r[1] for r in results], strings),
            pa.array([sum(x == UNKNOWN for x in r[1]) for r in results], pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "licenses", "sentences", "n_unknown"])


def scan_licenses(docs: DataFrame) -> DataFrame:
    """``doc_id, licenses, sentences, n_unknown`` per row of ``docs(doc_id, text)``.

    ``licenses`` are in order of their place, repeats included; ``sentences`` are the identifiers of
    all licence sentences; ``n_unknown`` counts licence-like sentences that are not known. Null and
    empty texts have none; repeated rows are scanned each; null doc_ids are carried; other columns
    are ignored; an empty table gives none.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scan, "doc_id bigint, licenses array<string>, sentences array<string>, n_unknown bigint")
