"""Licence scan by conditional compression.

Sentences with a cue are looked at together with the rest of their paragraph, within reach
of a template. Windows of each template's size that hold enough of its words are compressed
alone and with the template as a raw zstandard dictionary; those that save enough of their
compressed size are confirmed by their exact wording differences, word by word. Of
overlapping matches the one with the fewest differences names the licence; all others stay.
"""

from __future__ import annotations

import difflib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_and_text, table

#: Short public wordings of licences, by SPDX identifier.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of "
            "this software and associated documentation files (the \"Software\"), to deal in "
            "the Software without restriction, including without limitation the rights to "
            "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
            "the Software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may "
                   "not use this file except in compliance with the License. You may obtain a "
                   "copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under "
                "the terms of the GNU General Public License as published by the Free Software "
                "Foundation, either version 3 of the License, or (at your option) any later "
                "version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without "
                     "modification, are permitted provided that the following conditions are "
                     "met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, "
                "v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose "
            "with or without fee is hereby granted"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International "
                  "License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
#: Lower-case wording that makes a sentence a candidate.
CUES = ("licen", "copyright", "permission", "redistribut", "free software", "public domain",
        "creative commons", "source code form", "free and unencumbered")
#: Least share of the compressed size that a template must save to be confirmed.
LEAST_SAVING = 0.25
#: Greatest share of a template's words that may be missing from the block.
MOST_MISSING = 0.2

_WORD = re.compile(r"\w+(?:[.-]\w+)*")
_END = re.compile(r"[.!?](?=\s|\Z)|(?=\n)|\Z")
_CUE = re.compile("|".join(CUES))
_BLANK = re.compile(r"\n[^\S\n]*\n")


class Template(NamedTuple):
    licence: str
    words: list[str]
    dictionary: zstandard.ZstdCompressionDict
    compressor: zstandard.ZstdCompressor


def templates(texts=TEMPLATES) -> list[Template]:
    out = []
    for licence, text in texts:
        data = zstandard.ZstdCompressionDict(text.lower().encode(),
                                             dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        out.append(Template(licence, _WORD.findall(text.lower()), data,
                            zstandard.ZstdCompressor(level=3, dict_data=data)))
    return out


def _lower(text: str) -> str:
    """Lower case, character by character where that would move offsets."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(
        c.lower() if len(c.lower()) == 1 else c for c in text)


def candidates(text: str) -> list[tuple[int, int]]:
    """Spans of the sentences that hold a cue, adjacent ones as one block."""
    low = _lower(text)
    if not any(c in low for c in CUES):
        return []
    spans: list[tuple[int, int]] = []
    at = 0
    for m in _CUE.finditer(low):
        if m.start() < at:
            continue
        line = max(at, low.rfind("\n", 0, m.start()) + 1)
        start = max([line, *(i + 2 for e in (". ", "! ", "? ")
                             if (i := low.rfind(e, line, m.start())) >= 0)])
        at = _END.search(low, m.end()).end()
        if spans and start - spans[-1][1] <= 1:
            spans[-1] = (spans[-1][0], at)
        else:
            spans.append((start, at))
    return spans


def differences(block: list[str], wording: list[str]) -> tuple[int, list[str]]:
    """Missing words of the wording and the exact differences, on the best alignment."""
    matcher = difflib.SequenceMatcher(None, wording, block, autojunk=False)
    parts = matcher.get_opcodes()
    while parts and parts[0][0] == "insert":  # words around the wording are no difference
        parts = parts[1:]
    while parts and parts[-1][0] == "insert":
        parts = parts[:-1]
    missing, shown = 0, []
    for kind, a, b, c, d in parts:
        if kind != "equal":
            missing += b - a
            shown.append(f"-{' '.join(wording[a:b])}+{' '.join(block[c:d])}")
    return missing, shown


def regions(text: str, spans: list[tuple[int, int]], reach: int) -> list[tuple[int, int]]:
    """Candidates extended by ``reach`` code points inside their paragraph, as far as they
    do not meet; those that do are one."""
    breaks = [m.span() for m in _BLANK.finditer(text)]
    ends, starts = [a for a, _ in breaks] + [len(text)], [0] + [b for _, b in breaks]
    out: list[tuple[int, int]] = []
    for a, b in spans:
        a = max(starts[bisect_right(starts, a) - 1], a - reach)
        b = max(b, min(ends[bisect_left(ends, b)], b + reach))
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def matches(text: str, known: list[Template], plain: zstandard.ZstdCompressor) -> list[dict]:
    """Every confirmed match of a template that overlaps no better one, best first."""
    low = _lower(text)
    places = [m.span() for m in _WORD.finditer(low)]
    words = [low[a:b] for a, b in places]
    found: dict[tuple[int, int, int], tuple] = {}
    for i, t in enumerate(known):
        size, own = len(t.words), set(t.words)
        held = [0, *accumulate(w in own for w in words)]
        step = max(1, size // 4)
        for a in range(0, max(1, len(words) - size + step), step):
            b = min(len(words), a + size + 2 * step)
            if held[b] - held[a] < (1 - MOST_MISSING) * size:
                continue
            same = [m for m in difflib.SequenceMatcher(None, t.words, words[a:b], autojunk=False)
                    .get_matching_blocks() if m.size]
            if sum(m.size for m in same) < (1 - MOST_MISSING) * size:
                continue
            first, last = a + same[0].b, a + same[-1].b + same[-1].size
            if (i, first, last) in found:
                continue
            data = low[places[first][0]:places[last - 1][1]].encode("utf-8", "replace")
            saving = 1 - len(t.compressor.compress(data)) / len(plain.compress(data))
            missing, shown = differences(words[first:last], t.words)
            if saving >= LEAST_SAVING and missing <= MOST_MISSING * size:
                found[i, first, last] = ((missing, len(shown), -size, -saving, i), {
                    "licence": t.licence, "saving": saving, "missing": missing,
                    "differences": shown})
    taken, out = bytearray(len(words)), []
    for (_, first, last), (_, hit) in sorted(found.items(), key=lambda x: (x[1][0], x[0])):
        if not any(taken[first:last]):
            taken[first:last] = b"\1" * (last - first)
            out.append({"start": places[first][0], "end": places[last - 1][1], **hit})
    return out


def identify(text: str, known: list[Template], plain: zstandard.ZstdCompressor) -> dict | None:
    """The best match of one block, or None if no template is confirmed."""
    return next(iter(matches(text, known, plain)), None)


def _sentences(text: str, hits: list[dict]) -> list[dict]:
    """Hits in order, extended to their sentences as far as they do not meet."""
    hits, out = sorted(hits, key=lambda h: h["start"]), []
    for k, h in enumerate(hits):
        low = out[-1]["end"] if out else 0
        high = hits[k + 1]["start"] if k + 1 < len(hits) else len(text)
        line = max(low, text.rfind("\n", low, h["start"]) + 1)
        start = max([line, *(i + 2 for e in (". ", "! ", "? ")
                             if (i := text.rfind(e, line, h["start"])) >= 0)])
        out.append({**h, "start": start, "end": min(high, _END.search(text, h["end"]).end())})
    return out


_HIT = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("licence", pa.string()),
                  ("saving", pa.float64()), ("missing", pa.int64()),
                  ("differences", pa.list_(pa.string()))])
_FOUND = ("doc_id long, n_blocks long, hits array<struct<start:long,end:long,licence:string,"
          "saving:double,missing:long,differences:array<string>>>")


def _scan(batches: Iterator[pa.RecordBatch], texts):
    known, plain = templates(texts), zstandard.ZstdCompressor(level=3)
    seen: dict[str, list[dict]] = {}
    reach = 2 * max(len(text) for _, text in texts)
    for batch in batches:
        counts, hits = [], []
        for text in batch.column("text").to_pylist():
            text = text or ""
            spans = candidates(text)
            found = []
            for a, b in regions(text, spans, reach):
                block = text[a:b]
                if block not in seen:
                    if len(seen) >= 4096:
                        seen.clear()
                    seen[block] = matches(block, known, plain)
                found += [{**h, "start": a + h["start"], "end": a + h["end"]}
                          for h in seen[block]]
            counts.append(len(spans))
            hits.append(_sentences(text, found))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()),
             pa.array(hits, pa.list_(_HIT))], names=["doc_id", "n_blocks", "hits"])


def find_licences(docs: DataFrame, texts=TEMPLATES) -> DataFrame:
    """Per document: doc_id, n_blocks (candidates), hits (code point span, licence, share of
    the compressed size saved, template words missing, wording differences).

    Null and empty texts have none; rows that repeat a doc_id are scanned one by one; a null
    doc_id stays null. Other columns are not read."""
    return id_and_text(docs).mapInArrow(lambda b: _scan(b, texts), _FOUND)


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = F.col("hits")
    return find_licences(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_blocks", F.size(hits).cast("long").alias("n_hits"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda h: h["licence"]))),
                     ",").alias("licences"),
        F.array_join(F.transform(hits, lambda h: F.concat_ws(
            ":", h["licence"], h["start"].cast("string"), h["end"].cast("string"),
            h["missing"].cast("string"))), ",").alias("hits"))
