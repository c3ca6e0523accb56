"""Personal data, with offset-preserving deobfuscation.

Detectors run on the text as it is (the base spans) and on a normalised text in which
transducers have undone disguises: homoglyphs and full-width forms, invisible characters,
spelled digits, letters that stand for digits, and "(at)" / " dot " spellings. Each normalised character knows
the source characters it came from, so what is found there maps back to source spans.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .common import id_and_text, table

KINDS = ("email", "ip", "card", "phone")

# Possessive forms of the stated patterns: the same matches, in linear time. A match of ip
# or card can only begin where a run of digits begins.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_NO_DIGIT = re.compile(r"[^0-9]+")

#: Letters of other scripts that look like ASCII ones.
_LOOKALIKES = {
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C",
    "Т": "T", "Х": "X", "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x",
    "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w", "к": "k", "м": "m",
    "т": "t", "п": "n", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K",
    "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "α": "a", "ο": "o",
    "ν": "v", "ρ": "p", "ι": "i", "κ": "k", "υ": "u", "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "․": ".", "。": ".", "·": ".",
    " ": " ", " ": " ", " ": " ", " ": " ", "　": " ",
}
#: Characters without width.
_INVISIBLE = "­​‌‍⁠﻿"
#: Spelled digits.
_SPELLED = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4",
            "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}


def _plain(c: str) -> str:
    """The ASCII form of one non-ASCII character, or itself."""
    if c in _INVISIBLE:
        return ""
    if c in _LOOKALIKES:
        return _LOOKALIKES[c]
    if unicodedata.category(c) == "Nd":
        return str(unicodedata.decimal(c))
    form = unicodedata.normalize("NFKC", c)
    return form if form.isascii() and len(form) == 1 else c


_ODD = re.compile("[ ­·²³¹ıɑɡͰ-֏"
                  "٠-٩۰-۹ऀ-෿ -ↈ−①-⒛"
                  "　-。﻿！-～\U0001d400-\U0001d7ff]")
_ODD_RUN = re.compile(f"{_ODD.pattern}+")
_DIGIT_WORD = "(?:" + "|".join(_SPELLED) + ")"
#: At least three numbers in a row, spelled or not.
_SPELLED_RUN = re.compile(
    rf"(?<![A-Za-z0-9])(?:(?:plus[ -]?|\+ ?)(?={_DIGIT_WORD}|[0-9]))?"
    rf"(?:{_DIGIT_WORD}|[0-9]+)"
    rf"(?:(?:[ .()-]{{1,2}}| ?, ?| (?:dot|point|dash|hyphen) )(?:{_DIGIT_WORD}|[0-9]+)){{2,}}"
    r"(?![A-Za-z0-9])", re.I)
_SPELLED_TOKEN = re.compile(rf"(?P<plus>plus[ -]?|\+ ?)|(?P<word>{_DIGIT_WORD})|(?P<digits>[0-9]+)"
                            r"|(?P<dot> (?:dot|point) )|(?P<dash> (?:dash|hyphen) )|(?P<sep>[ .,()-]+)",
                            re.I)
#: Letters for digits inside a number.
_LETTER_DIGITS = re.compile(r"(?<![A-Za-z0-9])[0-9OoIl](?:[ .-]?[0-9OoIl]){6,}(?![A-Za-z0-9])")
_AS_DIGIT = {"O": "0", "o": "0", "I": "1", "l": "1"}
_BRACKETED = re.compile(r" {0,2}[\[({<]\s{0,2}(?:(?P<at>at|@)|(?P<dot>dot|\.))\s{0,2}[\])}>] {0,2}",
                        re.I)
#: name at host dot domain, with words for both signs; the dots may be signs if the name's
#: "at" stands in brackets (above).
_SPOKEN = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+-]+(?:(?:\.| dot )[A-Za-z0-9_%+-]+){0,3}"
                     r"(?: at |@)[A-Za-z0-9-]+(?:(?:\.| dot )[A-Za-z0-9-]+)* dot [A-Za-z]{2,}"
                     r"(?![A-Za-z0-9-])", re.I)
_SPOKEN_SIGN = re.compile(r" (?:(?P<at>at)|dot) ", re.I)


class Tape(NamedTuple):
    """A text and, for each of its characters, the source span [start, end)."""

    text: str
    start: list[int]
    end: list[int]

    def rewrite(self, edits: list[tuple[int, int, str]]) -> Tape:
        """Replace each [a, b) by its string, all of whose characters span [a, b)'s source."""
        if not edits:
            return self
        text, start, end, at = [], [], [], 0
        for a, b, new in edits:
            text += [self.text[at:a], new]
            start += self.start[at:a]
            end += self.end[at:a]
            if b > a:
                start += [self.start[a]] * len(new)
                end += [self.end[b - 1]] * len(new)
            at = b
        return Tape("".join([*text, self.text[at:]]), start + self.start[at:],
                    end + self.end[at:])


def _homoglyphs(tape: Tape) -> list[tuple[int, int, str]]:
    return [(i, i + 1, new) for run in _ODD_RUN.finditer(tape.text)
            for i in range(*run.span()) if (new := _plain(tape.text[i])) != tape.text[i]]


def _brackets(tape: Tape) -> list[tuple[int, int, str]]:
    return [(*m.span(), "@" if m["at"] else ".") for m in _BRACKETED.finditer(tape.text)]


def _spoken(tape: Tape) -> list[tuple[int, int, str]]:
    return [(m.start() + s.start(), m.start() + s.end(), "@" if s["at"] else ".")
            for m in _SPOKEN.finditer(tape.text) for s in _SPOKEN_SIGN.finditer(m[0])]


def _spelled(tape: Tape) -> list[tuple[int, int, str]]:
    edits = []
    for m in _SPELLED_RUN.finditer(tape.text):
        tokens = list(_SPELLED_TOKEN.finditer(m[0]))
        words = [bool(t["word"]) for t in tokens]
        if not any(words) and not any(t["dot"] for t in tokens):
            continue
        for i, t in enumerate(tokens):
            a, b = m.start() + t.start(), m.start() + t.end()
            if t["plus"]:
                edits.append((a, b, "+"))
            elif t["word"]:
                edits.append((a, b, _SPELLED[t[0].lower()]))
            elif t["dot"]:
                edits.append((a, b, "."))
            elif t["dash"]:
                edits.append((a, b, "-"))
            elif t["sep"] and "." not in t[0] and (words[i - 1] or words[i + 1]):
                edits.append((a, b, ""))
    return edits


def _letters(tape: Tape) -> list[tuple[int, int, str]]:
    return [(m.start() + i, m.start() + i + 1, _AS_DIGIT[c])
            for m in _LETTER_DIGITS.finditer(tape.text)
            if sum(c.isdigit() for c in m[0]) * 2 >= len(m[0]) // 2
            for i, c in enumerate(m[0]) if c in _AS_DIGIT]


def _steps(text: str):
    """The transducers in order, each with whether it may change the text so far; what is
    sent in is the text that the step before left."""
    text = yield _homoglyphs, not text.isascii()
    text = yield _brackets, True
    low = text.lower()
    text = yield _spoken, " dot " in low and ("@" in low or " at " in low)
    low = text.lower()
    text = yield _spelled, (" dot " in low or " point " in low or any(w in low for w in _SPELLED))
    yield _letters, True


def normalise(text: str) -> Tape | None:
    """The text without its disguises, or None if it has none."""
    tape, steps = Tape(text, [], []), _steps(text)
    step, may = next(steps)
    while True:
        if may and (edits := step(tape)):
            if not tape.start:
                tape = Tape(text, list(range(len(text))), list(range(1, len(text) + 1)))
            tape = tape.rewrite(edits)
        try:
            step, may = steps.send(tape.text)
        except StopIteration:
            return tape if tape.text != text else None


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def detect(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of every identifier: leftmost, not overlapping per kind."""
    spans = []
    done, at = 0, text.find("@")
    while at >= 0:
        a = at
        while a > done and text[a - 1] in _LOCAL:
            a -= 1
        if a < at and (m := _DOMAIN.match(text, at + 1)):
            done = m.end()
            spans.append((a, done, 0))
        at = text.find("@", at + 1)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255
               for p in m[0].split(".")):
            spans.append((*m.span(), 1))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _NO_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and _luhn(digits):
                spans.append((*m.span(), 2))
    at = text.find("+")
    while at >= 0:
        if m := _PHONE.match(text, at):
            if 10 <= len(_NO_DIGIT.sub("", m[0])) <= 15:
                spans.append((*m.span(), 3))
            at = text.find("+", m.end())
        else:
            at = text.find("+", at + 1)
    return sorted(spans, key=lambda s: (s[0], s[2], s[1]))


def find_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, spans that only the normalised text shows), in code points.

    A mapped span inside a span of its kind adds nothing; one that reaches further is added
    beside it."""
    base = detect(text)
    tape = normalise(text)
    if tape is None:
        return base, []
    more = []
    for a, b, kind in detect(tape.text):
        s, e = tape.start[a], tape.end[b - 1]
        if not any(k == kind and x <= s and e <= y for x, y, k in [*base, *more]):
            more.append((s, e, kind))
    return base, more


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()),
                   ("base", pa.bool_())])
_FOUND = ("doc_id long, spans array<struct<start:long,end:long,kind:string,base:boolean>>, "
          "masked string")


def mask(text: str, spans: list[dict]) -> str:
    """The text with each span (overlapping ones as one) replaced by its kind in brackets."""
    out, at, last = [], 0, ""
    for s in spans:
        if s["start"] >= at or not out:
            out += [text[at:s["start"]], f"[{s['kind'].upper()}]"]
        at = max(at, s["end"])
    return "".join([*out, text[at:]]) if spans else text


def _find(batches: Iterator[pa.RecordBatch], masked: bool):
    for block in K.text_blocks(batches, "text"):
        batch = block.batch
        texts = batch.column("text").to_pylist()
        rows, new = [], []
        for text in texts:
            base, more = find_spans(text or "")
            all_spans = sorted([(a, k, b, True) for a, b, k in base]
                               + [(a, k, b, False) for a, b, k in more])
            rows.append([{"start": a, "end": b, "kind": KINDS[k], "base": x}
                         for a, k, b, x in all_spans])
            new.append(mask(text, rows[-1]) if masked and text is not None else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(rows, pa.list_(_SPAN)),
             pa.array(new, pa.string())], names=["doc_id", "spans", "masked"])


def find_pii(docs: DataFrame, masked: bool = False) -> DataFrame:
    """Per document: doc_id, spans (start, end, kind, base; by start, then kind; code
    points) and, if wanted, masked: the text with the spans replaced by [KIND].

    Null and empty texts have no spans (a null text stays null); rows that repeat a doc_id
    are read one by one; a null doc_id stays null. Other columns are not read."""

    def find(batches):
        return _find(batches, masked)

    return id_and_text(docs).mapInArrow(find, _FOUND)


def with_masked_text(docs: DataFrame) -> DataFrame:
    """``docs``, all columns, with every identifier in the text replaced by its [KIND] and,
    if there is such a column, n_chars counted anew."""

    def rewrite(batches):
        for block in K.text_blocks(batches, "text"):
            batch, new = block.batch, []
            for text in batch.column("text").to_pylist():
                base, more = find_spans(text or "")
                spans = sorted([*base, *more], key=lambda s: (s[0], s[2]))
                new.append(mask(text, [{"start": a, "end": b, "kind": KINDS[k]}
                                       for a, b, k in spans]) if spans else text)
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, batch.schema.field(at), pa.array(
                new, batch.schema.field(at).type))

    out = docs.mapInArrow(rewrite, docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.char_length("text").cast(kind))
    return out


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str, only_base: bool):
        return F.size(F.filter("spans", lambda s: (s["kind"] == kind)
                               & (s["base"] | (not only_base)))).cast("long")

    return found.select(
        "doc_id", *[count(k, True).alias(f"n_{k}") for k in KINDS],
        F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"),
        *[count(k, False).alias(f"all_{k}") for k in KINDS])
