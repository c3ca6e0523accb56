"""Detectors against the stated patterns, disguises against planted identifiers."""

import random
import re

from sparkledger.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10))
               for i, c in enumerate(reversed(d))) % 10 == 0


def _brute(t):
    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    found = [(*m.span(), 0) for m in EMAIL.finditer(t)]
    found += [(*m.span(), 1) for m in IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [(*m.span(), 2) for m in CARD.finditer(t)
              if 14 <= len(digits(m)) <= 19 and _luhn(digits(m))]
    found += [(*m.span(), 3) for m in PHONE.finditer(t) if 10 <= len(digits(m)) <= 15]
    return sorted(found, key=lambda s: (s[0], s[2]))


def test_base_spans_match_the_patterns():
    rng = random.Random(3)
    for _ in range(20000):
        t = "".join(rng.choice("0123456789 1.-+@a(") for _ in range(rng.randrange(45)))
        assert pii.detect(t) == _brute(t), t


def test_long_runs_take_linear_time():
    for c in ("1", "a", "1.", "+1", "@", "a@", "1 ", "one ", "(", "( at ", "l0"):
        pii.find_spans(c * 60000)


def _more(text):
    base, more = pii.find_spans(text)
    assert not base
    return [(pii.KINDS[k], text[a:b]) for a, b, k in more]


def test_disguises_map_back_to_the_source():
    cases = [
        ("email", "john.doe (at) example (dot) com"), ("email", "bob [at] mail.example.com"),
        ("email", "jane at example dot co dot uk"), ("email", "john[@]example[.]com"),
        ("email", "jоhn@exаmple.com"), ("email", "ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
        ("email", "a​b@c​.com"), ("card", "４１１１ １１１１ １１１１ １１１１"),
        ("card", "four" + " one" * 15), ("card", "4lll-llll-1111-1111"),
        ("phone", "plus one five five five two three four five six seven eight nine"),
        ("phone", "+1 (five five five) 867 five three zero nine"),
        ("ip", "one nine two dot one six eight dot one dot one"),
        ("ip", "192 dot 168 dot 1 dot 1")]
    for kind, text in cases:
        for before, after in (("", ""), ("écrire à ", " merci"), ("x\n", "\ny")):
            assert _more(before + text + after) == [(kind, text)], text


def test_prose_is_left_alone():
    for text in ("We met at noon. Then at two we left.", "one two three", "look at example.com",
                 "a dot on the map", "Il y a cinq à sept jours", "(at least) five or six seven",
                 "Olli II lO Il", "see (.) there", "1 2 3 at 4 dot 5"):
        assert _more(text) == [], text


def test_query_columns_and_masking(spark, make_docs):
    docs = make_docs([(1, "é a@b.co or 10.0.0.1"), (2, None), (3, ""), (None, "x (at) y.zz"),
                      (1, "é a@b.co or 10.0.0.1")])
    rows = {(r.doc_id, i): r for i, r in enumerate(pii.find_pii(docs, True).collect())}
    assert {(k[0], r.masked) for k, r in rows.items()} == {
        (1, "é [EMAIL] or [IP]"), (2, None), (3, ""), (None, "[EMAIL]")}
    masked = pii.with_masked_text(docs)
    assert masked.columns == docs.columns
    assert sorted(masked.toPandas().n_chars.dropna()) == [0, 7, 17, 17]


def test_empty_table(spark, make_docs):
    assert pii.find_pii(make_docs([])).count() == 0


def test_each_step_sees_what_the_one_before_left():
    for kind, text in (("ip", "I92.I68.I.I"), ("phone", "+4I 7I1 2I4 56I8"),
                       ("email", "jane {at} example dot com"),
                       ("email", "jane <at> example dot com"),
                       ("ip", "192 point 168 point 1 point 1")):
        assert _more(text) == [(kind, text)], text


def test_a_wider_disguised_span_is_added_beside_the_base_one():
    text = "write to jane@mail.example dot com now"
    base, more = pii.find_spans(text)
    assert [text[a:b] for a, b, _ in base] == ["jane@mail.example"]
    assert [text[a:b] for a, b, _ in more] == ["jane@mail.example dot com"]
    spans = sorted([*base, *more], key=lambda s: (s[0], s[2]))
    masked = pii.mask(text, [{"start": a, "end": b, "kind": pii.KINDS[k]} for a, b, k in spans])
    assert masked == "write to [EMAIL] now"
