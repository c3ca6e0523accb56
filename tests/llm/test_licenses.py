from sparkledger.llm import licenses


def test_finds_wording_among_prose(spark, make_docs):
    rows = [(1, "Hello there.\nReleased under the MIT License.\nBye."),
            (2, "Some text. Licensed under CC BY-NC 4.0. More text follows here."),
            (3, "Licensed under the Apache License, Version 2.0."),
            (4, "THIS WORK IS LICENSED UNDER THE GNU GENERAL PUBLIC LICENSE, VERSION 2."),
            (5, "He lost his driving licence and asked permission to leave."),
            (6, None), (7, ""), (None, "Licensed under CC BY 4.0."),
            (8, "Released under the MIT License.\n\nx\n\nLicensed under CC BY-SA 4.0.")]
    got = {r.doc_id: [(h.licence, h.missing) for h in r.hits]
           for r in licenses.find_licences(make_docs(rows)).collect()}
    assert got == {1: [("MIT", 0)], 2: [("CC-BY-NC-4.0", 0)], 3: [("Apache-2.0", 0)],
                   4: [("GPL-2.0", 0)], 5: [], 6: [], 7: [], None: [("CC-BY-4.0", 0)],
                   8: [("MIT", 0), ("CC-BY-SA-4.0", 0)]}


def test_every_template_is_itself():
    import zstandard
    known, plain = licenses.templates(), zstandard.ZstdCompressor(level=3)
    for licence, text in licenses.TEMPLATES:
        hit = licenses.identify(text, known, plain)
        assert hit["licence"] == licence and hit["missing"] == 0 and not hit["differences"]


def test_differences_are_exact():
    missing, shown = licenses.differences("released under the bsd license".split(),
                                          "released under the mit license".split())
    assert missing == 1 and shown == ["-mit+bsd"]


def test_spans_are_code_points(spark, make_docs):
    text = "İstanbul é. Released under the MIT License."
    (row,) = licenses.find_licences(make_docs([(1, text)])).collect()
    assert text[row.hits[0].start:row.hits[0].end] == "Released under the MIT License."


def test_empty_table(spark, make_docs):
    assert licenses.find_licences(make_docs([])).count() == 0


def test_wrapped_adjacent_and_crowded_licences(spark, make_docs):
    import textwrap
    by_name = {}
    for name, text in licenses.TEMPLATES:
        by_name[name] = max(text, by_name.get(name, ""), key=len)
    names = ("MIT", "BSD-3-Clause", "ISC", "GPL-3.0")
    rows = [(i, "Some program.\n\n" + textwrap.fill(by_name[n], 60) + "\n\nThe end.")
            for i, n in enumerate(names)]
    rows += [(10, "Released under the MIT License. Licensed under CC BY 4.0."),
             (11, "Licence notes on copyright.\n" * 50 + "Released under the MIT License.\n"
              + "Copyright and permission lines.\n" * 50)]
    got = {r.doc_id: [h.licence for h in r.hits]
           for r in licenses.find_licences(make_docs(rows)).collect()}
    assert got == {**{i: [n] for i, n in enumerate(names)}, 10: ["MIT", "CC-BY-4.0"], 11: ["MIT"]}
