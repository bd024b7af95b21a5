"""Licences inside longer documents."""

from __future__ import annotations

import pytest

from siliscope.llm.licenses import ALL_TEMPLATES, TELLING, TEMPLATES, THRESHOLD, anchors, bounds, license_scan, template_bigrams

PROSE = " ".join(f"The committee of day{i} met and talked of door{i} until member{i} had gone home{i} again." for i in range(60))
MIT = TEMPLATES["mit-text"][1]
PARAGRAPHS = "\n\n".join([MIT[: MIT.index("The above")], MIT[MIT.index("The above") : MIT.index("THE SOFTWARE IS")], MIT[MIT.index("THE SOFTWARE IS") :]])
EMBEDDED = {
    1: ("\n\n".join([PROSE, PARAGRAPHS, PROSE]), ["MIT"]),
    2: ("Copyright 2020 Example Authors. Released under the MIT License.", ["MIT"]),
    3: ("The code is licensed under the Apache License, Version 2.0, and may be used by anybody.", ["Apache-2.0"]),
    4: (PROSE + "Licensed under CC BY 4.0. " + PROSE + "\n" + PROSE + PARAGRAPHS.replace("\n\n", " ") + PROSE, ["CC-BY-4.0", "MIT"]),
    5: (PROSE + "\n\n" + PROSE, []),
    6: ("", []),
    7: (None, []),
}


@pytest.fixture(scope="module")
def passages(spark):
    rows = [(doc, text) for doc, (text, _) in EMBEDDED.items()]
    return license_scan(spark.createDataFrame(rows, "doc_id long, text string")).filter("unit = 'passage'").collect()


def test_licences_inside_longer_texts(passages):
    found = {doc: [r.licence for r in sorted(passages, key=lambda r: r.unit_no) if r.doc_id == doc] for doc in EMBEDDED}
    assert found == {doc: licences for doc, (_, licences) in EMBEDDED.items()}
    assert next(r.dice for r in passages if r.doc_id == 1) > 0.97


def test_a_matching_line_is_not_given_twice(spark):
    text = PROSE + "\nReleased under the MIT License.\n" + PROSE + "\n\nLicensed under\nCC BY\n4.0.\n\n" + PROSE
    found = license_scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert sorted((r.unit, r.licence) for r in found) == [("line", "MIT"), ("paragraph", "CC-BY-4.0")]


GPL_3 = TEMPLATES["gpl-3-header"][1]
SIBLINGS = {
    "GPL-3.0": GPL_3,
    "GPL-2.0": GPL_3.replace("version 3", "version 2"),
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": GPL_3.replace("GNU General", "GNU Affero General"),
    "LGPL-2.1": GPL_3.replace("GNU General", "GNU Lesser General").replace("version 3", "version 2.1"),
    "BSD-3-Clause": ALL_TEMPLATES["bsd-3-text"][1],
    "BSD-2-Clause": TEMPLATES["bsd-2-text"][1],
    "Apache-2.0": ALL_TEMPLATES["apache-2-text"][1],
    "": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
}


def test_siblings_are_told_apart(spark):
    rows = [(name, " ".join(text.split())) for name, text in SIBLINGS.items()]
    rows += [("in " + name, f"{PROSE} {text} {PROSE}") for name, text in rows]
    found = license_scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert sorted({(r.doc_id, r.licence) for r in found}) == sorted((doc, doc.removeprefix("in ")) for doc, _ in rows if doc.removeprefix("in "))


def test_few_anchors_and_no_match_without_one():
    sets = {name: template_bigrams(text) for name, (_, text) in ALL_TEMPLATES.items()}
    licences = {name: licence for name, (licence, _) in ALL_TEMPLATES.items()}
    words = anchors(sets, licences, THRESHOLD)
    assert len(words) <= 40 and "by" not in words
    for name, grams in sets.items():
        left = [gram for gram in grams if not any(word in gram for word in words)]
        told = all(any(gram in left for gram in one_of) for one_of in TELLING.get(licences[name], []))
        assert len(left) < bounds(len(grams), THRESHOLD)[0] or not told
    # Telling bigrams count even where the template does not have them.
    for licence, tuples in TELLING.items():
        alone = [name for name in sets if licences[name] == licence]
        own = anchors({name: sets[name] for name in alone}, {name: licence for name in alone}, THRESHOLD)
        for name in alone:
            left = [gram for gram in sets[name] if not any(word in gram for word in own)]
            free = all(any(not any(word in gram for word in own) for gram in one_of) for one_of in tuples)
            assert len(left) < bounds(len(sets[name]), THRESHOLD)[0] or not free
