import random
import textwrap

from hypothesis import given
from hypothesis import strategies as st

from paperflow.llm import licenses as L

from .helpers import docs


def test_wordings_are_found(spark):
    rows, want = [], {}
    for k, (name, texts) in enumerate(L.TEMPLATES.items()):
        for j, t in enumerate(texts):
            rows.append((10 * k + j, f"Some words before.\n{t}\nAnd after them."))
            want[10 * k + j] = (name, 1, 0)
    got = {r["doc_id"]: (r["license"], r["line"], r["edits"]) for r in L.scan_licenses(docs(spark, rows)).collect()}
    assert got == want


def test_wording_differences_decide(spark):
    rows = [(1, "This work is licensed under the GNU General Public License, version 2."),
            (2, "Released under the  Mit License today"),
            (3, "Their license plates were stolen by unknown people last night in town"),
            (4, "Licensed under the Apache Licence, Version 2.0.")]
    got = {r["doc_id"]: r for r in L.scan_licenses(docs(spark, rows)).collect()}
    assert got[1]["license"] == "GPL-2.0" and got[1]["edits"] == 0
    assert got[2]["license"] == "MIT"
    assert got[3]["license"] is None
    assert got[4]["license"] == "Apache-2.0" and got[4]["differences"] == "license>licence"


@given(st.lists(st.sampled_from("abc"), max_size=6), st.lists(st.sampled_from("abc"), max_size=8))
def test_fewest_edits(wording, block):
    def cost(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
            row = new
        return row[-1]

    best = min(cost(wording, block[i:j]) for i in range(len(block) + 1) for j in range(i, len(block) + 1))
    edits, what = L.fewest_edits(wording, block)
    assert edits == best == len(what)


def test_edges(spark):
    long = "word " * 400 + "Released under the MIT License. " + "more " * 400
    rows = [(1, None), (2, ""), (3, "nothing here"), (4, long), (4, long), (None, "All rights reserved."), (5, "Copyright\nAll rights reserved.\n\nSPDX-License-Identifier: MIT")]
    got = sorted(((r["doc_id"] or 0, r["block"], r["license"]) for r in L.scan_licenses(docs(spark, rows)).collect()), key=str)
    assert got == [(0, 0, "All-Rights-Reserved"), (4, 0, "MIT"), (4, 0, "MIT"), (5, 0, "All-Rights-Reserved"), (5, 1, "MIT")]
    assert L.scan_licenses(docs(spark, [])).count() == 0


def test_wrapped_notices(spark):
    gpl = L.TEMPLATES["GPL-3.0"][-1]
    notices = {"MIT": L.TEMPLATES["MIT"][-1], "GPL-3.0": gpl, "MPL-2.0": L.TEMPLATES["MPL-2.0"][-1], "BSD-3-Clause": L.TEMPLATES["BSD-3-Clause"][-1]}
    rows, want = [], {}
    for width in (20, 50, 80):
        for mark in ("", " * ", "# "):
            for name, notice in notices.items():
                lines = [mark + x for x in textwrap.wrap(notice, width)]
                rows.append((len(rows), "\n".join(["Of another matter", "", f"{mark}Written by somebody", *lines, mark + "and some words after it", "", "the end"])))
                want[rows[-1][0]] = (name, 3, 0)
    far = " ".join(f"w{k}" for k in range(3000))
    rows.append((len(rows), f"{far}\n" + "\n".join(textwrap.wrap(gpl, 60)) + f"\n{far}"))
    want[rows[-1][0]] = ("GPL-3.0", 1, 0)
    got = L.scan_licenses(docs(spark, rows)).collect()
    assert {r["doc_id"]: (r["license"], r["line"], r["edits"]) for r in got} == want and len(got) == len(rows)
    assert max(len(r["text"]) for r in got) < 2000


def test_every_license_of_a_block(spark):
    three = "Released under the MIT License.\nLicensed under the Apache License, Version 2.0.\nAll rights reserved."
    every = [(name, t) for name, texts in L.TEMPLATES.items() for t in texts]
    twice = "Licensed under CC BY 4.0. Then text.\nLicensed under CC BY 4.0. Then text."
    rows = [(1, three), (2, "\n".join(t for _, t in every)), (3, twice)]
    got = {k: [] for k, _ in rows}
    for r in L.scan_licenses(docs(spark, rows)).collect():
        got[r["doc_id"]].append((r["line"], r["license"], r["edits"]))
    assert sorted(got[1]) == [(0, "MIT", 0), (1, "Apache-2.0", 0), (2, "All-Rights-Reserved", 0)]
    assert sorted(got[2]) == [(k, name, 0) for k, (name, _) in enumerate(every)]
    assert sorted(got[3]) == [(0, "CC-BY-4.0", 0), (1, "CC-BY-4.0", 0)]


PROBED = {
    "Released under the ISC License.": "ISC", "Licensed under the Zlib License.": "Zlib", "Licensed under CC BY 3.0.": None,
    "Released under the BSD 2-Clause License.": "BSD-2-Clause", "This work is licensed under the GNU General Public License, version 1.": None,
    "This work is dedicated to the public domain under Unlicense 1.0 Universal.": None,
    "This work is licensed under the GNU Lesser General Public License, version 2.": None,
    "Released under the MIX License.": None, "Released under the MIT-0 License.": None, "Licensed under the Apache License, Version 1.1.": None,
    "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.": None,
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published "
    "by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.": None,
}


def test_names_and_versions_must_agree(spark):
    rows = list(enumerate(PROBED))
    got = {r["doc_id"]: r["license"] for r in L.scan_licenses(docs(spark, rows)).collect()}
    assert [got[k] for k, _ in rows] == list(PROBED.values())
    few = {name: L.TEMPLATES[name] for name in ("MIT", "Apache-2.0", "GPL-3.0", "CC-BY-4.0", "CC0-1.0", "BSD-3-Clause")}
    assert {r["license"] for r in L.scan_licenses(docs(spark, rows), few).collect()} == {None}


def test_long_wordings_may_differ(spark):
    notice = L.TEMPLATES["GPL-3.0"][-1]
    rows = [(1, notice.replace("program", "plugin").replace("it and/or", "this and/or")), (2, notice.replace("version 3", "version 4")),
            (3, notice.replace("General", "Affero General")), (4, notice.replace("free software: ", "")), (5, L.TEMPLATES["MIT"][-1].replace("any person", "each and any person"))]
    got = {r["doc_id"]: (r["license"], r["edits"]) for r in L.scan_licenses(docs(spark, rows)).collect()}
    assert got == {1: ("GPL-3.0", 2), 2: (None, None), 3: (None, None), 4: ("GPL-3.0", 2), 5: ("MIT", 2)}


def test_templates_without_a_fixed_cue(spark):
    own = {"House": ("You may copy this page freely within the house.",),
           "Shop": ("Guests of the shop are welcome to take one of these leaflets home with them and to hand it on to friends and neighbours who might like to read it too.",)}
    rows = [(1, "before\nYou may copy this page freely within the house.\nafter"), (2, "You may copy this page freely within the hotel."),
            (3, own["Shop"][0].replace("friends", "family").replace("welcome", "free")), (4, "Released under the MIT License.")]
    got = {r["doc_id"]: r["license"] for r in L.scan_licenses(docs(spark, rows), own).collect()}
    assert got[1] == "House" and got[3] == "Shop" and got.get(2) is None and got[4] is None


def test_scan_against_brute_force(spark):
    """Every part of every paragraph against every wording, by the edit distance of whole lists."""
    words = ["released", "under", "the", "mit", "isc", "license", "licence", "apache", "version", "2.0", "licensed", "all", "rights", "reserved", "zlib"]
    names = L.license_names({n: [L.wording_words(t) for t in texts] for n, texts in L.TEMPLATES.items()})

    def fits(wording, part):
        most = int(L.MOST_EDITS * len(wording) + 1e-9)
        if len(part) != len(wording):
            return False
        changed = [(a, b) for a, b in zip(wording, part) if a != b]
        return len(changed) <= most and all(a not in names and b not in names and not any(map(str.isdigit, a)) and L.spelt_otherwise(a, b) for a, b in changed)

    rng = random.Random(4)
    rows, want = [], {}
    for k in range(300):
        line = [rng.choice(words) for _ in range(rng.randrange(3, 9))]
        if rng.random() < 0.6:
            line = L.wording_words(rng.choice([t for texts in L.TEMPLATES.values() for t in texts if len(L.wording_words(t)) < 12]))
            if rng.random() < 0.5:
                line[rng.randrange(len(line))] = rng.choice(words)
        rows.append((k, " ".join(line)))
        want[k] = {n for n, texts in L.TEMPLATES.items() for t in texts if len(w := L.wording_words(t)) < L.LONG_WORDS
                   for i in range(len(line) - len(w) + 1) if fits(w, line[i:i + len(w)])}
    got = {k: set() for k, _ in rows}
    for r in L.scan_licenses(docs(spark, rows)).collect():
        if r["license"]:
            got[r["doc_id"]].add(r["license"])
    assert got == want
