import textwrap
from collections import Counter

import zstandard

from wardwatch.llm import licenses
from wardwatch.llm.common import table

SHORT = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT",
         "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
         "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0"}


def names(text):
    return [f["license"] for f in licenses.scan(text)]


def test_every_template_finds_itself():
    for name, _, text in licenses.TEMPLATES:
        found = licenses.scan(f"Some prose before it.\n{text}\nAnd some after, of no concern.")
        assert [f["license"] for f in found] == [name], text
        assert found[0]["differences"] == [] and found[0]["saved"] > 0


def test_like_wording_of_another_license_is_told_apart():
    assert names("Licensed under CC BY 4.0.") == ["CC-BY-4.0"]
    assert names("Licensed under CC BY-SA 4.0.") == ["CC-BY-SA-4.0"]
    assert names("Licensed under CC BY-NC-ND 4.0.") == ["CC-BY-NC-ND-4.0"]
    assert names("Licensed under CC BY-NC-ND 2.0.") == []
    assert names("This work is licensed under the GNU General Public License, version 2.") == ["GPL-2.0"]
    assert names("Not licensed under the MIT License.") == []


def test_identifiers_abbreviations_headings_and_addresses():
    for text, want in {
            "SPDX-License-Identifier: BSD-3-Clause": ["BSD-3-Clause"],
            "SPDX-License-Identifier: GPL-2.0-or-later": ["GPL-2.0-or-later"],
            "SPDX-License-Identifier: GPL-2.0": ["GPL-2.0"],
            "# SPDX-License-Identifier: MIT-0\nimport os": ["MIT-0"],
            "GNU Lesser General Public License version 2.1 is what it is licensed under.": [],
            "Licensed under the GNU Lesser General Public License version 2.1": ["LGPL-2.1"],
            "Licensed under the GNU GPL v3": ["GPL-3.0"],
            "Licensed under the LGPLv3 or later.": ["LGPL-3.0-or-later"],
            "Prose.\nMIT License\nCopyright of nobody": ["MIT"],
            "The MIT License\n": ["MIT"],
            "He read the MIT License.": [],
            "See https://creativecommons.org/licenses/by-nc-sa/4.0/ for it.": ["CC-BY-NC-SA-4.0"],
            "https://creativecommons.org/licenses/by/3.0": ["CC-BY-3.0"],
            "https://creativecommons.org/licenses/by/2.5": [],
            "https://creativecommons.org/publicdomain/zero/1.0/": ["CC0-1.0"]}.items():
        assert names(text) == want, text


def test_licenses_joined_by_or_and_and():
    assert names("SPDX-License-Identifier: MIT OR Apache-2.0") == ["MIT", "Apache-2.0"]
    assert names("SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause\nand the rest") == [
        "MIT", "Apache-2.0", "BSD-3-Clause"]
    assert names("It is dual-licensed under the MIT License and the Apache License, Version 2.0.") == ["MIT", "Apache-2.0"]
    assert names("Released under the MIT License or GPLv3.") == ["MIT", "GPL-3.0"]
    assert names("Released under the MIT License and or the like, or Apache ants.") == ["MIT"]
    assert names("A license, mit or isc, and apache.") == []


def test_prose_on_rights_is_no_notice():
    assert names("The driver lost a license. Permission was never asked; no warranty came with the dog.") == []
    assert names("") == names("nothing here") == []


def test_whole_texts_with_small_differences_and_neighbours():
    whole = [t for t in licenses.TEMPLATES if len(t[2].split()) > licenses.LONG]
    a, b = whole[0], whole[4]
    text = f"Intro.\n\nCopyright (c) 2020 Joe\n{a[2].replace('free of charge', 'gratis')}\n{b[2]}\nEnd of it."
    found = licenses.scan(text)
    assert [f["license"] for f in found] == [a[0], b[0]]
    assert found[0]["differences"] == ["-free", "-of", "-charge", "+gratis"] and found[1]["differences"] == []
    lines = "\n".join(a[2][i: i + 60] for i in range(0, len(a[2]), 60))
    assert names(lines.replace("\n", " \n"))[:1] in ([a[0]], [])
    changed = " ".join(w if i % 2 else "other" for i, w in enumerate(a[2].split()))
    assert names(changed) == []


def test_notices_across_lines_and_several_in_a_sentence():
    assert names("Licensed under the Apache License,\nVersion 2.0.") == ["Apache-2.0"]
    assert names("# This work is licensed under a Creative\n# Commons\n# Attribution 4.0 International License.") == ["CC-BY-4.0"]
    assert names("This is free and unencumbered software released into the public\ndomain.") == ["Unlicense"]
    assert names("It is not\nlicensed under the Apache License,\nVersion 2.0.") == []
    both = "Licensed under the MIT License or licensed under the Apache License, Version 2.0"
    found = licenses.scan(both)
    assert [both[f["start"]: f["end"]].split()[3] for f in found] == ["MIT", "Apache"]
    assert [f["license"] for f in found] == ["MIT", "Apache-2.0"]
    for at in range(1_900, 2_010, 7):                  # a long line, cut anywhere
        assert names("word " * (at // 5) + "x" * (at % 5) + " Licensed under the MIT License " + "word " * 900) == ["MIT"], at


def test_whole_text_among_reworded_ones_and_in_long_runs():
    text = {t[0]: t[2] for t in licenses.TEMPLATES if len(t[2].split()) > licenses.LONG}

    def altered(t):
        return " ".join("other" if i % 4 == 3 else w for i, w in enumerate(t.split()))

    notices = "\n".join([altered(text[n]) for n in ("BSD-3-Clause", "BSD-2-Clause", "GPL-3.0", "GPL-2.0")] + [text["ISC"]])
    assert names(notices) == ["ISC"]
    wrapped = "\n".join(textwrap.wrap(text["MIT"], 60))
    for lines in (190, 196, 199, 203):
        assert names("this line speaks of a license\n" * lines + wrapped) == ["MIT"], lines


def test_spans_and_sizes():
    text = "Été ﬁn.\nReleased under the MIT License.\nİx"
    (f,) = licenses.scan(text)
    assert text[f["start"]: f["end"]] == "Released under the MIT License"
    plain = zstandard.ZstdCompressor(level=licenses.LEVEL).compress(b"released under the mit license.")
    assert 0 < f["saved"] < f["plain_size"] <= len(plain)


def test_ranking_prefers_the_template_that_is_there():
    known, plain = licenses._prepared(tuple(licenses.TEMPLATES))
    for text, name in SHORT.items():
        assert licenses.ranked(text.lower(), known, plain)[0][2].license == name


def test_notices_of_the_given_table(spark, small):
    docs = table(spark, small, "documents")
    want = set()
    for r in docs.collect():
        for line in (r["text"] or "").split("\n"):
            if line.strip() in SHORT:
                want.add((r["doc_id"], SHORT[line.strip()]))
    rows = licenses.license_scan(docs).collect()
    assert want <= {(r["doc_id"], r["license"]) for r in rows} and want
    text, known = {r["doc_id"]: r["text"] for r in docs.collect()}, licenses.TEMPLATES + licenses.HEADINGS + licenses.CONTINUED
    taken = {}
    for r in rows:                                     # no false hit: the span is the template but for the differences
        wording = Counter(licenses._WORD.findall(text[r["doc_id"]][r["start"]: r["end"]].lower()))
        wording.subtract(d[1:] for d in r["differences"] if d[0] == "+")
        wording.update(d[1:] for d in r["differences"] if d[0] == "-")
        own = licenses._WORD.findall(r["template"])
        assert +wording == Counter(own) and len(r["differences"]) <= licenses.DIFFERENT * len(own)
        assert (r["license"], r["template"]) in {(name, t.lower()) for name, _, t in known}
        taken.setdefault(r["doc_id"], []).append((r["start"], r["end"]))
    for spans in taken.values():                       # no notice twice
        spans.sort()
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_awkward_rows(spark, awkward, clashing, empty):
    notice = "Released under the MIT License."
    more = spark.createDataFrame([(900, f"{notice} {notice}", None, None, 1), (None, notice, None, None, 1),
                                  (901, "x" * 50_000 + " licensed " + "word " * 20_000, None, None, 1)], awkward.schema)
    rows = licenses.license_scan(awkward.union(more)).collect()
    assert sorted((r["doc_id"] or 0, r["license"]) for r in rows) == [(0, "MIT"), (900, "MIT"), (900, "MIT")]
    assert licenses.license_scan(clashing).columns[:2] == ["doc_id", "license"]
    assert licenses.license_scan(empty).count() == 0
