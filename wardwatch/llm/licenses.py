"""License scan by conditional compression.

Passages that speak of rights are cut out as candidate blocks.  Each block is
compressed alone and again with each template as a raw Zstandard dictionary; the
templates that shrink it most are the likeliest, and the exact differences in
wording confirm or refuse them; a template whose needed words are not all in the
block could not be confirmed and is not tried.  Whole license texts are sought in
runs of sentences, short notices in each sentence and then across its borders;
what a notice leaves on either side is looked at again.  A license that OR or AND
adds to a notice is sought right behind it, a license's bare name only where it is
all there is on a line.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher
from functools import lru_cache, partial

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, slices

LEVEL = 3
WINNERS = 3                    # templates whose wording is compared before the next in rank
DIFFERENT = 0.2                # share of a template's words that may differ
GAP = 3                        # sentences between two that speak of rights
LONG = 25                      # words from which a template is a whole text
LONGEST = 2_000                # characters of a sentence; a longer one is cut
RUN = 4_000                    # words of a run that are compared at once

#: What a passage on rights contains, in lower case.
MARKS = ["licen", "copyright", "spdx", "warrant", "redistribut", "permission", "public domain",
         "rights reserved", "creative commons", "creativecommons", "cc by", "cc0"]

#: Words that make another license of one that is otherwise worded alike.
QUALIFIERS = {"nc", "nd", "sa", "noncommercial", "sharealike", "noderivatives", "noderivs", "lesser",
              "library", "affero", "not", "no", "except"}

#: What turns the wording that follows around.
NEGATIONS = {"not", "no", "never"}

# --- fixed values: the wording of public license notices ---------------------------
#: id, words that must be there, text
TEMPLATES: list[tuple[str, str, str]] = [
    ("MIT", "mit", "Released under the MIT License."),
    ("MIT", "mit", "Licensed under the MIT License."),
    ("MIT", "mit", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "apache 2", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "apache 2", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "general public 3", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "gpl 3", "Licensed under the GPL, version 3."),
    ("GPL-3.0", "gpl 3", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "general public 2", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "gpl 2", "SPDX-License-Identifier: GPL-2.0-only"),
    ("LGPL-3.0", "lesser 3", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "affero 3", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "bsd 3", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "bsd 2", "Licensed under the BSD 2-Clause License."),
    ("MPL-2.0", "mozilla 2", "This work is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "isc", "Licensed under the ISC License."),
    ("Unlicense", "public domain", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "cc0 1", "Released under CC0 1.0."),
    ("CC-BY-4.0", "cc by 4", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "cc by sa 4", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-ND-4.0", "cc by nd 4", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-4.0", "cc by nc 4", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "cc by nc sa 4", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-4.0", "attribution 4", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "attribution sharealike 4",
     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "attribution noncommercial 4",
     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("all-rights-reserved", "reserved", "All rights reserved."),
    ("MIT", "",
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
     "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
     "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
     "conditions: The above copyright notice and this permission notice shall be included in all copies or "
     "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS "
     "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
     "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
     "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
     "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "",
     "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies. THE "
     "SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
     "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."),
    ("BSD-2-Clause", "",
     "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
     "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
     "list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
     "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
     "materials provided with the distribution."),
    ("BSD-3-Clause", "endorse",
     "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
     "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
     "list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
     "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
     "materials provided with the distribution. Neither the name of the copyright holder nor the names of its "
     "contributors may be used to endorse or promote products derived from this software without specific prior "
     "written permission."),
    ("Apache-2.0", "apache",
     "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
     "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
     "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
     "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("GPL-3.0", "3",
     "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
     "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
     "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    ("GPL-2.0", "2",
     "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
     "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
     "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
]

#: SPDX identifier and name of licenses whose notices follow by rule
NAMED: list[tuple[str, str]] = [
    ("0BSD", "BSD Zero Clause License"),
    ("AGPL-3.0-only", "GNU Affero General Public License, version 3"),
    ("AGPL-3.0-or-later", "GNU Affero General Public License, version 3 or later"),
    ("Apache-1.1", "Apache License, Version 1.1"),
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("Artistic-2.0", "Artistic License, version 2.0"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-4-Clause", "BSD 4-Clause License"),
    ("BSL-1.0", "Boost Software License, version 1.0"),
    ("CC0-1.0", "CC0 1.0 Universal License"),
    ("CDDL-1.0", "Common Development and Distribution License, version 1.0"),
    ("EPL-1.0", "Eclipse Public License, version 1.0"),
    ("EPL-2.0", "Eclipse Public License, version 2.0"),
    ("EUPL-1.2", "European Union Public License, version 1.2"),
    ("GPL-2.0-only", "GNU General Public License, version 2"),
    ("GPL-2.0-or-later", "GNU General Public License, version 2 or later"),
    ("GPL-3.0-only", "GNU General Public License, version 3"),
    ("GPL-3.0-or-later", "GNU General Public License, version 3 or later"),
    ("ISC", "ISC License"),
    ("LGPL-2.0-only", "GNU Library General Public License, version 2"),
    ("LGPL-2.1-only", "GNU Lesser General Public License, version 2.1"),
    ("LGPL-2.1-or-later", "GNU Lesser General Public License, version 2.1 or later"),
    ("LGPL-3.0-only", "GNU Lesser General Public License, version 3"),
    ("LGPL-3.0-or-later", "GNU Lesser General Public License, version 3 or later"),
    ("MIT", "MIT License"),
    ("MIT-0", "MIT No Attribution License"),
    ("MPL-1.1", "Mozilla Public License, version 1.1"),
    ("MPL-2.0", "Mozilla Public License, version 2.0"),
    ("OFL-1.1", "SIL Open Font License, version 1.1"),
    ("PostgreSQL", "PostgreSQL License"),
    ("Unlicense", "Unlicense"),
    ("Zlib", "zlib License"),
]
#: Creative Commons: code and name
COMMONS: list[tuple[str, str]] = [
    ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
    ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
]
COMMONS_VERSIONS = ["4.0", "3.0"]
# --- end of fixed values -------------------------------------------------------------

_WORD = re.compile(r"[a-z0-9]+")
_COMMON = {"the", "gnu", "license", "version", "and", "a"}     # words that a name may do without


def _needs(text: str) -> str:
    return " ".join(sorted(set(_WORD.findall(text.lower())) - _COMMON))


def _by_rule() -> tuple[list, list, list]:
    """(notices, headings, continued): templates that follow from NAMED and COMMONS.
    Notices stand anywhere, headings alone on a line, the last behind a notice."""
    notices, headings, continued = [], [], []
    for spdx, name in NAMED:
        own = spdx.removesuffix("-only")
        family, _, version = own.removesuffix("-or-later").partition("-")
        notices += [(own, _needs(spdx.removesuffix("-only")), f"SPDX-License-Identifier: {spdx}"),
                    (own, _needs(name), f"Licensed under the {name}."),
                    (own, _needs(name), f"Released under the terms of the {name}.")]
        headings += [(own, _needs(name), name), (own, _needs(name), f"The {name}")]
        if family in ("GPL", "LGPL", "AGPL"):
            short = "v" + version.removesuffix(".0")
            later = " or later" if spdx.endswith("-or-later") else ""
            for form in (f"GNU {family} {short}{later}", f"{family} {short}{later}", f"{family}{short}{later}"):
                notices.append((own, _needs(form), f"Licensed under the {form}."))
                continued += [(own, _needs(f"{how} {form}"), f"{how} {form}") for how in ("or", "and", "or the", "and the")]
        for how in ("or", "and"):
            continued += [(own, f"{how} {_needs(spdx.removesuffix('-only'))}", f"{how} {spdx}"),
                          (own, f"{how} {_needs(name)}", f"{how} the {name}"),
                          (own, f"{how} {_needs(name)}", f"{how} {name}")]
    for code, name in COMMONS:
        for version in COMMONS_VERSIONS:
            own, digit = f"CC-{code}-{version}", version[0]
            form = f"CC {code} {version}"
            notices += [(own, _needs(f"cc {code} {digit}"), f"Licensed under {form}."),
                        (own, _needs(f"cc {code} {digit}"), f"SPDX-License-Identifier: {own}"),
                        (own, _needs(f"{name} {digit}"), f"This work is licensed under a Creative Commons {name} {version} "
                                                         f"{'International' if digit == '4' else 'Unported'} License."),
                        (own, _needs(f"creativecommons {code} {digit}"),
                         f"creativecommons.org/licenses/{code.lower()}/{version}")]
            headings += [(own, _needs(form), form)]
            continued += [(own, _needs(f"{how} cc {code} {digit}"), f"{how} {form}") for how in ("or", "and")]
    notices.append(("CC0-1.0", "publicdomain zero 1", "creativecommons.org/publicdomain/zero/1.0"))
    known = {text for _, _, text in TEMPLATES}
    return [n for n in notices if n[2] not in known], headings, continued


NOTICES, HEADINGS, CONTINUED = _by_rule()
TEMPLATES += NOTICES
_JOINERS = {"or", "and"}
#: Up to the end of a line or of a sentence (not the dot after a single letter).
_SENTENCE = re.compile(r"(?:[^\n.;]|[.;](?!\s|$)|(?<=\W[a-z])\.)+[.;]*|[.;]+")
#: Two words of a mark may stand on two lines.
MARK = "|".join(m.replace(" ", "[^a-z0-9]+") for m in MARKS)
_MARK = re.compile(MARK)


def _lower(text: str) -> str:
    """Lower case that keeps every character's place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


@dataclass(frozen=True)
class Template:
    license: str
    needs: frozenset[str]
    text: str
    words: tuple[str, ...]
    compressor: object

    @property
    def whole(self) -> bool:
        return len(self.words) >= LONG


@lru_cache(maxsize=4)
def _prepared(templates: tuple) -> tuple[list[Template], object]:
    """Templates with a compressor that holds each as a raw dictionary, and one
    that holds none."""
    params = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=0, write_checksum=0,
                                                            write_dict_id=0)
    out = []
    for name, needs, text in templates:
        low = text.lower()
        held = zstandard.ZstdCompressionDict(low.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        out.append(Template(name, frozenset(needs.split()), low, tuple(_WORD.findall(low)),
                            zstandard.ZstdCompressor(dict_data=held, compression_params=params)))
    return out, zstandard.ZstdCompressor(compression_params=params)


def sentences(low: str) -> list[tuple[int, int]]:
    """Spans of a text's sentences and lines, the very long ones in parts."""
    out = []
    for m in _SENTENCE.finditer(low):
        s, e = m.span()
        while s < e and low[s].isspace():
            s += 1
        while s < e:
            cut = min(e, s + LONGEST)
            out.append((s, cut))
            s = cut
    return out


def ranked(block: str, templates: list[Template], plain) -> list[tuple[int, int, Template]]:
    """(size saved, size with the template, template), the largest saving first."""
    raw = block.encode("utf-8", "replace")
    alone = len(plain.compress(raw))
    there = set(_WORD.findall(block))
    found = [(alone - (size := len(t.compressor.compress(raw))), size, t) for t in templates if t.needs <= there]
    return sorted(found, key=lambda f: (-f[0], f[1], f[2].license, f[2].text))


def differences(words: list[str], template: Template) -> tuple[int, int, list[str]]:
    """(first, end) word of the block that the template covers, and the words that
    differ within: ``-word`` is missing, ``+word`` is added."""
    match = [m for m in SequenceMatcher(None, template.words, words, autojunk=False).get_matching_blocks() if m.size]
    if not match:
        return 0, 0, [f"-{w}" for w in template.words]
    cost = {}                                          # stray words on either side are no part of it
    for i in range(len(match)):
        kept = 0
        for j in range(i, len(match)):
            kept += match[j].size
            cost[i, j] = len(template.words) - kept + match[j].b + match[j].size - match[i].b - kept
    i, j = min(cost, key=lambda c: (cost[c], c[0] - c[1]))
    match = match[i: j + 1]
    out, at, own = [], match[0].b, 0
    for m in match:
        out += [f"-{w}" for w in template.words[own: m.a]] + [f"+{w}" for w in words[at: m.b]]
        own, at = m.a + m.size, m.b + m.size
    return match[0].b, at, out + [f"-{w}" for w in template.words[own:]]


def _confirmed(words: list[str], best: list[tuple[int, int, Template]], before: list[str], least: float = 1):
    """Of the templates that save ``least`` bytes, the one whose wording differs least, if it
    differs little and in no word that matters: the first WINNERS, then the next
    ones while none fits.  ``before`` are the words before the block."""
    there = set(words)
    for lo in range(0, len(best), WINNERS):
        fit = []
        for place, (saved, size, t) in enumerate(best[lo: lo + WINNERS]):
            most = DIFFERENT * len(t.words)
            if saved < least or t.needs - there or sum(w not in there for w in t.words) > most:
                continue
            first, end, diff = differences(words, t)
            lost = {d[1:] for d in diff if d[0] == "-"} & t.needs
            added = {d[1:] for d in diff if d[0] == "+"} & (QUALIFIERS - set(t.words))
            refused = NEGATIONS & set([*before, *words[:first]][-3:])
            if not refused and not lost and not added and len(diff) <= most:
                fit.append((len(diff), place, saved, size, t, first, end, diff))
        if fit:
            return min(fit, key=lambda f: f[:2])
    return None


def _reach(among: list[Template]) -> int:
    """Words that a notice of these templates may take up."""
    return int(max((len(t.words) for t in among), default=0) * (1 + DIFFERENT)) + 1


def scan(text: str, templates: tuple = tuple(TEMPLATES)) -> list[dict]:
    """License notices of a text: license, start and end (characters), plain_size
    and saved (bytes compressed), template (its text) and differences."""
    known, plain = _prepared(templates)
    headings, continued = _prepared(tuple(HEADINGS))[0], _prepared(tuple(CONTINUED))[0]
    low = _lower(text)
    spans = sentences(low)
    marks = [m.span() for m in _MARK.finditer(low)]
    if not marks:
        return []
    places = [m.span() for m in _WORD.finditer(low)]
    words, starts = [low[a:b] for a, b in places], [a for a, _ in places]
    bounds = [(bisect_left(starts, s), bisect_left(starts, e)) for s, e in spans]    # of spans, in words
    ends = [e for _, e in spans]
    marked = sorted({i for a, b in marks
                     for i in range(bisect_right(ends, a), min(len(spans), bisect_left(ends, b) + 1))})
    whole, short = [t for t in known if t.whole], [t for t in known if not t.whole]
    out: list[dict] = []
    taken: list[tuple[int, int]] = []                  # words of the notices found, in order

    def gaps(lo: int, hi: int) -> list[tuple[int, int]]:
        """What is not taken of the words lo to hi."""
        left = []
        for a, b in taken[max(0, bisect_left(taken, (lo, lo)) - 1):]:
            if a >= hi:
                break
            if b > lo:
                left.append((lo, a))
                lo = b
        return [(a, b) for a, b in [*left, (lo, hi)] if a < b]

    def look(lo: int, hi: int, among: list[Template], before: list[str], exact: str = "") -> bool:
        """Words lo to hi as one block; ``exact``: without differences, and right at
        its ``start`` or covering it ``whole``."""
        s, e = places[lo][0], places[hi - 1][1]
        while e < len(low) and low[e] in ".;":         # as a sentence ends
            e += 1
        # two words alone save nothing beside a frame's own bytes
        found = _confirmed(words[lo:hi], ranked(low[s:e], among, plain), before, float("-inf") if exact else 1)
        if not found:
            return False
        _, _, saved, size, t, first, end, diff = found
        if exact and (diff or first or exact == "whole" and end < hi - lo):
            return False
        out.append({"license": t.license, "start": places[lo + first][0], "end": places[lo + end - 1][1],
                    "plain_size": size + saved, "saved": saved, "template": t.text, "differences": diff})
        insort(taken, (lo + first, lo + end))
        return True

    def search(lo: int, hi: int, among: list[Template], first: int, split: int = 0) -> None:
        """Every notice among the words lo to hi; a block without one is split, if a
        notice takes up ``split`` words and the block more than three times that.
        From word ``first`` on the words before count as being before a notice."""
        open_ = [(lo, hi)]
        while open_:
            for a, b in gaps(*open_.pop()):
                if look(a, b, among, words[max(first, a - 3): a]):
                    open_.append((a, b))
                elif split and b - a > 3 * split:
                    mid = (a + b) // 2
                    open_ += [(mid, b), (a, mid + split)]

    far, runs = _reach(whole), []
    for i in marked if whole else []:
        lo, last = bounds[max(0, i - 1)][0], bounds[min(len(spans) - 1, i + GAP)][1]
        hi = max(last, min(len(words), bounds[i][1] + far))
        if runs and lo <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], hi)
        else:
            runs.append([lo, hi])
    for lo, hi in runs:                                # what is longer comes in overlapping parts
        for a in range(lo, max(lo + 1, hi - far), RUN - far):
            search(a, min(hi, a + RUN), whole, a, far)
    near = _reach(short)
    for i in marked if short else []:
        if bounds[i][0] < bounds[i][1]:
            search(*bounds[i], short, bounds[i][0])
    for i in marked if short else []:                  # across the borders of sentences and lines
        a, b = max(0, bounds[i][0] - near), min(len(words), bounds[i][1] + near)
        if (a, b) != bounds[i] and a < b:
            search(a, b, short, max(0, a - 3))
    line = max(len(t.words) for t in headings)
    for i in marked:                                   # a name alone on its line
        lo, hi = bounds[i]
        if lo < hi <= lo + line and gaps(lo, hi) == [(lo, hi)]:
            s, e = places[lo][0], places[hi - 1][1]
            ahead, behind = low.rfind("\n", 0, s) + 1, low.find("\n", e)
            if not _WORD.search(low, ahead, s) and not _WORD.search(low, e, behind if behind >= 0 else len(low)):
                look(lo, hi, headings, [], "whole")
    tail = max(len(t.words) for t in continued)
    for _, end in list(taken):                         # what OR and AND add to a notice
        while end < len(words) and words[end] in _JOINERS:
            hi = next((b for a, b in gaps(end, min(len(words), end + tail)) if a == end), end)
            if hi == end or not any(look(end, b, continued, [], "start") for b in range(hi, end + 1, -1)):
                break
            end = next(b for a, b in taken if a == end)
    return sorted(out, key=lambda f: (f["start"], f["license"]))


def _scan(batches, templates: tuple) -> Iterator[pa.RecordBatch]:
    fields = ["license", "start", "end", "plain_size", "saved", "template", "differences"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string())]
    for b in slices(batches, "text"):
        rows = [(i, f) for i, t in enumerate(b.column("text").to_pylist()) for f in scan(t, templates)]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array([i for i, _ in rows])),
                 *(pa.array([f[c] for _, f in rows], k) for c, k in zip(fields, kinds, strict=True))],
                names=["doc_id", *fields])


def license_scan(docs: DataFrame, templates: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """doc_id, license, start, end, plain_size, saved, template, differences: one row
    for each license notice found in a text.  Licenses of one expression ("MIT OR
    Apache-2.0") give a row each.

    Null and empty texts have none.  Of templates that save alike, the one whose
    wording differs less wins, then the alphabetically first.  Repeated rows give
    their notices each; a text holds any number.  Rows without doc_id keep a null
    one.  Further columns are left out; no rows: no rows.
    """
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(F.lower("text").rlike(MARK))
    return map_arrow(read, partial(_scan, templates=tuple(templates or TEMPLATES)),
                     "doc_id long, license string, start long, end long, plain_size long, saved long, "
                     "template string, differences array<string>")
