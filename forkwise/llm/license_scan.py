"""License scan by conditional compression.

Blocks of text around license words, across line breaks, are laid out in words, so that
wrapping, comment marks and case make no difference. A block is compressed alone and with each
template as a raw zstandard dictionary. Templates are ranked by how many bytes the dictionary
saves, and confirmed in that order by the exact wording: the template is aligned with the block, all of its telling
words (those that name the license or its version) must be there in order, and few of the
others may differ. The first that is confirmed stays, with its differing words, unless one that saves
nearly as much differs in fewer; what stands before and after it is a block again. Long runs of license words are cut into overlapping
blocks.

A notice that is denied ("is not licensed under ...") is none: a negation in it, or before it
in the same sentence, rules it out. Of SPDX tags, identifiers of the license list
and LicenseRef ones are taken as they are written, and others are not; a tag has no
template, and so no reduction.

What is found are notices, tags, and license texts by their title or by their grant and
conditions, in the wordings of TEMPLATES; other licenses only by SPDX tag.

Defined cases: null and empty texts hold no license. Repeated rows and null ids each give a
row; of matches that overlap the longer template stays, of equal ones the first; empty tables
give empty results; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from difflib import SequenceMatcher
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

# Conditions are given without their numbers, whose marks differ.
_MIT_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_GNU = [("GPL-3.0", "General Public License", "3"), ("GPL-2.0", "General Public License", "2"), ("LGPL-3.0", "Lesser General Public License", "3"), ("LGPL-2.1", "Lesser General Public License", "2.1"), ("LGPL-2.0", "Library General Public License", "2"), ("AGPL-3.0", "Affero General Public License", "3")]
# Notices of public licenses, by SPDX identifier.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "Released under CC0 1.0 into the public domain."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", _MIT_GRANT),
    ("MIT", _MIT_GRANT + " The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("BSD-2-Clause", _BSD),
    ("BSD-3-Clause", _BSD + " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    *((name, f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.")
      for name, kind, version in _GNU),
    *((name, f"under the terms of the GNU {kind} version {version} as published by the Free Software Foundation") for name, kind, version in _GNU),
    *((name, f"under the terms of version {version} of the GNU {kind} as published by the Free Software Foundation") for name, kind, version in _GNU),
    *((name, f"under the terms of the GNU {kind}, version {version}") for name, kind, version in _GNU),
    *((name, f"licensed under the GNU {kind} version {version}") for name, kind, version in _GNU),
    *((name, f"licensed under the GNU {kind} v{version}") for name, kind, version in _GNU),
    *((name, f"GNU {kind} Version {version}, {date}") for (name, kind, version), date in zip(_GNU, ("29 June 2007", "June 1991", "29 June 2007", "February 1999", "June 1991", "19 November 2007"))),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    *((name, f"This work is licensed under a Creative Commons {kind} 4.0 International License.")
      for name, kind in (("CC-BY-4.0", "Attribution"), ("CC-BY-SA-4.0", "Attribution-ShareAlike"), ("CC-BY-NC-4.0", "Attribution-NonCommercial"), ("CC-BY-ND-4.0", "Attribution-NoDerivatives"), ("CC-BY-NC-SA-4.0", "Attribution-NonCommercial-ShareAlike"), ("CC-BY-NC-ND-4.0", "Attribution-NonCommercial-NoDerivatives"))),
    ("CC0-1.0", "CC0 1.0 Universal"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Apache-2.0", "under the Apache 2.0 license"),
    ("Apache-2.0", "Licensed under the Apache License 2.0"),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "under the terms of the MIT license"),
    *((name, f"{short} or later") for name, short in (("GPL-3.0", "GPLv3"), ("GPL-2.0", "GPLv2"), ("LGPL-3.0", "LGPLv3"), ("LGPL-2.1", "LGPLv2.1"), ("AGPL-3.0", "AGPLv3"))),
    *((name, f"licensed under the {short}") for name, short in (("GPL-3.0", "GPLv3"), ("GPL-2.0", "GPLv2"), ("LGPL-3.0", "LGPLv3"), ("LGPL-2.1", "LGPLv2.1"), ("AGPL-3.0", "AGPLv3"))),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("EPL-1.0", "made available under the terms of the Eclipse Public License v1.0"),
    ("EPL-2.0", "made available under the terms of the Eclipse Public License 2.0"),
    ("EPL-2.0", "made available under the terms of the Eclipse Public License v. 2.0"),
]
# Words that tell licenses from one another.
NAMES = {"apache", "mit", "gnu", "general", "lesser", "affero", "public", "mozilla", "cc", "by", "by-sa", "by-nc", "by-nd", "cc0", "redistribution", "hereby", "compliance", "endorse", "fee", "unencumbered", "commons", "attribution", "attribution-sharealike", "attribution-noncommercial", "attribution-noderivatives", "attribution-noncommercial-sharealike", "attribution-noncommercial-noderivatives", "by-nc-sa", "by-nc-nd", "gplv2", "gplv3", "lgplv2.1", "lgplv3", "agplv3", "as-is", "boost", "eclipse"}
# Words that make another license of the template they are not in.
OTHERS = {"lesser", "affero"}
# Words that begin a notice's own sentence where they are capitalised, words that deny what they stand before (the last ones as they are cut at an apostrophe), and words that may stand between.
BEGINS = {"licensed", "released", "distributed", "permission", "redistribution", "this"}
DENIALS = {"not", "no", "never", "nor", "neither", "cannot", "isn", "aren", "wasn", "weren", "don", "doesn"}
BETWEEN = {"t", "be", "been", "being", "yet", "longer", "currently"}
# Identifiers of the SPDX license list in common use; each may also end with a plus sign.
SPDX = set(
    """0BSD AAL AFL-1.1 AFL-1.2 AFL-2.0 AFL-2.1 AFL-3.0 AGPL-1.0 AGPL-1.0-only AGPL-1.0-or-later AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.0 Apache-1.1 Apache-2.0 APSL-1.0
    APSL-2.0 Artistic-1.0 Artistic-1.0-Perl Artistic-2.0 Beerware BlueOak-1.0.0 BSD-1-Clause BSD-2-Clause BSD-2-Clause-Patent BSD-3-Clause BSD-3-Clause-Clear BSD-3-Clause-LBNL BSD-4-Clause
    BSD-4-Clause-UC BSD-Source-Code BSL-1.0 BUSL-1.1 bzip2-1.0.6 CAL-1.0 CC-BY-1.0 CC-BY-2.0 CC-BY-2.5 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-2.0 CC-BY-NC-3.0 CC-BY-NC-4.0 CC-BY-NC-ND-3.0
    CC-BY-NC-ND-4.0 CC-BY-NC-SA-3.0 CC-BY-NC-SA-4.0 CC-BY-ND-3.0 CC-BY-ND-4.0 CC-BY-SA-2.0 CC-BY-SA-2.5 CC-BY-SA-3.0 CC-BY-SA-4.0 CC-PDDC CC0-1.0 CDDL-1.0 CDDL-1.1 CDLA-Permissive-1.0
    CDLA-Permissive-2.0 CDLA-Sharing-1.0 CECILL-2.0 CECILL-2.1 CECILL-B CECILL-C CERN-OHL-P-2.0 CERN-OHL-S-2.0 CERN-OHL-W-2.0 ClArtistic CPAL-1.0 CPL-1.0 curl ECL-1.0 ECL-2.0 EFL-2.0
    Elastic-2.0 EPL-1.0 EPL-2.0 EUPL-1.0 EUPL-1.1 EUPL-1.2 FSFAP FTL GFDL-1.1 GFDL-1.2 GFDL-1.3 GFDL-1.3-only GFDL-1.3-or-later GPL-1.0 GPL-1.0-only GPL-1.0-or-later GPL-2.0 GPL-2.0-only
    GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later HPND ICU IJG ImageMagick Imlib2 IPL-1.0 ISC JSON LGPL-2.0 LGPL-2.0-only LGPL-2.0-or-later LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later
    LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later Libpng libtiff LPL-1.02 LPPL-1.3c MIT MIT-0 MIT-CMU MIT-Modern-Variant MPL-1.0 MPL-1.1 MPL-2.0 MPL-2.0-no-copyleft-exception MS-PL MS-RL MulanPSL-2.0
    NCSA NPL-1.1 NTP ODbL-1.0 ODC-By-1.0 OFL-1.1 OLDAP-2.8 OpenSSL OSL-1.0 OSL-2.1 OSL-3.0 PDDL-1.0 PHP-3.01 PostgreSQL PSF-2.0 Python-2.0 QPL-1.0 Ruby SISSL Sleepycat SSPL-1.0 TCL
    Unicode-3.0 Unicode-DFS-2016 Unlicense UPL-1.0 Vim W3C WTFPL X11 Xnet Zend-2.0 Zlib zlib-acknowledgement ZPL-2.0 ZPL-2.1""".split()
)

_TRIGGER = re.compile(r"(?i)licen[cs]|hereby|redistribution|unencumbered|\bCC0?\b|GPLv\d|as-is")
_SENTENCE = re.compile(r"[.;:!?]|\n\s*\n")
_TAG = re.compile(r"(?i)SPDX-License-Identifier:[ \t]*(?=[\w(])")
_TAGGED = re.compile(r"[ \t(]*([A-Za-z0-9][A-Za-z0-9.+:-]*)(?:[ \t]+(?:WITH|with)[ \t]+[A-Za-z0-9.-]+)?[ \t)]*")
_OPERATOR = re.compile(r"(?:AND|OR|and|or)\b")
_WORD = re.compile(r"\w+(?:[-.]\w+)*")
MOST_DIFFERENT = 0.25
#: Part of the most saved bytes within which wordings decide, and words of a block at most.
NEARLY, LONGEST = 0.1, 1024
LEVEL = 9


_VERSION = re.compile(r"v(?=\d)")


def _spoken(words: list[str]) -> list[str]:
    return [_VERSION.sub("", w.lower(), count=1) if w[0] in "vV" else w.lower() for w in words]


def _telling(word: str) -> bool:
    return word in NAMES or word[0].isdigit()


class Scanner:
    def __init__(self, templates: list[tuple[str, str]] = TEMPLATES):
        self.alone = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        self.known = []
        for name, text in templates:
            words = _spoken(_WORD.findall(text))
            self.known.append((name, words, set(words), {w for w in words if _telling(w)}, self.with_dictionary(words)))
        #: Words on either side of a license word: the longest template with as many words more as may differ.
        self.reach = max(40, *(math.ceil(len(words) * (1 + MOST_DIFFERENT)) for _, words, *_ in self.known))

    def with_dictionary(self, words: list[str]) -> zstandard.ZstdCompressor:
        data = zstandard.ZstdCompressionDict(" ".join(words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False)

    def ranked(self, said: list[str]) -> list[tuple[int, int]]:
        """Bytes that each template saves of a block, and its number, most first; of equal ones the longer template.

        None is left out: amid text that repeats itself a short notice saves next to nothing.
        """
        raw = " ".join(said).encode()
        plain = len(self.alone.compress(raw))
        saved = [(plain - len(own.compress(raw)), i) for i, (*_, own) in enumerate(self.known)]
        return sorted(saved, key=lambda x: (-x[0], -len(self.known[x[1]][1]), x[1]))

    def blocks(self, text: str, words: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
        """Runs of words (first, behind the last) around license words, merged where they meet; long ones cut into overlapping parts."""
        ends, run = [b for _, b in words], None
        for m in _TRIGGER.finditer(text):
            i = bisect_right(ends, m.start())
            lo, hi = max(0, i - self.reach), min(len(words), i + 1 + self.reach)
            if run and lo <= run[1]:
                run = (run[0], hi)
            else:
                if run:
                    yield from self.parts(*run)
                run = (lo, hi)
        if run:
            yield from self.parts(*run)

    def parts(self, lo: int, hi: int) -> Iterator[tuple[int, int]]:
        """Every notice of a run lies whole in one of its parts."""
        while hi - lo > LONGEST:
            yield lo, lo + LONGEST
            lo += LONGEST - self.reach
        yield lo, hi

    def places(self, block: list[str], words: list[str], known: set[str]) -> Iterator[tuple[int, int]]:
        """Runs of the block outside of which the template can't be: any place of it holds enough of its words."""
        size = min(len(block), int(len(words) * (1 + MOST_DIFFERENT)))
        least = math.ceil(len(words) * (1 - MOST_DIFFERENT))
        seen = [0, *accumulate(w in known for w in block)]
        run = None
        for i in range(len(block) - size + 1):
            if seen[i + size] - seen[i] >= least:
                if run and i <= run[1]:
                    run = (run[0], i + size)
                else:
                    if run:
                        yield run
                    run = (i, i + size)
        if run:
            yield run

    def confirm(self, block: list[str], template: list[str]) -> tuple[int, int, list[str]] | None:
        """First and last block word of the template's best alignment, and the differing words."""
        matches = [m for m in SequenceMatcher(None, block, template, autojunk=False).get_matching_blocks() if m.size]
        if not matches:
            return None
        longest = max(matches, key=lambda m: m.size)
        near = [m for m in matches if abs((m.a - m.b) - (longest.a - longest.b)) <= len(template)]
        # The run of matches with most words matched and fewest between; text around may hold a missing word.
        best = score = at = 0
        tight = near
        for i, m in enumerate(matches):
            gap = m.a - matches[i - 1].a - matches[i - 1].size if i else 0
            if score <= gap:
                score, at = 0, i
            else:
                score -= gap
            score += m.size
            if score > best:
                best, tight = score, matches[at : i + 1]
        return self._judged(block, template, tight) or self._judged(block, template, near)

    def _judged(self, block: list[str], template: list[str], near: list) -> tuple[int, int, list[str]] | None:
        first, last = near[0].a, near[-1].a + near[-1].size
        there = {i for m in near for i in range(m.b, m.b + m.size)}
        missing = [w for i, w in enumerate(template) if i not in there]
        used = {i for m in near for i in range(m.a, m.a + m.size)}
        extra = [block[i] for i in range(first, last) if i not in used]
        if any(map(_telling, missing)) or not OTHERS.isdisjoint(extra) or len(missing) + len(extra) > MOST_DIFFERENT * len(template):
            return None
        return first, last, [f"-{w}" for w in missing] + [f"+{w}" for w in extra]

    def tags(self, text: str) -> Iterator[dict]:
        """The identifiers of SPDX tags; the first one's span begins with its tag."""
        for tag in _TAG.finditer(text):
            start, at = tag.start(), tag.end()
            while m := _TAGGED.match(text, at):
                if m[1].removesuffix("+") in SPDX or m[1].startswith(("LicenseRef-", "DocumentRef-")):
                    yield {"license": m[1], "start": start, "end": m.end(1), "reduction": None, "differences": []}
                more = _OPERATOR.match(text, m.end())
                following = more and _TAGGED.match(text, more.end())
                if not following:
                    break
                start, at = following.start(1), more.end()

    def denied(self, text: str, words: list[tuple[int, int]], said: list[str], first: int, differences: list[str]) -> bool:
        """Whether a negation stands in a notice, or before it in its sentence."""
        if any(d[0] == "+" and d[1:] in DENIALS for d in differences):
            return True
        if said[first] in BEGINS and text[words[first][0]].isupper():
            return False
        for i in range(first - 1, -1, -1):
            if _SENTENCE.search(text, words[i][1], words[i + 1][0]) or said[i] not in BETWEEN:
                return i >= 0 and said[i] in DENIALS and not _SENTENCE.search(text, words[i][1], words[i + 1][0])
        return False

    def winner(self, block: list[str]) -> tuple[int, int, int, int, list[str]] | None:
        """Template, bytes saved, place and differing words of the first template in rank whose wording is confirmed; of those that save nearly as much, of the one with fewest differing words."""
        there, least, found = set(block), None, []
        for saved, number in self.ranked(block):
            if least is not None and saved < least:
                break
            _, template, known, telling, _ = self.known[number]
            if not telling <= there:
                continue
            # Of several places in the block the one with fewest differences.
            places = [(len(c[2]), p + c[0], p + c[1], c[2]) for p, q in self.places(block, template, known) if (c := self.confirm(block[p:q], template))]
            if places:
                n, first, last, differences = min(places)
                found.append((n, -saved, -len(template), number, first, last, differences))
                least = saved - max(1.0, NEARLY * saved) if least is None else least
        if not found:
            return None
        _, saved, _, number, first, last, differences = min(found)
        return number, -saved, first, last, differences

    def scan(self, text: str) -> list[dict]:
        if not _TRIGGER.search(text):
            return []
        words = [m.span() for m in _WORD.finditer(text)]
        said = _spoken([text[x:y] for x, y in words])
        todo, found = list(self.blocks(text, words)), []
        while todo:
            lo, hi = todo.pop()
            best = self.winner(said[lo:hi])
            if best:
                number, saved, first, last, differences = best
                first, last = lo + first, lo + last
                if not self.denied(text, words, said, first, differences):
                    found.append((-len(self.known[number][1]), first, last, number, saved, differences))
                # What stands before and after may hold another notice.
                todo += [(p, q) for p, q in ((lo, first), (last, hi)) if p < q and _TRIGGER.search(text, words[p][0], words[q - 1][1])]
        # Parts overlap, so that a notice may have been found twice, or cut.
        taken, out = [], list(self.tags(text))
        for _, first, last, number, saved, differences in sorted(found, key=lambda f: f[:4]):
            if not any(first < y and x < last for x, y in taken):
                taken.append((first, last))
                raw = len(" ".join(said[first:last]))
                out.append({"license": self.known[number][0], "start": words[first][0], "end": words[last - 1][1], "reduction": saved / raw, "differences": differences})
        return sorted(out, key=lambda m: (m["start"], m["end"]))


MATCHES = "doc_id long, matches array<struct<license: string, start: int, end: int, reduction: double, differences: array<string>>>"
TYPE = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("reduction", pa.float64()), ("differences", pa.list_(pa.string()))]))


def license_scan(docs: DataFrame) -> DataFrame:
    """doc_id and the confirmed notices of every row of ``docs(doc_id, text)``, with spans in code points."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for b in batches:
            found = [scanner.scan(t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, TYPE)], ["doc_id", "matches"])

    return docs.select("doc_id", "text").mapInArrow(made, MATCHES)
