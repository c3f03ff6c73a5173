"""License notices amid other text."""

from __future__ import annotations

import random
import textwrap

from forkwise.llm import license_scan

LEGAL = "the party shall this agreement license terms conditions work under of any such use is subject to licensed software permitted provided that source form copyright holder and or in by public may not be used except with law general notice rights version distribution".split()


def names(text):
    return {m["license"] for m in license_scan.Scanner().scan(text)}


def test_short_notices_amid_legal_prose():
    scanner = license_scan.Scanner()
    for notice, name in (("Licensed under CC BY 4.0.", "CC-BY-4.0"), ("Released under the MIT License.", "MIT"), ("Licensed under the Apache License, Version 2.0.", "Apache-2.0")):
        for seed in range(150):
            rng = random.Random(seed)
            prose = [rng.choice(LEGAL) for _ in range(80)]
            text = " ".join([*prose[:40], notice, *prose[40:]])
            assert name in {m["license"] for m in scanner.scan(text)}, (notice, seed)


def wrapped(text, mark, width=60):
    return "\n".join(mark + line for line in textwrap.wrap(text, width))


GPL = "This file is part of Thing. Thing is free software: you can redistribute it and/or modify it under the terms of the GNU {} Public License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
MIT = 'Copyright (c) 2020 Someone. Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'
ISC = "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
BSD_2 = license_scan.TEMPLATES[[n for n, _ in license_scan.TEMPLATES].index("BSD-2-Clause")][1] if "BSD-2-Clause" in dict(license_scan.TEMPLATES) else "Redistribution"
BSD_3 = BSD_2 + " 3. Neither the name of Someone nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
APACHE = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'


def test_wrapped_notices():
    for text, name in (
        (GPL.format("General", 3), "GPL-3.0"), (GPL.format("General", 2), "GPL-2.0"), (GPL.format("Lesser General", "2.1"), "LGPL-2.1"), (GPL.format("Affero General", 3), "AGPL-3.0"),
        (MIT, "MIT"), (ISC, "ISC"), (BSD_2, "BSD-2-Clause"), (BSD_3, "BSD-3-Clause"), (APACHE, "Apache-2.0"),
        ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    ):
        for mark in ("", " * ", "# ", "// "):
            for width in (30, 70):
                assert names("x = 1\n" + wrapped(text, mark, width) + "\nint main;\n") == {name}, (name, mark)


def test_tags_titles_and_versions():
    scan = license_scan.Scanner().scan
    text = "// SPDX-License-Identifier: (GPL-2.0-only WITH Linux-syscall-note OR BSD-2-Clause)\nint x;"
    assert [(m["license"], text[m["start"] : m["end"]]) for m in scan(text)] == [("GPL-2.0-only", "SPDX-License-Identifier: (GPL-2.0-only"), ("BSD-2-Clause", "BSD-2-Clause")]
    assert names("                   GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n") == {"GPL-3.0"}
    assert names("under the terms of the GNU Lesser General Public License, version 2.5") == set()
    assert names("a license to talk\nabout the general public and version 3") == set()
    two = MIT + "\n\n" + wrapped(APACHE, "# ")
    assert names(two) == {"MIT", "Apache-2.0"}


def test_denied_and_made_up():
    assert names("This tool is not licensed under the GNU General Public License, version 3.") == set()
    assert names("It isn't released under the MIT License.") == set() and names("never licensed under CC BY 4.0.") == set()
    assert names("This is not mine. Released under the MIT License.") == {"MIT"}
    assert names("SPDX-License-Identifier: see the file") == set()
    assert names("SPDX-License-Identifier: LicenseRef-Own AND MIT") == {"LicenseRef-Own", "MIT"}
    assert names("# SPDX-License-Identifier: GPL-2.0+") == {"GPL-2.0+"}


def test_further_wordings():
    zlib = "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"
    for text, name in (
        (zlib, "Zlib"), ("Distributed under the Boost Software License, Version 1.0. (See accompanying file)", "BSL-1.0"),
        ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at", "EPL-2.0"),
        ("All of it comes under the Apache 2.0 license.", "Apache-2.0"), ("Use it under GPLv3 or later.", "GPL-3.0"), ("The MIT License (MIT)\n\nCopyright", "MIT"),
    ):
        assert names(text) == {name}, text


def test_every_template_wins_its_own_block():
    """All templates against blocks of all templates: each is found whole, and ranked by what it saves."""
    scanner = license_scan.Scanner()
    for name, text in license_scan.TEMPLATES:
        found = scanner.scan("Some words before. " + text + " Words behind it.")
        assert name in {m["license"] for m in found}, text
        said = license_scan._spoken(license_scan._WORD.findall(text))
        plain = len(scanner.alone.compress(" ".join(said).encode()))
        saved = [plain - len(known[4].compress(" ".join(said).encode())) for known in scanner.known]
        assert [n for n, _ in scanner.ranked(said)] == sorted(saved, reverse=True)
        best = scanner.winner(said)
        assert best[4] == [] and (scanner.known[best[0]][0] == name or text == license_scan.TEMPLATES[best[0]][1])


def test_many_notices_in_one_text():
    """A run of license words longer than a block: every notice is found once."""
    notices = [wrapped(MIT, "# ") if i % 3 == 0 else "Released under the MIT License." if i % 3 == 1 else wrapped(APACHE, " * ") for i in range(60)]
    text = "\n\nSome other words about a license stand here.\n".join(notices)
    got = license_scan.Scanner().scan(text)
    assert [m["license"] for m in got] == [("MIT", "MIT", "Apache-2.0")[i % 3] for i in range(60)]
    assert all(a["end"] <= b["start"] for a, b in zip(got, got[1:]))


def test_notice_amid_text_that_repeats_itself():
    for seed in range(20):
        rng = random.Random(seed)
        word = "".join(rng.choice("abcdehst") for _ in range(6))
        assert names((word + " ") * 150 + "\nReleased under the MIT License.") == {"MIT"}
