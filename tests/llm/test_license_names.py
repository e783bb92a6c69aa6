"""Licences that the test tables do not hold."""

import numpy as np
import pytest

from rewardseg.llm import licenses
from rewardseg.llm.license_templates import TEMPLATES

INDEX = licenses.Index(TEMPLATES)
WHOLE = {name: text for name, text, _ in TEMPLATES if len(text) > 5000}
GPL = ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU {}General Public "
       "License as published by the Free Software Foundation; either version {} of the License, or (at your option) any later "
       "version.")


def names(text):
    return [INDEX.names[r[1]] for r in licenses.scan_texts([text.encode()], INDEX)]


@pytest.mark.parametrize("text, name", [
    (GPL.format("", 2), "GPL-2.0-or-later"), (GPL.format("", 3), "GPL-3.0-or-later"),
    (GPL.format("Lesser ", "2.1"), "LGPL-2.1-or-later"), (GPL.format("Lesser ", 3), "LGPL-3.0-or-later"),
    (GPL.format("Library ", 2), "LGPL-2.0-or-later"), (GPL.format("Affero ", 3), "AGPL-3.0-or-later"),
    (GPL.format("", 3).replace("either ", "").replace(", or (at your option) any later version", ""), "GPL-3.0-only"),
    ("This work is licensed under the GNU General Public License, version 2 or later.", "GPL-2.0-or-later"),
    ("This work is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0-only"),
    *[(f"Licensed under CC {kind} {v}.", f"CC-{kind}-{v}") for kind in ("BY", "BY-SA", "BY-ND", "BY-NC-SA", "BY-NC-ND")
      for v in ("2.0", "3.0", "4.0")],
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported License.", "CC-BY-NC-SA-3.0"),
    ("Licensed under CC0 1.0", "CC0-1.0"), ("This is free and unencumbered software released into the public domain.", "Unlicense"),
    ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is "
     "available at", "EPL-2.0"), ("Licensed under the Boost Software License, Version 1.0.", "BSL-1.0"),
    ("Licensed under the BSD 2-Clause License", "BSD-2-Clause")])
def test_notices_get_their_own_name(text, name):
    assert names(f"Some words before. {text}\nSome words after it.") == [name]


def test_other_versions_and_families_get_no_wrong_name():
    for text in (GPL.format("Odd ", 3), GPL.format("", 9), "Licensed under CC BY-NC 9.0", "Licensed under the Apache License, Version 3.0"):
        assert names(text) == []


@pytest.mark.parametrize("name", sorted(WHOLE))
def test_whole_texts_are_one_span(name):
    text = WHOLE[name].strip()
    raw = f"Before. {text}\n\nAfter.".encode()
    (_, i, _, coverage, start, end), = licenses.scan_texts([raw], INDEX)
    assert INDEX.names[i] == name and coverage == 1.0 and end - start > 0.98 * len(text)


def test_short_whole_texts():
    own = {name: max((t for n, t, _ in TEMPLATES if n == name), key=len)
           for name in ("MIT", "MIT-0", "X11", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "ISC", "0BSD", "Zlib", "Unlicense")}
    for name, text in own.items():
        found = licenses.scan_texts([f"Copyright 2020 A. {text} End.".encode()], INDEX)
        assert [INDEX.names[r[1]] for r in found] == [name] and found[0][3] == 1.0, name


def test_alignment_by_rows_equals_the_loops():
    rng = np.random.default_rng(7)
    for _ in range(40):
        template = rng.integers(0, 30, 50).astype(np.uint64)
        text = template[rng.random(50) > 0.1]
        text = np.concatenate([rng.integers(0, 30, 5).astype(np.uint64), np.where(rng.random(len(text)) < 0.1, 99, text).astype(np.uint64)])
        a, b = licenses.align(template, text, -9, 14), licenses.align_rows(template, text, -9, 14)
        assert a[0] == b[0] and a[2] == b[2]
