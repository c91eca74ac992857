import random
import re

import pytest

from arcash.llm import licences as L
from tests.llm.helpers import doc


def grams(t):
    w = re.findall(r"[^\W_]+", (t or "").lower())
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)]


def brute(text):
    """Licences with a template of which 80 % of shingles lie within its class's windows."""
    out = set()
    g = grams(text)
    for name, t in L.TEMPLATES:
        want, size = set(grams(t)), 8
        while size < len(grams(t)) + 4:
            size *= 2
        for s in range(0, max(1, len(g)), size // 2):
            have = set(g[s:s + 3 * size // 2 - 4]) & want
            if len(have) / len(want) >= 0.8:
                out.add((name, round(len(have) / len(want), 6), frozenset(have)))
    best = {}
    for name, share, have in out:
        if not any(s2 > share and have <= h2 for n2, s2, h2 in out if n2 != name):
            best[name] = max(best.get(name, 0), share)
    return best


def texts():
    rnd = random.Random(9)
    fill = lambda n: " ".join(rnd.choice(["lorem", "ipsum", "under", "the", "license", "of"]) for _ in range(n))
    out = [fill(rnd.randrange(0, 300)) for _ in range(20)]
    for name, t in L.TEMPLATES:
        w = t.split()
        out.append(f"{fill(rnd.randrange(0, 90))}\n{t.upper()} {fill(rnd.randrange(0, 90))}")
        if len(w) > 20:
            w[len(w) // 2] = "changed"
            out.append(fill(37) + " " + " ".join(w) + " " + fill(5))
            out.append(fill(11) + " " + " ".join(w[:len(w) // 2]))
    return out


def test_every_template_found_and_verified(spark, tables):
    rows = [doc(i, t) for i, t in enumerate(texts())]
    rows += [doc(900, None), doc(901, ""), doc(902, "MIT"), doc(903, "x y z " * 30000 + L.TEMPLATES[2][1]),
             doc(904, L.TEMPLATES[0][1]), doc(904, L.TEMPLATES[0][1])]
    got = {}
    n904 = 0
    for r in L.op7_licences(spark, tables(documents=rows)).collect():
        got.setdefault(r.doc_id, {})[r.licence] = round(r.containment, 6)
        n904 += r.doc_id == 904
    assert n904 == 2 and got[903] == {"MIT": 1.0}
    want = {i: b for i, t in enumerate(texts()) if (b := brute(t))}
    assert {k: v for k, v in got.items() if k < 900} == want and len(want) > 20
    assert L.op7_licences(spark, tables(documents=[])).collect() == []


def test_versions_are_told_apart_and_short_templates_refused():
    s = L.Scanner(L.TEMPLATES, 96, 0.8)
    assert [x[0] for x in s.scan("This work is licensed under the GNU General Public License, version 3.")] == ["GPL-3.0"]
    with pytest.raises(ValueError):
        L.Scanner([("x", "too short")], 8, 0.8)


GNU = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as "
       "published by the Free Software Foundation, either version 3 of the License, or any later version.")


@pytest.mark.parametrize("text, want", [
    (GNU.format("General Public License"), ["GPL"]),
    (GNU.format("Lesser General Public License"), ["LGPL"]),
    (GNU.format("Affero General Public License"), ["AGPL-3.0"]),
    # neither template's own shingles are there
    (GNU.format("Other General Public License"), []),
    ("This work is licensed under the GNU General Public License, version 4.", []),
    ("This work is licensed under the GNU Lesser General Public License, version 2.1.", ["LGPL-2.1"]),
    ("Licensed under CC BY-NC-SA 4.0.", ["CC-BY-NC-SA-4.0"]),
    ("Licensed under CC BY-ND 3.0.", ["CC-BY-ND-3.0"]),
    ("To the extent possible under law, Ann has waived all copyright and related or neighboring rights to this work.",
     ["CC0-1.0"]),
    ("Distributed under the Boost Software License, Version 1.0.", ["BSL-1.0"]),
    ("This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0",
     ["EPL"]),
    ("x\n// SPDX-License-Identifier: (MIT OR GPL-2.0-only WITH Linux-syscall-note) AND ISC */", ["GPL-2.0-only", "ISC", "MIT"]),
    ("a b\nMIT License\nc d", ["MIT"]),
    ("compare the MIT License", []),
])
def test_notices_told_apart_and_short_forms(text, want):
    s = L.Scanner(L.TEMPLATES, 96, 0.8)
    assert [x[0] for x in s.scan(text)] == want
    assert [x[0] for x in s.scan("lorem ipsum dolor " * 40 + "\n" + text + "\n" + "sit amet " * 50)] == want
