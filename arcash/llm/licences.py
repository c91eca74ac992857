"""Licence scan by MinHash bands over overlapping text windows (operator 7).

Templates (notices and licence sentences) are classed by length: class W holds those of
W / 2 to W words. A text is read in windows of 3 W / 2 words that start every W / 2 words, so
whatever spans W words lies whole in a window. A window that holds ``contain`` of a template's
5-word shingles has Jaccard similarity of at least 1 / 8 with it; with ``bands`` bands of one
minimum hash it is retrieved with probability 1 - (7 / 8) ** bands, 0.999997 for 96. Each
retrieved template is then verified: the share of its shingles in the window, exactly.

Windows without a single template shingle cannot verify and are not hashed: one look into a
small bitmap per word. The templates are a fixed list, so the broadcast is bounded.

Templates of different licences can share most shingles (the notices of GPL, LGPL and AGPL,
two versions of a sentence): one is matched only if the window also holds a shingle that
tells it from each such other. Forms too short for a shingle are read exactly: identifiers of
SPDX-License-Identifier tags, and lines that are a licence's title and nothing else.

Defined results: null, empty and short texts hold no licence; templates of fewer than five
words have no shingle and are refused; repeated rows are reported each; a null doc_id is
carried as null; an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arcash.llm.common import ROLL, BoundedCache, mix64, read, ship, word_hash, worker_state

ship(__name__)

# FIXED VALUES: public licence notices and sentences, by SPDX name
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            "and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
            "sublicense, and/or sell copies of the Software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the "
                   "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
                   "either express or implied."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the "
            "GNU General Public License as published by the Free Software Foundation"),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the "
             "GNU Lesser General Public License as published by the Free Software Foundation"),
    ("LGPL", "This program is free software: you can redistribute it and/or modify it under the terms of the "
             "GNU Lesser General Public License as published by the Free Software Foundation"),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the "
                 "GNU Affero General Public License as published by the Free Software Foundation"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
            "fee is hereby granted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
                     "License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
                     "International License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "has waived all copyright and related or neighboring rights to this work"),
    ("CC0-1.0", "Licensed under CC0 1.0 Universal."),
    ("EPL", "This program and the accompanying materials are made available under the terms of the "
            "Eclipse Public License"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the "
             "authors be held liable for any damages arising from the use of this software."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of "
                "the software and accompanying documentation covered by this license"),
]
for _kind, _name in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
                     ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
                     ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")):
    for _version, _port in (("3.0", "Unported"), ("4.0", "International")):
        for _text in (f"Licensed under CC {_kind} {_version}.",
                      f"This work is licensed under a Creative Commons {_name} {_version} {_port} License."):
            if (f"CC-{_kind}-{_version}", _text) not in TEMPLATES:
                TEMPLATES.append((f"CC-{_kind}-{_version}", _text))
# FIXED VALUES: titles that stand alone on a line, as words, by SPDX name
TITLES = {
    "mit license": "MIT", "the mit license": "MIT", "mit license mit": "MIT", "the mit license mit": "MIT",
    "isc license": "ISC", "the isc license": "ISC", "bsd license": "BSD", "the bsd license": "BSD",
    "bsd 2 clause license": "BSD", "bsd 3 clause license": "BSD", "zlib license": "Zlib", "the zlib license": "Zlib",
    "apache license 2 0": "Apache-2.0", "apache license version 2 0": "Apache-2.0",
    "boost software license 1 0": "BSL-1.0", "boost software license version 1 0": "BSL-1.0",
    "mozilla public license 2 0": "MPL-2.0", "mozilla public license version 2 0": "MPL-2.0",
    "eclipse public license": "EPL", "the unlicense": "Unlicense", "cc0 1 0 universal": "CC0-1.0",
}
TAG = re.compile(r"spdx-license-identifier:[ \t]*([^\n]*)", re.I)
TAG_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9.+-]*")
LINE = re.compile(r"^[^\n]*(?:licen|cc0)[^\n]*$", re.I | re.M)
WORD = re.compile(r"[^\W_]+")
WIDTH = 5


def stated(text: str | None) -> Iterator[tuple[str, int]]:
    """(licence, characters before it) by tags and by lines that are a title."""
    low = (text or "").lower()
    if "spdx-license-identifier:" in low:
        for m in TAG.finditer(text):
            at, wanted = m.start(1), True
            # an expression: identifiers between operators; what follows one is a comment
            for x in re.finditer(r"[()]|[^\s()]+", m[1]):
                word = x[0]
                if word in "()":
                    continue
                if word.upper() in ("AND", "OR", "WITH"):
                    wanted = word.upper() != "WITH"    # an exception's name is no licence
                    exception = not wanted
                elif wanted and TAG_ID.fullmatch(word):
                    yield word, at + x.start()
                    wanted, exception = False, False
                elif not wanted and exception:
                    exception = False
                else:
                    break
    if "licen" in low or "cc0" in low:
        for m in LINE.finditer(text):
            if m.end() - m.start() <= 80 and (name := TITLES.get(" ".join(WORD.findall(m[0].lower())))):
                yield name, m.start()


def shingles(text: str | None) -> np.ndarray:
    """Hashes of the 5-word shingles of a text, in order."""
    cache = worker_state("licences", "words", lambda: BoundedCache(lambda w: word_hash(w.encode("utf-8", "surrogatepass"))))
    words = WORD.findall((text or "").lower())
    w = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    n = len(w) - WIDTH + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(WIDTH):
            h = h * ROLL + w[j:j + n]
        return mix64(h)


class Scanner:
    """Template sets and, by class, the templates under each band's minimum hash."""

    def __init__(self, templates: list[tuple[str, str]], bands: int, contain: float):
        self.contain, self.names = contain, [n for n, _ in templates]
        rng = np.random.default_rng(11)
        self.seeds = rng.integers(0, 2 ** 63, bands, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.sets = [np.unique(shingles(t)) for _, t in templates]
        if any(len(s) == 0 for s in self.sets):
            raise ValueError("a template needs five words at least")
        # by template, what tells it from each other licence's that holds enough of it
        self.telling: list[list[np.ndarray]] = []
        for a, s in zip(self.names, self.sets):
            rest = [s[~np.isin(s, t)] for b, t in zip(self.names, self.sets) if a != b]
            self.telling.append([r for r in rest if 0 < len(r) <= (1 - contain) * len(s) + 1e-9])
        self.classes: dict[int, dict] = {}
        for i, (s, (_, text)) in enumerate(zip(self.sets, templates)):
            size = 8
            while size < len(WORD.findall(text.lower())):
                size *= 2
            under = self.classes.setdefault(size, {})
            for band, low in enumerate(self.minima(s).tolist()):
                under.setdefault((band, low), []).append(i)
        self.every = np.unique(np.concatenate(self.sets)) if self.sets else np.zeros(0, np.uint64)
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self._low(self.every)] = True

    @staticmethod
    def _low(h: np.ndarray) -> np.ndarray:
        return (h & np.uint64((1 << 20) - 1)).astype(np.int64)

    def minima(self, h: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix64(h[None, :] * self.seeds[:, None]).min(axis=1)

    def verified(self, found: set[int], window: np.ndarray) -> list[tuple[int, float]]:
        """Templates that the window contains, with their share. One whose matched shingles
        all belong to another that matches better (another version's sentence) is left out."""
        matched = {i: self.sets[i][np.isin(self.sets[i], window)] for i in sorted(found)}
        share = {i: len(m) / len(self.sets[i]) for i, m in matched.items()}
        ok = [i for i in matched if share[i] >= self.contain
              and all(np.isin(t, matched[i]).any() for t in self.telling[i])]
        return [(i, share[i]) for i in ok
                if not any(share[j] > share[i] and np.isin(matched[i], matched[j]).all() for j in ok)]

    def scan(self, text: str | None) -> list[tuple[str, float, int]]:
        """(licence, best containment, first word of the best window or of a tag's licence or
        a title) of a whole text."""
        h = shingles(text)
        at = np.flatnonzero(self.seen[self._low(h)])
        at = at[np.isin(h[at], self.every)]
        best: dict[str, tuple[float, int]] = {}
        for name, chars in stated(text):
            if name not in best:
                best[name] = (1.0, len(WORD.findall(text[:chars].lower())))
        for size, under in self.classes.items() if len(at) else ():
            step = size // 2
            # the windows that hold one of these shingles: up to three each
            starts = np.unique(np.concatenate([at // step - j for j in range(3)]))
            for start in (starts[starts >= 0] * step).tolist():
                window = h[start:start + 3 * step - WIDTH + 1]
                if not len(window):
                    continue
                found = {i for key in enumerate(self.minima(window).tolist()) for i in under.get(key, ())}
                for i, share in self.verified(found, window):
                    held = best.get(self.names[i], (0.0, 0))
                    if (-share, start) < (-held[0], held[1]):
                        best[self.names[i]] = (share, start)
        return [(n, *best[n]) for n in sorted(best)]


FOUND = "doc_id long, licence string, containment double, start_word int"


def scan_licences(docs: DataFrame, templates: list[tuple[str, str]] | None = None, bands: int = 96,
                  contain: float = 0.8) -> DataFrame:
    """One row per document and licence found in its whole text."""
    templates = TEMPLATES if templates is None else templates

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(templates, bands, contain)
        for pdf in batches:
            out = [(d, *f) for d, t in zip(pdf["doc_id"].astype("Int64"), pdf["text"]) for f in scanner.scan(t)]
            got = pd.DataFrame(out, columns=["doc_id", "licence", "containment", "start_word"])
            yield got.astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, FOUND)


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, licence, containment, start_word over all documents."""
    return scan_licences(read(spark, sf_dir, "documents"))
